import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tripleframe.llm import common
from tripleframe.llm import near_dedup as near
from tripleframe.llm.exact_dedup import exact_dedup, keep_unique

from .data import clashing, docs, empty, got, words


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted(
        ((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr
    )


def test_exact_dedup_is_brute_force(spark):
    for df in (docs(spark), clashing(docs(spark))):
        want = brute_exact([(r["doc_id"], r["text"]) for r in df.collect()])
        for digest in (None, F.length(F.coalesce("text", F.lit(""))), F.lit(1)):  # weak digests: the byte check tells texts apart
            out = exact_dedup(df, digest=digest).collect()
            assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out), key=repr) == want
            assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in out)


def test_exact_dedup_of_files_keeps_locators(spark, tmp_path):
    docs(spark, repeat=False).write.parquet(f"{tmp_path}/d")
    out = got(exact_dedup(spark.read.parquet(f"{tmp_path}/d")))
    assert all(r["keep_locator"] and "#" in r["keep_locator"] for r in out)


def test_exact_dedup_of_nothing_and_filter(spark):
    assert exact_dedup(empty(spark)).count() == 0
    df = clashing(docs(spark, repeat=False))
    kept = keep_unique(df)
    assert kept.columns == df.columns
    assert kept.count() == df.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_unique_rows_are_known_by_identifier_and_text(spark):
    rows = [(1, "x"), (1, "x"), (1, "x"), (5, "copy"), (5, "alone"), (9, "copy"), (None, "copy"), (None, "no one"), (None, "no one"), (7, None), (8, "")]
    kept = keep_unique(clashing(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, "x"), (5, "alone"), (9, "copy"), (None, "no one"), (8, "")], key=repr)


def test_a_later_batch_meets_the_state(spark, tmp_path):
    """Three batches from files, against brute force over all rows so far; digests that stand for several texts, too."""
    import pytest

    batches = [[(1, "a"), (2, "b"), (3, "a"), (4, None)], [(5, "a"), (6, "c"), (7, ""), (0, "b")], [(9, "c"), (8, "d")]]
    for weak in (None, F.length(F.coalesce("text", F.lit("")))):
        seen = []
        for k, rows in enumerate(batches):
            path = f"{tmp_path}/batch-{weak is None}-{k}"
            spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
            seen += rows
            out = exact_dedup(spark.read.parquet(path), digest=weak, state=f"file://{tmp_path}/state-{weak is None}").collect()
            want = {r[0]: r for r in brute_exact(seen)}
            assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == sorted(want[i] for i, _ in rows)
    with pytest.raises(ValueError, match="Parquet"):
        exact_dedup(docs(spark), state=f"file://{tmp_path}/other")


def test_only_hit_texts_are_shuffled(spark):
    """The plan of the byte check: texts meet the hits by a broadcast, before any exchange."""
    from tripleframe.llm import exact_dedup as module

    texts = docs(spark).select("text", F.col("doc_id").alias("_dg"))
    plan = module._only_hits(texts, spark.range(3).select(F.col("id").alias("_dg")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_exact_dedup_starts_no_python_worker(spark, monkeypatch):
    df = docs(spark)
    want = brute_exact([(r["doc_id"], r["text"]) for r in df.collect()])

    def none(*_, **__):
        raise AssertionError("rows from Python take a daemon and workers of their own on each executor")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", none)
    assert sorted((tuple(r) for r in exact_dedup(df).select("doc_id", "keep_id", "group_size", "text_sha256").collect()), key=repr) == want


def test_results_outlive_another_scope(spark):
    from tripleframe.llm.common import Scratch

    held = exact_dedup(docs(spark))
    with Scratch(spark) as scratch:
        inner = near.near_dedup(docs(spark))
        n = inner.count()
    scratch.delete()
    assert held.count() == docs(spark).count() == n and not scratch.paths


def brute_near(rows, share=75):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if rows[a][0] == rows[b][0] or 100 * common >= share * (len(sets[a]) + len(sets[b]) - common):
                label[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), None if d is None else least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def check_near(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near.near_dedup(df).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr) == brute_near(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_dedup_is_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in docs(spark).collect()]
    check_near(spark, rows)


def test_near_dedup_of_a_large_group(spark):
    """Copies at all similarities around the threshold, chains, and a shared passage: more in a bucket than a block."""
    rng = np.random.default_rng(3)
    base, rows = words(7, 120), []
    for i in range(220):
        copy = list(base)
        for at in rng.integers(0, len(base), rng.integers(1, 7)):
            copy[at] = f"new{rng.integers(10**6)}"
        rows.append((i, " ".join(copy)))
    passage = words(8, 60)
    rows += [(300 + i, " ".join(passage + words(1000 + i, int(rng.integers(5, 80)), 10**6))) for i in range(120)]
    rows += [(500 + i, " ".join(words(9, 100)[i : 70 + i])) for i in range(0, 30, 3)]
    check_near(spark, rows)


def test_near_dedup_of_nothing_and_filter(spark):
    assert near.near_dedup(empty(spark)).count() == 0
    df = clashing(docs(spark, repeat=False))
    kept = near.keep_first(df)
    assert kept.columns == df.columns and kept.count() == near.near_dedup(df).filter("kept").count() < df.count()


def test_first_of_repeated_identifiers(spark):
    text = " ".join(words(1, 30))
    rows = [(1, text), (1, text), (2, text), (3, "other words"), (None, text), (None, text)]
    kept = near.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(((r["doc_id"] for r in kept.collect())), key=repr) == sorted([1, 3, None, None], key=repr)


def test_bayesian_bounds():
    bounds = near.least_matches(0.75)
    assert all(a[1] <= b[1] for a, b in zip(bounds, bounds[1:]))
    n, least = bounds[-1]
    assert least / n < 0.75 < (least + 80) / n
    rng = np.random.default_rng(1)

    def pair(similarity):
        x = rng.integers(0, 60000, n).astype(np.uint16)
        return bytes(8) + x.tobytes(), bytes(8) + np.where(rng.random(n) < similarity, x, x + 1).astype(np.uint16).tobytes()

    assert all(near.survives(*pair(0.75), bounds) for _ in range(2000))
    assert not any(near.survives(*pair(0.3), bounds) for _ in range(200))


def test_short_sets_never_lose_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 36, 60).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(30, len(a))], rng.integers(0, 1 << 36, 10).astype(np.uint64)]))
        if near.linked(a.tobytes(), b.tobytes(), 75):
            assert near.perhaps_linked(near.short_set(a), near.short_set(b), len(a), len(b), 75)


def test_the_plan_of_the_rest_stays_small(spark):
    """The joins that find near copies are planned once, not again wherever the dropped documents are read."""
    for repeat, joins in ((False, 2), (True, 7)):
        out = near.keep_first(docs(spark, repeat))
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= joins


def test_the_heap_is_given_back_once_it_has_grown(spark, monkeypatch):
    called = []
    monkeypatch.setattr(common, "release", called.append)
    for share, calls in ((1.0, 0), (0.0, 1)):
        monkeypatch.setattr(common, "HEAP_SHARE", share)
        assert common.cut(spark.range(3)).count() == 3 and len(called) == calls
