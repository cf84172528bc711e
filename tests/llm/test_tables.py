"""Operators over whole tables: sharding, mixing, images, the pipeline and the queries."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripleframe.llm import mixing, sharding

from .data import clashing, docs, empty, words


def check_shards(df, shards, together=sharding.LARGE):
    rows = {(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}
    out = sharding.shard(df, shards).collect()
    total, n = sum(r["size"] for r in out), df.count()
    assert len(out) == n and {r["law"] for r in out} <= {"bytes"} and {r["grown_shard"] for r in out} <= {None}
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by.values())
    assert all(0 <= s < shards for s in by)
    biggest = max((r["size"] for r in out), default=0)
    for s in range(shards):
        assert abs(sum(r["size"] for r in by.get(s, ())) - total / shards) <= biggest + together * total / shards + 1
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    assert sorted({(r["doc_id"], r["size"], r["text_crc32"]) for r in out}, key=repr) == want
    return out


def test_shards(spark):
    check_shards(docs(spark), 4)
    check_shards(clashing(docs(spark)), 24)
    assert sharding.shard(empty(spark), 24).count() == 0


def test_shards_with_a_hot_text_and_a_hot_row(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(words(i, rng.randrange(5, 60)))) for i in range(1500)] + [(2000 + i, "the same text") for i in range(900)] + [(7000, "the same row")] * 700
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = check_shards(df, 8)
    pairs = [(i, f"pair {i // 2} " + "y" * 40) for i in range(2000)]
    out = check_shards(spark.createDataFrame(pairs, "doc_id bigint, text string"), 8)
    where = {r["doc_id"]: r["shard"] for r in out}
    assert all(where[i] == where[i + 1] for i in range(0, 2000, 2))  # small groups of equal texts stay together


def test_groups_of_equal_texts_stay_whole(spark):
    """Few rows, so that a group is much of a shard; groups that fit into no shard's room are split."""
    for pairs in (250, 60):
        df = spark.createDataFrame([(i, f"pair {i // 2}") for i in range(2 * pairs)], "doc_id bigint, text string").repartition(3)
        out = {r["doc_id"]: r for r in sharding.shard(df, 24).collect()}
        assert all(out[i]["shard"] == out[i + 1]["shard"] for i in range(0, 2 * pairs, 2))
        sizes = [sum(r["size"] for r in out.values() if r["shard"] == s) for s in range(24)]
        assert max(sizes) - min(sizes) <= 2 * max(2 * r["size"] for r in out.values())
    sized = [(100 * g + i, f"group {g:03}") for g, n in enumerate([300, 90, 90, 80, 40, 7, 5, *[1] * 188]) for i in range(n)]
    sized = [(n, t) for n, (_, t) in enumerate(sized)]
    out = check_shards(spark.createDataFrame(sized, "doc_id bigint, text string").repartition(4), 8)
    where, text = {}, dict(sized)
    for r in out:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert {t for t, s in where.items() if len(s) > 1} <= {"group 000"}


def test_shard_of_repeated_rows(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, None), (2, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sharding.shard(df, 3).count() == len(rows)
    sharding.write_shards(df, f"{tmp_path}/r", 3)
    back = spark.read.parquet(f"{tmp_path}/r")
    assert sorted(((r[0], r[1]) for r in back.select("doc_id", "text").collect()), key=repr) == sorted(rows, key=repr)


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "OVERSAMPLE", 1)
    keys = sharding.shard.__globals__["staged"](
        spark.range(4000).select(F.col("id").alias("_id"), F.when(F.col("id") < 3000, 5).otherwise(F.xxhash64("id")).cast("bigint").alias("_h"), F.col("id").alias("_o"), F.lit(0).cast("bigint").alias("_u"), F.lit(100).cast("bigint").alias("_size")), "t"
    )
    _, _, filled = sharding.split_keys(keys, 400_000, 4, [5])
    assert sum(n for *_, n in filled) == 4000 and max(b for _, b, _ in filled) <= 3 * sharding.OVERFULL * 400_000 / 32


def test_write_shards(spark, tmp_path):
    df = docs(spark, repeat=False)
    sharding.write_shards(df, f"{tmp_path}/s", 3)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == df.count() and back.select("_shard_no").distinct().count() == 3


VOICES = {"en": ["the", "and", "of", "house"], "de": ["der", "und", "von", "haus"], "fr": ["le", "et", "de", "maison"]}


def spoken(spark, n, seed, shares=(0.7, 0.2, 0.1)):
    rng = random.Random(seed)
    langs = rng.choices(list(VOICES), shares, k=n)
    rows = [(i, " ".join(rng.choice(VOICES[x]) for _ in range(rng.randrange(5, 60))), x) for i, x in enumerate(langs)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_mix_meets_its_targets(spark):
    df = spoken(spark, 1500, 1)
    labelled = df.filter("doc_id % 3 = 0").select("doc_id", "lang")
    targets = {"en": 0.5, "de": 0.3, "fr": 0.2}
    for most in (4.0, 1.0):
        out = mixing.mix(clashing(df), labelled, targets, max_rate=most).join(df.select("doc_id", "lang"), "doc_id").cache()
        assert out.count() == 1500 and out.filter("domain = lang").count() >= 1490
        assert out.agg(F.min("rate"), F.max("rate")).first()[1] <= most
        tokens = {r["lang"]: (r["rated"], r["taken"]) for r in out.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("rate")).alias("rated"), F.sum(F.col("n_tokens") * F.col("copies")).alias("taken")).collect()}
        for k in (0, 1):
            total = sum(t[k] for t in tokens.values())
            assert all(abs(tokens[x][k] / total - w) < (0.01 if k == 0 else 0.05) for x, w in targets.items())
    taken = mixing.take(clashing(df), labelled, targets, max_rate=1.0)
    assert taken.columns == clashing(df).columns and taken.count() == out.agg(F.sum("copies")).first()[0]
    assert out.first()["target_gap"] <= mixing.TOLERANCE


def test_take_knows_rows_by_their_text(spark):
    rows = [(1, "the house"), (1, "the house"), (1, "and of"), (2, "der und"), (None, "the"), (None, "von"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labelled = spark.createDataFrame([(2, "de")], "doc_id bigint, lang string")
    taken = mixing.take(df, labelled, ["en", "de"])
    assert sorted(map(tuple, taken.collect()), key=repr) == sorted(rows, key=repr)


def test_targets_that_cannot_be_met_are_told(spark):
    df = spoken(spark, 200, 4, (1.0, 0.0, 0.0))
    out = mixing.mix(df, df.select("doc_id", "lang"), {"en": 0.5, "de": 0.5}, max_rate=1.0)
    assert out.first()["target_gap"] > 0.1
    assert 70 <= out.agg(F.sum("copies")).first()[0] <= 130  # half the budget is for the domain that is there


def test_posteriors_are_brute_force(spark):
    """The memberships against naive Bayes in plain Python."""
    import math

    df = spoken(spark, 60, 9)
    labelled = {r["doc_id"]: r["lang"] for r in df.collect() if r["doc_id"] % 2}
    domains = sorted(VOICES)
    soft = mixing.memberships(df, spark.createDataFrame(list(labelled.items()), "doc_id bigint, lang string"), domains)
    vocabulary = sorted({w for x in VOICES.values() for w in x})
    bucket = {r["w"]: r["b"] for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(mixing.BUCKETS)).alias("b")).collect()}
    counts = {d: {} for d in domains}
    for r in df.collect():
        if r["doc_id"] in labelled:
            for w in r["text"].split():
                counts[r["lang"]][bucket[w]] = counts[r["lang"]].get(bucket[w], 0) + 1
    sums = {d: sum(c.values()) for d, c in counts.items()}
    seen = {b for c in counts.values() for b in c}
    texts_ = {r["doc_id"]: r["text"].split() for r in df.collect()}
    for r in soft.collect():
        said = texts_[r["_id"]]
        scale = min(1.0, mixing.EVIDENCE / max(1, len(said)))
        logs = [
            math.log((sums[d] + 1) / (sum(sums.values()) + len(domains)))
            + scale * sum(math.log((counts[d].get(bucket[w], 0) + 0.5) / (sums[d] + 0.5 * mixing.BUCKETS)) for w in said if bucket[w] in seen)
            for d in domains
        ]
        p = np.exp(np.array(logs) - max(logs))
        assert r["_tokens"] == len(said) and np.allclose([r[f"_p{i}"] for i in range(3)], p / p.sum(), atol=1e-9)


def test_the_pipeline_mixes_without_loss(spark, tmp_path):
    import corpus_pipeline

    df = spoken(spark, 400, 3)
    df.filter("doc_id % 3 = 0").select("doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.mixed_languages(spark, df, str(tmp_path))
    assert out.columns == df.columns and sorted(out.collect()) == sorted(df.collect())
    half = mixing.mix(df, df.select("doc_id", "lang"), list(VOICES), budget=df.count() * 16.0)
    assert 0.3 < half.agg(F.avg("rate")).first()[0] < 0.7 and half.select("rate").distinct().count() == 1


def test_the_mix_decides_the_order_of_what_follows(spark, tmp_path):
    import corpus_pipeline

    df = spoken(spark, 1500, 3)
    df.filter("doc_id % 3 = 0").select("doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    corpus_pipeline.mixed_languages(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.tokens(spark, spark.read.parquet(f"{tmp_path}/mixed"), str(tmp_path))
    ordered = out.join(df.select("doc_id", "lang", F.size(F.split("text", " ")).alias("n")), "doc_id").orderBy("place").collect()
    assert len({r["place"] for r in ordered}) == len(ordered) == 1500
    whole, seen, had = sum(r["n"] for r in ordered), 0, dict.fromkeys(VOICES, 0)
    wanted = {d: corpus_pipeline.TARGETS[d] / 0.85 for d in VOICES}  # no Spanish
    for r in ordered:
        seen, had[r["lang"]] = seen + r["n"], had[r["lang"]] + r["n"]
        if 0.15 * whole < seen < 0.35 * whole:
            assert all(abs(had[d] / seen - wanted[d]) < 0.06 for d in VOICES), (seen / whole, had)


def test_mix_is_the_least_squares_solution(spark):
    """The rates against projected gradients over all rates in numpy."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.5, 0.5, 0.5], 300)
    n = rng.integers(1, 100, 300)
    soft = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(300)], "_id bigint, _tokens bigint, _p0 double, _p1 double, _p2 double")
    weights, budget = [0.2, 0.5, 0.3], float(n.sum())
    steps, start, gap = mixing.solve(soft, weights, 10.0, budget)
    rates = np.array([r[0] for r in soft.orderBy("_id").select(mixing.rate_of(steps, start, 10.0, 3)).collect()])
    assert (rates >= 0).all() and np.allclose((rates * n) @ p, np.array(weights) * budget, rtol=0.002)
    assert len(steps) < mixing.STEPS and gap <= mixing.TOLERANCE


def test_mix_edges(spark):
    df, none = docs(spark), spark.createDataFrame([], "doc_id bigint, lang string")
    out = mixing.mix(df, none, {"en": 1, "de": 1}).collect()
    assert len(out) == df.count() and all(abs(r["membership"] - 0.5) < 1e-9 for r in out)
    odd = spark.createDataFrame([(3, "xx"), (4, None), (None, "en"), (5, "en")], "doc_id bigint, lang string")
    assert mixing.mix(df, odd, {"en": 0.5, "de": 0.5}).count() == df.count()
    assert mixing.mix(df, odd, {"en": 1.0}).count() == df.count()
    assert mixing.mix(empty(spark), odd, {"en": 0.5, "de": 0.5}).count() == 0


def test_pipeline_and_queries(spark, tmp_path):
    """Each query and stage on the smallest tables, SQL where there is some."""
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    import corpus_pipeline
    from tripleframe.llm.queries import ORACLE_SQL, QUERIES

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    assert len(QUERIES) == 10
    for name, query in QUERIES.items():
        df = query(spark, str(folder))
        if name not in ORACLE_SQL:
            assert df.count() > 0
            continue
        columns = sorted(df.columns)
        found = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        want = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())
        assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == want, name
    docs_ = spark.read.parquet(f"{folder}/documents.parquet")
    now, sizes = docs_, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(folder)).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert after.columns == docs_.columns and after.join(now, "doc_id", "left_anti").count() == 0
        now = after
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0
    assert corpus_pipeline.run(spark, str(folder)).count() == sizes[-1]
