import random
from itertools import combinations

from pyspark.sql import functions as F

from tripleframe.llm import linking
from tripleframe.llm.linking import components, connect


def brute(links):
    label = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_are_brute_force(spark):
    rng = random.Random(3)
    cases = [
        [(i + 1, i) for i in range(40)],  # a chain
        [(rng.randrange(100), rng.randrange(100)) for _ in range(70)],
        [(0, i) for i in range(1, 30)] + [(50, i) for i in range(20, 60)],
        [(10 - i, 90 + i) for i in range(10)] + [(91, 5), (5, 5)],
    ]
    for links in cases:
        df = spark.createDataFrame(links + links[:3], "_a bigint, _b bigint")
        assert {r["_node"]: r["_label"] for r in components(df).collect()} == brute(links)


def test_five_thousand_unlinked_members_of_a_bucket(spark):
    """All pairs of classes near each other are examined, in cells of bounded size, and no row is made for each."""
    n, classes = 5000, 40
    members = spark.range(n).select(F.lit(7).cast("bigint").alias("_bucket"), F.col("id").alias("_id"))
    popular = spark.range(n).select(F.col("id").alias("_id"), F.lit(1).cast("bigint").alias("_pop"), (F.col("id") % classes).cast("int").alias("_class"))
    payload = spark.range(n).select(F.col("id").alias("_id"), F.lit(b"").alias("_load"), F.lit(b"").alias("_more"))
    wanted = {(a, a + 1) for a in range(0, n - 1, 500)} | {(0, classes)}  # neighbours in the next class, and one of the same
    links = spark.createDataFrame([(a, b) for a, b in wanted], "_a bigint, _b bigint")

    def possible(bucket, left, right):
        return [(a[0], b[0]) for a in left for b in right if (min(a[0], b[0]), max(a[0], b[0])) in wanted]

    def check(pairs):
        return pairs.join(links, ["_a", "_b"])

    widths, blocks = [], []
    real = linking._met

    def watched(made, possible):
        blocks.append(made.count())
        widths.append(made.agg(F.max("_cells")).first()[0])
        return real(made, possible)

    linking._met = watched
    try:
        labels, found = connect(members, popular, payload, check, possible)
    finally:
        linking._met = real
    assert {(r["_a"], r["_b"]) for r in found.collect()} == wanted
    assert blocks[0] <= 2 * n / linking.BLOCK + 2 * classes and widths[0] <= n / classes / linking.BLOCK / linking.CELL + 1
    assert {r["_node"]: r["_label"] for r in labels.collect()} == {i: i for i in range(n)} | {b: min(a for a, c in wanted if c == b) for _, b in wanted}


def test_blocks_meet_once_and_all(spark):
    """Every pair of different labels in one group, whatever the cells."""
    rng = random.Random(1)
    seen = []
    members = [(1, i) for i in range(23)] + [(2, i) for i in range(10, 40)]
    df = spark.createDataFrame(members, "_bucket bigint, _id bigint")
    popular = spark.range(40).select(F.col("id").alias("_id"), F.lit(1).cast("bigint").alias("_pop"), F.lit(0).alias("_class"))
    payload = spark.range(40).select(F.col("id").alias("_id"), F.lit(b"").alias("_load"), F.lit(b"").alias("_more"))
    known = spark.createDataFrame([(rng.randrange(12), 12 + rng.randrange(11)) for _ in range(6)], "_a bigint, _b bigint")
    before = (linking.BLOCK, linking.CELL)
    try:
        for linking.BLOCK, linking.CELL in ((64, 16), (3, 2), (3, 1)):
            seen = []

            def check(pairs, seen=seen):
                seen.append({(r["_a"], r["_b"]) for r in pairs.collect()})
                return pairs.limit(0)

            connect(df, popular, payload, check, lambda _, a, b: [(x[0], y[0]) for x in a for y in b if x[1] != y[1]], known)
            label = {r["_node"]: r["_label"] for r in linking.labelled(popular, known).collect()}
            buckets = [[i for b, i in members if b == k] for k in (1, 2)]
            want = {(a, b) for own in buckets for a, b in combinations(own, 2) if label[a] != label[b]}
            assert seen[1] >= want
    finally:
        linking.BLOCK, linking.CELL = before
