"""Small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F

CLASHES = ["_id", "_text", "_u", "_h", "_n", "_set", "_sig", "_dg", "_gone", "_bad", "_mid", "_metadata", "kept", "keep_id", "copies", "rate", "shard", "slot", "score", "labels", "spans", "ids", "lang"]
SCHEMA = "doc_id bigint, text string"


def words(seed, n, pool=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def texts():
    out = [None, "", " ", "one", "two words", "Ünï cödé 🦆 text", "tab\tand\nline", "x" * 30_000, " ".join(words(1, 20_000, 5000)), "MIT License", "a" * 5, "mit license mit license"]
    out += [" ".join(words(s, 60)) for s in range(10, 20)]
    base = words(99, 80)
    out += [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in (3, 20, 50)] + [" ".join(base)] * 3
    return out


def docs(spark, repeat=True):
    rows = list(enumerate(texts()))
    if repeat:
        rows += [(5, rows[5][1]), (None, "no identifier"), (None, None), (None, "no identifier")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return [r.asDict() for r in df.collect()]
