"""Sharding by sampled splitters, in DataFrame operations only.

1. One pass over the table writes narrow keys: (hash of the text, identifier,
   row number), the size in bytes and a checksum. Equal texts are neighbours.
2. A size-weighted sample of the keys gives quantile boundaries; they cut the
   key order into ranges. Ranges that turn out overfull (a text that fills many
   rows, an unlucky sample) are sampled again and subdivided.
3. Each range is one window, so that no task holds more than a range. Exact
   running sums over ranges place every row on the line of all bytes, and the
   line is cut into shards of equal length.

Law `bytes`: shards differ by little. Rows of equal texts stay in one shard,
unless they are more than a shard:
* groups of more than LARGE of a shard's bytes are placed first, the largest
  first, each whole in the shard with the most room; there are at most shards /
  LARGE of them. Those of more than a shard's bytes are split over shards.
* all others move as one along the line, which fills the room that is left; so
  shards differ by LARGE of a shard or one group or row, whatever is more.

Defined results
* null text: size 8, checksum 0. Null identifiers sort first. Repeated rows are
  rows of their own. Very long texts: one row, in one shard, as it is.
* fewer rows than shards: some shards stay empty. Empty table: empty result.
* other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import same_text, staged, text_of, unit_hash

#: Sampled keys for each range; ranges for each shard; ranges at most, which bounds what the driver holds.
OVERSAMPLE, RANGES_PER_SHARD, MAX_RANGES, RANGE_BYTES = 32, 8, 8192, 256 << 20
#: Times a range's share of the bytes from which it is subdivided, and rounds of that.
OVERFULL, ROUNDS = 2.0, 3
#: Part of a shard's bytes from which a group of equal texts is placed by itself.
LARGE = 0.01

KEY = ("_h", "_o", "_u")
_LEAST = -(1 << 63)


def _sample(keys: DataFrame, rates: dict[int, float], seed: int) -> list[tuple]:
    """Keys of these ranges, each drawn with a probability in proportion to its size: (range, key, weight), about rate x bytes of a range."""
    rate = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])[F.col("_range")] if len(rates) > 1 else F.lit(next(iter(rates.values())))
    chosen = keys.filter(F.col("_range").isin(list(rates)))
    drawn = chosen.filter(unit_hash(*KEY, seed=seed) < F.least(F.lit(1.0), F.col("_size") * rate))
    rows = drawn.select("_range", *KEY, F.greatest(F.col("_size").cast("double"), F.lit(1.0) / rate)).collect()
    return sorted((r[0], (r[1], r[2], r[3]), r[4]) for r in rows)


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """At most parts - 1 keys that cut the sample's weight evenly."""
    total, run, out = sum(w for *_, w in sample), 0.0, []
    for _, key, w in sample:
        if run and run * parts >= total * (len(out) + 1):
            out.append(key)
        run += w
    return out


def _ranged(keys: DataFrame, splitters: list[tuple]) -> DataFrame:
    """keys with _range: the number of splitters at or below the key, found by halving."""
    if not splitters:
        return keys.withColumn("_range", F.lit(0))
    cuts = F.from_json(F.lit(json.dumps([dict(zip(KEY, s, strict=True)) for s in splitters])), "array<struct<_h:bigint,_o:bigint,_u:bigint>>")
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]

    def halve(low: Column, step: Column) -> Column:
        to = low + step
        return F.when((to <= F.lit(len(splitters))) & (F.get(cuts, to - 1) <= F.struct(*KEY)), to).otherwise(low)

    return keys.withColumn("_range", F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve))


def _order(docs: DataFrame, id_col: str) -> Column:
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    o = F.col(id_col).cast("bigint") if whole else F.xxhash64(F.col(id_col))
    return F.coalesce(o, F.lit(_LEAST))


def split_keys(keys: DataFrame, total: int, shards: int, large: list[int]) -> tuple[DataFrame, list[tuple], list[tuple[int, int, int]]]:
    """keys with _range, the splitters, and (range, bytes, rows) of every range in key order.

    Splitters fall between groups of equal texts, but for those of the large ones' hashes, which have ranges of their own.
    """
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-total // RANGE_BYTES)))
    keys, own = keys.withColumn("_range", F.lit(0)), set(large)
    apart = [(h + k, _LEAST, _LEAST) for h in large for k in (0, 1) if h + k < 1 << 63]
    most, rate = OVERFULL * total / ranges, ranges * OVERSAMPLE / total

    def between(found: list[tuple]) -> list[tuple]:
        return [s if s[0] in own else (s[0], _LEAST, _LEAST) for s in found]

    splitters = sorted({*apart, *between(_quantiles(_sample(keys, {0: rate}, 1), ranges))})
    for again in range(ROUNDS + 1):
        keys = _ranged(keys, splitters)
        filled = sorted((r[0], r[1], r[2]) for r in keys.groupBy("_range").agg(F.sum("_size"), F.count(F.lit(1))).collect())
        over = [(r, b) for r, b, n in filled if b > most and n > 1]
        if not over or again == ROUNDS or len(splitters) >= 2 * MAX_RANGES:
            return keys, splitters, filled
        by_range: dict[int, list] = {}
        # as many keys for each new range as at first, so that the driver never holds more than for all ranges
        for row in _sample(keys, {r: -(-b * ranges // total) * OVERSAMPLE / b for r, b in over}, 2 + again):
            by_range.setdefault(row[0], []).append(row)
        more = {s for r, b in over for s in between(_quantiles(by_range.get(r, []), -(-b * ranges // total)))}
        if more <= set(splitters):
            return keys, splitters, filled
        splitters = sorted({*splitters, *more})
    raise AssertionError


def _placed_groups(groups: list[tuple[int, int, int]], total: int, shards: int) -> tuple[dict[int, int], list[int]]:
    """The shard of each group (hash, bytes, rows) that is no larger than one, the largest first, and the bytes that shards have left."""
    room = [total // shards + (s < total % shards) for s in range(shards)]
    most = max(room)
    where: dict[int, int] = {}
    for h, size, _ in sorted(groups, key=lambda g: (-g[1], g[0])):
        if size <= most:
            s = max(range(shards), key=lambda s: (room[s], -s))
            where[h] = s
            room[s] -= size
    return where, [max(0, r) for r in room]


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    return _sharded(docs, shards, id_col, text_col).drop("_same")


def _sharded(docs: DataFrame, shards: int, id_col: str, text_col: str) -> DataFrame:
    """shard(), and _same, which stands for the row's text."""
    spark, text = docs.sparkSession, text_of(text_col)
    keys = staged(
        docs.select(
            F.col(id_col).alias("_id"),
            F.xxhash64(text).alias("_h"),
            _order(docs, id_col).alias("_o"),
            F.monotonically_increasing_id().alias("_u"),
            (F.octet_length(text) + F.lit(8)).cast("bigint").alias("_size"),
            F.crc32(text).alias("_crc"),
            same_text(text).alias("_same"),
        ),
        "shard-keys",
    )
    total = keys.agg(F.sum("_size")).first()[0] or 0
    by_text = keys.groupBy("_h").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    large = by_text.filter((F.col("_rows") > 1) & (F.col("_bytes") > F.lit(LARGE * total / shards)))
    groups = [tuple(r) for r in large.collect()] if total else []  # shards / LARGE at most
    where, room = _placed_groups(groups, total, shards)
    on_the_line = total - sum(size for h, size, _ in groups if h in where)
    ends = [sum(room[: s + 1]) * on_the_line // max(1, sum(room)) for s in range(shards)]
    if total:
        ranged, splitters, filled = split_keys(keys, total, shards, sorted(h for h, *_ in groups))
    else:
        ranged, splitters, filled = keys.withColumn("_range", F.lit(0)), [], []
    # what comes before each range: on the line, or in the shard of the group that it belongs to
    offsets, at, rows, torn = [], 0, 0, {h for h, *_ in groups} - where.keys()
    own_rows = [0] * shards
    for r, b, n in filled:
        h = splitters[r - 1][0] if r else None
        if h in where and splitters[bisect.bisect_left(splitters, (h, _LEAST, _LEAST))][0] == h:
            offsets.append((r, 0, own_rows[where[h]], where[h], False))
            own_rows[where[h]] += n
        else:
            offsets.append((r, at, rows, None, h in torn))
            at, rows = at + b, rows + n
    offsets = F.broadcast(spark.createDataFrame(offsets, "_range int, _before long, _rows_before long, _home int, _torn boolean"))  # a row for each range
    in_order = Window.partitionBy("_range").orderBy(*KEY)
    group = Window.partitionBy("_range", "_h")
    placed = (
        ranged.withColumn("_end", F.sum("_size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_rn", F.row_number().over(in_order))
        .withColumn("_g", F.sum("_size").over(group))
        .withColumn("_g_end", F.max("_end").over(group))
        .join(offsets, "_range")
    )
    twice_mid = F.lit(2) * F.col("_before") + F.when(F.col("_torn"), 2 * F.col("_end") - F.col("_size")).otherwise(2 * F.col("_g_end") - F.col("_g"))
    cuts = F.array(*[F.lit(2 * e).cast("bigint") for e in ends[:-1]])
    on_line = F.size(F.filter(cuts, lambda e: e <= F.col("_twice")))
    placed = placed.withColumn("_twice", twice_mid).select(
        "_id", "_same", "_size", "_crc", F.col("_home").isNull().alias("_line"), (F.col("_rows_before") + F.col("_rn") - 1).alias("_rank"), F.coalesce("_home", on_line).cast("int").alias("_shard")
    )
    placed = staged(placed, "shard-placed")
    # in a shard, the groups that were placed come first
    first = placed.filter("_line").groupBy("_shard").agg(F.min("_rank").alias("_first"))
    first = F.broadcast(spark.createDataFrame(list(enumerate(own_rows)), "_shard int, _own long").join(first, "_shard", "left"))  # a row for each shard
    slot = F.when(F.col("_line"), F.col("_rank") - F.col("_first") + F.col("_own")).otherwise(F.col("_rank"))
    return placed.join(first, "_shard").select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "_same",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write docs as Parquet, a folder for each shard; rows of one identifier and text go together."""
    where = _sharded(docs, shards, id_col, text_col).groupBy(F.col(id_col).alias("_sid"), F.col("_same").alias("_st")).agg(F.min("shard").alias("_shard_no"))
    same = docs[id_col].eqNullSafe(where["_sid"]) & (same_text(text_of(text_col)) == where["_st"])
    out = docs.join(where, same).select(*[docs[c] for c in docs.columns], where["_shard_no"])
    out.write.partitionBy("_shard_no").parquet(path)
