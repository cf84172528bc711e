"""Connecting records that share buckets; used by the operators on pairs.

Nothing here collects links or components: all of it is joins on narrow rows,
cut by reliable checkpoints, and the driver only asks whether a table is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lean

#: Records of a bucket that are compared with as many others at a time, and blocks on each side of a cell: what one
#: task compares without a break. A group of any size is dealt out over cells of this size.
BLOCK, CELL = 64, 16


def components(links: DataFrame) -> DataFrame:
    """_node, _label (the smallest node that it is connected with), for the nodes of links (_a, _b), of which there is one at least.

    Every node hangs on its smallest neighbour, if smaller; trees are flattened by pointer jumping and contracted to
    their roots, until no link is left between roots. So each link is joined once, later rounds see what remains.
    """
    edges = cut(links.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct())
    names = None
    while names is None or not edges.isEmpty():
        ends = edges.select(F.col("_b").alias("_node"), F.col("_a").alias("_root")).union(edges.select(F.col("_a").alias("_node"), F.col("_a").alias("_root")))
        roots = cut(ends.groupBy("_node").agg(F.min("_root").alias("_root")))
        while True:
            up = roots.select(F.col("_node").alias("_root"), F.col("_root").alias("_up"))
            jumped = cut(roots.join(up, "_root").select("_node", "_root", "_up"))
            roots = jumped.select("_node", F.col("_up").alias("_root"))
            if jumped.filter("_up <> _root").isEmpty():
                break
        if names is None:
            names = roots.select("_node", F.col("_root").alias("_label"))
        else:
            moved = roots.select(F.col("_node").alias("_label"), "_root")
            names = cut(names.join(moved, "_label", "left").select("_node", F.coalesce("_root", "_label").alias("_label")))
        to_a, to_b = (roots.select(F.col("_node").alias(c), F.col("_root").alias(f"_r{c}")) for c in ("_a", "_b"))
        between = edges.join(to_a, "_a").join(to_b, "_b").filter("_r_a <> _r_b")
        edges = cut(between.select(F.least("_r_a", "_r_b").alias("_a"), F.greatest("_r_a", "_r_b").alias("_b")).distinct())
    return names


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """The rows of keyed (_bucket, _id, ...) whose bucket has more than one, with the bucket's size as _many."""
    many = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_many")).filter("_many > 1")
    return keyed.join(many, "_bucket")


def popularity(members: DataFrame) -> DataFrame:
    """_id, _pop: how many others a record shares buckets with, buckets counted apart."""
    return members.groupBy("_id").agg(F.sum(F.col("_many") - 1).alias("_pop"))


def labelled(nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    """_node, _label of all nodes (_id): the smallest node that links connect them with, or the node itself."""
    if links is None:
        return nodes.select(F.col("_id").alias("_node"), F.col("_id").alias("_label"))
    known = components(links)
    return nodes.select("_id").join(known, F.col("_id") == F.col("_node"), "left").select(F.col("_id").alias("_node"), F.coalesce("_label", "_id").alias("_label"))


def stars(members: DataFrame) -> DataFrame:
    """The distinct pairs (_a, _b) of each bucket's hub and its others. members: _bucket, _id and, to choose the hub, _pop."""
    hubs = members.groupBy("_bucket").agg(F.max(F.struct("_pop", "_id"))["_id"].alias("_hub"))
    return members.join(hubs, "_bucket").filter("_id <> _hub").select(F.least("_id", "_hub").alias("_a"), F.greatest("_id", "_hub").alias("_b")).distinct()


def connect(
    members: DataFrame,
    popular: DataFrame,
    payload: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    possible: Callable[[int, list, list], list[tuple]],
    links: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Labels (_node, _label) of the popular records, and the links (_a, _b) found, None if there are none.

    members: _bucket (long), _id. popular: _id, _pop and _class, where records whose classes differ by more than 1 are
    never linked. payload: _id and the binary columns _load and _more. links: those that are known already.
    check: keeps those of the pairs (_a, _b) that are links.
    possible: of (bucket, records, records), records being (id, label, load, more), the pairs with different labels that
    may be links; in buckets of at most BLOCK records, whose pairs are few, more is null, in larger ones the bucket is.

    First every bucket's most popular record is compared with the bucket's others, which connects nearly all of
    a group of copies at one pair a record. Then, in buckets whose records are not all connected, the pairs between
    components are examined: blocks of records that are not of the bucket's largest component meet all blocks of
    classes near theirs. Large buckets with the same largest component are taken together, since they hold much the
    same records; their blocks are dealt out over cells. So every pair that could join two components is compared,
    without a row for each pair of a bucket.
    """
    members = members.join(popular, "_id").select("_bucket", "_id", "_pop", "_class")
    first = cut(check(cut(stars(members))))
    if not first.isEmpty():
        links = first if links is None else links.unionByName(first)
    labels = labelled(popular, links)
    open_ = cut(_unconnected(members, labels))
    if not open_.isEmpty():
        more = cut(check(cut(_met(_blocks(open_, payload), possible).distinct())))
        if not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            labels = labelled(popular, links)
    return labels, links


def _unconnected(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with several components: _group, _bucket (null in large ones), _id, _class, _label, _most (the largest component's label), _many (records of the group and class), _widest (those of the group's largest class)."""
    now = members.join(labels, F.col("_id") == F.col("_node")).select("_bucket", "_id", "_class", "_label")
    parts = now.groupBy("_bucket", "_label").agg(F.count(F.lit(1)).alias("_part"))
    largest = parts.groupBy("_bucket").agg(F.max(F.struct("_part", "_label"))["_label"].alias("_most"), F.sum("_part").alias("_many"), F.count(F.lit(1)).alias("_parts"))
    now = cut(now.join(largest.filter("_parts > 1").drop("_parts"), "_bucket"))
    small = now.filter(F.col("_many") <= BLOCK).select(F.col("_bucket").alias("_group"), "_bucket", "_id", F.lit(0).alias("_class"), "_label", "_most", "_many", F.col("_many").alias("_widest"))
    large = now.filter(F.col("_many") > BLOCK).select("_id", "_class", "_label", "_most").distinct()
    counts = large.groupBy("_most", "_class").agg(F.count(F.lit(1)).alias("_many"))
    classes = counts.groupBy("_most").agg(F.max("_many").alias("_widest"), F.map_from_entries(F.collect_list(F.struct("_class", "_many"))).alias("_of"))  # a number for each class
    large = large.join(classes, "_most").select(
        F.xxhash64("_most").alias("_group"), F.lit(None).cast("bigint").alias("_bucket"), "_id", "_class", "_label", "_most", F.col("_of")[F.col("_class")].alias("_many"), "_widest"
    )
    return small.unionByName(large)


def _blocks(now: DataFrame, payload: DataFrame) -> DataFrame:
    """_group, _bucket, _class, _other (not of the largest component), _block, _cells (of the group's largest class), _records: about BLOCK records."""
    blocks = F.ceil(F.col("_many") / BLOCK).cast("int")
    more = F.when(F.col("_bucket").isNull(), F.col("_more")).alias("_more")
    record = F.struct("_id", "_label", "_load", more).alias("_record")
    loaded = now.join(payload, "_id").select(
        "_group", "_bucket", "_class", (F.col("_label") != F.col("_most")).alias("_other"), F.pmod(F.xxhash64("_id"), blocks).cast("int").alias("_block"), F.ceil(F.col("_widest") / (BLOCK * CELL)).cast("int").alias("_cells"), record
    )
    return loaded.groupBy("_group", "_bucket", "_class", "_other", "_block", "_cells").agg(F.collect_list("_record").alias("_records"))


def _met(blocks: DataFrame, possible: Callable[[int, list, list], list[tuple]]) -> DataFrame:
    """The possible pairs (_a, _b) between blocks.

    A block of one side goes to every cell of the other side's blocks, so that a group of n blocks becomes
    (n / CELL)^2 keys, none of which holds more than CELL^2 pairs of blocks of each kind.
    """
    kind = blocks.schema["_records"].dataType.elementType["_id"].dataType.simpleString()
    near = F.explode(F.array(F.col("_class") - 1, F.col("_class"), F.col("_class") + 1))
    cells, at = F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)), (F.col("_block") / CELL).cast("int")
    left = blocks.filter("_other").select("_group", F.col("_bucket").alias("_of"), F.col("_class").alias("_from"), F.col("_block").alias("_lb"), F.col("_records").alias("_left"), at.alias("_row"), "_cells", near.alias("_to"))
    left = left.select("_group", "_of", "_from", "_to", "_lb", "_left", "_row", cells.alias("_col"))
    right = blocks.select("_group", "_bucket", F.col("_class").alias("_to"), "_other", "_block", "_records", at.alias("_col"), "_cells", near.alias("_from"))
    right = right.select("_group", "_bucket", "_from", "_to", "_other", "_block", "_records", "_col", cells.alias("_row"))
    # two blocks of others meet once: in the lower class, or lower number of one class, first
    once = ~F.col("_other") | (F.struct("_from", "_lb") <= F.struct("_to", "_block"))
    pairs = left.join(right, ["_group", "_from", "_to", "_row", "_col"]).filter(F.col("_of").eqNullSafe(F.col("_bucket")) & once).select("_bucket", "_left", "_records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for bucket, a, b in zip(*batch.columns, strict=True):
                records = [[(r["_id"], r["_label"], r["_load"], r["_more"]) for r in side.as_py()] for side in (a, b)]
                out += possible(bucket.as_py(), *records)
            ids = batch.schema.field(1).type.value_type.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in out], ids), pa.array([max(p) for p in out], ids)], ["_a", "_b"])

    return pairs.mapInArrow(lean(run), f"_a {kind}, _b {kind}")
