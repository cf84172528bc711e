"""Exact deduplication by stateful streaming, in DataFrame operations only.

Digests pass through Structured Streaming into a RocksDB state store without
expiry. For each digest the state retains the row that stays (the largest
identifier), its content locator (file and row) and the number of rows seen.
Rows whose digest was hit more than once are then compared byte by byte; should
a digest ever stand for two texts, its rows are grouped by the full text.

The state may be kept in a folder that the caller names: a later batch of
documents, from other files, then meets the digests of all earlier ones, in the
restored state, and hits are compared with the earlier texts, which are read
again at their locators.

Defined results
* null text: an empty text. Very long texts: only their digest is shuffled, the
  text itself only where its digest was hit, for the byte check, and of each
  digest a task passes on two texts at most.
* null identifiers: never stay before a row with an identifier; a group with
  nothing else keeps its rows with null.
* repeated rows (same identifier and text): one record; group_size counts
  every row; keep_unique() returns one of them.
* empty table: an empty result. Other columns, whatever their names, are ignored
  by exact_dedup() and returned untouched by keep_unique().
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, staged, staged_at, text_of

#: Hit digests at most that are broadcast, so that no other text is shuffled (32 bytes each, and Spark's table around them).
MOST_BROADCAST = 1 << 20

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every small store reserves megabytes of disk
}


def _locator(docs: DataFrame) -> Column | None:
    """File and row of each record, where the table comes straight from files."""
    if "_metadata" not in docs.columns:
        try:
            docs.select("_metadata.file_path", "_metadata.row_index")
            return F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
        except AnalysisException:
            pass
    return None


def stay_by_digest(stream: DataFrame) -> DataFrame:
    """Streaming state over (_dg, _id, _loc): the row that stays, its locator, some earlier locator and the count, by digest, without expiry."""
    return stream.groupBy("_dg").agg(
        F.max("_id").alias("_keep"), F.max_by("_loc", "_id").alias("_keep_loc"), F.min("_loc").alias("_some_loc"), F.count(F.lit(1)).alias("_n")
    )


def run_state(spark: SparkSession, schema, source: str, out: str, place: str) -> DataFrame:
    """Drain what is new in the Parquet folder `source` through the state in `place`; the state's last word on each digest."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        state = stay_by_digest(spark.readStream.schema(schema).parquet(source))
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", place)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # no createDataFrame(): even for no rows executors would start a Python daemon of its own with two workers
    empty = spark.range(0).select(*[F.lit(None).cast(c.dataType).alias(c.name) for c in state.schema])
    empty.write.mode("overwrite").parquet(f"{out}/batch=-1")
    said = spark.read.schema(state.schema).parquet(f"{out}/batch=*")
    # a later batch says again what it has changed; keep and count only grow
    return said.groupBy("_dg").agg(F.max("_keep").alias("_keep"), F.max_by("_keep_loc", "_n").alias("_keep_loc"), F.min("_some_loc").alias("_some_loc"), F.max("_n").alias("_n"))


def _at_locators(spark: SparkSession, wanted: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """_text, _dg, _id of the rows that wanted (_dg, _loc) points to, read from their files."""
    file = F.substring_index("_loc", "#", 1)
    files = [r[0] for r in wanted.select(file).distinct().collect()]  # names of files, not rows
    rows = spark.read.parquet(*files)
    return rows.select(text_of(text_col).alias("_text"), F.col(id_col).alias("_id"), _locator(rows).alias("_at")).join(wanted, F.col("_at") == F.col("_loc")).select("_text", "_dg", "_id")


def _only_hits(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows whose digest is among hits."""
    return texts.join(F.broadcast(hits) if hits.count() <= MOST_BROADCAST else hits, "_dg", "left_semi")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Column | None = None, state: str | None = None) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256, keep_locator.

    digest: another digest of the text (the tests pass a weak one); SHA-256 if not given.
    state: a folder, shared by driver and executors, in which the state lives on: keep_id and group_size count the
    documents of all calls with it. The tables must then come straight from Parquet files that stay where they are.
    """
    return _deduped(docs, id_col, text_col, digest, state).drop("_dg", "_rest")


def _deduped(docs: DataFrame, id_col: str, text_col: str, digest: Column | None = None, state: str | None = None) -> DataFrame:
    """exact_dedup(), and _dg (the digest)."""
    spark, locator = docs.sparkSession, _locator(docs)
    if state is not None and locator is None:
        raise ValueError("a state is kept only for tables that come straight from Parquet files: earlier texts are read there again")
    sha = F.unhex(F.sha2(text_of(text_col), 256))
    digest = sha if digest is None else digest
    rows = docs.select(F.col(id_col).alias("_id"), sha.alias("_sha"), digest.alias("_dg"), (F.lit(None).cast("string") if locator is None else locator).alias("_loc"))
    if state is None:
        rows, path = staged_at(rows, "dedup-digests")
        out, place = new_path(spark, "dedup-groups"), new_path(spark, "dedup-state")
    else:
        path, out, place = (f"{state.rstrip('/')}/{x}" for x in ("digests", "groups", "state"))
        rows = staged(rows, "dedup-digests")
        rows.write.mode("append").parquet(path)
    groups = staged(run_state(spark, rows.schema, path, out, place), "dedup-kept")

    hits = groups.filter("_n > 1").select("_dg", "_some_loc")
    if state is not None:  # of all that the state knows, what this batch met
        hits = staged(hits.join(rows.select("_dg").distinct(), "_dg", "left_semi"), "dedup-hits")
    texts = _only_hits(docs.select(text_of(text_col).alias("_text"), digest.alias("_dg"), F.col(id_col).alias("_id")), hits.select("_dg"))
    sides = [texts]
    if state is not None and not hits.isEmpty():
        # one earlier text of each digest: those of a digest were compared when they came
        sides.append(_at_locators(spark, hits.select("_dg", F.col("_some_loc").alias("_loc")), text_col, id_col))
    ends = reduce(DataFrame.unionByName, sides).groupBy("_dg").agg(F.min("_text").alias("_a"), F.max("_text").alias("_b"))
    torn = staged(ends.filter("_a <> _b").select("_dg"), "dedup-torn")

    good = rows.join(groups, "_dg")
    columns = ["_id", "_keep", "_n", "_sha", "_dg", "_keep_loc"]
    if not torn.isEmpty():
        own = _only_hits(texts, torn).withColumn("_sha", F.unhex(F.sha2("_text", 256)))
        every = own
        if state is not None:
            every = _at_locators(spark, spark.read.schema(rows.schema).parquet(path).join(torn, "_dg").select("_dg", "_loc"), text_col, id_col)
        by_text = every.groupBy("_dg", "_text").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        again = own.join(by_text, ["_dg", "_text"]).withColumn("_keep_loc", F.lit(None).cast("string"))
        good = good.join(torn, "_dg", "left_anti").select(columns).unionByName(again.select(columns))
    return good.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
        F.col("_keep_loc").alias("keep_locator"),
        F.col("_sha").alias("_dg"),
    )


def keep_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one of each text, with all their columns; rows are known by identifier and text."""
    all_ = staged(_deduped(docs, id_col, text_col).select(F.col(id_col).alias("_of"), F.col("_dg").alias("_sha"), "kept", "group_size"), "dedup-rows")
    told = docs.select("*", F.unhex(F.sha2(text_of(text_col), 256)).alias("_sha_of"))
    same = F.col(id_col).eqNullSafe(F.col("_of")) & (F.col("_sha_of") == F.col("_sha"))
    gone = all_.filter("not kept").select("_of", "_sha").distinct()
    twice = all_.filter("kept and group_size > 1").groupBy("_of", "_sha").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("_of", "_sha")
    twice = staged(twice, "dedup-twice")
    rest = told.join(F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone, same, "left_anti")
    if not twice.isEmpty():
        small = F.broadcast(twice) if twice.count() <= MOST_BROADCAST else twice
        rest = rest.join(small, same, "left_anti").unionByName(rest.join(small, same, "left_semi").dropDuplicates([id_col, "_sha_of"]))
    return rest.select(*[rest[c] for c in docs.columns])
