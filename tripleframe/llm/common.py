"""Small helpers shared by the training-data operators.

Intermediate tables live in the folder that the session names in
``spark.checkpoint.dir``: executors and driver share it, so a lost executor
costs only the tasks it was running.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; one of our own only where none is set and Spark is local."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tripleframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


_ACTIVE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


class Scratch:
    """What operators leave in the shared folder while a with block of this is open; delete() removes that and nothing else.

    An operator's result is lazy and reads these tables, so delete only after it has been written. Tables that were
    made outside any block stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._before = _ACTIVE.set(self)
        return self

    def __exit__(self, *_) -> None:
        _ACTIVE.reset(self._before)

    def delete(self) -> None:
        release(self.spark)
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


def new_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder; the open Scratch, if there is one, will delete it."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    if (scratch := _ACTIVE.get()) is not None:
        scratch.paths.append(path)
    return path


def staged_at(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """staged(), and its path."""
    path = new_path(df.sparkSession, what)
    relieve(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there and readers take only the columns they need."""
    return staged_at(df, what)[0]


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles and checkpoints to which nothing refers any more, here and in the JVM, and give memory back."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: The part of its largest heap that the driver may take before memory is given back.
HEAP_SHARE = 0.5


def relieve(spark: SparkSession) -> None:
    """release(), where the driver's heap has grown beyond HEAP_SHARE: the JVM keeps what it once took, and little of it is in use between queries."""
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_SHARE * runtime.maxMemory():
        release(spark)


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """make(), which this Python worker keeps between tasks until another key is asked for.

    Workers serve one operator after another, so that what each kept for itself would add up. make()'s result must hold
    what the key names by id().
    """
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Let go of what this Python worker keeps; for operators that keep nothing themselves."""
    _KEPT.clear()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow(), giving back after each batch what Arrow would keep: workers stay, and with them what their largest batches took."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return lean_run


#: Rows of a checkpoint that are worth a partition of their own.
ROWS_A_PARTITION = 50_000


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint; Spark removes its files once nothing refers to it. Small ones have few partitions."""
    shared_dir(df.sparkSession)
    relieve(df.sparkSession)
    out = df.checkpoint()
    return out.coalesce(1 + out.count() // ROWS_A_PARTITION)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unit_hash(*columns: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that the given values decide."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) / F.lit(float(1 << 53))


def same_text(text: Column) -> Column:
    """128 bits that stand for a text where rows of one identifier must be told apart."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))


def one_of_each(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows with one row of each key; only those whose key repeats are dealt out whole."""
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").drop("_times")
    said = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in key]
    repeated = repeated.select(*[F.col(k).alias(f"_r{k}") for k in key])
    if repeated.isEmpty():
        return rows
    once = rows.join(repeated, said, "left_anti")
    return once.unionByName(rows.join(repeated, said, "left_semi").dropDuplicates(key))
