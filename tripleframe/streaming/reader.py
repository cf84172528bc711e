"""N-Triples and N-Quads as a stream.

The line expressions are row-local, so they work on streams as on tables: files that
arrive in a folder, or any streaming DataFrame with a text column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import COLUMNS
from ..sources.lines import statements


def parse_stream(lines: DataFrame, quads: bool = False, strict: bool = False, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The triple table of a stream of lines, and the columns to keep (an event time, say)."""
    return statements(lines, quads, strict, value, keep).select(*COLUMNS, *keep)


def read_rdf_stream(spark: SparkSession, folder: str, quads: bool = False, strict: bool = False, max_files: int | None = None) -> DataFrame:
    """The triples of files that arrive in a folder."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_stream(reader.text(folder), quads, strict)


def counts_by_window(triples: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Statements by predicate and event-time window; rows later than `late` behind the newest are left out."""
    return triples.withWatermark(time, late).groupBy(F.window(time, width), "predicate").agg(F.count(F.lit(1)).alias("n"))
