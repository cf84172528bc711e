"""read_rdf and read_rdf_prefixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInput
from ..model import COLUMNS, KIND
from . import documents, lines
from .paths import LINE_FORMATS, files_of, format_of


def _local(path: Column) -> Column:
    """A file's path from its URI, local ones without their scheme."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"^file:(?://)?", "")


def scan(
    spark: SparkSession, paths: str | list[str], strict_parsing: bool = True, prefix_expansion: bool = False, file_type: str | None = None, parallel_scan: bool = True
) -> DataFrame:
    """The triple table with object_kind, filename and _pos (a struct that orders the statements of a file)."""
    by_format: dict[str, list[str]] = {}
    for file in files_of(spark, paths):
        by_format.setdefault(format_of(file, file_type), []).append(file)
    parts, whole = [], []
    for kind, files in by_format.items():
        if kind not in LINE_FORMATS:
            whole += files
            continue
        text = spark.read.option("lineSep", "\n").text(files)
        block = F.col("_metadata.file_block_start")
        text = text.select("value", F.col("_metadata.file_path").alias("_file"), block.alias("_block"))
        if not parallel_scan:
            text = text.coalesce(len(files))
        name = _local(F.col("_file"))  # for rows that ask for it, and for errors
        table = lines.statements(text, kind == "nquads", strict_parsing, keep=("_file", "_block"), file=name)
        pos = F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        parts.append(table.select(*COLUMNS, KIND, name.alias("filename"), pos.alias("_pos")))
    if whole:
        table = documents.scan(spark, whole, file_type, strict_parsing, prefix_expansion)
        pos = F.struct(F.lit(0).cast("bigint").alias("block"), F.col("_pos").alias("row"))
        parts.append(table.select(*COLUMNS, KIND, F.col("_path").alias("filename"), pos.alias("_pos")))
    return reduce(DataFrame.unionByName, parts)


def read_rdf(
    spark: SparkSession,
    paths: str | list[str],
    strict_parsing: bool = True,
    prefix_expansion: bool = False,
    file_type: str | None = None,
    filename: bool = False,
    parallel_scan: bool = True,
) -> DataFrame:
    """One row per statement: graph, subject, predicate, object, object_datatype, object_lang[, filename].

    paths: files, globs, folders or a list of them; `.gz` and `.zst` are read as they are.
    strict_parsing: a syntax error fails the query; otherwise malformed IRIs are accepted and lines or statements
    that still can't be read are left out.
    prefix_expansion: prefixed names and relative IRIs of Turtle and TriG become full IRIs.
    file_type: a format for all files, instead of their extensions.
    """
    table = scan(spark, paths, strict_parsing, prefix_expansion, file_type, parallel_scan)
    return table.select(*COLUMNS, *(["filename"] if filename else []))


def read_rdf_prefixes(spark: SparkSession, paths: str | list[str], strict_parsing: bool = True, file_type: str | None = None, filename: bool = False) -> DataFrame:
    """One row per declaration of Turtle and TriG files, in order: prefix (null for a base), uri, is_base[, filename]."""
    files = files_of(spark, paths)
    for file in files:
        kind = format_of(file, file_type)
        if kind in LINE_FORMATS:
            raise InvalidInput("read_rdf_prefixes does not support NTriples or NQuads format")
        if kind == "rdfxml":
            raise InvalidInput("read_rdf_prefixes only supports Turtle (.ttl) and TriG (.trig)")
    table = documents.directives(spark, files, file_type, strict_parsing)
    return table.select("prefix", "uri", "is_base", *([F.col("_path").alias("filename")] if filename else []))


def skipped_lines(spark: SparkSession, paths: str | list[str], strict: bool = False, file_type: str | None = None) -> DataFrame:
    """The lines of N-Triples and N-Quads files that lax reading leaves out: filename, line."""
    parts = []
    for file in files_of(spark, paths):
        kind = format_of(file, file_type)
        if kind in LINE_FORMATS:
            text = spark.read.option("lineSep", "\n").text(file).select("value", _local(F.col("_metadata.file_path")).alias("filename"))
            parts.append(lines.skipped(text, kind == "nquads", strict).select("filename", F.col("value").alias("line")))
    if not parts:
        return spark.createDataFrame([], "filename string, line string")
    return reduce(DataFrame.unionByName, parts)


def syntax_error(spark: SparkSession, paths: str | list[str], file_type: str | None = None) -> tuple[str, int, str] | None:
    """File, number and text of the first line that strict reading of line formats fails on; None if there is none.

    Called after a query has failed: it reads up to the first error of each file in order.
    """
    for file in files_of(spark, paths):
        kind = format_of(file, file_type)
        if kind not in LINE_FORMATS:
            continue
        text = spark.read.option("lineSep", "\n").text(file).select("value", F.monotonically_increasing_id().alias("_n"), F.spark_partition_id().alias("_part"))
        bad = lines.skipped(text, kind == "nquads", True).orderBy("_part", "_n").first()
        if bad is not None:
            before = text.filter((F.col("_part") < bad["_part"]) | (F.col("_part") == bad["_part"]) & (F.col("_n") < bad["_n"])).count()
            return documents.shown(file), before + 1, bad["value"]
    return None
