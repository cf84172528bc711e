"""Document formats (Turtle, TriG, RDF/XML): whole files, parsed on the executors.

These grammars need all that precedes a statement, so a file is one task; files
go in parallel. Use N-Triples or N-Quads where one file is large.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RdfSyntaxError
from ..model import COLUMNS, KIND
from .paths import format_of, shown
from .rdfxml import RdfXml
from .turtle import Turtle, prefixes

_ROWS = 10_000
_NAMES = [*COLUMNS, KIND, "_pos", "_path"]


def plain_bytes(path: str, content: bytes) -> bytes:
    """A file's content without its codec."""
    if path.lower().endswith(".gz"):
        return gzip.decompress(content)
    if path.lower().endswith(".zst"):
        import zstandard

        return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)).read()
    return content


def text_of(path: str, data: bytes) -> str:
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError as e:
        raise RdfSyntaxError("Invalid UTF-8", path, data.count(b"\n", 0, e.start) + 1, 0) from None


def parse(path: str, content: bytes, file_type: str | None, strict: bool, expand: bool) -> Iterator[tuple]:
    """The statements of one file (graph, subject, predicate, object, datatype, lang, kind)."""
    kind, data = format_of(path, file_type), plain_bytes(path, content)
    if kind == "rdfxml":
        return RdfXml(path).statements(data)
    return Turtle(text_of(path, data), path, kind == "trig", strict, expand).statements()


def scan(spark: SparkSession, files: list[str], file_type: str | None, strict: bool, expand: bool) -> DataFrame:
    """A triple table with object_kind, _pos (number of the statement in its file) and _path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 7 + [pa.int64(), pa.string()]
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                name, rows = shown(path.as_py()), []
                for i, row in enumerate(parse(name, content.as_py(), file_type, strict, expand)):
                    rows.append((*row, i, name))
                    if len(rows) == _ROWS:
                        yield _batch(rows, kinds)
                        rows = []
                if rows:
                    yield _batch(rows, kinds)

    schema = ", ".join(f"{n} string" for n in (*COLUMNS, KIND)) + ", _pos bigint, _path string"
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def directives(spark: SparkSession, files: list[str], file_type: str | None, strict: bool) -> DataFrame:
    """prefix, uri, is_base and _path of the declarations in Turtle and TriG files, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                name = shown(path.as_py())
                found = prefixes(text_of(name, plain_bytes(name, content.as_py())), name, format_of(name, file_type) == "trig", strict)
                columns = [[p for p, _, _ in found], [u for _, u, _ in found], [b for *_, b in found], [name] * len(found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.bool_(), pa.string()), strict=True)], ["prefix", "uri", "is_base", "_path"])

    read = spark.read.format("binaryFile").load(files).select(F.col("path"), "content")
    return read.mapInArrow(run, "prefix string, uri string, is_base boolean, _path string")
