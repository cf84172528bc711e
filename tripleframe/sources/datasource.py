"""A Python data source: spark.read.format("rdf").load(path), and SQL over it.

One partition for each file; equality filters skip statements in the reader where
spark.sql.python.filterPushdown.enabled is set. It opens files that executors see
as local ones; read_rdf() reads all that Hadoop's file systems reach, and splits
N-Triples and N-Quads, which it parses without Python.
"""

from __future__ import annotations

import glob as globs
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, IsNotNull, IsNull
from pyspark.sql.types import StringType, StructField, StructType

from ..errors import NoFilesError
from ..model import COLUMNS
from . import documents
from .paths import LINE_FORMATS, format_of


class FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def local_files(pattern: str) -> list[str]:
    """Local files by path, folder or glob."""
    pattern = pattern.removeprefix("file://").removeprefix("file:")
    found = sorted(globs.glob(os.path.join(pattern, "*") if os.path.isdir(pattern) else pattern))
    found = [f for f in found if os.path.isfile(f)]
    if not found:
        raise NoFilesError(f'IO Error: No files found that match the pattern "{pattern}"')
    return found


def file_rows(path: str, file_type: str | None, strict: bool, expand: bool) -> Iterator[tuple]:
    """The statements of a local file, of any format: N-Triples and N-Quads are read as Turtle and TriG are."""
    with open(path, "rb") as file:
        content = file.read()
    kind = format_of(path, file_type)
    if kind not in LINE_FORMATS:
        yield from (row[:6] for row in documents.parse(path, content, file_type, strict, expand))
        return
    from .ntriples import rows

    yield from rows(documents.text_of(path, documents.plain_bytes(path, content)), path, kind == "nquads", strict)


class RdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.equal: list[tuple[int, str | None]] = []
        self.absent: list[tuple[int, bool]] = []

    def flag(self, name: str, default: str) -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def partitions(self):
        return [FilePartition(f) for f in local_files(self.options["path"])]

    def read(self, partition: FilePartition):
        named = self.flag("filename", "false")
        strict, expand = self.flag("strict_parsing", "true"), self.flag("prefix_expansion", "false")
        for row in file_rows(partition.path, self.options.get("file_type"), strict, expand):
            if all(row[i] == v for i, v in self.equal) and all((row[i] is None) == null for i, null in self.absent):
                yield (*row, partition.path) if named else row


class PushingReader(RdfReader):
    """The reader of sessions where filters may be pushed down; others refuse readers that could."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in COLUMNS and isinstance(f, EqualTo):
                self.equal.append((COLUMNS.index(column), f.value))
            elif column in COLUMNS and isinstance(f, (IsNull, IsNotNull)):
                self.absent.append((COLUMNS.index(column), isinstance(f, IsNull)))
            else:
                yield f


class RdfDataSource(DataSource):
    """Options: strict_parsing, prefix_expansion, file_type, filename, pushdown."""

    @classmethod
    def name(cls) -> str:
        return "rdf"

    def schema(self) -> StructType:
        names = [*COLUMNS, *(["filename"] if str(self.options.get("filename", "false")).lower() == "true" else [])]
        return StructType([StructField(n, StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        push = str(self.options.get("pushdown", "false")).lower() == "true"
        return PushingReader(dict(self.options)) if push else RdfReader(dict(self.options))
