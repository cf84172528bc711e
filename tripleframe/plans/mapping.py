"""Mappings as data: what R2RML and YARRRML documents say, and whether they are valid."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from ..errors import MappingError

_PART = re.compile(r"\\(.)|\{((?:[^{}\\]|\\.)+)\}|([^{\\]+)", re.DOTALL)


@dataclass(frozen=True)
class Term:
    """A term map. kind: column, template or constant. type: I (IRI), B (blank node) or L (literal)."""

    kind: str
    value: str
    type: str
    datatype: str | None = None
    lang: str | None = None

    @property
    def parts(self) -> tuple[tuple[str, bool], ...]:
        """A template's parts: (text, False) and (column, True)."""
        if self.kind == "constant":
            return ((self.value, False),)
        if self.kind == "column":
            return ((self.value, True),)
        out: list[tuple[str, bool]] = []
        for escaped, column, text in _PART.findall(self.value):
            if column:
                out.append((unquoted(re.sub(r"\\(.)", r"\1", column)), True))
            elif out and not out[-1][1]:
                out[-1] = (out[-1][0] + (escaped or text), False)
            else:
                out.append((escaped or text, False))
        return tuple(out)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(p for p, is_column in self.parts if is_column)


@dataclass(frozen=True)
class Reference:
    """An object that is the subject of another triples map; joins: (child column, parent column)."""

    parent: str
    joins: tuple[tuple[str, str], ...]


@dataclass
class PredicateObject:
    predicates: list[Term]
    objects: list[Term | Reference]


@dataclass
class TriplesMap:
    id: str
    table: str | None = None
    query: str | None = None
    subject: Term | None = None
    classes: list[str] = field(default_factory=list)
    pairs: list[PredicateObject] = field(default_factory=list)

    @property
    def has_source(self) -> bool:
        return self.table is not None or self.query is not None

    @property
    def references(self) -> list[Reference]:
        return [o for p in self.pairs for o in p.objects if isinstance(o, Reference)]


@dataclass
class Mapping:
    maps: dict[str, TriplesMap]

    def is_valid(self) -> bool:
        """Whether it says all that full mode needs: sources, subjects and parents that exist."""
        return bool(self.maps) and all(m.has_source and m.subject is not None and all(r.parent in self.maps for r in m.references) for m in self.maps.values())

    def can_call_inside_out(self) -> bool:
        """Whether rows can be given from outside: no sources and no joins."""
        return bool(self.maps) and all(not m.has_source and m.subject is not None and not m.references for m in self.maps.values())


def unquoted(column: str) -> str:
    """A column's name without SQL quotes."""
    return column[1:-1] if len(column) > 1 and column[0] == column[-1] and column[0] in "\"`" else column


def read_text(path: str) -> str:
    """A mapping document. Mappings are small; they are read on the driver."""
    try:
        with open(path.removeprefix("file://").removeprefix("file:"), encoding="utf-8") as file:
            return file.read()
    except UnicodeDecodeError as e:
        raise MappingError(f"Mapping file '{path}' is not UTF-8: {e.reason}") from None
    except OSError:
        pass
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is not None and "://" in path:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(where):
            try:
                return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]).decode()
            except UnicodeDecodeError as e:
                raise MappingError(f"Mapping file '{path}' is not UTF-8: {e.reason}") from None
    raise MappingError(f"Mapping file not found: '{path}'")


def read_mapping(path: str) -> Mapping:
    """The mapping in a file: YARRRML by extension (.yml, .yaml, .yarrrml), R2RML in Turtle otherwise."""
    from . import r2rml, yarrrml

    text = read_text(path)
    if path.lower().endswith((".yml", ".yaml", ".yarrrml")):
        return yarrrml.parse(text, path)
    return r2rml.parse(text, path)


def is_valid_r2rml(path: str) -> bool:
    """Whether the file is a valid full mapping; false if it can't be read."""
    try:
        return read_mapping(path).is_valid()
    except MappingError:
        return False


def can_call_inside_out(path: str) -> bool:
    """Whether the file is a mapping for rows from outside; false if it can't be read or parsed, as in is_valid_r2rml()."""
    try:
        return read_mapping(path).can_call_inside_out()
    except MappingError:
        return False
