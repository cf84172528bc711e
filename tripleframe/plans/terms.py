"""Term maps over a table's columns, as Spark SQL text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..functions.lexical import encoded, lexical, name, quote
from ..model import xsd_of
from .mapping import Term


@dataclass(frozen=True)
class Source:
    """A table at hand: the alias of its columns and their types by name (None: not known)."""

    alias: str
    schema: T.StructType | None
    ignore_case: bool = False

    def column(self, said: str) -> str | None:
        """The actual name of a column; None if there is none. Case only matters where two names differ by it."""
        if self.schema is None or said in self.schema.names:
            return said
        found = [n for n in self.schema.names if n.lower() == said.lower()]
        return found[0] if len(found) == 1 and self.ignore_case else None

    def sql(self, said: str) -> str:
        column = self.column(said)
        if column is None:
            return "cast(NULL AS STRING)"
        return f"{self.alias}.{name(column)}" if self.alias else name(column)

    def type(self, said: str) -> T.DataType | None:
        column = self.column(said)
        if self.schema is None:
            return None
        return T.StringType() if column is None else self.schema[column].dataType


def term_sql(term: Term, source: Source, writing: bool = False) -> str:
    """The term's lexical form; null if a column is null."""
    out = []
    for said, is_column in term.parts:
        if not is_column:
            out.append(quote(said))
        else:
            text = lexical(source.sql(said), source.type(said), writing)
            out.append(encoded(text) if term.kind == "template" and term.type == "I" else text)
    return out[0] if len(out) == 1 else f"concat({', '.join(out)})" if out else "''"


def datatype_of(term: Term, source: Source) -> str | None:
    """The datatype of a literal: as said, or by its column's type."""
    if term.type != "L" or term.lang:
        return None
    if term.datatype or term.kind != "column":
        return term.datatype
    kind = source.type(term.value)
    return None if kind is None else xsd_of(kind)
