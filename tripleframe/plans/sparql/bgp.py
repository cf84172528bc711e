"""Basic graph patterns over a mapping: unfolded into flat joins of tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote as percent
from urllib.parse import unquote

from pyspark.sql import types as T

from ...functions.lexical import name, quote
from ...model import RDF, XSD
from ..mapping import Mapping, Reference, Term, TriplesMap
from ..terms import Source, datatype_of, term_sql
from ..write import source_sql
from .ast import Iri, Literal, Triple, Var
from .expressions import NUMERIC, Info

#: Combinations of triples maps that a pattern may unfold into before it is split into joins of single patterns.
MOST_COMBINATIONS = 128


@dataclass(frozen=True)
class Bound:
    """A term in a row: a term map over a table at hand, or a constant."""

    kind: str
    datatype: str | None
    lang: str | None
    term: Term | None = None
    source: Source | None = None
    value: str | None = None

    @property
    def sql(self) -> str:
        return quote(self.value) if self.term is None else term_sql(self.term, self.source)

    @property
    def info(self) -> Info:
        sure = self.kind != "L" or self.term is None or self.source.schema is not None or self.term.kind != "column" or bool(self.term.datatype or self.term.lang)
        return Info(frozenset(self.kind), self.datatype, self.lang, sure)


def bound(term: Term, source: Source) -> Bound:
    if term.kind == "constant":
        return Bound(term.type, term.datatype if term.datatype != XSD + "string" else None, term.lang, value=term.value)
    return Bound(term.type, datatype_of(term, source), term.lang, term, source)


def constant(term: Iri | Literal) -> Bound:
    if isinstance(term, Iri):
        return Bound("I", None, None, value=term.value)
    return Bound("L", term.datatype, term.lang, value=term.value)


def _comparable(a: T.DataType | None, b: T.DataType | None) -> bool:
    """Whether two columns may be compared as they are."""
    if a is None or b is None:
        return False
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return a == b and not isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(a, whole) and isinstance(b, whole)


def _columns_equal(a: Source, x: str, b: Source, y: str) -> str:
    if _comparable(a.type(x), b.type(y)):
        return f"{a.sql(x)} = {b.sql(y)}"
    one = lambda s, c: term_sql(Term("column", c, "L"), s)
    return f"{one(a, x)} = {one(b, y)}"


def _column_is(source: Source, column: str, text: str, datatype: str | None = None) -> str | None:
    """A condition on a column whose lexical form is text; None if it can't be."""
    kind, raw = source.type(column), source.sql(column)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        if datatype in NUMERIC and re.fullmatch(r"[+-]?\d+(\.0*)?", text):
            text = str(int(text.split(".")[0]))
        return f"{raw} = {text}" if re.fullmatch(r"-?\d{1,18}", text) and str(int(text)) == text else None
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) and datatype in NUMERIC:
        return f"{raw} = {text}D" if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text) else None
    if isinstance(kind, T.StringType):
        return f"{raw} = {quote(text)}"
    return f"{term_sql(Term('column', column, 'L'), source)} = {quote(text)}"


def unify(a: Bound, b: Bound) -> list[str] | None:
    """Conditions under which two terms are the same; None if they never are."""
    if a.kind != b.kind or (a.lang or "").lower() != (b.lang or "").lower():
        return None
    if a.term is None and b.term is None:
        same = a.value == b.value or a.datatype in NUMERIC and b.datatype in NUMERIC and float(a.value) == float(b.value)
        return [] if same else None
    if a.term is None:
        a, b = b, a
    parts = a.term.parts
    if b.term is None:
        if a.term.kind == "column":
            found = _column_is(a.source, a.term.value, b.value, b.datatype)
            return None if found is None else [found]
        columns = a.term.columns
        ends = [p for p, is_column in (parts[0], parts[-1]) if not is_column]
        if not parts[0][1] and not b.value.startswith(parts[0][0]) or not parts[-1][1] and not b.value.endswith(parts[-1][0]):
            return None
        if len(columns) == 1:
            start = 0 if parts[0][1] else len(parts[0][0])
            end = len(b.value) - (0 if parts[-1][1] else len(parts[-1][0]))
            inner = b.value[start:end] if end >= start else None
            if inner is None:
                return None
            if a.kind == "I":
                if percent(unquote(inner), safe="-._~") != inner:
                    return None
                inner = unquote(inner)
            found = _column_is(a.source, columns[0], inner)
            return None if found is None else [found]
        return [f"{a.sql} = {b.sql}"] if ends is not None else None
    others = b.term.parts
    if a.term.kind == b.term.kind == "column":
        return [_columns_equal(a.source, a.term.value, b.source, b.term.value)]
    if [p if not c else None for p, c in parts] == [p if not c else None for p, c in others]:
        return [_columns_equal(a.source, x, b.source, y) for x, y in zip(a.term.columns, b.term.columns, strict=True)]
    for i in (0, -1):
        (p, pc), (q, qc) = parts[i], others[i]
        if not pc and not qc:
            n = min(len(p), len(q))
            if (p[:n] != q[:n]) if i == 0 else (p[-n:] != q[-n:] and n > 0):
                return None
    return [f"{a.sql} = {b.sql}"]


@dataclass
class State:
    """Tables, conditions and terms of variables of a combination."""

    tables: list[tuple[str, str]] = field(default_factory=list)
    rows: list[tuple[str, TriplesMap, Source]] = field(default_factory=list)
    conditions: dict[str, None] = field(default_factory=dict)
    bindings: dict[str, Bound] = field(default_factory=dict)

    def copy(self) -> State:
        return State(list(self.tables), list(self.rows), dict(self.conditions), dict(self.bindings))

    def match(self, said: Var | Iri | Literal, found: Bound) -> bool:
        """Bind or unify a position of a pattern; whether it is possible."""
        if found.term is not None:
            for c in found.term.columns:
                self.conditions[f"{found.source.sql(c)} IS NOT NULL"] = None
        if isinstance(said, Var):
            if said.name not in self.bindings:
                self.bindings[said.name] = found
                return True
            more = unify(self.bindings[said.name], found)
        else:
            more = unify(found, constant(said))
        if more is None:
            return False
        self.conditions |= dict.fromkeys(more)
        return True


class Bgps:
    """Unfolds patterns. unique_subjects: triples maps (or True: all) whose subjects are unique, so that patterns on
    one subject may share a row of its table instead of joining the table with itself."""

    def __init__(self, mapping: Mapping, schema_of: Callable[[TriplesMap], T.StructType | None], unique_subjects: bool | set[str] = False):
        self.mapping, self.schema_of, self.unique = mapping, schema_of, unique_subjects
        self.aliases = 0

    def source(self, m: TriplesMap) -> tuple[str, str, Source]:
        self.aliases += 1
        alias = f"t{self.aliases}"
        return alias, source_sql(m), Source(alias, self.schema_of(m), True)

    def candidates(self, t: Triple) -> list[tuple[TriplesMap, Term, Term | Reference]]:
        """Triples maps, predicates and objects that the pattern may match, by its constants."""
        out = []
        for m in self.mapping.maps.values():
            pairs = [(Term("constant", RDF + "type", "I"), Term("constant", c, "I")) for c in m.classes]
            pairs += [(p, o) for pair in m.pairs for p in pair.predicates for o in pair.objects]
            for p, o in pairs:
                if isinstance(t.predicate, Iri) and p.kind == "constant" and p.value != t.predicate.value:
                    continue
                if isinstance(o, Term) and o.kind == "constant" and not isinstance(t.object, Var) and unify(bound(o, None), constant(t.object)) is None:
                    continue
                out.append((m, p, o))
        return out

    def extend(self, state: State, t: Triple, m: TriplesMap, predicate: Term, obj: Term | Reference) -> State | None:
        out = state.copy()
        row = None
        if isinstance(t.subject, Var) and (self.unique is True or self.unique and m.id in self.unique):
            known = out.bindings.get(t.subject.name)
            row = next((s for _, other, s in out.rows if other is m and known is not None and known.source is s and known.term == m.subject), None)
        if row is None:
            alias, sql, row = self.source(m)
            out.tables.append((alias, sql))
            out.rows.append((alias, m, row))
        if not out.match(t.subject, bound(m.subject, row)) or not out.match(t.predicate, bound(predicate, row)):
            return None
        if isinstance(obj, Reference):
            parent = self.mapping.maps[obj.parent]
            there = row
            if obj.joins:
                alias, sql, there = self.source(parent)
                out.tables.append((alias, sql))
                out.rows.append((alias, parent, there))
                for child, of_parent in obj.joins:
                    out.conditions[_columns_equal(row, child, there, of_parent)] = None
            found = bound(parent.subject, there)
        else:
            found = bound(obj, row)
        return out if out.match(t.object, found) else None

    def unfold(self, triples: list[Triple]) -> list[State] | None:
        """All possible combinations; None if there are too many."""
        left = [(t, self.candidates(t)) for t in triples]
        states, seen = [State()], set()
        while left:
            # the pattern that is known best comes next: bound variables first, then few candidates
            def order(item):
                t, found = item
                joined = any(isinstance(x, Var) and x.name in seen for x in (t.subject, t.object))
                return (not joined and bool(seen), len(found))

            t, found = min(left, key=order)
            left.remove((t, found))
            seen |= {x.name for x in (t.subject, t.predicate, t.object) if isinstance(x, Var)}
            states = [new for s in states for m, p, o in found if (new := self.extend(s, t, m, p, o)) is not None]
            if len(states) > MOST_COMBINATIONS and len(triples) > 1:
                return None
        return states

    def select(self, triples: list[Triple]) -> tuple[str, dict[str, Info]] | None:
        """SQL of the distinct solutions, with columns v_<variable>; None if there are too many combinations."""
        states = self.unfold(triples)
        if states is None:
            return None
        names = list(dict.fromkeys(x.name for t in triples for x in (t.subject, t.predicate, t.object) if isinstance(x, Var)))
        if not states:
            return no_rows(names), {n: Info() for n in names}
        infos: dict[str, Info] = {}
        parts = []
        for s in states:
            columns = [f"{s.bindings[n].sql} AS {name('v_' + n)}" for n in names] or ["1 AS `_one`"]
            where = f" WHERE {' AND '.join(f'({c})' for c in s.conditions)}" if s.conditions else ""
            tables = ", ".join(f"{sql} AS {alias}" for alias, sql in s.tables)
            parts.append(f"SELECT {'DISTINCT ' if len(states) == 1 else ''}{', '.join(columns)} FROM {tables}{where}")
            for n in names:
                info = s.bindings[n].info
                infos[n] = infos[n].merged(info) if n in infos else info
        if len(parts) == 1:
            return parts[0], infos
        return f"SELECT DISTINCT * FROM ({' UNION ALL '.join(parts)})", infos


def no_rows(names: list[str]) -> str:
    columns = [f"cast(NULL AS STRING) AS {name('v_' + n)}" for n in names] or ["1 AS `_one`"]
    return f"SELECT {', '.join(columns)} WHERE false"
