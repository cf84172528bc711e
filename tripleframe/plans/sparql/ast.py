"""Syntax trees of SPARQL queries."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Iri:
    value: str


@dataclass(frozen=True)
class Literal:
    value: str
    datatype: str | None = None
    lang: str | None = None


@dataclass(frozen=True)
class Path:
    """op: '/', '|', '^', '+', '*', '?' or '!' (not one of; inner: IRIs and inverse paths)."""

    op: str
    parts: tuple


@dataclass(frozen=True)
class Triple:
    subject: Var | Iri | Literal
    predicate: Var | Iri | Path
    object: Var | Iri | Literal


@dataclass(frozen=True)
class Call:
    """An operator or function by its upper-case name (operators by their sign) and its arguments."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Exists:
    group: Group
    negated: bool


@dataclass(frozen=True)
class Aggregate:
    name: str
    distinct: bool
    arg: object | None
    separator: str = " "


@dataclass
class Bgp:
    triples: list[Triple] = field(default_factory=list)


@dataclass
class Group:
    """Elements in order: Bgp, Group, Union, Optional, Minus, Filter, Bind, Values, Select."""

    elements: list = field(default_factory=list)


@dataclass
class Union:
    branches: list[Group]


@dataclass
class Optional:
    group: Group


@dataclass
class Minus:
    group: Group


@dataclass
class Filter:
    expr: object


@dataclass
class Bind:
    expr: object
    var: str


@dataclass
class Values:
    vars: list[str]
    rows: list[list]


@dataclass
class Select:
    """items: (name, expression or None); None for all variables."""

    items: list[tuple[str, object]] | None
    where: Group
    distinct: bool = False
    group_by: list[tuple[object, str | None]] = field(default_factory=list)
    having: list = field(default_factory=list)
    order_by: list[tuple[object, bool]] = field(default_factory=list)
    limit: int | None = None
    offset: int = 0
    values: Values | None = None
    ask: bool = False
