"""R2RML mappings in Turtle."""

from __future__ import annotations

from collections import defaultdict

from ..errors import MappingError, RdfSyntaxError
from ..model import RDF
from ..sources.turtle import Turtle
from .mapping import Mapping, PredicateObject, Reference, Term, TriplesMap, unquoted

RR = "http://www.w3.org/ns/r2rml#"


def parse(text: str, path: str = "") -> Mapping:
    """The mapping that a Turtle document describes."""
    try:
        facts = list(Turtle(text, path, expand=True).statements())
    except RdfSyntaxError as e:
        raise MappingError(f"R2RML mapping parse error: {e}") from None
    graph: dict[str, dict[str, list[tuple]]] = defaultdict(lambda: defaultdict(list))
    for _, s, p, o, datatype, lang, kind in facts:
        graph[s][p.removeprefix(RR)].append((o, datatype, lang, kind))
    ids = [s for s, ps in graph.items() if {"subjectMap", "subject", "logicalTable", "predicateObjectMap"} & ps.keys() or any(o[0] == RR + "TriplesMap" for o in ps.get(RDF + "type", ()))]
    if not ids:
        raise MappingError("R2RML mapping parse error: it has no triples map")
    return Mapping({s: _triples_map(graph, s) for s in ids})


def _one(node: dict, name: str):
    return node[name][0][0] if node.get(name) else None


def _term(node: dict, position: str) -> Term:
    """position: subject, predicate or object."""
    datatype, lang, said = _one(node, "datatype"), _one(node, "language"), _one(node, "termType")
    if node.get("constant"):
        value, dt, la, kind = node["constant"][0]
        return Term("constant", value, kind, dt, la)
    if node.get("template"):
        kind, value = "template", _one(node, "template")
    elif node.get("column"):
        kind, value = "column", unquoted(_one(node, "column"))
    else:
        raise MappingError(f"R2RML mapping parse error: a {position} map has no column, template or constant")
    literal = position == "object" and (kind == "column" or datatype or lang)
    types = {RR + "IRI": "I", RR + "BlankNode": "B", RR + "Literal": "L"}
    return Term(kind, value, types.get(said, "L" if literal else "I"), datatype, lang)


def _terms(graph: dict, node: dict, name: str, position: str) -> list:
    out = [Term("constant", v, kind, dt, lang) for v, dt, lang, kind in node.get(name, ())]
    for to, *_ in node.get(f"{name}Map", ()):
        inner = graph[to]
        if position == "object" and inner.get("parentTriplesMap"):
            conditions = [graph[j] for j, *_ in inner.get("joinCondition", ())]
            if not all(c.get("child") and c.get("parent") for c in conditions):
                raise MappingError("R2RML mapping parse error: a join condition has no child or no parent")
            joins = tuple((unquoted(_one(c, "child")), unquoted(_one(c, "parent"))) for c in conditions)
            out.append(Reference(_one(inner, "parentTriplesMap"), joins))
        else:
            out.append(_term(inner, position))
    return out


def _triples_map(graph: dict, s: str) -> TriplesMap:
    node, out = graph[s], TriplesMap(s)
    for source, *_ in node.get("logicalTable", ()):
        out.table, out.query = _one(graph[source], "tableName"), _one(graph[source], "sqlQuery")
    subjects = _terms(graph, node, "subject", "subject")
    out.subject = subjects[0] if subjects else None
    for to, *_ in node.get("subjectMap", ()):
        out.classes += [c for c, *_ in graph[to].get("class", ())]
    for to, *_ in node.get("predicateObjectMap", ()):
        pair = graph[to]
        out.pairs.append(PredicateObject(_terms(graph, pair, "predicate", "predicate"), _terms(graph, pair, "object", "object")))
    return out
