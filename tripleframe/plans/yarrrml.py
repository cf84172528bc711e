"""YARRRML mappings."""

from __future__ import annotations

import re

from ..errors import MappingError
from ..model import RDF
from .mapping import Mapping, PredicateObject, Reference, Term, TriplesMap

_COLUMN = re.compile(r"\$\(([^()]+)\)")


def parse(text: str, path: str = "") -> Mapping:
    """The mapping that a YARRRML document describes."""
    try:
        import yaml
    except ImportError:
        raise MappingError("YARRRML mapping parse error: PyYAML is not installed") from None
    try:
        doc = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise MappingError(f"R2RML/YARRRML mapping parse error in '{path}': {e}") from None
    if not isinstance(doc, dict) or not isinstance(doc.get("mappings") or doc.get("mapping"), dict):
        raise MappingError(f"R2RML/YARRRML mapping parse error in '{path}': it has no mappings")
    said_prefixes, sources = doc.get("prefixes") or {}, doc.get("sources") or {}
    if not isinstance(said_prefixes, dict) or not isinstance(sources, dict):
        raise MappingError(f"R2RML/YARRRML mapping parse error in '{path}': prefixes and sources must have names")
    prefixes = {"rdf": RDF, **{str(k): str(v) for k, v in said_prefixes.items()}}
    try:
        return Mapping({name: _map(str(name), said or {}, prefixes, sources) for name, said in (doc.get("mappings") or doc.get("mapping")).items()})
    except (AttributeError, IndexError, KeyError, TypeError) as e:  # lists where mappings belong, pairs of one, and the like
        raise MappingError(f"R2RML/YARRRML mapping parse error in '{path}': {e}") from None


def _get(node: dict, *names: str):
    return next((node[n] for n in names if n in node), None)


def _list(value) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def expand(said: str, prefixes: dict[str, str]) -> str:
    """A prefixed name as an IRI; anything else as it is."""
    prefix, colon, local = said.partition(":")
    return prefixes[prefix] + local if colon and prefix in prefixes and not local.startswith("//") else said


def _term(said, prefixes: dict[str, str], position: str, datatype: str | None = None, lang: str | None = None, kind: str | None = None) -> Term:
    text = str(said)
    if text.endswith("~iri"):
        text, kind = text[:-4], "iri"
    if position == "predicate" and text == "a":
        return Term("constant", RDF + "type", "I")
    columns = _COLUMN.findall(text)
    is_iri = kind == "iri" or position != "object"
    if not columns:
        full = expand(text, prefixes)
        is_iri = is_iri or position == "object" and kind is None and datatype is None and lang is None and full != text
        return Term("constant", full if is_iri else text, "B" if kind == "blank" else "I" if is_iri else "L", datatype, lang)
    if text == f"$({columns[0]})":
        return Term("column", columns[0], "I" if is_iri else "L", datatype, lang)
    text = expand(text, prefixes) if is_iri else text
    template = _COLUMN.sub(lambda m: "{" + m[1] + "}", re.sub(r"([\\{}])", r"\\\1", text))
    return Term("template", template, "I" if is_iri else "L", datatype, lang)


def _object(said, prefixes: dict[str, str], more: list) -> Term | Reference:
    if isinstance(said, dict):
        if "mapping" in said:
            joins = []
            for c in _list(_get(said, "condition", "conditions")):
                values = [p[1] if isinstance(p, list) else p.get("value") for p in c.get("parameters", ())]
                names = [m[1] for v in values if (m := _COLUMN.search(str(v)))]
                if len(names) == 2:
                    joins.append((names[0], names[1]))
            return Reference(str(said["mapping"]), tuple(joins))
        datatype, lang = said.get("datatype"), said.get("language")
        return _term(said.get("value", ""), prefixes, "object", expand(str(datatype), prefixes) if datatype else None, lang, said.get("type"))
    datatype = lang = None
    for extra in more:
        if str(extra).endswith("~lang"):
            lang = str(extra)[:-5]
        else:
            datatype = expand(str(extra), prefixes)
    return _term(said, prefixes, "object", datatype, lang)


def _map(name: str, said: dict, prefixes: dict[str, str], sources: dict) -> TriplesMap:
    if not isinstance(said, dict):
        raise TypeError(f"mapping {name} has no fields")
    out = TriplesMap(name)
    for source in _list(_get(said, "sources", "source")):
        source = sources.get(source, source) if isinstance(source, str) else source
        if isinstance(source, dict):
            out.table, out.query = source.get("table") or source.get("access"), source.get("query")
        elif isinstance(source, list) and source:
            out.table = str(source[0]).partition("~")[0]
        elif source:
            out.table = str(source)
    subjects = _list(_get(said, "s", "subject", "subjects"))
    if subjects:
        first = subjects[0]
        out.subject = _term(first.get("value"), prefixes, "subject") if isinstance(first, dict) else _term(first, prefixes, "subject")
    for pair in _list(_get(said, "po", "predicateobjects", "predicateobject")):
        if isinstance(pair, dict):
            predicates, objects, more = _list(_get(pair, "p", "predicate", "predicates")), _list(_get(pair, "o", "object", "objects")), []
            objects = [o[0] if isinstance(o, list) and len(o) == 1 else o for o in objects]
        else:
            predicates, objects, more = _list(pair[0]), _list(pair[1]), pair[2:]
        made = [_term(p, prefixes, "predicate") for p in predicates]
        if all(m.kind == "constant" and m.value == RDF + "type" for m in made):
            objects = [o if isinstance(o, (dict, list)) or o.endswith("~iri") else f"{o}~iri" for o in objects]
        out.pairs.append(PredicateObject(made, [_object(*(o[0], prefixes, o[1:]) if isinstance(o, list) else (o, prefixes, more)) for o in objects]))
    return out
