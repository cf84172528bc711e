"""N-Triples and N-Quads in plain Python, for table functions and mixed folders; read_rdf() uses Catalyst instead."""

from __future__ import annotations

import re
from collections.abc import Iterator

from ..errors import RdfSyntaxError
from .turtle import _ESCAPES, _PLAIN

_BLANK = r"_:[^\s<>\"@^.,;]+(?:\.+[^\s<>\"@^.,;]+)*"
_STRICT = r"<(?:[^\x00-\x20<>\"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*>"


def _line(iri: str) -> re.Pattern:
    literal = rf"\"(?P<text>(?:[^\"\\\n\r]|\\.)*)\"(?:@(?P<lang>[A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^(?P<type>{iri}))?"
    return re.compile(rf"^[ \t]*(?P<s>{iri}|{_BLANK})[ \t]*(?P<p>{iri})[ \t]*(?:(?P<o>{iri}|{_BLANK})|{literal})[ \t]*(?P<g>{iri}|{_BLANK})?[ \t]*\.[ \t]*(?:#.*)?$")


_LINES = {True: _line(_STRICT), False: _line(r"<[^>\n]*>")}
_NOTHING = re.compile(r"^[ \t]*(?:#.*)?$")


def _plain(text: str | None) -> str | None:
    if text is None or "\\" not in text:
        return text
    return _ESCAPES.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[3] is None else _PLAIN.get(m[3], m[3]), text)


def _name(term: str | None) -> str | None:
    return None if term is None else _plain(term[1:-1]) if term[0] == "<" else term[2:]


def rows(text: str, file: str, quads: bool, strict: bool) -> Iterator[tuple]:
    """graph, subject, predicate, object, datatype, lang of each statement."""
    for n, line in enumerate(text.split("\n"), 1):
        line = line.rstrip("\r")
        m = _LINES[strict].match(line)
        if m is None or m["g"] and not quads:
            if strict and not _NOTHING.match(line):
                raise RdfSyntaxError("Invalid syntax", file, n, 1)
            continue
        yield (_name(m["g"]), _name(m["s"]), _name(m["p"]), _plain(m["text"]) if m["text"] is not None else _name(m["o"]), _name(m["type"]), m["lang"])
