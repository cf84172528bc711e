"""Turtle and TriG: a tokenizer and a recursive-descent parser that yields statements as it reads.

Statements are tuples (graph, subject, predicate, object, datatype, lang, kind).
Unless names are expanded, prefixed names and relative IRIs stay as written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

from ..errors import RdfSyntaxError
from ..model import RDF, XSD

_NAME_START = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02ff\u0370-\u037d\u037f-\u1fff\u200c-\u200d\u2070-\u218f\u2c00-\u2fef\u3001-\ud7ff\uf900-\ufdcf\ufdf0-\ufffd\U00010000-\U000effff"
_NAME = _NAME_START + "_0-9\u00b7\u0300-\u036f\u203f-\u2040-"
_LOCAL_ESCAPE = r"\\[_~.\-!$&'()*+,;=/?#@%]"
_PREFIX = rf"(?:[{_NAME_START}](?:[{_NAME}.]*[{_NAME}])?)?"
_LOCAL = rf"(?:(?:[{_NAME}:]|%[0-9A-Fa-f]{{2}}|{_LOCAL_ESCAPE})(?:(?:[{_NAME}.:]|%[0-9A-Fa-f]{{2}}|{_LOCAL_ESCAPE})*(?:[{_NAME}:]|%[0-9A-Fa-f]{{2}}|{_LOCAL_ESCAPE}))?)?"

_TOKEN = re.compile(
    r"(?P<skip>(?:[ \t\r\n]+|#[^\n\r]*)+)"
    r"|(?P<iri><[^<>\"{}|^`\\\x00-\x20]*(?:\\[uU][0-9A-Fa-f]{4,8}[^<>\"{}|^`\\\x00-\x20]*)*>)"
    r"|(?P<string>\"\"\"(?:\"{0,2}(?:[^\"\\]|\\.))*\"\"\"|'''(?:'{0,2}(?:[^'\\]|\\.))*'''|\"(?:[^\"\\\n\r]|\\.)*\"|'(?:[^'\\\n\r]|\\.)*')"
    rf"|(?P<blank>_:[{_NAME}](?:[{_NAME}.]*[{_NAME}])?)"
    r"|(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))"
    r"|(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)"
    r"|(?P<mark>\^\^|[.;,\[\](){}])"
    rf"|(?P<name>{_PREFIX}:{_LOCAL})"
    r"|(?P<word>[A-Za-z]+)",
    re.DOTALL,
)
_LAX_IRI = re.compile(r"<[^>\n]*>")
_ESCAPES = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


class Turtle:
    """One document. trig: graph blocks are allowed. strict: IRIs must be well formed; otherwise a broken statement is skipped."""

    def __init__(self, text: str, file: str = "", trig: bool = False, strict: bool = True, expand: bool = False, resolve_base: bool = True):
        self.text, self.file, self.trig, self.strict, self.expand, self.resolve_base = text, file, trig, strict, expand, resolve_base
        self.at, self.kind, self.value, self.start = 0, "", "", 0
        self.prefixes: dict[str, str] = {}
        self.base = ""
        self.graph: str | None = None
        self.fresh = 0
        self.skipped = 0
        self.directives: list[tuple[str | None, str, bool]] = []
        self.out: list[tuple] = []
        self.labels: set[str] | None = None

    # tokens

    def fail(self, what: str = "Invalid syntax", at: int | None = None):
        at = self.start if at is None else at
        line = self.text.count("\n", 0, at) + 1
        raise RdfSyntaxError(what, self.file, line, at - self.text.rfind("\n", 0, at))

    def next(self) -> None:
        text, at = self.text, self.at
        while True:
            if at >= len(text):
                self.kind, self.value, self.start, self.at = "end", "", at, at
                return
            m = _TOKEN.match(text, at)
            if m is None:
                if not self.strict and (m := _LAX_IRI.match(text, at)):
                    self.kind, self.value, self.start, self.at = "iri", m[0], at, m.end()
                    return
                self.fail(at=at)
            if m.lastgroup != "skip":
                self.kind, self.value, self.start, self.at = m.lastgroup, m[0], at, m.end()
                return
            at = m.end()

    def take(self, value: str) -> None:
        if self.value != value or self.kind not in ("mark", "word"):
            self.fail()
        self.next()

    def decoded(self, text: str) -> str:
        if "\\" not in text:
            return text

        def one(m: re.Match) -> str:
            if m[3] is not None:
                if m[3] not in _PLAIN:
                    self.fail("Invalid escape")
                return _PLAIN[m[3]]
            code = int(m[1] or m[2], 16)
            if code > 0x10FFFF:
                self.fail("Invalid escape")
            return chr(code)

        return _ESCAPES.sub(one, text)

    # names

    def iri(self) -> str:
        """The IRI at hand, and on to the next token."""
        if self.kind == "iri":
            out = self.decoded(self.value[1:-1])
            if self.expand:
                out = self.resolved(out)
        elif self.kind == "name":
            out = self.curie(self.value)
        else:
            self.fail()
        self.next()
        return out

    def resolved(self, iri: str) -> str:
        if not self.base or not self.resolve_base or _SCHEME.match(iri):
            return iri
        return urljoin(self.base, iri) if _SCHEME.match(self.base) and self.base.split(":")[0] in ("http", "https", "ftp", "file") else self.base + iri

    def curie(self, name: str) -> str:
        if not self.expand:
            return name
        prefix, _, local = name.partition(":")
        if prefix not in self.prefixes:
            return name
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def new_blank(self) -> str:
        if self.labels is None:
            self.labels = set(re.findall(r"_:(genid\d+)", self.text))
        while True:
            self.fresh += 1
            if (label := f"genid{self.fresh}") not in self.labels:
                return label

    # grammar

    def statements(self) -> Iterator[tuple]:
        """All statements. A broken one fails (strict) or is skipped up to the next line that ends in a full stop."""
        while True:
            mark = self.at
            try:
                if self.kind == "":
                    self.next()
                if self.kind == "end":
                    return
                mark = self.start
                self.block()
            except RdfSyntaxError:
                if self.strict:
                    raise
                self.skipped += 1
                end = re.compile(r"\.[ \t]*(?:#[^\n]*)?(?:\n|$)").search(self.text, max(mark, self.start))
                self.at, self.kind = (end.end() if end else len(self.text)), ""
                if end is None:
                    yield from self.out
                    return
            yield from self.out
            self.out = []

    def block(self) -> None:
        word = self.value.lower() if self.kind in ("word", "at") else ""
        if word in ("@prefix", "prefix"):
            self.next()
            if self.kind != "name" or self.value.partition(":")[2]:
                self.fail()
            prefix = self.value[:-1]
            self.next()
            if self.kind != "iri":
                self.fail()
            uri = self.decoded(self.value[1:-1])
            self.directives.append((prefix, uri, False))
            self.prefixes[prefix] = self.resolved(uri)
            self.next()
            if word[0] == "@":
                self.take(".")
        elif word in ("@base", "base"):
            self.next()
            if self.kind != "iri":
                self.fail()
            uri = self.decoded(self.value[1:-1])
            self.directives.append((None, uri, True))
            self.base = self.resolved(uri)
            self.next()
            if word[0] == "@":
                self.take(".")
        elif self.trig and word == "graph":
            self.next()
            self.graph_block(self.label())
        elif self.trig and self.kind == "mark" and self.value == "{":
            self.graph_block(None)
        else:
            self.triples(may_be_graph=self.trig)

    def label(self) -> str:
        if self.kind == "blank":
            out = self.value[2:]
            self.next()
            return out
        return self.iri()

    def graph_block(self, name: str | None) -> None:
        self.take("{")
        self.graph = name
        try:
            while not (self.kind == "mark" and self.value == "}"):
                self.triples(inside=True)
            self.next()
        finally:
            self.graph = None

    def triples(self, may_be_graph: bool = False, inside: bool = False) -> None:
        if self.kind == "mark" and self.value == "[":
            subject = self.blank_properties()
            if not self.ends_triples(inside):
                self.predicates(subject)
        elif self.kind == "mark" and self.value == "(":
            subject, _ = self.collection()
            self.predicates(subject)
        else:
            subject = self.label()
            if may_be_graph and self.kind == "mark" and self.value == "{":
                self.graph_block(subject)
                return
            self.predicates(subject)
        if inside and self.kind == "mark" and self.value == "}":
            return
        self.take(".")

    def ends_triples(self, inside: bool) -> bool:
        return self.kind == "mark" and (self.value == "." or inside and self.value == "}")

    def predicates(self, subject: str) -> None:
        while True:
            if self.kind == "word" and self.value == "a":
                predicate = RDF + "type"
                self.next()
            else:
                predicate = self.iri()
            while True:
                self.object(subject, predicate)
                if not (self.kind == "mark" and self.value == ","):
                    break
                self.next()
            if not (self.kind == "mark" and self.value == ";"):
                return
            while self.kind == "mark" and self.value == ";":
                self.next()
            if self.kind == "mark" and self.value in ".]}":
                return

    def emit(self, s: str, p: str, o: str, datatype: str | None, lang: str | None, kind: str) -> None:
        self.out.append((self.graph, s, p, o, datatype, lang, kind))

    def object(self, subject: str, predicate: str) -> None:
        kind, value = self.kind, self.value
        if kind in ("iri", "name"):
            self.emit(subject, predicate, self.iri(), None, None, "I")
        elif kind == "blank":
            self.next()
            self.emit(subject, predicate, value[2:], None, None, "B")
        elif kind == "mark" and value == "[":
            at = len(self.out)
            node = self.blank_properties()
            self.out.insert(at, (self.graph, subject, predicate, node, None, None, "B"))
        elif kind == "mark" and value == "(":
            at = len(self.out)
            node, is_ = self.collection()
            self.out.insert(at, (self.graph, subject, predicate, node, None, None, is_))
        else:
            self.emit(subject, predicate, *self.literal(), "L")

    def literal(self) -> tuple[str, str | None, str | None]:
        kind, value = self.kind, self.value
        self.next()
        if kind == "number":
            name = "double" if "e" in value.lower() else "decimal" if "." in value else "integer"
            return value, XSD + name, None
        if kind == "word" and value in ("true", "false"):
            return value, XSD + "boolean", None
        if kind != "string":
            self.fail()
        width = 3 if value[:3] in ('"""', "'''") and len(value) >= 6 else 1
        body = self.decoded(value[width:-width])
        if self.kind == "at":
            lang = self.value[1:]
            self.next()
            return body, None, lang
        if self.kind == "mark" and self.value == "^^":
            self.next()
            return body, self.iri(), None
        return body, None, None

    def blank_properties(self) -> str:
        self.take("[")
        node = self.new_blank()
        if not (self.kind == "mark" and self.value == "]"):
            self.predicates(node)
        self.take("]")
        return node

    def collection(self) -> tuple[str, str]:
        """The first node of a list and its kind."""
        self.take("(")
        first, node = None, None
        while not (self.kind == "mark" and self.value == ")"):
            new = self.new_blank()
            if node is None:
                first = new
            else:
                self.emit(node, RDF + "rest", new, None, None, "B")
            node = new
            self.object(node, RDF + "first")
        self.next()
        if node is None:
            return RDF + "nil", "I"
        self.emit(node, RDF + "rest", RDF + "nil", None, None, "I")
        return first, "B"


def prefixes(text: str, file: str, trig: bool, strict: bool) -> list[tuple[str | None, str, bool]]:
    """The directives of a document in order; lax reading stops at the first error and returns what it has."""
    doc = Turtle(text, file, trig, strict=True)
    try:
        for _ in doc.statements():
            pass
    except RdfSyntaxError:
        if strict:
            raise
        return doc.directives
    return doc.directives
