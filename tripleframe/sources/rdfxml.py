"""RDF/XML by the W3C grammar, over expat.

Statements are tuples (graph, subject, predicate, object, datatype, lang, kind);
the graph is always null and names are always full IRIs.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr
from zlib import crc32

from ..errors import RdfSyntaxError
from ..model import RDF

_XML = "http://www.w3.org/XML/1998/namespace"
_SYNTAX = {RDF + n for n in ("about", "ID", "nodeID", "resource", "datatype", "parseType", "RDF", "Description", "li", "aboutEach", "aboutEachPrefix", "bagID")}
_CHUNK = 1 << 20


class _Frame:
    """An open element. role: root, node, property, literal (inside parseType Literal) or collection."""

    def __init__(self, role: str, base: str, lang: str | None):
        self.role, self.base, self.lang = role, base, lang
        self.subject = self.predicate = self.object = self.datatype = self.reify = self.parse = None
        self.kind = ""
        self.items: list[tuple[str, str]] = []
        self.li, self.text, self.filled = 0, [], False


class RdfXml:
    """One document, fed in pieces."""

    def __init__(self, file: str = "", base: str = ""):
        self.file, self.out, self.fresh = file, [], 0
        self.own = f"g{crc32(file.encode()):08x}"  # labels of blank nodes that the file doesn't name differ from file to file
        self.stack: list[_Frame] = [_Frame("document", base, None)]
        self.depth = 0  # of elements inside parseType Literal
        self.open_spaces: list[tuple[str | None, str]] = []
        self.parser = expat.ParserCreate(namespace_separator="\n")
        self.parser.buffer_text = True
        self.parser.ordered_attributes = True
        self.parser.namespace_prefixes = True
        self.parser.StartElementHandler = self.start
        self.parser.EndElementHandler = self.end
        self.parser.CharacterDataHandler = self.characters
        self.parser.StartNamespaceDeclHandler = lambda prefix, uri: self.open_spaces.append((prefix, uri or ""))

    def statements(self, data: bytes) -> Iterator[tuple]:
        try:
            for i in range(0, len(data), _CHUNK):
                self.parser.Parse(data[i : i + _CHUNK], False)
                yield from self.out
                self.out.clear()
            self.parser.Parse(b"", True)
        except expat.ExpatError as e:
            raise RdfSyntaxError(f"Error in '{self.file}': XML parsing error at line {e.lineno}, column {e.offset}", self.file, e.lineno, e.offset) from None
        yield from self.out

    def fail(self, what: str):
        raise RdfSyntaxError(what, self.file, self.parser.CurrentLineNumber, self.parser.CurrentColumnNumber)

    @staticmethod
    def name(said: str) -> str:
        parts = said.split("\n")
        return parts[0] + parts[1] if len(parts) > 1 else parts[0]

    @staticmethod
    def qname(said: str) -> str:
        parts = said.split("\n")
        return f"{parts[2]}:{parts[1]}" if len(parts) > 2 and parts[2] else parts[-1] if len(parts) < 2 else parts[1]

    def blank(self) -> str:
        self.fresh += 1
        return f"{self.own}n{self.fresh}"

    def resolve(self, iri: str, base: str) -> str:
        if not base:
            return iri
        return urljoin(base, iri) if iri else base.split("#")[0]

    def label(self, said: str) -> str:
        """A label that the document gives, told apart from those that are made here."""
        return f"{said}_" if said.startswith(self.own) else said

    def emit(self, s: str, p: str, o: str, datatype: str | None, lang: str | None, kind: str, reify: str | None = None, blank: str = "I") -> None:
        """blank: the kind of the subject."""
        self.out.append((None, s, p, o, datatype, lang, kind))
        if reify:
            for n, v, d, la, k in (("type", RDF + "Statement", None, None, "I"), ("subject", s, None, None, blank), ("predicate", p, None, None, "I"), ("object", o, datatype, lang, kind)):
                self.out.append((None, reify, RDF + n, v, d, la, k))

    def start(self, said: str, flat: list[str]) -> None:
        spaces, self.open_spaces = self.open_spaces, []
        top = self.stack[-1]
        if top.role == "literal":
            self.depth += 1
            top.text.append(self.tag(said, flat, spaces))
            return
        attributes = {self.name(flat[i]): flat[i + 1] for i in range(0, len(flat), 2)}
        base = attributes.pop(_XML + "base", None)
        lang = attributes.pop(_XML + "lang", None)
        frame = _Frame("", self.resolve(base, top.base).split("#")[0] if base else top.base, lang if lang else top.lang if lang is None else None)
        self.stack.append(frame)
        attributes = {k: v for k, v in attributes.items() if not k.startswith(_XML)}
        element = self.name(said)
        if top.role == "document" and element == RDF + "RDF":
            frame.role = "root"
        elif top.role in ("document", "root", "property", "collection"):
            self.node(frame, top, element, attributes)
        else:
            self.property(frame, top, element, attributes)

    def node(self, frame: _Frame, top: _Frame, element: str, attributes: dict[str, str]) -> None:
        frame.role, kind = "node", "I"
        get = lambda n: attributes.get(RDF + n, attributes.get(n) if n == "about" else None)
        if (about := get("about")) is not None:
            frame.subject = self.resolve(about, frame.base)
        elif (own := get("ID")) is not None:
            frame.subject = f"{frame.base}#{own}"
        elif (label := get("nodeID")) is not None:
            frame.subject, kind = self.label(label), "B"
        else:
            frame.subject, kind = self.blank(), "B"
        frame.kind = kind
        if top.role == "property":
            if top.filled:
                self.fail("a property has one node")
            top.filled = True
            self.emit(top.subject, top.predicate, frame.subject, None, None, kind, top.reify, top.kind)
        elif top.role == "collection":
            top.items.append((frame.subject, kind))
        if element != RDF + "Description":
            self.emit(frame.subject, RDF + "type", element, None, None, "I")
        self.attributes(frame.subject, frame, attributes)

    def attributes(self, subject: str, frame: _Frame, attributes: dict[str, str]) -> None:
        for name, value in attributes.items():
            if name == RDF + "type":
                self.emit(subject, name, self.resolve(value, frame.base), None, None, "I")
            elif name not in _SYNTAX and ":" in name:
                self.emit(subject, name, value, None, frame.lang, "L")

    def property(self, frame: _Frame, top: _Frame, element: str, attributes: dict[str, str]) -> None:
        frame.role, frame.subject, frame.predicate, frame.kind = "property", top.subject, element, top.kind
        if element == RDF + "li":
            top.li += 1
            frame.predicate = f"{RDF}_{top.li}"
        if (own := attributes.get(RDF + "ID")) is not None:
            frame.reify = f"{frame.base}#{own}"
        frame.datatype = attributes.get(RDF + "datatype")
        if frame.datatype is not None:
            frame.datatype = self.resolve(frame.datatype, frame.base)
        frame.parse = attributes.get(RDF + "parseType")
        if frame.parse == "Resource":
            node = self.blank()
            self.emit(frame.subject, frame.predicate, node, None, None, "B", frame.reify, frame.kind)
            frame.role, frame.subject, frame.kind = "node", node, "B"
        elif frame.parse == "Collection":
            frame.role = "collection"
        elif frame.parse is not None:
            frame.role = "literal"
        else:
            more = {k: v for k, v in attributes.items() if k not in _SYNTAX and ":" in k}
            to, label = attributes.get(RDF + "resource"), attributes.get(RDF + "nodeID")
            if to is not None or label is not None or more:
                node, kind = (self.resolve(to, frame.base), "I") if to is not None else (self.label(label), "B") if label is not None else (self.blank(), "B")
                frame.filled = True
                self.emit(frame.subject, frame.predicate, node, None, None, kind, frame.reify, frame.kind)
                self.attributes(node, frame, more)

    def tag(self, said: str, flat: list[str], spaces: list[tuple[str | None, str]]) -> str:
        declared = "".join(f" xmlns{':' + p if p else ''}={quoteattr(u)}" for p, u in spaces)
        attributes = "".join(f" {self.qname(flat[i])}={quoteattr(flat[i + 1])}" for i in range(0, len(flat), 2))
        return f"<{self.qname(said)}{declared}{attributes}>"

    def characters(self, text: str) -> None:
        top = self.stack[-1]
        if top.role == "literal":
            top.text.append(escape(text))
        elif top.role == "property":
            top.text.append(text)

    def end(self, said: str) -> None:
        frame = self.stack[-1]
        if frame.role == "literal" and self.depth:
            self.depth -= 1
            frame.text.append(f"</{self.qname(said)}>")
            return
        self.stack.pop()
        if frame.role == "literal":
            self.emit(frame.subject, frame.predicate, "".join(frame.text).strip(" \t\r\n"), RDF + "XMLLiteral", None, "L", frame.reify, frame.kind)
        elif frame.role == "collection":
            nodes = [self.blank() for _ in frame.items]
            head, kind = (nodes[0], "B") if nodes else (RDF + "nil", "I")
            self.emit(frame.subject, frame.predicate, head, None, None, kind, frame.reify, frame.kind)
            for i, (item, is_) in enumerate(frame.items):
                self.emit(nodes[i], RDF + "first", item, None, None, is_)
                last = i + 1 == len(nodes)
                self.emit(nodes[i], RDF + "rest", RDF + "nil" if last else nodes[i + 1], None, None, "I" if last else "B")
        elif frame.role == "property" and not frame.filled:
            text = "".join(frame.text).strip(" \t\r\n")
            self.emit(frame.subject, frame.predicate, text, frame.datatype, None if frame.datatype else frame.lang, "L", frame.reify, frame.kind)
