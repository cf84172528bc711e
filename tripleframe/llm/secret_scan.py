r"""Secret scans by assignment-aware lexing.

Base patterns find assignments, access key identifiers and long hexadecimal
strings. Beside them, source and configuration syntax (`name = "literal"`,
`"name": "literal"`, `name: literal`, `export NAME=literal`, `name := literal`)
is lexed into name-literal pairs. Names assigned from other names or from sums
get the sums' values (constants are folded within the text, names in cycles stand
for nothing), and every value is scored by the target names that it reaches,
directly or through others. The literals of values that score THRESHOLD or more
are spans of kind `literal`. Spans count code points, the end exclusive.

Defined results
* null or empty text: no spans. Very long texts are read whole; the patterns
  are linear in the text.
* repeated rows and null identifiers pass as rows of their own; an empty table
  gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")

#: A literal is a secret from this score on; names are worth up to 0.7, the look of the literal up to 0.4.
THRESHOLD = 0.75

_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_ANY_CASE = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", name) for name in _NAMES)
ASSIGN = re.compile(rf"(?:{_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones needn't be matched and dropped
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Parts of names, and how surely they name a secret.
SENSITIVE = {
    "password": 0.7, "passwd": 0.7, "pwd": 0.65, "passphrase": 0.7, "secret": 0.65, "token": 0.6, "apikey": 0.7,
    "credential": 0.65, "credentials": 0.65, "privatekey": 0.7, "accesskey": 0.65, "authkey": 0.65, "signingkey": 0.65,
    "encryptionkey": 0.65, "auth": 0.5, "bearer": 0.6, "key": 0.4, "salt": 0.4, "pin": 0.4,
}

#: Literals that stand for something else.
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|change_?me|example|your[_-].*|none|null|true|false|todo|test|dummy)$")

_PAIR = re.compile(
    # each run of characters of names is entered at its start alone, so that long ones are read once
    r"""(?<![A-Za-z0-9_.-])(?:(?P<q>["'])|[0-9.-]*+)(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?(q)(?P=q))[ \t]*+(?::=|=>|[:=](?!=))[ \t]*+"""
    r"""(?P<value>(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[^\s"',;#+()\[\]{}]+)"""
    r"""(?:[ \t]*\+[ \t]*(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[A-Za-z_][A-Za-z0-9_.]*))*)"""
)
_ATOM = re.compile(r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[^\s"'+]+(?:\+(?![ \t])[^\s"'+]+)*""")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*$")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end, kind) of the base patterns' matches."""
    out = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        out += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out)


def name_score(name: str) -> float:
    """How surely a name is that of a secret: its best part, or two parts that belong together."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    words = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)


def literal_score(literal: str) -> float:
    """The look of a literal: length, kinds of characters and entropy, up to 0.4; below 0 for placeholders and prose."""
    if len(literal) < 6 or PLACEHOLDER.match(literal):
        return -1.0
    if " " in literal.strip():
        return -0.3
    counts = Counter(literal)
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", r"\d", r"[^A-Za-z\d]"))
    return 0.05 * min(kinds, 3) + min(0.25, max(0.0, bits - 2) * 0.15)


def pairs(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]]]]:
    """Assignments in order: the name, and the atoms of its value (text, start, end, is a literal)."""
    out = []
    for m in _PAIR.finditer(text):
        atoms = []
        for a in _ATOM.finditer(text, m.start("value"), m.end("value")):
            said = a[0]
            if said[0] in "\"'" and len(said) >= 2:
                atoms.append((said[1:-1], a.start() + 1, a.end() - 1, True))
            else:
                atoms.append((said, a.start(), a.end(), not _IDENTIFIER.match(said)))
        out.append((m["name"], atoms))
    return out


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals that reach a sensitive name.

    A name's value is the sum of its atoms, with names replaced by what they were given last before (constants are
    folded); it is scored as a whole, and all literals that are in it are spans if it is a secret.
    """
    if "=" not in text and ":" not in text:
        return []
    found = pairs(text)
    named = {name for name, _ in found}
    values: dict[str, list[_Value]] = {}  # what a name was given, in the order of the text
    for name, atoms in found:
        values.setdefault(name, []).append([(said, start, end, not literal and said in named) for said, start, end, literal in atoms])
    worth = {name: w for name in named if (w := name_score(name)) >= 0.4}
    folded = _folded(values)
    reached: dict[int, tuple[int, bool]] = {}
    seen: set[str] = set()
    for name in sorted(worth, key=lambda n: (-worth[n], n)):  # most sensitive first: what it reaches, no other name reaches better
        todo = [name]
        while todo:
            at = todo.pop()
            if at in seen:
                continue
            seen.add(at)
            for value, whole in zip(values[at], folded[at], strict=True):
                secret = worth[name] + literal_score(whole) >= THRESHOLD
                for said, start, end, is_name in value:
                    if is_name:
                        todo.append(said)
                    elif end > start:
                        alone = worth[name] + literal_score(said) >= THRESHOLD
                        reached[start] = (end, secret or alone or reached.get(start, (0, False))[1])
                if secret:
                    for start, end in _places(value, values):
                        reached[start] = (end, True)
    return [(start, len(KINDS) - 1, end, "literal") for start, (end, secret) in reached.items() if secret]


#: The atoms of a value: text, start, end, whether it is the name of another value.
_Value = list[tuple[str, int, int, bool]]
#: Characters of a folded value that are scored; sums may double with each name, and the look of a literal is settled long before.
FOLDED = 4096


def _folded(values: dict[str, list[_Value]]) -> dict[str, list[str]]:
    """The sums of all values, each name folded once, those that it needs before it; names in a cycle stand for nothing."""
    done: dict[str, list[str]] = {}
    for name in values:
        todo = [(name, False)]
        begun: set[str] = set()
        while todo:
            at, ready = todo.pop()
            if at in done:
                continue
            if ready:
                done[at] = ["".join((done[said][-1] if said in done else "") if is_name else said for said, _, _, is_name in value)[:FOLDED] for value in values[at]]
            elif at not in begun:
                begun.add(at)
                todo.append((at, True))
                todo += [(said, False) for value in values[at] for said, _, _, is_name in value if is_name and said not in done]
    return done


def _places(value: _Value, values: dict[str, list[_Value]]) -> list[tuple[int, int]]:
    """The literals that a value is the sum of: its own, and those of names that are nothing but one sum of literals."""
    out = []
    for said, start, end, is_name in value:
        if not is_name:
            out.append((start, end))
        else:
            out += [(a, b) for _, a, b, name in values[said][-1] if not name]
    return [(a, b) for a, b in out if b > a]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_assign, n_access, n_hex, base_sha256, spans, n_literal."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    said = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py()
                base, more = base_spans(text), literal_spans(text)
                n = Counter(k for *_, k in base)
                digest = hashlib.sha256(said(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, said(sorted(base + more)), len(more)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], ["_id", *names])

    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    schema = f"_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_literal bigint"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
