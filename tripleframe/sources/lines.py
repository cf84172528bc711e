r"""N-Triples and N-Quads as Catalyst expressions.

Lines are Spark's own text source, so files split and codecs work. A statement
is checked and cut into its terms by one pass of an anchored regular expression
with possessive quantifiers (no backtracking, constant stack): the terms come out
as lines of a text, since no statement holds a line break, and are then fields of
an array. A generator makes a row of it, or none; so filters on terms are applied
to the fields, not to another pass, and those on file names still reach the scan.
Only the terms that are asked for are unescaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import COLUMNS, KIND

_ESCAPE = r"\\(?:[tbnrf\"'\\]|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})"
_IRI_CHARS = r"[^\x00-\x20<>\"{}|^`\\]*+"
_STRICT_IRI = rf"{_IRI_CHARS}(?:\\(?:u[0-9A-Fa-f]{{4}}|U[0-9A-Fa-f]{{8}}){_IRI_CHARS})*+"
_LAX_IRI = r"[^>\n]*+"
_BLANK = r"_:[^\s<>\"@^.,;]++(?:\.++[^\s<>\"@^.,;]++)*+"
_STRING = rf"[^\"\\\n\r]*+(?:{_ESCAPE}[^\"\\\n\r]*+)*+"
_GAP = r"[ \t]*+"


def _statement(iri: str, quads: bool) -> str:
    """Groups: subject, predicate's IRI, object's node or its literal's text, datatype behind ^^, language, graph."""
    node = f"(<{iri}>|{_BLANK})"
    literal = rf"\"({_STRING})\"(?:(\^\^<{iri})>|@([A-Za-z]++(?:-[A-Za-z0-9]++)*+))?+"
    graph = rf"(?:{node}{_GAP})?+" if quads else "()"
    return rf"^{_GAP}{node}{_GAP}<({iri})>{_GAP}(?:{node}|{literal}){_GAP}{graph}\.{_GAP}(?:#[^\n]*+)?+\r?\z"


STATEMENT = {(strict, quads): _statement(_STRICT_IRI if strict else _LAX_IRI, quads) for strict in (True, False) for quads in (True, False)}
#: The fields of a statement, in the order of the groups.
_S, _P, _O, _BODY, _DT, _LANG, _G = range(7)
_CUT = "\n".join(f"${n + 1}" for n in range(7))


_NOTHING = r"^[ \t\r]*+(?:#[^\n]*+)?+\z"
_TOKENS = r"([^\\]++|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.)"


def _begun(quads: bool) -> str:
    """What a strict statement may begin with: matches as much of a bad line as is right."""
    node, literal = f"(?:<{_STRICT_IRI}>|{_BLANK})", rf"\"{_STRING}\"(?:\^\^<{_STRICT_IRI}>|@[A-Za-z]++(?:-[A-Za-z0-9]++)*+)?+"
    graph = f"(?:{node}{_GAP})?+" if quads else ""
    return rf"^{_GAP}(?:{node}{_GAP}(?:<{_STRICT_IRI}>{_GAP}(?:(?:{node}|{literal}){_GAP}{graph}(?:\.{_GAP})?+)?+)?+)?+"


def unescape(value: Column) -> Column:
    """Decode the escapes of a string or an IRI; values without a backslash pass as they are."""

    def decoded(token: Column) -> Column:
        code = F.decode(F.unhex(F.lpad(F.substring(token, 3, 8), 8, "0")), "UTF-32")
        second = F.substring(token, 2, 1)
        plain = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}
        named = F.when(F.lower(second) == "u", code)
        for letter, is_ in plain.items():
            named = named.when(second == letter, F.lit(is_))
        return F.when(F.substring(token, 1, 1) != "\\", token).otherwise(named.otherwise(second))

    tokens = F.regexp_extract_all(value, F.lit(_TOKENS), F.lit(1))
    return F.when(F.instr(value, "\\") > 0, F.array_join(F.transform(tokens, decoded), "")).otherwise(value)


def _name(term: Column) -> Column:
    """A term without its brackets, or a blank node's label."""
    inner = F.substr(term, F.lit(2), F.length(term) - 2)
    return F.when(F.startswith(term, F.lit("<")), unescape(inner)).otherwise(F.substr(term, F.lit(3)))


def statements(lines: DataFrame, quads: bool, strict: bool = True, value: str = "value", keep: tuple[str, ...] = (), file: Column | None = None) -> DataFrame:
    """The columns of a triple table, object_kind and the columns to keep, from lines of N-Triples or N-Quads.

    strict: a line that is no statement, comment or blank fails the query with its text and the column from which it is
    wrong. Otherwise IRIs may hold any character but '>' and lines that still don't fit are left out.
    file: the name of the line's file for that message, made of columns to keep.
    """
    whole = F.col(value)
    cut = F.split(F.when(F.instr(whole, "\n") == 0, F.regexp_replace(whole, STATEMENT[strict, quads], _CUT)), "\n", -1)
    step = lines.select(whole.alias("_line"), cut.alias("_cut"), *keep)
    fits = F.size("_cut") == F.lit(7)
    row = F.when(fits, F.array("_cut"))
    if strict:
        where = F.lit("") if file is None else F.concat(F.lit(" in '"), file, F.lit("'"))
        at = F.length(F.regexp_extract("_line", _begun(quads), 0)) + 1
        said = F.concat(F.lit("Syntax Error: 'Invalid syntax'"), where, F.lit(", column "), at.cast("string"), F.lit(", at line: "), F.substring("_line", 1, 200))
        row = row.when(~F.col("_line").rlike(_NOTHING), F.raise_error(said).cast("array<array<string>>"))
    step = step.select(F.explode(row).alias("_f"), *keep)
    field = lambda i: F.get("_f", F.lit(i))
    node, datatype, lang, graph = field(_O), field(_DT), field(_LANG), field(_G)
    literal = node == ""
    kind = F.when(literal, "L").when(F.startswith(node, F.lit("<")), "I").otherwise("B")
    said = lambda x, is_: F.when(x != "", is_)
    made = (
        said(graph, _name(graph)) if quads else F.lit(None).cast("string"),
        _name(field(_S)),
        unescape(field(_P)),
        F.when(literal, unescape(field(_BODY))).otherwise(_name(node)),
        said(datatype, unescape(F.substr(datatype, F.lit(4)))),
        said(lang, lang),
    )
    return step.select(*[c.alias(n) for n, c in zip(COLUMNS, made, strict=True)], kind.alias(KIND), *keep)


def skipped(lines: DataFrame, quads: bool, strict: bool = False, value: str = "value") -> DataFrame:
    """The lines that lax reading leaves out (strict: those that strict reading fails on)."""
    return lines.filter(~F.col(value).rlike(STATEMENT[strict, quads]) & ~F.col(value).rlike(_NOTHING))
