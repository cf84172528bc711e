"""SPARQL expressions as Spark SQL text, typed as far as the mapping tells."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from ...errors import TranslationError
from ...functions.lexical import lex_double, quote
from ...model import RDF, XSD
from .ast import Aggregate, Call, Exists, Iri, Literal, Var

INTEGERS = {XSD + n for n in ("integer", "int", "long", "short", "byte", "unsignedByte", "unsignedShort", "unsignedInt", "unsignedLong", "nonNegativeInteger", "positiveInteger", "negativeInteger", "nonPositiveInteger")}
NUMERIC = INTEGERS | {XSD + n for n in ("decimal", "double", "float")}


@dataclass(frozen=True)
class Info:
    """What is known of a variable: kinds of its terms, and datatype and language of its literals if they are sure."""

    kinds: frozenset[str] = frozenset("IBL")
    datatype: str | None = None
    lang: str | None = None
    sure: bool = False
    optional: bool = False

    def merged(self, other: Info) -> Info:
        same = self.sure and other.sure and (self.datatype, self.lang) == (other.datatype, other.lang)
        if "L" not in self.kinds or "L" not in other.kinds:  # only one side has literals
            keep = self if "L" in self.kinds else other
            return replace(keep, kinds=self.kinds | other.kinds, optional=self.optional or other.optional)
        return Info(self.kinds | other.kinds, self.datatype if same else None, self.lang if same else None, same, self.optional or other.optional)


@dataclass(frozen=True)
class Value:
    """An expression. type: str (a term's lexical form), int, dbl or bool."""

    sql: str
    type: str
    info: Info = Info(frozenset("L"), None, None, True)


def plain(sql: str) -> Value:
    return Value(sql, "str", Info(frozenset("L"), None, None, True))


def boolean(sql: str) -> Value:
    return Value(sql, "bool", Info(frozenset("L"), XSD + "boolean", None, True))


def integer(sql: str) -> Value:
    return Value(sql, "int", Info(frozenset("L"), XSD + "integer", None, True))


def double(sql: str) -> Value:
    return Value(sql, "dbl", Info(frozenset("L"), XSD + "double", None, True))


def lex(v: Value) -> str:
    """The lexical form."""
    return v.sql if v.type == "str" else lex_double(f"({v.sql})") if v.type == "dbl" else f"cast({v.sql} AS STRING)"


def is_numeric(v: Value) -> bool:
    return v.type in ("int", "dbl") or v.type == "str" and v.info.sure and v.info.datatype in NUMERIC


def number(v: Value) -> Value:
    """As a number; null if it is none."""
    if v.type in ("int", "dbl"):
        return v
    if v.type == "bool":
        return integer("cast(NULL AS BIGINT)")
    if v.info.sure and v.info.datatype in INTEGERS:
        return integer(f"try_cast({v.sql} AS BIGINT)")
    return double(f"try_cast({v.sql} AS DOUBLE)")


def truth(v: Value) -> str:
    """The effective boolean value."""
    if v.type == "bool":
        return v.sql
    if is_numeric(v):
        return f"({number(v).sql} <> 0)"
    return f"({v.sql} = 'true')" if v.info.datatype == XSD + "boolean" else f"(length({v.sql}) > 0)"


class Expressions:
    """Compiles expressions over variables at hand.

    variables: SQL and Info by name. aggregates: values of aggregates that were computed before.
    exists: compiles EXISTS, given the pattern and the variables.
    """

    def __init__(self, variables: dict[str, tuple[str, Info]], exists: Callable | None = None, aggregates: dict[Aggregate, Value] | None = None, where: str = "an expression"):
        self.variables, self.exists, self.aggregates, self.where = variables, exists, aggregates, where

    def value(self, e) -> Value:
        if isinstance(e, Var):
            if e.name not in self.variables:
                raise TranslationError(f"variable ?{e.name} is not in scope in {self.where}")
            sql, info = self.variables[e.name]
            return Value(sql, "str", info)
        if isinstance(e, Iri):
            return Value(quote(e.value), "str", Info(frozenset("I"), None, None, True))
        if isinstance(e, Literal):
            if e.datatype in INTEGERS:
                return integer(f"{int(e.value)}L")
            if e.datatype in NUMERIC:
                return double(f"double({quote(e.value)})")
            if e.datatype == XSD + "boolean":
                return boolean("true" if e.value in ("true", "1") else "false")
            return Value(quote(e.value), "str", Info(frozenset("L"), e.datatype, e.lang, True))
        if isinstance(e, Exists):
            if self.exists is None:
                raise TranslationError(f"EXISTS is not supported in {self.where}")
            return boolean(self.exists(e, self.variables))
        if isinstance(e, Aggregate):
            if self.aggregates is None or e not in self.aggregates:
                raise TranslationError(f"an aggregate is not allowed in {self.where}")
            return self.aggregates[e]
        method = _FUNCTIONS.get(e.name)
        if method is None:
            raise TranslationError(f"function {e.name} is not supported")
        return method(self, *e.args)

    def text(self, e) -> str:
        return lex(self.value(e))

    def number(self, e) -> Value:
        return number(self.value(e))

    def truth(self, e) -> str:
        return truth(self.value(e))

    def compare(self, sign: str, a, b) -> Value:
        x, y = self.value(a), self.value(b)
        sign = {"!=": "<>"}.get(sign, sign)
        if is_numeric(x) or is_numeric(y):
            return boolean(f"({number(x).sql} {sign} {number(y).sql})")
        if "bool" in (x.type, y.type):
            x, y = [v.sql if v.type == "bool" else f"try_cast({v.sql} AS BOOLEAN)" for v in (x, y)]
            return boolean(f"({x} {sign} {y})")
        return boolean(f"({x.sql} {sign} {y.sql})")

    def arithmetic(self, sign: str, a, b) -> Value:
        x, y = self.number(a), self.number(b)
        if sign == "/":
            return double(f"try_divide({x.sql}, {y.sql})")
        both = x.type == y.type == "int"
        sql = f"try_{ {'+': 'add', '-': 'subtract', '*': 'multiply'}[sign] }({x.sql}, {y.sql})"
        return integer(sql) if both else double(sql)

    def rounded(self, name: str, a) -> Value:
        x = self.number(a)
        if x.type == "int":
            return integer(f"abs({x.sql})" if name == "abs" else x.sql)
        sql = {"abs": f"abs({x.sql})", "ceil": f"cast(ceil({x.sql}) AS DOUBLE)", "floor": f"cast(floor({x.sql}) AS DOUBLE)", "round": f"cast(floor({x.sql} + 0.5) AS DOUBLE)"}
        return double(sql[name])

    def regex(self, text, pattern, flags=None) -> Value:
        return boolean(f"rlike({self.text(text)}, {self.pattern(pattern, flags)})")

    def pattern(self, pattern, flags) -> str:
        said = flags.value if isinstance(flags, Literal) else "" if flags is None else None
        if said is None:
            raise TranslationError("flags of REGEX and REPLACE must be literals")
        if set(said) - set("ismxq"):
            raise TranslationError(f"unknown flags '{said}'")
        sql = self.text(pattern)
        if "q" in said:
            sql = f"concat('\\\\Q', {sql}, '\\\\E')"
        marks = "".join(f for f in said if f != "q")
        return f"concat('(?{marks})', {sql})" if marks else sql

    def either(self, *args) -> list[Value]:
        """Values of one type: as they are if they agree, else their lexical forms."""
        values = [self.value(a) for a in args]
        if len({v.type for v in values}) == 1 and values[0].type != "str":
            return values
        info = values[0].info
        for v in values[1:]:
            info = info.merged(v.info)
        return [Value(lex(v), "str", info) for v in values]

    def kind_is(self, e, kind: str) -> Value:
        v = self.value(e)
        if len(v.info.kinds) > 1:
            raise TranslationError("the kind of a term of mixed kinds is not known")
        return boolean(f"({lex(v)} IS NOT NULL AND {'true' if kind in v.info.kinds else 'false'})")

    def lang(self, e) -> Value:
        v = self.value(e)
        if not v.info.sure and "L" in v.info.kinds:
            raise TranslationError("LANG of literals of mixed languages is not known")
        return plain(f"CASE WHEN {lex(v)} IS NOT NULL THEN {quote(v.info.lang or '')} END")

    def datatype(self, e) -> Value:
        v = self.value(e)
        if v.type == "str" and not v.info.sure:
            raise TranslationError("DATATYPE of literals of mixed datatypes is not known")
        if "L" not in v.info.kinds:
            return Value("cast(NULL AS STRING)", "str", Info(frozenset("I"), None, None, True))
        name = RDF + "langString" if v.info.lang else v.info.datatype or XSD + "string"
        return Value(f"CASE WHEN {lex(v)} IS NOT NULL THEN {quote(name)} END", "str", Info(frozenset("I"), None, None, True))

    def is_number(self, e) -> Value:
        v = self.value(e)
        if v.type in ("int", "dbl"):
            return boolean(f"({v.sql} IS NOT NULL)")
        if v.info.sure and v.info.datatype not in NUMERIC:
            return boolean("false")
        return boolean(f"(try_cast({lex(v)} AS DOUBLE) IS NOT NULL)")

    def cast(self, name: Iri, e=None) -> Value:
        if e is None:
            raise TranslationError("a cast has one argument")
        v, to = self.value(e), name.value.removeprefix(XSD)
        if to == "string":
            return plain(lex(v))
        if to == "boolean":
            return v if v.type == "bool" else boolean(f"({v.sql} <> 0)" if v.type in ("int", "dbl") else f"try_cast({v.sql} AS BOOLEAN)")
        if to in ("double", "float", "decimal"):
            if v.type == "bool":
                return double(f"cast(cast({v.sql} AS INT) AS DOUBLE)")
            out = double(f"cast({v.sql} AS DOUBLE)" if v.type in ("int", "dbl") else f"try_cast({v.sql} AS DOUBLE)")
            return replace(out, info=replace(out.info, datatype=name.value))
        if name.value in INTEGERS:
            if v.type == "str":
                return integer(f"try_cast(trim({v.sql}) AS BIGINT)")
            return integer(f"cast({v.sql} AS BIGINT)")
        if to in ("dateTime", "date"):
            kind, text = ("TIMESTAMP_NTZ" if to == "dateTime" else "DATE"), lex(v)
            return Value(f"CASE WHEN try_cast({text} AS {kind}) IS NOT NULL THEN {text} END", "str", Info(frozenset("L"), name.value, None, True))
        raise TranslationError(f"a cast to <{name.value}> is not supported")

    def same_kind(self, e, kind: str) -> Value:
        return Value(self.text(e), "str", Info(frozenset(kind), None, None, True))

    def typed(self, text, iri) -> Value:
        if not isinstance(iri, Iri):
            raise TranslationError("the datatype of STRDT must be an IRI")
        return Value(self.text(text), "str", Info(frozenset("L"), iri.value, None, True))

    def spoken(self, text, lang) -> Value:
        if not isinstance(lang, Literal):
            raise TranslationError("the language of STRLANG must be a literal")
        return Value(self.text(text), "str", Info(frozenset("L"), None, lang.value, True))

    def before(self, a, b) -> Value:
        x, y = self.text(a), self.text(b)
        return plain(f"CASE WHEN instr({x}, {y}) > 0 THEN substring({x}, 1, instr({x}, {y}) - 1) ELSE '' END")

    def after(self, a, b) -> Value:
        x, y = self.text(a), self.text(b)
        return plain(f"CASE WHEN instr({x}, {y}) > 0 THEN substring({x}, instr({x}, {y}) + length({y})) ELSE '' END")

    def substring(self, text, start, length=None) -> Value:
        more = "" if length is None else f", cast({self.number(length).sql} AS INT)"
        return plain(f"substring({self.text(text)}, cast({self.number(start).sql} AS INT){more})")

    def chosen(self, test, a, b) -> Value:
        x, y = self.either(a, b)
        return replace(x, sql=f"if({self.truth(test)}, {x.sql}, {y.sql})")

    def first(self, *args) -> Value:
        values = self.either(*args)
        return replace(values[0], sql=f"coalesce({', '.join(v.sql for v in values)})")

    def one_of(self, e, *options) -> Value:
        return boolean("(" + (" OR ".join(self.compare("=", e, o).sql for o in options) or "false") + ")")

    def lang_matches(self, a, b) -> Value:
        x, y = self.text(a), self.text(b)
        return boolean(f"CASE WHEN {y} = '*' THEN {x} <> '' ELSE lower({x}) = lower({y}) OR startswith(lower({x}), concat(lower({y}), '-')) END")

    def bound(self, e) -> Value:
        if not isinstance(e, Var):
            raise TranslationError("BOUND takes a variable")
        return boolean(f"({self.value(e).sql} IS NOT NULL)")


def _text_function(template: str, result=plain):
    return lambda s, *args: result(template.format(*[s.text(a) for a in args]))


_FUNCTIONS = {
    "||": lambda s, a, b: boolean(f"({s.truth(a)} OR {s.truth(b)})"),
    "&&": lambda s, a, b: boolean(f"({s.truth(a)} AND {s.truth(b)})"),
    "!": lambda s, a: boolean(f"(NOT {s.truth(a)})"),
    **{sign: (lambda s, a, b, sign=sign: s.compare(sign, a, b)) for sign in ("=", "!=", "<", ">", "<=", ">=")},
    **{sign: (lambda s, a, b, sign=sign: s.arithmetic(sign, a, b)) for sign in "+-*/"},
    **{name.upper(): (lambda s, a, name=name: s.rounded(name, a)) for name in ("abs", "ceil", "floor", "round")},
    "NEG": lambda s, a: replace(s.number(a), sql=f"(-{s.number(a).sql})"),
    "IN": Expressions.one_of,
    "IF": Expressions.chosen,
    "COALESCE": Expressions.first,
    "BOUND": Expressions.bound,
    "STR": _text_function("{0}"),
    "STRLEN": _text_function("length({0})", integer),
    "UCASE": _text_function("upper({0})"),
    "LCASE": _text_function("lower({0})"),
    "STRSTARTS": _text_function("startswith({0}, {1})", boolean),
    "STRENDS": _text_function("endswith({0}, {1})", boolean),
    "CONTAINS": _text_function("contains({0}, {1})", boolean),
    "STRBEFORE": Expressions.before,
    "STRAFTER": Expressions.after,
    "SUBSTR": Expressions.substring,
    "CONCAT": lambda s, *args: plain(f"concat({', '.join(s.text(a) for a in args)})" if args else "''"),
    "REGEX": Expressions.regex,
    "REPLACE": lambda s, t, p, r, f=None: plain(f"regexp_replace({s.text(t)}, {s.pattern(p, f)}, {s.text(r)})"),
    "LANGMATCHES": Expressions.lang_matches,
    "LANG": Expressions.lang,
    "DATATYPE": Expressions.datatype,
    "IRI": lambda s, a: s.same_kind(a, "I"),
    "URI": lambda s, a: s.same_kind(a, "I"),
    "BNODE": lambda s, a: s.same_kind(a, "B"),
    "STRDT": Expressions.typed,
    "STRLANG": Expressions.spoken,
    "SAMETERM": lambda s, a, b: boolean(f"({s.text(a)} = {s.text(b)})"),
    "ISIRI": lambda s, a: s.kind_is(a, "I"),
    "ISURI": lambda s, a: s.kind_is(a, "I"),
    "ISBLANK": lambda s, a: s.kind_is(a, "B"),
    "ISLITERAL": lambda s, a: s.kind_is(a, "L"),
    "ISNUMERIC": Expressions.is_number,
    "MD5": _text_function("md5({0})"),
    "SHA1": _text_function("sha1({0})"),
    "SHA256": _text_function("sha2({0}, 256)"),
    "CAST": Expressions.cast,
}


def aggregates_in(e) -> list[Aggregate]:
    """The aggregates of an expression."""
    if isinstance(e, Aggregate):
        return [e]
    return [a for x in e.args for a in aggregates_in(x)] if isinstance(e, Call) else []
