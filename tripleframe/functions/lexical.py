"""Lexical forms of SQL values, as Spark SQL text."""

from __future__ import annotations

from pyspark.sql import types as T


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"


def name(column: str) -> str:
    """A quoted identifier."""
    return "`" + column.replace("`", "``") + "`"


def table_name(said: str) -> str:
    """A table's name with its parts quoted."""
    return ".".join(name(p.strip('"`')) for p in said.split("."))


def encoded(sql: str) -> str:
    """A value percent-encoded for an IRI: only letters, digits and -._~ stay."""
    return f"replace(replace(replace(url_encode({sql}), '+', '%20'), '%7E', '~'), '*', '%2A')"


def lex_double(sql: str) -> str:
    """A double in the shortest form, without an exponent between 1e7 and 1e15."""
    whole = f"regexp_replace(regexp_replace(cast(cast({sql} AS DECIMAL(38,9)) AS STRING), '0+$', ''), '[.]$', '.0')"
    return f"CASE WHEN abs({sql}) >= 1e7 AND abs({sql}) < 1e15 THEN {whole} ELSE cast({sql} AS STRING) END"


def written_double(sql: str) -> str:
    """A float or double as writers put it: six decimals, and the names of XSD for other values."""
    return (
        f"CASE WHEN isnan({sql}) THEN 'NaN' WHEN {sql} = double('Infinity') THEN 'INF' WHEN {sql} = double('-Infinity') THEN '-INF' "
        f"ELSE format_string('%.6f', cast({sql} AS DOUBLE)) END"
    )


def lexical(sql: str, kind: T.DataType | None, writing: bool = False) -> str:
    """The lexical form of a column of a Spark type (None: not known)."""
    if isinstance(kind, T.StringType):
        return sql
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return written_double(sql) if writing else lex_double(sql)
    if isinstance(kind, T.TimestampNTZType):
        return f"replace(cast({sql} AS STRING), ' ', 'T')"
    if isinstance(kind, T.TimestampType):
        return f"date_format({sql}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")"
    return f"cast({sql} AS STRING)"
