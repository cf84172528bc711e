"""Names for SQL: sql(spark, text), register(spark) and catalog(spark)."""

from __future__ import annotations

import functools
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import InvalidInput
from .functions.lexical import quote
from .model import COLUMNS
from .operators.pivot import pivot_rdf
from .operators.profile import profile_rdf
from .plans.mapping import can_call_inside_out, is_valid_r2rml
from .plans.sparql.run import execute_sparql, sparql_to_sql
from .sources.datasource import RdfDataSource, file_rows, local_files
from .sources.reader import read_rdf, read_rdf_prefixes
from .sources.remote import read_sparql

#: name: kind, description, examples.
FUNCTIONS = {
    "read_rdf": ("table", "The statements of RDF files as rows: graph, subject, predicate, object, object_datatype, object_lang.", ["read_rdf(spark, 'data/*.nt')", "SELECT * FROM read_rdf('data/people.ttl')"]),
    "read_rdf_prefixes": ("table", "The prefix and base declarations of Turtle and TriG files.", ["read_rdf_prefixes(spark, 'people.ttl')"]),
    "profile_rdf": ("table", "Per predicate: types, counts, extremes, numbers of graphs and subjects.", ["profile_rdf(spark, 'people.nt')"]),
    "pivot_rdf": ("table", "A typed, wide table with a column for each predicate.", ["pivot_rdf(spark, 'people.nt')"]),
    "read_sparql": ("table", "The results of a remote SPARQL endpoint.", ["read_sparql(spark, 'https://host/sparql', 'SELECT * {?s ?p ?o} LIMIT 5')"]),
    "execute_sparql": ("table", "The solutions of a SPARQL query over mapped tables.", ["execute_sparql(spark, 'SELECT ?s {?s a ex:Person}', 'map.ttl')"]),
    "sparql_to_sql": ("scalar", "The Spark SQL of a SPARQL query over mapped tables.", ["sparql_to_sql('ASK {?s ?p ?o}', 'map.ttl')"]),
    "is_valid_r2rml": ("scalar", "Whether a file is a valid full mapping.", ["is_valid_r2rml('map.ttl')"]),
    "can_call_inside_out": ("scalar", "Whether a mapping takes its rows from outside.", ["can_call_inside_out('map.yml')"]),
    "write_rdf": ("sink", "Writes rows or mapped tables as N-Triples, Turtle or N-Quads.", ["write_rdf(df, 'out', 'map.ttl')"]),
    "read_rdf_stream": ("stream", "The triples of files that arrive in a folder.", ["read_rdf_stream(spark, 'incoming')"]),
}


def catalog(spark: SparkSession) -> DataFrame:
    """function_name, kind, description and examples of all functions."""
    return spark.createDataFrame([(n, *said) for n, said in FUNCTIONS.items()], "function_name string, kind string, description string, examples array<string>")


class ReadRdf:
    """Rows of RDF files that executors see as local ones, for SQL, in one task; sql() and read_rdf() are distributed."""

    def eval(self, path: str, strict_parsing: bool = True, prefix_expansion: bool = False, file_type: str = None):  # noqa: RUF013
        for file in local_files(path):
            yield from file_rows(file, file_type, strict_parsing, prefix_expansion)


def _changed(path: str | None) -> float | None:
    """When a local file was changed last."""
    try:
        return os.stat(path.removeprefix("file://").removeprefix("file:")).st_mtime
    except (AttributeError, OSError):
        return None


@functools.lru_cache(maxsize=256)
def _once(what: str, *said):
    """A scalar function's value for constants, worked out once in a worker for each state of the mapping's file."""
    if what == "sql":
        return sparql_to_sql(said[0], said[1])
    return (is_valid_r2rml if what == "valid" else can_call_inside_out)(said[0])


def register(spark: SparkSession) -> None:
    """Make the scalar functions, the table function read_rdf and the data source `rdf` known to Spark's own SQL.

    The scalar functions work constants out once in a worker. Mappings named in SQL are read where
    the expression runs: their paths must be visible there. sparql_to_sql has no catalog there, so its text compares by
    lexical form. All six table functions, distributed and on all of Hadoop's paths, are for sql() below.
    """
    spark.udf.register("is_valid_r2rml", F.udf(lambda path: _once("valid", path, _changed(path)), "boolean"))
    spark.udf.register("can_call_inside_out", F.udf(lambda path: _once("inside_out", path, _changed(path)), "boolean"))
    spark.udf.register("sparql_to_sql", F.udf(lambda query, mapping: _once("sql", query, mapping, _changed(mapping)), "string"))
    spark.udtf.register("read_rdf", F.udtf(ReadRdf, returnType=", ".join(f"{c} string" for c in COLUMNS)))
    spark.dataSource.register(RdfDataSource)


#: Table functions of sql(), by name: the DataFrame functions that they call.
TABLE_FUNCTIONS = {
    "read_rdf": read_rdf, "read_rdf_prefixes": read_rdf_prefixes, "profile_rdf": profile_rdf,
    "pivot_rdf": pivot_rdf, "read_sparql": read_sparql, "execute_sparql": execute_sparql,
}
#: Scalar functions of sql(); their arguments are constants, so that the driver knows the values.
SCALAR_FUNCTIONS = {
    "is_valid_r2rml": lambda spark, path: is_valid_r2rml(path),
    "can_call_inside_out": lambda spark, path: can_call_inside_out(path),
    "sparql_to_sql": lambda spark, query, mapping: sparql_to_sql(query, mapping, spark),
}

_CALL = re.compile(rf"\b({'|'.join([*TABLE_FUNCTIONS, *SCALAR_FUNCTIONS])})\s*\(", re.IGNORECASE)
_SKIP = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/""", re.DOTALL)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """spark.sql() with the table functions of catalog(): read_rdf('data/*.nt', strict_parsing => false), pivot_rdf(...) ...

    Arguments are constants: texts, numbers, true, false, NULL and ARRAY[...] or array(...) of them, by place or as
    name => value (or :=, or =). A call becomes the view of a lazy, distributed DataFrame, so that filters and columns of
    the surrounding query reach the scan; the scalar functions become their values.
    """
    out, at = [], 0
    while at < len(text):
        skip, call = _SKIP.match(text, at), _CALL.match(text, at)
        if skip is not None or call is None or at and (text[at - 1].isalnum() or text[at - 1] in "_.`"):
            step = skip.end() - at if skip is not None else 1
            out.append(text[at : at + step])
            at += step
            continue
        name = call[1].lower()
        given, named, at = _arguments(text, call.end())
        if name in SCALAR_FUNCTIONS:
            out.append(_literal(SCALAR_FUNCTIONS[name](spark, *given, **named)))
        else:
            view = f"{name}_{uuid.uuid4().hex}"
            TABLE_FUNCTIONS[name](spark, *given, **named).createOrReplaceTempView(view)
            out.append(view)
    return spark.sql("".join(out))


def _literal(value) -> str:
    return "NULL" if value is None else str(value).lower() if isinstance(value, bool) else quote(value)


def _arguments(text: str, at: int) -> tuple[list, dict, int]:
    """Values by place and by name, and where the list ends."""
    given, named = [], {}
    while True:
        start = re.compile(r"\s*(?:([A-Za-z_]\w*)\s*(?:=>|:=|=)\s*)?").match(text, at)
        value, at = _constant(text, start.end())
        if start[1]:
            named[start[1].lower()] = value
        elif value is not _NONE:
            given.append(value)
        end = re.compile(r"\s*([,)])").match(text, at)
        if end is None:
            raise InvalidInput(f"Invalid Input Error: a constant, ',' or ')' is expected at '{text[at : at + 20]}'")
        at = end.end()
        if end[1] == ")":
            return given, named, at


_NONE = object()
_VALUE = re.compile(r"""'((?:[^'\\]|\\.|'')*)'|(true|false|null)\b|([-+]?\d+)|(array\s*[\[(]|\[)""", re.IGNORECASE)


def _constant(text: str, at: int) -> tuple[object, int]:
    found = _VALUE.match(text, at)
    if found is None:
        return _NONE, at
    if found[1] is not None:
        return re.sub(r"\\(.)|''", lambda m: "'" if m[1] is None else {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), found[1]), found.end()
    if found[2]:
        return {"true": True, "false": False, "null": None}[found[2].lower()], found.end()
    if found[3]:
        return int(found[3]), found.end()
    items, at = [], found.end()
    while True:
        blank = re.compile(r"\s*").match(text, at).end()
        value, at = _constant(text, blank)
        if value is not _NONE:
            items.append(value)
        end = re.compile(r"\s*([,)\]])").match(text, at)
        if end is None:
            raise InvalidInput(f"Invalid Input Error: ',' or the list's end is expected at '{text[at : at + 20]}'")
        at = end.end()
        if end[1] != ",":
            return items, at
