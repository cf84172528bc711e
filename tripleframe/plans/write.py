"""Rows to triples to text: write_rdf and its parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInput, MappingError
from ..functions.lexical import quote, table_name
from ..model import RDF
from .mapping import Mapping, Reference, Term, TriplesMap, read_mapping
from .terms import Source, datatype_of, term_sql

#: Names of output formats.
RDF_FORMATS = {"ntriples": "ntriples", "nt": "ntriples", "turtle": "turtle", "ttl": "turtle", "nquads": "nquads", "nq": "nquads"}
_FIELDS = ("subject", "subject_kind", "predicate", "object", "object_kind", "object_datatype", "object_lang")


def _struct(subject: str, subject_kind: str, predicate: str, obj: str, kind: str, datatype: str | None, lang: str | None) -> str:
    values = (subject, quote(subject_kind), predicate, obj, quote(kind), *["cast(NULL AS STRING)" if x is None else quote(x) for x in (datatype, lang)])
    return "named_struct(" + ", ".join(f"'{f}', {v}" for f, v in zip(_FIELDS, values, strict=True)) + ")"


def _map_structs(m: TriplesMap, source: Source, objects: list[tuple[Term, Term, Source]]) -> list[str]:
    """The triples of a row, as SQL structs; a null subject, predicate or object means that there is no triple."""
    subject = term_sql(m.subject, source, True)
    out = [_struct(subject, m.subject.type, quote(RDF + "type"), quote(c), "I", None, None) for c in m.classes]
    for predicate, obj, where in objects:
        out.append(_struct(subject, m.subject.type, term_sql(predicate, source, True), term_sql(obj, where, True), obj.type, datatype_of(obj, where), obj.lang))
    return out


def _inlined(df: DataFrame, structs: list[str]) -> DataFrame:
    """One scan whatever the number of triples in a row."""
    if not structs:
        return df.select(*[F.lit(None).cast("string").alias(f) for f in _FIELDS]).limit(0)
    return df.select(F.inline(F.expr(f"array({', '.join(structs)})"))).filter("subject is not null and predicate is not null and object is not null")


def rows_to_triples(df: DataFrame, mapping: Mapping, ignore_case: bool = False) -> DataFrame:
    """The triples of df's rows by a mapping without sources (subject, predicate, object, their kinds, datatype, lang)."""
    source = Source("", df.schema, ignore_case)
    structs = []
    for m in mapping.maps.values():
        structs += _map_structs(m, source, [(p, o, source) for pair in m.pairs for p in pair.predicates for o in pair.objects])
    return _inlined(df, structs)


def source_sql(m: TriplesMap) -> str:
    return f"({m.query.strip().rstrip(';')})" if m.query is not None else table_name(m.table)


def source_frame(spark: SparkSession, m: TriplesMap) -> DataFrame:
    return spark.sql(m.query.strip().rstrip(";")) if m.query is not None else spark.table(table_name(m.table))


def tables_to_triples(spark: SparkSession, mapping: Mapping, ignore_case: bool = False) -> DataFrame:
    """The triples of the mapping's own tables and queries; references are joins of child and parent."""
    parts = []
    for m in mapping.maps.values():
        frame = source_frame(spark, m)
        source = Source("c", frame.schema, ignore_case)
        plain = [(p, o, source) for pair in m.pairs for p in pair.predicates for o in pair.objects if isinstance(o, Term)]
        parts.append(_inlined(frame.alias("c"), _map_structs(m, source, plain)))
        for pair in m.pairs:
            for o in pair.objects:
                if not isinstance(o, Reference):
                    continue
                parent = mapping.maps[o.parent]
                other = source_frame(spark, parent)
                there = Source("p", other.schema, ignore_case)
                if o.joins:
                    on = F.expr(" AND ".join(f"{source.sql(c)} = {there.sql(p)}" for c, p in o.joins))
                    joined = frame.alias("c").join(other.alias("p"), on)
                else:  # the same row
                    joined, there = frame.alias("c"), Source("c", frame.schema, ignore_case)
                bare = TriplesMap(m.id, subject=m.subject)
                parts.append(_inlined(joined, _map_structs(bare, source, [(p, parent.subject, there) for p in pair.predicates])))
    return reduce(DataFrame.unionByName, parts)


def _iri(value: Column, strict: bool) -> Column:
    """An IRI in brackets; characters that an IRI can't have make it null (or fail)."""
    bad = value.rlike(r"[\x00-\x20<>\"{}|^`\\]")
    said = F.concat(F.lit("<"), value, F.lit(">"))
    return F.when(~bad, said).otherwise(F.raise_error(F.concat(F.lit("Invalid IRI: "), value)).cast("string") if strict else F.lit(None).cast("string"))


def _blank(value: Column) -> Column:
    return F.concat(F.lit("_:"), F.when(value.rlike("^[A-Za-z0-9]+$"), value).otherwise(F.concat(F.lit("x"), F.lower(F.hex(value)))))


def escape_literal(value: Column) -> Column:
    for raw, said in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(raw), F.lit(said))
    return value


def triples_to_lines(triples: DataFrame, ignore_non_fatal_errors: bool = True) -> DataFrame:
    """A line of N-Triples for each triple, as column value; N-Triples are N-Quads and Turtle as well."""
    strict = not ignore_non_fatal_errors
    node = lambda c: F.when(F.col(f"{c}_kind") == "B", _blank(F.col(c))).otherwise(_iri(F.col(c), strict))
    tail = F.when(F.col("object_lang").isNotNull(), F.concat(F.lit("@"), F.col("object_lang"))).when(
        F.col("object_datatype").isNotNull(), F.concat(F.lit("^^<"), F.col("object_datatype"), F.lit(">"))
    )
    literal = F.concat(F.lit('"'), escape_literal(F.col("object")), F.lit('"'), F.coalesce(tail, F.lit("")))
    obj = F.when(F.col("object_kind") == "L", literal).otherwise(node("object"))
    line = F.concat(node("subject"), F.lit(" "), _iri(F.col("predicate"), strict), F.lit(" "), obj, F.lit(" ."))
    return triples.select(line.alias("value")).filter("value is not null")


def write_rdf(
    df: DataFrame | None,
    path: str,
    mapping: str | Mapping | None = None,
    rdf_format: str = "ntriples",
    ignore_non_fatal_errors: bool = True,
    ignore_case: bool = False,
    distinct: bool = False,
    single_file: bool = False,
    mode: str = "error",
    compression: str | None = None,
) -> None:
    """Write RDF by a mapping: from df's rows if the mapping has no sources, else from the mapping's own tables.

    ignore_non_fatal_errors: triples with a malformed IRI are left out; otherwise they fail the write.
    ignore_case: the mapping's column names match in any case (SQL text is never changed).
    The output is a folder of part files, written in parallel; single_file: one file instead.
    """
    if mapping is None:
        raise InvalidInput("Invalid Input Error: the mapping option is required")
    if rdf_format.lower() not in RDF_FORMATS:
        raise InvalidInput(f"Unknown rdf_format: '{rdf_format}'")
    said = mapping if isinstance(mapping, str) else "given"
    model = read_mapping(mapping) if isinstance(mapping, str) else mapping
    if model.can_call_inside_out():
        if df is None:
            raise InvalidInput("Invalid Input Error: this mapping needs rows")
        triples = rows_to_triples(df, model, ignore_case)
    elif model.is_valid():
        spark = df.sparkSession if df is not None else SparkSession.getActiveSession()
        triples = tables_to_triples(spark, model, ignore_case)
    else:
        raise MappingError(f"R2RML mapping '{said}' is not valid.")
    lines = triples_to_lines(triples.distinct() if distinct else triples, ignore_non_fatal_errors)
    spark = lines.sparkSession
    extension = {"ntriples": "nt", "turtle": "ttl", "nquads": "nq"}[RDF_FORMATS[rdf_format.lower()]]
    to = lines.coalesce(1) if single_file else lines
    writer = to.write.mode(mode).option("compression", compression or "none")
    if not single_file:
        writer.text(path)
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(f"{path}.parts"), jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    if system.exists(target):
        if mode == "ignore":
            return
        if mode != "overwrite":
            raise InvalidInput(f"IO Error: '{path}' exists; it would hold {extension} lines")
    writer.text(f"{path}.parts")
    part = next(s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-"))
    system.delete(target, True)
    system.rename(part, target)
    system.delete(folder, True)
