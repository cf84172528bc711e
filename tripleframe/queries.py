"""Queries over the test tables, and their SQL, for the entry file.

Triples are made from the tables as N-Triples or N-Quads lines, or written as files
where a reader of files is at work, and SPARQL runs over the tables through a mapping.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import COLUMNS, KIND
from .operators.pivot import pivot, pivot_rdf, pivot_schema, union_extract, union_tag
from .operators.profile import profile, profile_rdf
from .plans import r2rml
from .plans.mapping import can_call_inside_out, is_valid_r2rml
from .plans.sparql.run import execute_sparql, sparql_to_sql
from .plans.write import escape_literal, rows_to_triples, tables_to_triples, triples_to_lines, write_rdf
from .sources.lines import statements
from .sources.paths import files_of
from .sources.reader import read_rdf, read_rdf_prefixes, skipped_lines
from .sqlapi import FUNCTIONS, catalog, sql
from .streaming.reader import read_rdf_stream

EX = "http://example.org/ns#"
DATA = "http://data.example.org/"
_XSD = "http://www.w3.org/2001/XMLSchema#"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# lines of N-Triples from tables


def iri(kind: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"<{DATA}{kind}/"), F.col(key).cast("string") if isinstance(key, str) else key, F.lit(">"))


def quoted(value: Column | str) -> Column:
    return F.concat(F.lit('"'), escape_literal(F.col(value).cast("string") if isinstance(value, str) else value), F.lit('"'))


def typed(value: Column | str, name: str) -> Column:
    return F.concat(quoted(value), F.lit(f"^^<{_XSD}{name}>"))


def lines(df: DataFrame, subject: Column, objects: dict[str, Column], graph: Column | None = None, at_once: bool = False) -> DataFrame:
    """A line for each row and predicate; at_once: as df's rows are dealt and in their order."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not at_once and df.rdd.getNumPartitions() < cores:  # a table of few row groups: each row becomes several lines, which all cores should cut
        df = df.repartition(cores)
    tail = F.lit(" .") if graph is None else F.concat(F.lit(" "), graph, F.lit(" ."))
    made = [F.concat(subject, F.lit(f" <{EX}{p}> "), o, tail) for p, o in objects.items()]
    return df.select(F.explode(F.array(*made)).alias("value")).filter("value is not null")


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer")
    return lines(df, iri("customer", "c_custkey"), {"name": quoted("c_name"), "segment": F.concat(quoted("c_mktsegment"), F.lit("@en")), "nation": iri("nation", "c_nationkey")})


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return lines(
        df,
        iri("order", "o_orderkey"),
        {"status": quoted("o_orderstatus"), "priority": quoted("o_orderpriority"), "customer": iri("customer", "o_custkey"), "key": typed("o_orderkey", "long")},
        iri("status", "o_orderstatus"),
    )


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    subject = iri("item", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return lines(df, subject, {"part": iri("part", "l_partkey"), "flag": quoted("l_returnflag"), "line": typed("l_linenumber", "int"), "ship": typed(F.col("l_shipdate").cast("date").cast("string"), "date")})


def triples(line_table: DataFrame, quads: bool = False) -> DataFrame:
    return statements(line_table, quads).select(*COLUMNS)


def numbered(line_table: DataFrame, quads: bool = False) -> DataFrame:
    """A triple table as pivot() and profile() take it."""
    pos = F.struct(F.lit(0).cast("bigint").alias("block"), F.monotonically_increasing_id().alias("row"))
    return statements(line_table, quads).select(*COLUMNS, KIND, F.lit("").alias("filename"), pos.alias("_pos"))


_CUSTOMER_TRIPLES = f"""
SELECT NULL::VARCHAR AS graph, '{DATA}customer/' || c_custkey AS subject, '{EX}name' AS predicate, c_name AS object, NULL::VARCHAR AS object_datatype, NULL::VARCHAR AS object_lang FROM customer
UNION ALL SELECT NULL, '{DATA}customer/' || c_custkey, '{EX}segment', c_mktsegment, NULL, 'en' FROM customer
UNION ALL SELECT NULL, '{DATA}customer/' || c_custkey, '{EX}nation', '{DATA}nation/' || c_nationkey, NULL, NULL FROM customer"""
_ORDER_TRIPLES = f"""
SELECT '{DATA}status/' || o_orderstatus AS graph, '{DATA}order/' || o_orderkey AS subject, p AS predicate,
  CASE p WHEN '{EX}status' THEN o_orderstatus WHEN '{EX}priority' THEN o_orderpriority WHEN '{EX}customer' THEN '{DATA}customer/' || o_custkey ELSE o_orderkey::VARCHAR END AS object,
  CASE WHEN p = '{EX}key' THEN '{_XSD}long' END AS object_datatype, NULL::VARCHAR AS object_lang
FROM orders, (VALUES ('{EX}status'), ('{EX}priority'), ('{EX}customer'), ('{EX}key')) v(p)"""


@query(_CUSTOMER_TRIPLES)
def nt_roundtrip_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(customer_lines(spark, sf_dir))


@query("SELECT doc_id, coalesce(text, '') AS text FROM documents")
def nt_escapes_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    out = triples(lines(df, iri("doc", "doc_id"), {"text": quoted("text")}))
    return out.select(F.substring_index("subject", "/", -1).cast("bigint").alias("doc_id"), F.col("object").alias("text"))


@query(f"SELECT graph, predicate, count(*) AS n, count(DISTINCT subject) AS subjects FROM ({_ORDER_TRIPLES}) GROUP BY graph, predicate")
def nq_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = triples(order_lines(spark, sf_dir), True)
    return out.groupBy("graph", "predicate").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subject").alias("subjects"))


@query(f"SELECT subject, object FROM ({_CUSTOMER_TRIPLES}) WHERE predicate = '{EX}nation'")
def nt_filter_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(customer_lines(spark, sf_dir)).filter(F.col("predicate") == f"{EX}nation").select("subject", "object")


@query(f"SELECT subject, object FROM ({_CUSTOMER_TRIPLES}) WHERE subject LIKE '{DATA}customer/1%'")
def nt_prefix_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(customer_lines(spark, sf_dir)).filter(F.col("subject").startswith(f"{DATA}customer/1")).select("subject", "object")


@query(f"SELECT count(*) AS n FROM ({_CUSTOMER_TRIPLES}) WHERE graph IS NULL AND object_lang IS NULL")
def nt_graph_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(customer_lines(spark, sf_dir)).filter("graph IS NULL AND object_lang IS NULL").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT predicate, count(*) AS n FROM ({_CUSTOMER_TRIPLES}) WHERE predicate <> '{EX}name' AND object >= 'B' GROUP BY predicate")
def nt_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(customer_lines(spark, sf_dir)).filter(f"predicate <> '{EX}name' AND object >= 'B'").groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang AS object_lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def lang_literals_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").filter("lang IS NOT NULL")
    out = triples(lines(df, iri("doc", "doc_id"), {"chars": F.concat(quoted("n_chars"), F.lit("@"), F.col("lang"))}))
    return out.groupBy("object_lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("object").cast("bigint")).alias("chars"))


@query("SELECT count(*) AS n FROM lineitem, range(4)")
def nt_scan_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(item_lines(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag AS object, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def nt_scan_lineitem_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(item_lines(spark, sf_dir)).filter(F.col("predicate") == f"{EX}flag").groupBy("object").agg(F.count(F.lit(1)).alias("n"))


# profiles


def _order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(numbered(order_lines(spark, sf_dir), True))


_ORDER_TYPED = f"""(SELECT *, CASE WHEN object_datatype IS NOT NULL THEN 'BIGINT' WHEN predicate = '{EX}customer' THEN 'IRI' ELSE 'VARCHAR' END AS type FROM ({_ORDER_TRIPLES}))"""


@query(f"SELECT predicate, type, count(*) AS n FROM {_ORDER_TYPED} GROUP BY predicate, type")
def profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_profile(spark, sf_dir).select("predicate", F.explode("count").alias("type", "n"))


@query(f"SELECT predicate, type, min(object) AS lo, max(object) AS hi FROM {_ORDER_TYPED} GROUP BY predicate, type")
def profile_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _order_profile(spark, sf_dir).select("predicate", F.explode("types").alias("type"), "min", "max")
    return out.select("predicate", "type", F.try_element_at("min", F.col("type")).alias("lo"), F.try_element_at("max", F.col("type")).alias("hi"))


@query(f"SELECT predicate, count(DISTINCT graph) AS graph_count, count(DISTINCT subject) AS subject_count FROM ({_ORDER_TRIPLES}) GROUP BY predicate")
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_profile(spark, sf_dir).select("predicate", "graph_count", "subject_count")


# pivots


def _pivoted(line_table: DataFrame) -> DataFrame:
    data = numbered(line_table)
    return pivot(data, pivot_schema(profile(data, False).collect()))


@query(f"SELECT '' AS graph, '{DATA}nation/' || n_nationkey AS subject, n_nationkey AS nkey, n_name AS name, '{DATA}region/' || n_regionkey AS region FROM nation")
def pivot_scalar_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "nation")
    out = _pivoted(lines(df, iri("nation", "n_nationkey"), {"key": typed("n_nationkey", "int"), "name": quoted("n_name"), "region": iri("region", "n_regionkey")}))
    return out.select("graph", "subject", F.col(f"`{EX}key`").alias("nkey"), F.col(f"`{EX}name`").alias("name"), F.col(f"`{EX}region`").alias("region"))


@query(f"SELECT '{DATA}customer/' || o_custkey AS subject, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS orders FROM orders GROUP BY o_custkey")
def pivot_list_orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _pivoted(lines(table(spark, sf_dir, "orders"), iri("customer", "o_custkey"), {"order": typed("o_orderkey", "long")}))
    values = F.col(f"`{EX}order`")
    return out.select("subject", F.size(values).cast("bigint").alias("n"), F.array_join(F.array_sort(values).cast("array<string>"), ",").alias("orders"))


@query(
    f"SELECT '{DATA}supplier/' || s_suppkey AS subject, CASE WHEN s_suppkey % 2 = 0 THEN 'BIGINT' ELSE 'varchar' END AS tag, "
    "CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS whole, CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS words FROM supplier"
)
def pivot_union_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("s_suppkey") % 2 == 0, typed("s_suppkey", "long")).otherwise(quoted("s_name"))
    out = _pivoted(lines(table(spark, sf_dir, "supplier"), iri("supplier", "s_suppkey"), {"mixed": value}))
    mixed = F.col(f"`{EX}mixed`")
    return out.select("subject", union_tag(mixed).alias("tag"), union_extract(mixed, "BIGINT").alias("whole"), union_extract(mixed, "varchar").alias("words"))


@query(f"SELECT '{DATA}doc/' || doc_id AS subject, source AS object, coalesce(lang, '') AS lang FROM documents WHERE source IS NOT NULL")
def pivot_lang_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(quoted("source"), F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.lit("")))
    out = _pivoted(lines(table(spark, sf_dir, "documents"), iri("doc", "doc_id"), {"from": said}))
    at = F.col(f"`{EX}from`")
    return out.select("subject", at["object"].alias("object"), at["lang"].alias("lang"))


@query(
    f"SELECT '{DATA}status/' || o_orderstatus AS graph, '{DATA}order/' || o_orderkey AS subject, '{DATA}customer/' || o_custkey AS customer, o_orderkey AS okey, o_orderpriority AS priority FROM orders"
)
def pivot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = numbered(order_lines(spark, sf_dir), True)
    out = pivot(data, pivot_schema(profile(data).collect()))
    return out.select("graph", "subject", *[F.col(f"`{EX}{c}`").alias(n) for c, n in (("customer", "customer"), ("key", "okey"), ("priority", "priority"))])


@query(
    f"""SELECT '{DATA}item/' || l_orderkey || '-' || l_linenumber AS subject, count(DISTINCT l_partkey) AS parts, string_agg(DISTINCT l_returnflag, '' ORDER BY l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
)
def pivot_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys repeat in the test table, so that columns are lists."""
    data = numbered(item_lines(spark, sf_dir))
    out = pivot(data, [replace(c, multi=True) for c in pivot_schema(profile(data, False).collect())])
    return out.select("subject", F.size(F.col(f"`{EX}part`")).cast("bigint").alias("parts"), F.array_join(F.array_sort(F.col(f"`{EX}flag`")), "").alias("flags"))


# writing

_HEAD = f"@prefix rr: <http://www.w3.org/ns/r2rml#> .\n@prefix ex: <{EX}> .\n"


def _pom(predicate: str, column: str) -> str:
    return f'rr:predicateObjectMap [ rr:predicate ex:{predicate} ; rr:objectMap [ rr:column "{column}" ] ]'


def _ref(predicate: str, template: str) -> str:
    return f'rr:predicateObjectMap [ rr:predicate ex:{predicate} ; rr:objectMap [ rr:template "{DATA}{template}" ] ]'


def _map(name: str, source: str | None, template: str, *pairs: str, of_class: str | None = None) -> str:
    where = f'rr:logicalTable [ rr:tableName "{source}" ] ; ' if source else ""
    kind = f" ; rr:class ex:{of_class}" if of_class else ""
    return f'<#{name}> {where}rr:subjectMap [ rr:template "{DATA}{template}"{kind} ] ; {" ; ".join(pairs)} .\n'


_TRIPLE_COLUMNS = ("subject", "predicate", "object", "object_datatype", "object_lang")


@query(
    f"""SELECT '{DATA}customer/' || c_custkey AS subject, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS predicate, '{EX}Customer' AS object, NULL::VARCHAR AS object_datatype, NULL::VARCHAR AS object_lang FROM customer
UNION ALL SELECT '{DATA}customer/' || c_custkey, '{EX}name', c_name, NULL, NULL FROM customer
UNION ALL SELECT '{DATA}customer/' || c_custkey, '{EX}nation', '{DATA}nation/' || c_nationkey, NULL, NULL FROM customer"""
)
def write_inside_out_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to lines and back."""
    mapping = r2rml.parse(_HEAD + _map("C", None, "customer/{c_custkey}", _pom("name", "c_name"), _ref("nation", "nation/{c_nationkey}"), of_class="Customer"))
    out = triples_to_lines(rows_to_triples(table(spark, sf_dir, "customer"), mapping))
    return triples(out).select(*_TRIPLE_COLUMNS)


@query(
    f"""SELECT '{DATA}order/' || o_orderkey AS subject, p AS predicate,
  CASE p WHEN '{EX}key' THEN o_orderkey::VARCHAR WHEN '{EX}total' THEN printf('%.6f', o_totalprice) ELSE replace(o_orderdate::VARCHAR, ' ', 'T') END AS object,
  '{_XSD}' || CASE p WHEN '{EX}key' THEN 'long' WHEN '{EX}total' THEN 'double' ELSE 'dateTime' END AS object_datatype
FROM orders, (VALUES ('{EX}key'), ('{EX}total'), ('{EX}date')) v(p)"""
)
def write_typed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = r2rml.parse(_HEAD + _map("O", None, "order/{o_orderkey}", _pom("key", "o_orderkey"), _pom("total", "o_totalprice"), _pom("date", "o_orderdate")))
    out = triples_to_lines(rows_to_triples(table(spark, sf_dir, "orders"), mapping))
    return triples(out).select("subject", "predicate", "object", "object_datatype")


@query(f"SELECT '{DATA}event/' || event_id AS subject, CASE WHEN user_id % 3 > 0 THEN event_type END AS object FROM events WHERE user_id % 3 > 0")
def write_null_omitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("user_id") % 3 > 0, F.col("event_type")))
    mapping = r2rml.parse(_HEAD + _map("E", None, "event/{event_id}", _pom("kind", "kind"), _pom("none", "no_such_column")))
    return rows_to_triples(df, mapping).select("subject", "object")


@query(f"SELECT '{DATA}nation/' || n_nationkey AS subject, '{DATA}region/' || r_regionkey AS object FROM nation JOIN region ON n_regionkey = r_regionkey")
def write_join_refobject(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "nation", "region")
    join = 'rr:predicateObjectMap [ rr:predicate ex:in ; rr:objectMap [ rr:parentTriplesMap <#R> ; rr:joinCondition [ rr:child "n_regionkey" ; rr:parent "r_regionkey" ] ] ]'
    mapping = r2rml.parse(_HEAD + _map("N", "nation", "nation/{n_nationkey}", join) + _map("R", "region", "region/{r_regionkey}", _pom("name", "r_name")))
    out = tables_to_triples(spark, mapping).filter(F.col("predicate") == f"{EX}in")
    return out.select("subject", "object")


@query(f"SELECT '{DATA}part/' || p_partkey AS subject, '{EX}Part' AS object FROM part UNION ALL SELECT '{DATA}supplier/' || s_suppkey, '{EX}Supplier' FROM supplier")
def write_class_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "part", "supplier")
    mapping = r2rml.parse(
        _HEAD + _map("P", "part", "part/{p_partkey}", _pom("name", "p_name"), of_class="Part") + _map("S", "supplier", "supplier/{s_suppkey}", _pom("name", "s_name"), of_class="Supplier")
    )
    return tables_to_triples(spark, mapping).filter(F.col("predicate").endswith("#type")).select("subject", "object")


def work_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tripleframe-")
    return f"{base.rstrip('/')}/queries-{uuid.uuid4().hex}"


@query("SELECT 4 * count(*) AS n, count(DISTINCT o_orderkey) AS subjects FROM orders")
def write_orders_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as N-Triples files and read again."""
    mapping = _HEAD + _map("O", None, "order/{o_orderkey}", _pom("status", "o_orderstatus"), _pom("total", "o_totalprice"), _pom("date", "o_orderdate"), _ref("customer", "customer/{o_custkey}"))
    path = work_dir(spark)
    write_rdf(table(spark, sf_dir, "orders"), path, r2rml.parse(mapping))
    return read_rdf(spark, path, file_type="nt").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subject").alias("subjects"))


# document formats


def _written(spark: SparkSession, text: DataFrame) -> str:
    path = work_dir(spark)
    text.coalesce(1).write.option("lineSep", "\n").text(path)
    return path


_NATION_TRIPLES = f"""SELECT '{DATA}nation/' || n_nationkey AS subject, '{EX}name' AS predicate, n_name AS object, 'en' AS object_lang FROM nation
UNION ALL SELECT '{DATA}nation/' || n_nationkey, '{EX}region', '{DATA}region/' || n_regionkey, NULL FROM nation"""


def _document(df: DataFrame, head: list[str], tail: list[str], body: Column) -> DataFrame:
    """One row, the whole document: the table is bounded (nation)."""
    inner = F.array_join(F.array_sort(F.collect_list(body)), "\n")
    return df.agg(F.concat(F.lit("\n".join([*head, ""])), inner, F.lit("\n".join(["", *tail]))).alias("value"))


@query(_NATION_TRIPLES)
def turtle_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    body = F.concat(F.lit("<nation/"), key, F.lit("> ex:name "), quoted("n_name"), F.lit("@en ; ex:region <region/"), F.col("n_regionkey").cast("string"), F.lit("> ."))
    path = _written(spark, _document(table(spark, sf_dir, "nation"), [f"@prefix ex: <{EX}> .", f"@base <{DATA}> ."], [], body))
    return read_rdf(spark, path, prefix_expansion=True, file_type="ttl").select("subject", "predicate", "object", "object_lang")


@query(f"SELECT '{DATA}region/' || n_regionkey AS graph, '{DATA}nation/' || n_nationkey AS subject, n_name AS object FROM nation")
def trig_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    body = F.concat(F.lit("GRAPH <region/"), text("n_regionkey"), F.lit("> { <nation/"), text("n_nationkey"), F.lit("> ex:name "), quoted("n_name"), F.lit(" }"))
    path = _written(spark, _document(table(spark, sf_dir, "nation"), [f"PREFIX ex: <{EX}>", f"BASE <{DATA}>"], [], body))
    return read_rdf(spark, path, prefix_expansion=True, file_type="trig").select("graph", "subject", "object")


@query(_NATION_TRIPLES)
def rdfxml_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    body = F.concat(
        F.lit('<rdf:Description rdf:about="nation/'), text("n_nationkey"), F.lit('"><ex:name xml:lang="en">'), text("n_name"),
        F.lit('</ex:name><ex:region rdf:resource="region/'), text("n_regionkey"), F.lit('"/></rdf:Description>'),
    )
    head = [f'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:ex="{EX}" xml:base="{DATA}">']
    path = _written(spark, _document(table(spark, sf_dir, "nation"), head, ["</rdf:RDF>"], body))
    return read_rdf(spark, path, file_type="rdf").select("subject", "predicate", "object", "object_lang")


@query(f"SELECT * FROM (VALUES ('ex', '{EX}', false), (NULL, '{DATA}', true), ('ex', 'http://other.example.org/', false)) v(prefix, uri, is_base)")
def prefixes_of_generated_turtle(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit("<nation/"), F.col("n_nationkey").cast("string"), F.lit("> a ex:Nation ."))
    path = _written(spark, _document(table(spark, sf_dir, "nation"), [f"@prefix ex: <{EX}> .", f"@base <{DATA}> ."], ["PREFIX ex: <http://other.example.org/>"], body))
    return read_rdf_prefixes(spark, path, file_type="ttl")


# SPARQL over the tables


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


TPCH = r2rml.parse(
    _HEAD
    + _map("R", "region", "region/{r_regionkey}", _pom("regionName", "r_name"), of_class="Region")
    + _map("N", "nation", "nation/{n_nationkey}", _pom("nationName", "n_name"), _pom("nationKey", "n_nationkey"), _ref("inRegion", "region/{n_regionkey}"), of_class="Nation")
    + _map("C", "customer", "customer/{c_custkey}", _pom("customerName", "c_name"), _pom("segment", "c_mktsegment"), _pom("custNationKey", "c_nationkey"), _ref("ofNation", "nation/{c_nationkey}"), of_class="Customer")
    + _map("S", "supplier", "supplier/{s_suppkey}", _pom("supplierName", "s_name"), _ref("ofNation", "nation/{s_nationkey}"), of_class="Supplier")
    + _map("O", "orders", "order/{o_orderkey}", _pom("status", "o_orderstatus"), _pom("priority", "o_orderpriority"), _pom("orderKey", "o_orderkey"), _ref("placedBy", "customer/{o_custkey}"), of_class="Order")
    + _map("P", "part", "part/{p_partkey}", _pom("partName", "p_name"), _pom("brand", "p_brand"), _pom("size", "p_size"), of_class="Part")
    + _map("T", "conversations", "turn/{conv_id}/{turn}", _pom("role", "role"))
)


def sparql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    views(spark, sf_dir, "region", "nation", "customer", "supplier", "orders", "part", "conversations")
    return execute_sparql(spark, f"PREFIX ex: <{EX}> PREFIX xsd: <{_XSD}> {text}", TPCH)


def sparql_query(name: str, text: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sparql(spark, sf_dir, text)

    run.__name__ = f"sparql_{name}"
    query(sql)(run)


_N, _R, _C, _O, _P = (f"'{DATA}{k}/' || " for k in ("nation", "region", "customer", "order", "part"))

sparql_query("bgp", "SELECT ?c ?n { ?c ex:customerName ?n ; ex:segment 'BUILDING' }", f"SELECT {_C}c_custkey AS v_c, c_name AS v_n FROM customer WHERE c_mktsegment = 'BUILDING'")
sparql_query(
    "join_region",
    "SELECT ?c ?nn ?rn { ?c a ex:Customer ; ex:ofNation ?n . ?n ex:nationName ?nn ; ex:inRegion ?r . ?r ex:regionName ?rn }",
    f"SELECT {_C}c_custkey AS v_c, n_name AS v_nn, r_name AS v_rn FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
sparql_query(
    "join_native_key",
    "SELECT ?c ?nn { ?c ex:custNationKey ?k . ?n ex:nationKey ?k ; ex:nationName ?nn }",
    f"SELECT {_C}c_custkey AS v_c, n_name AS v_nn FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
sparql_query(
    "optional_orders",
    "SELECT ?c ?o { ?c ex:customerName ?n OPTIONAL { ?o ex:placedBy ?c ; ex:status 'P' } }",
    f"SELECT {_C}c_custkey AS v_c, {_O}o_orderkey AS v_o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'",
)
sparql_query("filter_numeric", "SELECT ?p ?s { ?p ex:size ?s FILTER(?s > 40 && ?s <= 45) }", f"SELECT {_P}p_partkey AS v_p, p_size::VARCHAR AS v_s FROM part WHERE p_size > 40 AND p_size <= 45")
sparql_query("filter_regex", "SELECT ?n { ?x ex:nationName ?n FILTER REGEX(?n, '^nation.*[1-4]$', 'i') }", "SELECT DISTINCT n_name AS v_n FROM nation WHERE regexp_matches(lower(n_name), '^nation.*[1-4]$')")
sparql_query(
    "bind_concat",
    "SELECT ?x { ?p ex:partName ?n ; ex:brand ?b BIND(CONCAT(UCASE(?b), ':', SUBSTR(?n, 1, 4)) AS ?x) }",
    "SELECT upper(p_brand) || ':' || substr(p_name, 1, 4) AS v_x FROM part",
)
sparql_query(
    "group_count",
    "SELECT ?seg (COUNT(?c) AS ?n) (COUNT(DISTINCT ?k) AS ?k2) { ?c ex:segment ?seg ; ex:custNationKey ?k } GROUP BY ?seg",
    "SELECT c_mktsegment AS v_seg, count(*)::VARCHAR AS v_n, count(DISTINCT c_nationkey)::VARCHAR AS v_k2 FROM customer GROUP BY 1",
)
sparql_query(
    "having",
    "SELECT ?b (SUM(?s) AS ?t) { ?p ex:brand ?b ; ex:size ?s } GROUP BY ?b HAVING (COUNT(*) > 2)",
    "SELECT p_brand AS v_b, sum(p_size)::BIGINT::VARCHAR AS v_t FROM part GROUP BY 1 HAVING count(*) > 2",
)
sparql_query("order_limit", "SELECT ?o ?k { ?o ex:orderKey ?k } ORDER BY DESC(?k) LIMIT 10 OFFSET 5", f"SELECT {_O}o_orderkey AS v_o, o_orderkey::VARCHAR AS v_k FROM orders ORDER BY o_orderkey DESC LIMIT 10 OFFSET 5")
sparql_query("distinct", "SELECT DISTINCT ?s ?p { ?o ex:status ?s ; ex:priority ?p }", "SELECT DISTINCT o_orderstatus AS v_s, o_orderpriority AS v_p FROM orders")
sparql_query(
    "union",
    "SELECT ?n { { ?x ex:nationName ?n } UNION { ?x ex:regionName ?n } UNION { ?x a ex:Supplier ; ex:supplierName ?n } }",
    "SELECT n_name AS v_n FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT s_name FROM supplier",
)
sparql_query(
    "minus", "SELECT ?c { ?c a ex:Customer MINUS { ?o ex:placedBy ?c ; ex:status 'F' } }", f"SELECT {_C}c_custkey AS v_c FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"
)
sparql_query("exists", "SELECT ?n { ?x ex:nationName ?n FILTER EXISTS { ?s a ex:Supplier ; ex:ofNation ?x } }", "SELECT n_name AS v_n FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)")
sparql_query("not_exists", "SELECT ?c { ?c a ex:Customer FILTER NOT EXISTS { ?o ex:placedBy ?c ; ex:status 'P' } }", f"SELECT {_C}c_custkey AS v_c FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
sparql_query(
    "values",
    f"SELECT ?r ?n {{ VALUES ?r {{ <{DATA}region/1> <{DATA}region/3> }} ?x ex:inRegion ?r ; ex:nationName ?n }}",
    f"SELECT {_R}n_regionkey AS v_r, n_name AS v_n FROM nation WHERE n_regionkey IN (1, 3)",
)
sparql_query(
    "subselect",
    "SELECT ?n ?k { ?x ex:nationName ?n { SELECT ?x (COUNT(?c) AS ?k) { ?c a ex:Customer ; ex:ofNation ?x } GROUP BY ?x } }",
    "SELECT n_name AS v_n, count(*)::VARCHAR AS v_k FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name",
)
sparql_query("ask", "ASK { ?x ex:regionName 'ASIA' . ?n ex:inRegion ?x }", "SELECT count(*) > 0 AS ask FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
sparql_query(
    "var_predicate",
    f"SELECT ?p ?o {{ <{DATA}nation/7> ?p ?o }}",
    f"""SELECT 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS v_p, '{EX}Nation' AS v_o UNION ALL SELECT '{EX}nationName', n_name FROM nation WHERE n_nationkey = 7
UNION ALL SELECT '{EX}nationKey', '7' UNION ALL SELECT '{EX}inRegion', {_R}n_regionkey FROM nation WHERE n_nationkey = 7""",
)
sparql_query(
    "path_sequence",
    "SELECT ?c ?r { ?c a ex:Customer ; ex:ofNation/ex:inRegion/ex:regionName ?r }",
    f"SELECT {_C}c_custkey AS v_c, r_name AS v_r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
sparql_query(
    "path_alternative",
    "SELECT ?x ?v { ?x (ex:regionName|ex:inRegion) ?v }",
    f"SELECT {_R}r_regionkey AS v_x, r_name AS v_v FROM region UNION ALL SELECT {_N}n_nationkey, {_R}n_regionkey FROM nation",
)
sparql_query(
    "group_concat",
    "SELECT ?r (GROUP_CONCAT(?n ; SEPARATOR = ',') AS ?all) { ?x ex:nationName ?n ; ex:inRegion ?r } GROUP BY ?r",
    f"SELECT {_R}n_regionkey AS v_r, string_agg(n_name, ',' ORDER BY n_name) AS v_all FROM nation GROUP BY n_regionkey",
)

#: A chain over the turns of conversations, and a cycle over nation keys.
_PATHS = r2rml.parse(
    _HEAD
    + f'<#T> rr:logicalTable [ rr:sqlQuery "SELECT conv_id, turn, turn + 1 AS following FROM conversations" ] ; rr:subjectMap [ rr:template "{DATA}turn/{{conv_id}}/{{turn}}" ] ; '
    + _ref("next", "turn/{conv_id}/{following}")
    + f' .\n<#N> rr:logicalTable [ rr:sqlQuery "SELECT n_nationkey, (n_nationkey + 5) % 25 AS other FROM nation" ] ; rr:subjectMap [ rr:template "{DATA}nation/{{n_nationkey}}" ] ; '
    + _ref("step", "nation/{other}")
    + " .\n"
)


@query(
    f"""WITH RECURSIVE e AS (SELECT DISTINCT conv_id, turn AS a, turn + 1 AS b FROM conversations),
c AS (SELECT conv_id, a, b FROM e UNION SELECT c.conv_id, c.a, e.b FROM c JOIN e ON c.conv_id = e.conv_id AND c.b = e.a)
SELECT '{DATA}turn/' || conv_id || '/' || a AS v_x, '{DATA}turn/' || conv_id || '/' || b AS v_y FROM c WHERE conv_id IS NOT NULL AND a IS NOT NULL"""
)
def sparql_path_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "conversations", "nation")
    return execute_sparql(spark, f"PREFIX ex: <{EX}> SELECT ?x ?y {{ ?x ex:next+ ?y }}", _PATHS)


@query(f"SELECT {_N}a.n_nationkey AS v_x, {_N}b.n_nationkey AS v_y FROM nation a JOIN nation b ON a.n_nationkey % 5 = b.n_nationkey % 5")
def sparql_path_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "conversations", "nation")
    return execute_sparql(spark, f"PREFIX ex: <{EX}> SELECT ?x ?y {{ ?x ex:step+ ?y }}", _PATHS)


@query("SELECT c_custkey, r_name AS v_rn, o_orderkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN orders ON o_custkey = c_custkey WHERE r_name = 'EUROPE'")
def sparql_outer_join_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SPARQL result joined with a table and filtered from outside."""
    found = sparql(spark, sf_dir, "SELECT ?c ?rn { ?c a ex:Customer ; ex:ofNation/ex:inRegion/ex:regionName ?rn }")
    keyed = found.withColumn("c_custkey", F.substring_index("v_c", "/", -1).cast("bigint"))
    return keyed.join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey")).filter("v_rn = 'EUROPE'").select("c_custkey", "v_rn", "o_orderkey")


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{k}')" for n, (k, *_) in FUNCTIONS.items()) + ") v(function_name, kind)")
def function_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark).filter("length(description) > 0 and size(examples) > 0").select("function_name", "kind")


# readers of files: globs, codecs, ranges, lax and strict


def _files(spark: SparkSession, text: DataFrame, files: int, codec: str = "none") -> str:
    """Lines written as so many files."""
    path = work_dir(spark)
    text.repartition(files).write.option("compression", codec).option("lineSep", "\n").text(path)
    return path


_SUPPLIERS = "SELECT count(*) AS n, count(DISTINCT s_name) AS names FROM supplier"


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(table(spark, sf_dir, "supplier"), iri("supplier", "s_suppkey"), {"name": quoted("s_name")})


def _counted(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("object").alias("names"))


@query(_SUPPLIERS)
def read_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _files(spark, supplier_lines(spark, sf_dir), 2, "gzip")
    return _counted(read_rdf(spark, f"{path}/*.txt.gz", file_type="nt"))


@query("SELECT 2 * count(*) AS n, 2::BIGINT AS files FROM supplier")
def read_globs_and_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of a folder and a glob, and the files' names."""
    path = _files(spark, supplier_lines(spark, sf_dir), 2)
    found = read_rdf(spark, [path, f"{path}/part-*.txt"], file_type="nt", filename=True)
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("filename").alias("files"))


@query("SELECT count(*) AS n, count(DISTINCT c_custkey) AS subjects, sum(c_custkey)::BIGINT AS keys FROM customer")
def read_byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file in many splits: every line is read once."""
    df = table(spark, sf_dir, "customer")
    path = _files(spark, lines(df, iri("customer", "c_custkey"), {"key": typed("c_custkey", "long")}), 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = read_rdf(spark, path, file_type="nt")
        found.rdd.getNumPartitions()  # the splits are made by this session's setting now
        return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subject").alias("subjects"), F.sum(F.col("object").cast("bigint")).alias("keys"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query("SELECT count(*) - count(*) FILTER (s_suppkey % 3 = 0) AS n, count(*) FILTER (s_suppkey % 3 = 0) AS left_out, count(*) FILTER (s_suppkey % 3 = 1) AS odd FROM supplier")
def read_lax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the lines broken, a third with a space in an IRI, which lax reading takes as it is."""
    key = F.substring_index(F.substring_index("value", ">", 1), "/", -1).cast("bigint")
    text = supplier_lines(spark, sf_dir).select(
        F.when(key % 3 == 0, F.replace("value", F.lit("> <"), F.lit("> "))).when(key % 3 == 1, F.replace("value", F.lit("#name>"), F.lit("#na me>"))).otherwise(F.col("value")).alias("value")
    )
    path = _files(spark, text, 2)
    found = read_rdf(spark, path, strict_parsing=False, file_type="nt").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("predicate") == f"{EX}na me", 1)).alias("odd"))
    return found.crossJoin(skipped_lines(spark, path, file_type="nt").agg(F.count(F.lit(1)).alias("left_out"))).select("n", "left_out", "odd")  # a row each


@query("SELECT count(*) AS n FROM nation")
def read_by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The format by the file's name, upper case and all."""
    path = f"{work_dir(spark)}/NATIONS.TTL"
    mapping = r2rml.parse(_HEAD + _map("N", None, "nation/{n_nationkey}", _pom("name", "n_name")))
    write_rdf(table(spark, sf_dir, "nation"), path, mapping, rdf_format="turtle", single_file=True)
    return read_rdf(spark, path).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT unnest(['unknown type', 'unknown override', 'no files', 'bad content']) AS what, true AS raised")
def read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers refuse."""
    path = _files(spark, supplier_lines(spark, sf_dir), 1)
    tries = {
        "unknown type": lambda: read_rdf(spark, f"{path}/*.txt").count(),
        "unknown override": lambda: read_rdf(spark, path, file_type="x").count(),
        "no files": lambda: read_rdf(spark, f"{path}/none-*.nt").count(),
        "bad content": lambda: read_rdf(spark, path, file_type="rdf").count(),
    }
    return spark.createDataFrame([(what, _raises(run)) for what, run in tries.items()], "what string, raised boolean")


def _raises(run: Callable[[], object]) -> bool:
    try:
        run()
    except Exception:
        return True
    return False


# RDF/XML by feature: one document for each region


_XML_FEATURES = """
SELECT 'id' AS feature, count(*) AS n FROM region UNION ALL SELECT 'attributes', count(*) FROM region UNION ALL SELECT 'datatype', count(*) FROM region
UNION ALL SELECT 'xml literal', count(*) FROM region UNION ALL SELECT 'resource', count(*) FROM region UNION ALL SELECT 'collection', 2 * count(*) FROM region
UNION ALL SELECT 'container', 2 * count(*) FROM region UNION ALL SELECT 'reified', 4 * count(*) FROM region UNION ALL SELECT 'nodes', count(*) FROM region"""


@query(_XML_FEATURES)
def rdfxml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers, property attributes, datatypes, XML literals, resources, collections, containers and reification."""
    key = F.col("r_regionkey").cast("string")
    body = F.concat(
        F.lit('<ex:Region rdf:ID="r'), key, F.lit('" ex:label="x"><ex:key rdf:datatype="http://www.w3.org/2001/XMLSchema#int">'), key,
        F.lit('</ex:key><ex:note rdf:parseType="Literal"><b>'), F.col("r_name"), F.lit('</b></ex:note><ex:place rdf:parseType="Resource"><ex:in>'), F.col("r_name"),
        F.lit('</ex:in></ex:place><ex:all rdf:parseType="Collection"><rdf:Description rdf:about="a"/><rdf:Description rdf:about="b"/></ex:all>'),
        F.lit('<ex:bag><rdf:Bag><rdf:li>1</rdf:li><rdf:li>2</rdf:li></rdf:Bag></ex:bag><ex:said rdf:ID="s'), key, F.lit('">'), F.col("r_name"),
        F.lit('</ex:said><ex:to rdf:nodeID="n'), key, F.lit('"/></ex:Region>'),
    )
    head = [f'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:ex="{EX}" xml:base="{DATA}doc">']
    path = _written(spark, _document(table(spark, sf_dir, "region"), head, ["</rdf:RDF>"], body))
    p, o, rdf = F.col("predicate"), F.col("object"), "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
    feature = (
        F.when((p == f"{rdf}type") & (o == f"{EX}Region") & F.col("subject").startswith(f"{DATA}doc#r"), "id")
        .when(p == f"{EX}label", "attributes")
        .when((p == f"{EX}key") & (F.col("object_datatype") == f"{_XSD}int"), "datatype")
        .when((p == f"{EX}note") & (F.col("object_datatype") == f"{rdf}XMLLiteral") & o.startswith("<b>"), "xml literal")
        .when(p == f"{EX}in", "resource")
        .when((p == f"{rdf}first") & o.isin(f"{DATA}a", f"{DATA}b"), "collection")
        .when(p.isin(f"{rdf}_1", f"{rdf}_2"), "container")
        .when(F.col("subject").startswith(f"{DATA}doc#s"), "reified")
        .when((p == f"{EX}to") & o.rlike("^n[0-9]+$"), "nodes")
    )
    return read_rdf(spark, path, file_type="rdf").select(feature.alias("feature")).filter("feature is not null").groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


# profiles and pivots of files


@query("SELECT p AS predicate, t AS type, count(*) AS n FROM part, (VALUES ('name', 'VARCHAR'), ('size', 'INTEGER'), ('price', 'DOUBLE'), ('maker', 'IRI')) v(p, t) GROUP BY p, t")
def profile_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part")
    text = lines(df, iri("part", "p_partkey"), {"name": quoted("p_name"), "size": typed("p_size", "int"), "price": typed("p_retailprice", "double"), "maker": iri("maker", F.url_encode("p_brand"))})
    out = profile_rdf(spark, _files(spark, text, 3), file_type="nt")
    return out.select(F.substring_index("predicate", "#", -1).alias("predicate"), F.explode("count").alias("type", "n"))


@query("SELECT '' AS graph, count(*) AS n, count(DISTINCT s_suppkey) AS subjects FROM supplier, range(2) GROUP BY 1")
def pivot_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subject in two files is two rows."""
    path = work_dir(spark)
    for part in ("a", "b"):
        supplier_lines(spark, sf_dir).coalesce(1).write.option("lineSep", "\n").text(f"{path}/{part}")
    out = pivot_rdf(spark, [f"{path}/a", f"{path}/b"], file_type="nt")
    return out.groupBy("graph").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subject").alias("subjects"))


@query("SELECT '" + DATA + "customer/' || o_custkey AS subject, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey DESC) AS orders FROM orders GROUP BY o_custkey")
def pivot_list_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists are in the order of the file."""
    sorted_lines = lines(table(spark, sf_dir, "orders").coalesce(1).sortWithinPartitions(F.desc("o_orderkey")).coalesce(1), iri("customer", "o_custkey"), {"order": typed("o_orderkey", "long")}, at_once=True)
    path = work_dir(spark)
    sorted_lines.write.option("lineSep", "\n").text(path)
    out = pivot_rdf(spark, path, file_type="nt")
    return out.select("subject", F.array_join(F.col(f"`{EX}order`").cast("array<string>"), ",").alias("orders"))


@query("SELECT '" + DATA + "event/' || event_id AS subject, CASE WHEN event_id % 2 = 0 THEN event_id::INTEGER END AS kept FROM events")
def pivot_lax_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed integers are null in lax reading."""
    value = F.when(F.col("event_id") % 2 == 0, typed("event_id", "int")).otherwise(typed("event_type", "int"))
    path = _files(spark, lines(table(spark, sf_dir, "events"), iri("event", "event_id"), {"value": value}), 2)
    out = pivot_rdf(spark, path, file_type="nt", strict_parsing=False)
    return out.select("subject", F.col(f"`{EX}value`").alias("kept"))


@query("SELECT true AS raised")
def pivot_strict_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _files(spark, lines(table(spark, sf_dir, "events"), iri("event", "event_id"), {"value": typed("event_type", "int")}), 2)
    return spark.createDataFrame([(_raises(lambda: pivot_rdf(spark, path, file_type="nt").select(f"`{EX}value`").collect()),)], "raised boolean")


# mappings and writing


@query("SELECT 'full' AS mapping, true AS valid, false AS inside_out UNION ALL SELECT 'rows', false, true UNION ALL SELECT 'orphan', false, false UNION ALL SELECT 'broken', false, false")
def mapping_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark)
    orphan = 'rr:predicateObjectMap [ rr:predicate ex:in ; rr:objectMap [ rr:parentTriplesMap <#None> ] ]'
    texts = {
        "full": _HEAD + _map("N", "nation", "nation/{n_nationkey}", _pom("name", "n_name")),
        "rows": _HEAD + _map("N", None, "nation/{n_nationkey}", _pom("name", "n_name")),
        "orphan": _HEAD + _map("N", "nation", "nation/{n_nationkey}", orphan),
        "broken": _HEAD + '<#N> rr:subjectMap [ rr:template "x ] .',
    }
    out = []
    for name, text in texts.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
        (path,) = files_of(spark, f"{folder}/{name}/part-*")
        out.append((name, is_valid_r2rml(path), can_call_inside_out(path)))
    return spark.createDataFrame(out, "mapping string, valid boolean, inside_out boolean")


@query("SELECT '" + DATA + "nation/' || n_nationkey AS subject, n_name AS object FROM nation")
def write_ignore_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = r2rml.parse(_HEAD + _map("N", None, "nation/{N_NATIONKEY}", _pom("name", "N_Name")))
    return rows_to_triples(table(spark, sf_dir, "nation"), mapping, ignore_case=True).select("subject", "object")


@query("SELECT count(*) AS n, count(DISTINCT o_orderpriority) AS objects FROM orders")
def write_keeps_repeated_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows say something of one subject: nothing is removed on writing."""
    mapping = r2rml.parse(_HEAD + _map("O", None, "orders", _pom("priority", "o_orderpriority")))
    path = f"{work_dir(spark)}/all.nq"
    write_rdf(table(spark, sf_dir, "orders"), path, mapping, rdf_format="nquads", single_file=True)
    return read_rdf(spark, path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("object").alias("objects"))


# more of SPARQL


sparql_query(
    "path_inverse",
    "SELECT ?r ?n { ?r a ex:Region ; ^ex:inRegion ?x . ?x ex:nationName ?n }",
    f"SELECT {_R}n_regionkey AS v_r, n_name AS v_n FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region)",
)
sparql_query(
    "path_negated",
    "SELECT ?x ?v { ?x a ex:Nation ; !(ex:inRegion|ex:nationName|<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>) ?v }",
    f"SELECT {_N}n_nationkey AS v_x, n_nationkey::VARCHAR AS v_v FROM nation",
)
sparql_query("path_optional_step", "SELECT ?x ?y { ?x a ex:Nation ; ex:inRegion? ?y }", f"SELECT {_N}n_nationkey AS v_x, {_N}n_nationkey AS v_y FROM nation UNION ALL SELECT {_N}n_nationkey, {_R}n_regionkey FROM nation")
sparql_query("path_star", "SELECT ?x ?y { ?x a ex:Nation ; ex:inRegion* ?y }", f"SELECT {_N}n_nationkey AS v_x, {_N}n_nationkey AS v_y FROM nation UNION ALL SELECT {_N}n_nationkey, {_R}n_regionkey FROM nation")
sparql_query(
    "functions",
    "SELECT ?n ?a ?b ?c ?d ?e ?f { ?x ex:nationName ?n ; ex:nationKey ?k BIND(ABS(?k - 10) AS ?a) BIND(STRLEN(?n) AS ?b) BIND(MD5(?n) AS ?c) BIND(IF(?k > 5, 'high', 'low') AS ?d) BIND(REPLACE(LCASE(?n), 'a', 'o') AS ?e) BIND(STRAFTER(?n, '_') AS ?f) }",
    "SELECT n_name AS v_n, abs(n_nationkey - 10)::VARCHAR AS v_a, length(n_name)::VARCHAR AS v_b, md5(n_name) AS v_c, CASE WHEN n_nationkey > 5 THEN 'high' ELSE 'low' END AS v_d, replace(lower(n_name), 'a', 'o') AS v_e, split_part(n_name, '_', 2) AS v_f FROM nation",
)
sparql_query(
    "terms_and_casts",
    "SELECT ?x ?i ?l ?s ?t { ?x ex:nationKey ?k BIND(isIRI(?x) AS ?i) BIND(isLiteral(?k) AS ?l) BIND(xsd:integer(STR(?k)) + 1 AS ?s) BIND(DATATYPE(?k) AS ?t) }",
    f"SELECT {_N}n_nationkey AS v_x, 'true' AS v_i, 'true' AS v_l, (n_nationkey + 1)::VARCHAR AS v_s, '{_XSD}int' AS v_t FROM nation",
)
sparql_query(
    "hashes",
    "SELECT ?n ?a ?b { ?x ex:regionName ?n BIND(SHA1(?n) AS ?a) BIND(SHA256(?n) AS ?b) }",
    "SELECT r_name AS v_n, sha1(r_name) AS v_a, sha256(r_name) AS v_b FROM region",
)
sparql_query(
    "optional_exists",
    "SELECT ?x ?n { ?x a ex:Nation OPTIONAL { ?x ex:nationName ?n FILTER EXISTS { ?s a ex:Supplier ; ex:ofNation ?x } } }",
    f"SELECT {_N}n_nationkey AS v_x, CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN n_name END AS v_n FROM nation",
)
sparql_query(
    "template_join",
    "SELECT ?c ?o { ?c a ex:Customer . ?o ex:placedBy ?c ; ex:status 'F' }",
    f"SELECT {_C}c_custkey AS v_c, {_O}o_orderkey AS v_o FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'",
)


@query(f"SELECT {_C}c_custkey AS v_c, n_name AS v_nn FROM customer JOIN nation ON c_nationkey = n_nationkey")
def sparql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sparql_to_sql's text, run as SQL."""
    views(spark, sf_dir, "customer", "nation")
    return spark.sql(sparql_to_sql(f"PREFIX ex: <{EX}> SELECT ?c ?nn {{ ?c a ex:Customer ; ex:ofNation ?n . ?n ex:nationName ?nn }}", TPCH, spark))


@query(f"SELECT {_C}c_custkey AS v_c, c_name AS v_n, c_mktsegment AS v_s FROM customer")
def sparql_shared_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns on one subject share its row where subjects are unique: no self-join."""
    views(spark, sf_dir, "customer")
    found = execute_sparql(spark, f"PREFIX ex: <{EX}> SELECT ?c ?n ?s {{ ?c ex:customerName ?n ; ex:segment ?s }}", TPCH, unique_subjects=True)
    if "Join" in found._jdf.queryExecution().optimizedPlan().toString():
        raise AssertionError("a self-join")
    return found


@query("SELECT unnest(['CONSTRUCT', 'DESCRIBE', 'GRAPH', 'SERVICE', 'scope', 'YEAR', 'parse']) AS what, true AS raised")
def sparql_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = {
        "CONSTRUCT": "CONSTRUCT { ?s ?p ?o } WHERE { ?s ?p ?o }", "DESCRIBE": "DESCRIBE ?s { ?s ?p ?o }", "GRAPH": "SELECT ?s { GRAPH ?g { ?s ?p ?o } }",
        "SERVICE": "SELECT ?s { SERVICE <http://h/> { ?s ?p ?o } }", "scope": "SELECT ?s { ?s ?p ?o FILTER(?z > 1) }", "YEAR": "SELECT ?y { ?s ?p ?o BIND(YEAR(?o) AS ?y) }", "parse": "SELECT ?s { ?s ?p }",
    }
    return spark.createDataFrame([(what, _raises(lambda text=text: sparql_to_sql(text, TPCH))) for what, text in tries.items()], "what string, raised boolean")


# names for SQL


@query("SELECT 'read_rdf' AS what, count(*) AS n FROM supplier UNION ALL SELECT 'profile_rdf', 1 UNION ALL SELECT 'pivot_rdf', count(*) FROM supplier UNION ALL SELECT 'execute_sparql', count(*) FROM supplier")
def sql_table_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table functions under SQL, by sql()."""
    path = _files(spark, supplier_lines(spark, sf_dir), 2)
    folder = f"{work_dir(spark)}/map"
    spark.createDataFrame([(_HEAD + _map("S", "supplier", "supplier/{s_suppkey}", _pom("name", "s_name")),)], "value string").coalesce(1).write.text(folder)
    (mapping,) = files_of(spark, f"{folder}/part-*")
    views(spark, sf_dir, "supplier")
    return sql(
        spark,
        f"""SELECT 'read_rdf' AS what, count(*) AS n FROM read_rdf('{path}', file_type => 'nt') UNION ALL SELECT 'profile_rdf', count(*) FROM profile_rdf('{path}', file_type => 'nt')
UNION ALL SELECT 'pivot_rdf', count(*) FROM pivot_rdf('{path}', file_type => 'nt')
UNION ALL SELECT 'execute_sparql', count(*) FROM execute_sparql('PREFIX ex: <{EX}> SELECT ?s ?n {{ ?s ex:name ?n }}', '{mapping}')""",
    )


@query("SELECT count(*) AS n, count(DISTINCT s_name) AS names FROM supplier")
def stream_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in a folder, read as a stream into a table."""
    path, out = _files(spark, supplier_lines(spark, sf_dir), 3), work_dir(spark)
    stream = read_rdf_stream(spark, path, max_files=1).writeStream.format("parquet").option("checkpointLocation", f"{out}/state")
    stream.trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return _counted(spark.read.parquet(f"{out}/rows"))
