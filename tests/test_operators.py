import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripleframe.operators.pivot import pivot_rdf, union_extract, union_tag
from tripleframe.operators.profile import profile_rdf

XSD = "http://www.w3.org/2001/XMLSchema#"


def put(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def nt(*triples):
    return "".join(f"<http://e/{s}> <http://e/{p}> {o} .\n" for s, p, o in triples)


def typed(value, name):
    return f'"{value}"^^<{XSD}{name}>'


def test_profile(spark, tmp_path):
    text = nt(("a", "p", '"x"'), ("a", "p", '"b"@en'), ("b", "p", typed(10, "integer")), ("b", "p", typed(9, "integer")), ("a", "q", "<http://e/b>"), ("a", "q", "_:n"), ("c", "r", '"1"^^<http://own/type>'))
    got = {r["predicate"]: r for r in profile_rdf(spark, put(tmp_path, "x.nt", text)).collect()}
    assert list(got) == ["http://e/p", "http://e/q", "http://e/r"]
    p = got["http://e/p"]
    assert p["types"] == ["HUGEINT", "LANG_STRING", "VARCHAR"] and p["count"] == {"HUGEINT": 2, "LANG_STRING": 1, "VARCHAR": 1}
    assert p["min"]["HUGEINT"] == "10" and p["max"]["HUGEINT"] == "9"
    assert (p["graph_count"], p["subject_count"]) == (1, 2)
    assert got["http://e/q"]["types"] == ["BLANK", "IRI"] and got["http://e/r"]["types"] == ["http://own/type"]
    quads = "".join(line.replace(" .\n", f" <http://g/{i % 2}> .\n") for i, line in enumerate(text.splitlines(True))) + '<http://e/z> <http://e/p> "1" .\n'
    got = {r["predicate"]: r for r in profile_rdf(spark, put(tmp_path, "x.nq", quads)).collect()}
    assert got["http://e/p"]["graph_count"] == 3
    ttl = '@prefix x: <http://e/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> . x:a x:p "1"^^xsd:int, "u"^^own:t .'
    (row,) = profile_rdf(spark, put(tmp_path, "x.ttl", ttl)).collect()
    assert row["predicate"] == "http://e/p" and row["types"] == ["INTEGER", "own:t"]


def test_pivot_basic(spark, tmp_path):
    text = nt(
        ("s1", "str", '"t"'), ("s1", "int", typed(42, "integer")), ("s1", "multi", '"b"'), ("s1", "multi", '"a"'), ("s1", "multi", '"b"'),
        ("s1", "lang", '"hi"@en'), ("s1", "lang", '"hola"@es'), ("s1", "lang", '"plain"'), ("s2", "str", '"u"'), ("s2", "int", typed(7, "integer")),
        ("s2", "date", typed("2020-01-02", "date")), ("s2", "flag", typed("1", "boolean")), ("s2", "hex", typed("0aff", "hexBinary")), ("s2", "one", '"solo"@de'),
    )
    df = pivot_rdf(spark, put(tmp_path, "x.nt", text))
    assert df.columns == ["graph", "subject", *[f"http://e/{c}" for c in sorted(("str", "int", "multi", "lang", "date", "flag", "hex", "one"))]]
    got = {r["subject"][-2:]: {k[9:] or k: v for k, v in r.asDict(True).items()} for r in df.collect()}
    s1, s2 = got["s1"], got["s2"]
    assert s1["multi"] == ["b", "a"] and s2["multi"] is None
    assert [tuple(x.values()) for x in s1["lang"]] == [("hi", "en"), ("hola", "es"), ("plain", "")]
    assert s1["int"] == Decimal(42) and s2["date"] == datetime.date(2020, 1, 2) and s2["flag"] is True and s2["hex"] == b"\x0a\xff"
    assert s2["one"] == {"object": "solo", "lang": "de"} and s1["date"] is None


def test_pivot_edges(spark, tmp_path):
    a, b = put(tmp_path, "a.nt", nt(("s1", "p", '"1"'), ("s2", "p", '"2"'))), put(tmp_path, "b.nt", nt(("s1", "p", '"3"'), ("s3", "p", '"4"')))
    got = pivot_rdf(spark, [a, b]).collect()
    assert sorted(r["subject"] for r in got) == ["http://e/s1", "http://e/s1", "http://e/s2", "http://e/s3"] and {r["graph"] for r in got} == {""}
    bad = put(tmp_path, "bad.nt", nt(("s", "p", typed(1, "integer")), ("s", "p", typed("notanumber", "integer"))))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|notanumber"):
        pivot_rdf(spark, bad).collect()
    assert pivot_rdf(spark, bad, strict_parsing=False).first()[2] == [Decimal(1), None]
    mixed = pivot_rdf(spark, put(tmp_path, "m.nt", nt(("s1", "p", typed(1, "integer")), ("s2", "p", typed("2.5", "double")), ("s3", "p", '"x"'))))
    col = F.col("`http://e/p`")
    rows = mixed.orderBy("subject").select(union_tag(col), union_extract(col, "HUGEINT"), union_extract(col, "DOUBLE"), union_extract(col, "varchar")).collect()
    assert [tuple(r) for r in rows] == [("HUGEINT", Decimal(1), None, None), ("DOUBLE", None, 2.5, None), ("varchar", None, None, "x")]
    quads = '<http://e/s> <http://e/p> "1" <http://g/1> .\n<http://e/s> <http://e/p> "2" <http://g/2> .\n_:b1 <http://e/p> "3" <http://g/1> .\n'
    got = {(r[0], r[1], *r[2]) for r in pivot_rdf(spark, put(tmp_path, "g.nq", quads)).collect()}  # a list: the subject has two, if in two graphs
    assert got == {("http://g/1", "http://e/s", "1"), ("http://g/2", "http://e/s", "2"), ("http://g/1", "b1", "3")}
    ttl = put(tmp_path, "e.ttl", "@prefix x: <http://e/> . @base <http://b/> . <s> x:p 1 ; <rel> 2 .")
    assert pivot_rdf(spark, ttl).columns[2:] in (["http://b/rel", "http://e/p"], ["rel", "x:p"])
    expanded = pivot_rdf(spark, ttl, prefix_expansion=True)
    assert expanded.columns[2:] == ["http://b/rel", "http://e/p"] and tuple(expanded.first())[1:] == ("http://b/s", Decimal(2), Decimal(1))


def test_pivot_is_one_exchange(spark, tmp_path):
    df = pivot_rdf(spark, put(tmp_path, "x.nt", nt(("s1", "p", '"1"'), ("s1", "q", '"2"'))))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ObjectHashAggregate") + plan.count("SortAggregate") == 2
