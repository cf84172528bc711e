import gzip
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tripleframe.errors import InvalidInput, NoFilesError, RdfSyntaxError
from tripleframe.sources.lines import unescape
from tripleframe.sources.reader import read_rdf, read_rdf_prefixes, skipped_lines, syntax_error

from .conftest import rows

XSD = "http://www.w3.org/2001/XMLSchema#"
FOAF = "http://xmlns.com/foaf/0.1/"

NT = r"""<http://e.org/a> <http://xmlns.com/foaf/0.1/name> "Ann" .
# a comment
<http://e.org/a> <http://xmlns.com/foaf/0.1/age> "30"^^<http://www.w3.org/2001/XMLSchema#integer> .
<http://e.org/a> <http://xmlns.com/foaf/0.1/knows> _:b1 .

_:b1 <http://xmlns.com/foaf/0.1/name> "Bob"@en-GB . # more
<http://e.org/a>	<http://e.org/says> "a \"b\" \\n \n \t \u00e9 \U0001F986" .
<http://e.org/a><http://e.org/empty>"".
<http://e.org/a> <http://e.org/home> <http://e.org/h\u00e9> .
"""
TRIPLES = [
    (None, "http://e.org/a", FOAF + "name", "Ann", None, None),
    (None, "http://e.org/a", FOAF + "age", "30", XSD + "integer", None),
    (None, "http://e.org/a", FOAF + "knows", "b1", None, None),
    (None, "b1", FOAF + "name", "Bob", None, "en-GB"),
    (None, "http://e.org/a", "http://e.org/says", 'a "b" \\n \n \t é 🦆', None, None),
    (None, "http://e.org/a", "http://e.org/empty", "", None, None),
    (None, "http://e.org/a", "http://e.org/home", "http://e.org/hé", None, None),
]
TTL = r"""@prefix foaf: <http://xmlns.com/foaf/0.1/> .
@base <http://e.org/> .
PREFIX e: <http://e.org/>
<a> foaf:name "Ann" ; foaf:age 30 ; foaf:knows _:b1 .
_:b1 foaf:name "Bob"@en-GB .
<a> e:says "a \"b\" \\n \n \t \u00e9 \U0001F986" ; e:empty '''''' ; e:home <h\u00e9> .
"""
XML = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:foaf="http://xmlns.com/foaf/0.1/" xmlns:e="http://e.org/" xml:base="http://e.org/">
 <rdf:Description rdf:about="a" foaf:name="Ann">
  <foaf:age rdf:datatype="http://www.w3.org/2001/XMLSchema#integer"> 30 </foaf:age>
  <foaf:knows><rdf:Description rdf:nodeID="b1"><foaf:name xml:lang="en-GB">Bob</foaf:name></rdf:Description></foaf:knows>
  <e:says>a "b" \\n &#10; &#9; é 🦆</e:says><e:empty></e:empty><e:home rdf:resource="hé"/>
 </rdf:Description>
</rdf:RDF>"""


def put(folder, name, text):
    path = folder / name
    data = text.encode()
    if name.endswith(".gz"):
        data = gzip.compress(data)
    if name.endswith(".zst"):
        data = zstandard.ZstdCompressor().compress(data)
    path.write_bytes(data)
    return str(path)


def in_graph(text):
    """N-Triples lines as N-Quads of one graph."""
    out = []
    for line in text.splitlines():
        body, dot, rest = line.rpartition(".") if "#" not in line or line.count('"') == 0 else line.partition(" . #")
        out.append(line if line.startswith("#") or not line else line[: line.rindex(".")] + "<http://e.org/g> ." if " # " not in line else line.replace(" . #", " <http://e.org/g> . #"))
    return "\n".join(out) + "\n"


def test_every_syntax_reads_the_same(spark, tmp_path):
    want = sorted(TRIPLES, key=repr)
    for name, text in (("x.nt", NT), ("x.ttl", TTL), ("x.rdf", XML), ("x.nt.gz", NT), ("x.nt.zst", NT), ("x.ttl.gz", TTL), ("x.rdf.zst", XML)):
        got = rows(read_rdf(spark, put(tmp_path, name, text), prefix_expansion=True))
        assert got == want, name
    quads = sorted([("http://e.org/g", *t[1:]) for t in TRIPLES], key=repr)
    assert rows(read_rdf(spark, put(tmp_path, "x.nq", in_graph(NT)))) == quads
    head, body = TTL.split("\n<a>", 1)
    trig = f"{head}\nGRAPH e:g {{ <a>{body} }}\n"
    assert rows(read_rdf(spark, put(tmp_path, "x.trig", trig), prefix_expansion=True)) == quads


def test_names_stay_unless_expanded(spark, tmp_path):
    path = put(tmp_path, "x.ttl", '@prefix p: <http://p/> . @base <http://b/> .\n<s> a p:T ; q:x "1"^^p:int, 5, 1.5, 1e3, true .')
    plain = {(r["subject"], r["predicate"], r["object"], r["object_datatype"]) for r in read_rdf(spark, path).collect()}
    rdf_type = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    kinds = [("5", "integer"), ("1.5", "decimal"), ("1e3", "double"), ("true", "boolean")]
    assert plain == {("s", rdf_type, "p:T", None), ("s", "q:x", "1", "p:int"), *[("s", "q:x", v, XSD + k) for v, k in kinds]}
    full = {(r["subject"], r["object"], r["object_datatype"]) for r in read_rdf(spark, path, prefix_expansion=True).collect()}
    assert ("http://b/s", "http://p/T", None) in full and ("http://b/s", "1", "http://p/int") in full


def test_turtle_grammar(spark, tmp_path):
    text = """PREFIX : <http://x/>
:a :p [ :q "in" ; :r [] ] , ( 1 :b ) ; ; :p2 () .
[] :p3 \"\"\"long "quoted" \n text\"\"\" .
[ :p4 :c ] .
:d\\,e :p5 "x"@de, 'y' , -1.5E-2 .
"""
    got = read_rdf(spark, put(tmp_path, "g.ttl", text), prefix_expansion=True).collect()
    has = {(r["subject"], r["predicate"].removeprefix("http://x/"), r["object"]) for r in got}
    assert len(got) == 14
    assert any(p == "p3" and o == 'long "quoted" \n text' for _, p, o in has)
    assert ("http://x/d,e", "p5", "-1.5E-2") in has and ("http://x/a", "p2", "http://www.w3.org/1999/02/22-rdf-syntax-ns#nil") in has


def test_trig_graphs(spark, tmp_path):
    text = "@prefix : <http://x/> . { :a :p 1 } :g { :a :p 2 . :b :p 3 } GRAPH _:h { :a :p 4 . } :c :p 5 ."
    got = {(r["graph"], r["object"]) for r in read_rdf(spark, put(tmp_path, "g.trig", text), prefix_expansion=True).collect()}
    assert got == {(None, "1"), ("http://x/g", "2"), ("http://x/g", "3"), ("h", "4"), (None, "5")}


def test_strict_and_lax(spark, tmp_path):
    good = '<http://e/a> <http://e/p> "1" .\n'
    space = '<http://e/a b> <http://e/p> "2" .\n'
    broken = "<http://e/a> <http://e/p .\n"
    for name in ("x.nt", "x.nq", "x.ttl", "x.trig"):
        path = put(tmp_path, "space" + name, good + space + good)
        with pytest.raises(Exception, match="Syntax"):
            read_rdf(spark, path).collect()
        assert [r["subject"] for r in read_rdf(spark, path, strict_parsing=False).collect()] == ["http://e/a", "http://e/a b", "http://e/a"]
        path = put(tmp_path, "broken" + name, good + broken + good)
        with pytest.raises(Exception, match="Syntax"):
            read_rdf(spark, path).collect()
        assert read_rdf(spark, path, strict_parsing=False).count() >= 1
    lines = put(tmp_path, "b.nt", good + broken + good)
    assert syntax_error(spark, lines)[1:] == (2, broken.strip())
    assert skipped_lines(spark, lines).count() == 1
    assert read_rdf(spark, lines, strict_parsing=False).count() == 2
    with pytest.raises(RdfSyntaxError) as e:
        from tripleframe.sources.turtle import Turtle

        list(Turtle(good + space, "f.ttl").statements())
    assert e.value.line == 2


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    put(tmp_path / "d", "a.nt", NT)
    put(tmp_path / "d", "b.nt", '<http://e/a> <http://e/p> "1" .\n')
    got = read_rdf(spark, f"{tmp_path}/d/*.nt", filename=True).groupBy("filename").count().collect()
    assert {(r[0].rsplit("/", 1)[1], r[1]) for r in got} == {("a.nt", 7), ("b.nt", 1)}
    assert got[0][0].startswith("/")
    assert read_rdf(spark, [f"{tmp_path}/d/a.nt", f"{tmp_path}/d/b*"]).count() == 8
    assert read_rdf(spark, f"{tmp_path}/d/*", parallel_scan=False).count() == 8
    with pytest.raises(NoFilesError, match="No files found"):
        read_rdf(spark, f"{tmp_path}/none*.nt")
    other = put(tmp_path, "x.foo", TTL)
    with pytest.raises(InvalidInput):
        read_rdf(spark, other)
    with pytest.raises(InvalidInput, match="Unknown file_type override: 'bad'"):
        read_rdf(spark, other, file_type="bad")
    assert read_rdf(spark, other, file_type="TTL").count() == 7
    for wrong in ("nt", "rdf"):
        with pytest.raises(Exception, match="rror"):
            read_rdf(spark, other, file_type=wrong).collect()


def test_prefixes(spark, tmp_path):
    path = put(tmp_path, "p.ttl", TTL + "@prefix foaf: <http://other/> .\n")
    got = [tuple(r) for r in read_rdf_prefixes(spark, path).collect()]
    assert got == [("foaf", FOAF, False), (None, "http://e.org/", True), ("e", "http://e.org/", False), ("foaf", "http://other/", False)]
    with pytest.raises(InvalidInput, match="NTriples or NQuads"):
        read_rdf_prefixes(spark, put(tmp_path, "p.nt", NT))
    with pytest.raises(InvalidInput, match="only supports Turtle"):
        read_rdf_prefixes(spark, put(tmp_path, "p.rdf", XML))
    bad = put(tmp_path, "bad.ttl", "@prefix a: <http://a/> .\n<http://x <b> .\n@prefix c: <http://c/> .\n")
    assert [r[0] for r in read_rdf_prefixes(spark, bad, strict_parsing=False, filename=True).collect()] == ["a"]
    with pytest.raises(Exception, match="Syntax"):
        read_rdf_prefixes(spark, bad).collect()


def test_rdfxml_features(spark, tmp_path):
    text = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="http://e/" xml:base="http://b/doc">
 <e:T rdf:ID="x"><e:p rdf:parseType="Literal"><b xmlns="http://h/">t &amp; u</b></e:p>
  <e:q rdf:parseType="Resource"><e:r>v</e:r></e:q>
  <e:c rdf:parseType="Collection"><rdf:Description rdf:about="#1"/><rdf:Description rdf:about="#2"/></e:c>
  <e:ed e:name="Dave" rdf:ID="st"/></e:T>
 <rdf:Seq rdf:about="http://s"><rdf:li>1</rdf:li><rdf:li rdf:resource="r"/></rdf:Seq>
</rdf:RDF>"""
    got = [(r["subject"], r["predicate"].rsplit("#", 1)[-1], r["object"]) for r in read_rdf(spark, put(tmp_path, "f.rdf", text)).collect()]
    assert ("http://b/doc#x", "type", "http://e/T") in got
    assert ("http://s", "_1", "1") in got and ("http://s", "_2", "http://b/r") in got
    assert [o for _, p, o in got if p == "http://e/name"] == ["Dave"]
    assert ("http://b/doc#st", "predicate", "http://e/ed") in got
    assert [o for _, p, o in got if p == "first"] == ["http://b/doc#1", "http://b/doc#2"]
    assert any(p == "http://e/p" and o == '<b xmlns="http://h/">t &amp; u</b>' for _, p, o in got)
    assert len(got) == 18
    with pytest.raises(Exception, match="XML parsing error at line 2"):
        read_rdf(spark, put(tmp_path, "bad.rdf", text.split("\n")[0] + "\n<e:"), strict_parsing=False).collect()


def test_random_literals_round_trip(spark, tmp_path):
    random.seed(5)
    texts = ["".join(random.choice('ab"\\\n\t\r é🦆<>.@^#') for _ in range(random.randrange(60))) for _ in range(200)] + ["x" * 200_000, '\\"' * 60_000]

    def quoted(t):
        return t.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")

    body = "".join(f'<http://e/{i}> <http://e/p> "{quoted(t)}"@en .\n' for i, t in enumerate(texts))
    for name in ("r.nt", "r.ttl"):
        got = {int(r["subject"].rsplit("/", 1)[1]): r["object"] for r in read_rdf(spark, put(tmp_path, name, body)).collect()}
        assert [got[i] for i in range(len(texts))] == texts
    one = spark.createDataFrame([("a\\u00e9\\U0001F986\\\\n\\n",)], "x string").select(unescape(F.col("x"))).first()[0]
    assert one == "aé🦆\\n\n"


def test_pruned_columns_and_filters(spark, tmp_path):
    df = read_rdf(spark, put(tmp_path, "x.nt", NT))
    assert df.filter("predicate = 'http://xmlns.com/foaf/0.1/name'").select("object").count() == 2
    assert df.filter("graph is null").count() == 7 and df.filter("object_lang <> 'x'").count() == 1
    assert df.filter(F.col("subject").startswith("http://e")).count() == 6
    plan = df.select("subject")._jdf.queryExecution().optimizedPlan().toString()
    assert "_body" not in plan
