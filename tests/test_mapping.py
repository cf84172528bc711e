import pytest
from pyspark.sql import functions as F

from tripleframe.errors import InvalidInput, MappingError
from tripleframe.plans import yarrrml
from tripleframe.plans.mapping import Reference, can_call_inside_out, is_valid_r2rml, read_mapping
from tripleframe.plans.write import rows_to_triples, write_rdf
from tripleframe.sources.reader import read_rdf

from .conftest import rows

HEAD = "@prefix rr: <http://www.w3.org/ns/r2rml#> .\n@prefix ex: <http://e.org/ns#> .\n"
STAFF = (
    HEAD
    + """
<#Staff> rr:logicalTable [ rr:tableName "staff" ] ;
  rr:subjectMap [ rr:template "http://e.org/staff/{id}" ; rr:class ex:Person ] ;
  rr:predicateObjectMap [ rr:predicate ex:name ; rr:objectMap [ rr:column "name" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:unit ; rr:objectMap [ rr:template "http://e.org/unit/{unit}" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:unitRef ; rr:objectMap [ rr:parentTriplesMap <#Unit> ; rr:joinCondition [ rr:child "unit" ; rr:parent "no" ] ] ] .
<#Unit> rr:logicalTable [ rr:sqlQuery "SELECT no, title FROM units;" ] ;
  rr:subject ex:ignored ;
  rr:predicateObjectMap [ rr:predicate ex:title ; rr:objectMap [ rr:column "title" ; rr:language "en" ] ] .
"""
)
INSIDE = (
    HEAD
    + """<#M> rr:subjectMap [ rr:template "http://e.org/{ID}" ] ;
  rr:predicateObjectMap [ rr:predicate ex:v ; rr:objectMap [ rr:column "V" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:none ; rr:objectMap [ rr:column "missing" ] ] ."""
)


def put(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


@pytest.fixture(scope="module")
def tables(spark):
    spark.createDataFrame([(1, "Ann", 10), (2, "Bob b", None)], "id int, name string, unit int").createOrReplaceTempView("staff")
    spark.createDataFrame([(10, "Sales"), (20, "IT")], "no int, title string").createOrReplaceTempView("units")


def test_validity(tmp_path):
    full = put(tmp_path, "full.ttl", STAFF)
    inside = put(tmp_path, "in.ttl", INSIDE)
    ghost = put(tmp_path, "ghost.ttl", STAFF.replace("parentTriplesMap <#Unit>", "parentTriplesMap <#Ghost>"))
    neither = put(tmp_path, "neither.ttl", INSIDE[:-1] + ' ; rr:predicateObjectMap [ rr:predicate ex:r ; rr:objectMap [ rr:parentTriplesMap <#M> ; rr:joinCondition [ rr:child "a" ; rr:parent "b" ] ] ] .')
    bad = put(tmp_path, "bad.ttl", HEAD + '<#M> rr:subjectMap [ rr:template "x ] .')
    bad_yaml = put(tmp_path, "bad.yml", "mappings: [a")
    got = {p: (is_valid_r2rml(p), can_call_inside_out(p)) for p in (full, inside, ghost, neither, bad, bad_yaml, "none.ttl")}
    assert got == {full: (True, False), inside: (False, True), ghost: (False, False), neither: (False, False), bad: (False, False), bad_yaml: (False, False), "none.ttl": (False, False)}
    with pytest.raises(MappingError, match="R2RML mapping parse error"):
        read_mapping(bad)
    with pytest.raises(MappingError, match="Mapping file not found"):
        read_mapping("none.ttl")


def test_malformed_mappings_are_mapping_errors(tmp_path):
    (tmp_path / "bytes.ttl").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "bytes.yml").write_bytes(b"\xff\xfe\x00")
    put(tmp_path, "half.ttl", STAFF.replace("rr:child", "rr:other"))
    put(tmp_path, "pair.yml", "mappings:\n  m:\n    s: x$(a)\n    po:\n      - [p]\n")
    put(tmp_path, "prefixes.yml", "prefixes: text\nmappings:\n  m: {s: x}\n")
    put(tmp_path, "list.yml", "mappings:\n  m: [1, 2]\n")
    for name in ("bytes.ttl", "bytes.yml", "half.ttl", "pair.yml", "prefixes.yml", "list.yml"):
        path = str(tmp_path / name)
        assert (is_valid_r2rml(path), can_call_inside_out(path)) == (False, False), name
        with pytest.raises(MappingError):
            read_mapping(path)


def test_yarrrml_says_the_same_as_r2rml():
    text = """
prefixes:
  ex: "http://e.org/ns#"
mappings:
  Staff:
    sources: [{table: staff}]
    s: http://e.org/staff/$(id)
    po:
      - [a, ex:Person]
      - [ex:name, $(name)]
      - [ex:unit, http://e.org/unit/$(unit)~iri]
      - p: ex:unitRef
        o: {mapping: Unit, condition: {function: equal, parameters: [[str1, $(unit)], [str2, $(no)]]}}
      - [ex:age, $(age), xsd:integer]
      - [ex:label, 'x $(name)', en~lang]
  Unit:
    sources: [['units~csv']]
    s: ex:$(no)
"""
    m = yarrrml.parse(text)
    staff = m.maps["Staff"]
    assert m.is_valid() and staff.table == "staff" and m.maps["Unit"].table == "units"
    assert staff.subject.parts == (("http://e.org/staff/", False), ("id", True))
    objects = [p.objects[0] for p in staff.pairs]
    assert (objects[0].value, objects[0].type) == ("http://e.org/ns#Person", "I")
    assert (objects[1].kind, objects[1].type) == ("column", "L")
    assert (objects[2].kind, objects[2].type) == ("template", "I")
    assert objects[3] == Reference("Unit", (("unit", "no"),))
    assert objects[5].lang == "en" and objects[5].parts == (("x ", False), ("name", True))
    assert m.maps["Unit"].subject.parts[0][0] == "http://e.org/ns#"


def test_write_full(spark, tables, tmp_path):
    path = put(tmp_path, "m.ttl", STAFF)
    write_rdf(spark.range(3), f"{tmp_path}/out", path)
    got = read_rdf(spark, f"{tmp_path}/out/*.txt", file_type="nt")
    assert got.count() == 2 + 2 + 1 + 1 + 2
    assert {tuple(r) for r in got.select("object", "object_lang").collect()} >= {("Sales", "en"), ("http://e.org/unit/10", None), ("http://e.org/ns#ignored", None)}


def test_write_inside_out(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\n\\'), (2, None), (3, "x y")], "ID int, V string")
    path = put(tmp_path, "m.ttl", INSIDE)
    for name in ("ntriples", "nt", "turtle", "ttl", "nquads", "nq"):
        target = f"{tmp_path}/{name}.{ {'turtle': 'ttl', 'nquads': 'nq'}.get(name, 'nt' if name == 'ntriples' else name)}"
        write_rdf(df, target, path, rdf_format=name, single_file=True)
        assert rows(read_rdf(spark, target).select("subject", "object")) == [("http://e.org/1", 'a "q"\n\\'), ("http://e.org/3", "x y")]
    with pytest.raises(InvalidInput, match="Unknown rdf_format"):
        write_rdf(df, f"{tmp_path}/x", path, rdf_format="xml")
    with pytest.raises(InvalidInput, match="mapping option"):
        write_rdf(df, f"{tmp_path}/x")
    lower = spark.createDataFrame([(1, "z")], "id int, v string")
    assert rows_to_triples(lower, read_mapping(path)).count() == 0
    assert rows_to_triples(lower, read_mapping(path), ignore_case=True).count() == 1
    neither = put(tmp_path, "n.ttl", STAFF.replace("<#Unit> ;", "<#Ghost> ;"))
    with pytest.raises(MappingError, match="is not valid"):
        write_rdf(df, f"{tmp_path}/x", neither)


def test_typed_literals(spark, tmp_path):
    df = spark.sql(
        "select 1 as ID, 7 as i, true as b, 3.14D as d, double('NaN') as nan, 2.5BD as dec, date'2020-01-02' as da, timestamp_ntz'2020-01-02 03:04:05.5' as ts, "
        "9L as big, 's' as s, cast(1 as decimal(38,0)) as huge, 'a b/é~*+' as odd"
    )
    pairs = "".join(f'; rr:predicateObjectMap [ rr:predicate ex:{c} ; rr:objectMap [ rr:column "{c}" ] ] ' for c in df.columns if c not in ("ID", "odd"))
    text = HEAD + f'<#M> rr:subjectMap [ rr:template "http://e.org/{{odd}}" ] {pairs}.'
    got = {r["predicate"].rpartition("#")[2]: (r["object"], (r["object_datatype"] or "").rpartition("#")[2]) for r in rows_to_triples(df, read_mapping(put(tmp_path, "t.ttl", text))).collect()}
    assert got == {
        "i": ("7", "int"), "b": ("true", "boolean"), "d": ("3.140000", "double"), "nan": ("NaN", "double"), "dec": ("2.5", "decimal"), "da": ("2020-01-02", "date"),
        "ts": ("2020-01-02T03:04:05.5", "dateTime"), "big": ("9", "long"), "s": ("s", ""), "huge": ("1", "integer"),
    }
    one = rows_to_triples(df, read_mapping(str(tmp_path / "t.ttl"))).first()
    assert one["subject"] == "http://e.org/a%20b%2F%C3%A9~%2A%2B"


def test_many_rows_in_parallel(spark, tmp_path):
    df = spark.range(0, 5000, 1, 8).select(F.col("id").alias("ID"), F.repeat(F.lit("x"), 80).alias("V"))
    write_rdf(df, f"{tmp_path}/big", put(tmp_path, "m.ttl", INSIDE))
    got = read_rdf(spark, f"{tmp_path}/big/part*", file_type="nt")
    assert got.count() == 5000 and got.select("subject").distinct().count() == 5000
