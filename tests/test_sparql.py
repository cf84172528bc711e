import pytest

from tripleframe.errors import MappingError, SparqlParseError, TranslationError
from tripleframe.plans.mapping import Mapping
from tripleframe.plans.r2rml import parse as r2rml
from tripleframe.plans.sparql.run import execute_sparql, sparql_to_sql

from .conftest import rows

MAPPING = """@prefix rr: <http://www.w3.org/ns/r2rml#> .
@prefix ex: <http://e.org/ns#> .
<#P> rr:logicalTable [ rr:tableName "people" ] ;
  rr:subjectMap [ rr:template "http://e.org/p/{id}" ; rr:class ex:Person ] ;
  rr:predicateObjectMap [ rr:predicate ex:name ; rr:objectMap [ rr:column "name" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:age ; rr:objectMap [ rr:column "age" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:boss ; rr:objectMap [ rr:template "http://e.org/p/{boss}" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:dept ; rr:objectMap [ rr:column "dept" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:note ; rr:objectMap [ rr:column "name" ; rr:language "en" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:in ; rr:objectMap [ rr:parentTriplesMap <#D> ; rr:joinCondition [ rr:child "dept" ; rr:parent "no" ] ] ] .
<#D> rr:logicalTable [ rr:tableName "depts" ] ;
  rr:subjectMap [ rr:template "http://e.org/d/{no}" ; rr:class ex:Dept ] ;
  rr:predicateObjectMap [ rr:predicate ex:no ; rr:objectMap [ rr:column "no" ] ] ;
  rr:predicateObjectMap [ rr:predicate ex:name ; rr:objectMap [ rr:column "title" ] ] .
"""
PREFIX = "PREFIX ex: <http://e.org/ns#> PREFIX xsd: <http://www.w3.org/2001/XMLSchema#> "


@pytest.fixture(scope="module")
def ask(spark):
    people = [(1, "Ann", 50, None, 10), (2, "Bob", 40, 1, 10), (3, "Cy", 30, 2, 20), (4, "Di", None, 3, None), (5, "Ann", 20, 5, 20)]
    spark.createDataFrame(people, "id int, name string, age int, boss int, dept int").createOrReplaceTempView("people")
    spark.createDataFrame([("10", "Sales"), ("20", "IT"), ("30", "Law")], "no string, title string").createOrReplaceTempView("depts")
    mapping = r2rml(MAPPING)

    def run(query, **more):
        lazy = rows(execute_sparql(spark, PREFIX + query, mapping, **more))
        text = rows(spark.sql(sparql_to_sql(PREFIX + query, mapping, spark, **more)))
        untyped = rows(spark.sql(sparql_to_sql(PREFIX + query, mapping, None))) if "?age" not in query and "LANG" not in query else lazy
        assert lazy == text == untyped
        return lazy

    return run


def p(*ids):
    return [f"http://e.org/p/{i}" for i in ids]


def test_basic_patterns(ask):
    assert ask("SELECT ?n WHERE { ?s a ex:Person ; ex:name ?n }") == [("Ann",), ("Ann",), ("Bob",), ("Cy",), ("Di",)]
    assert ask("SELECT DISTINCT ?n { ?s a ex:Person ; ex:name ?n }") == [("Ann",), ("Bob",), ("Cy",), ("Di",)]
    assert ask("SELECT ?s WHERE { ?s ex:name 'Bob' }") == [(p(2)[0],)]
    assert ask("SELECT ?n WHERE { <http://e.org/p/3> ex:name ?n }") == [("Cy",)]
    assert ask("SELECT ?n WHERE { <http://e.org/p/03> ex:name ?n }") == []
    assert ask("SELECT ?s WHERE { ?s ex:age 40 }") == [(p(2)[0],)]
    assert ask("SELECT ?a ?b WHERE { ?a ex:boss/ex:name ?b }") == [(x, n) for x, n in zip(p(2, 3, 4, 5), ("Ann", "Bob", "Cy", "Ann"), strict=True)]
    assert ask("SELECT ?n ?t { ?s ex:dept ?d ; ex:name ?n . ?u ex:no ?d ; ex:name ?t }") == [("Ann", "IT"), ("Ann", "Sales"), ("Bob", "Sales"), ("Cy", "IT")]
    assert ask("SELECT ?t { ?s ex:name 'Bob' ; ex:in [ ex:name ?t ] }") == [("Sales",)]
    assert ask("SELECT ?p ?o { <http://e.org/d/30> ?p ?o }") == [
        ("http://e.org/ns#name", "Law"), ("http://e.org/ns#no", "30"), ("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://e.org/ns#Dept")
    ]
    assert len(ask("SELECT * { ?s ?p ?o }")) == 5 + 5 + 4 + 4 + 4 + 5 + 4 + 9
    assert ask("SELECT ?n { ?s ex:boss ?s ; ex:name ?n }") == [("Ann",)]
    assert ask("SELECT ?s { ?s ex:nothing ?n }") == []
    assert ask("SELECT ?n { ?s ex:note ?n FILTER(LANG(?n) = 'en' && ?n = 'Di') }") == [("Di",)]
    assert ask("SELECT ?s { ?s ex:note 'Di'@en }") == [(p(4)[0],)] and ask("SELECT ?s { ?s ex:note 'Di' }") == []


def test_shared_rows(ask, spark):
    q = "SELECT ?n ?d { ?s ex:name ?n ; ex:dept ?d }"
    assert ask(q, unique_subjects=True) == ask(q)
    sql = sparql_to_sql(PREFIX + q, r2rml(MAPPING), spark, unique_subjects=True)
    assert sql.count("`people`") == 1
    native = sparql_to_sql(PREFIX + "SELECT ?a ?b { ?a ex:boss ?b . ?b ex:name ?n }", r2rml(MAPPING), spark)
    assert ".`boss` = " in native and "concat" in native


def test_optional_filter_bind(ask):
    assert ask("SELECT ?n ?b { ?s a ex:Person ; ex:name ?n OPTIONAL { ?s ex:boss/ex:name ?b } }") == [("Ann", "Ann"), ("Ann", None), ("Bob", "Ann"), ("Cy", "Bob"), ("Di", "Cy")]
    assert ask("SELECT ?n ?age { ?s a ex:Person ; ex:name ?n OPTIONAL { ?s ex:age ?age FILTER(?age > 35) } }") == [("Ann", "50"), ("Ann", None), ("Bob", "40"), ("Cy", None), ("Di", None)]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n OPTIONAL { ?s ex:age ?age } FILTER(!BOUND(?age)) }") == [("Di",)]
    assert ask("SELECT ?x { ?s ex:name ?n ; ex:age ?age BIND(CONCAT(UCASE(?n), '-', STR(?age + 1)) AS ?x) FILTER(?age >= 40 || ?n = 'Cy') }") == [("ANN-51",), ("BOB-41",), ("CY-31",)]
    assert ask("SELECT ?n { ?s ex:name ?n FILTER REGEX(?n, '^a', 'i') }") == [("Ann",), ("Ann",)]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n FILTER(?n IN ('Cy', 'Di')) }") == [("Cy",), ("Di",)]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n FILTER(?n NOT IN ('Cy', 'Ann')) }") == [("Bob",), ("Di",)]
    assert ask("SELECT (IF(?age > 35, 'old', 'young') AS ?x) ?n { ?s ex:name ?n ; ex:age ?age }") == [("old", "Ann"), ("old", "Bob"), ("young", "Ann"), ("young", "Cy")]


def test_set_operations(ask):
    assert ask("SELECT ?x { { ?s ex:no ?x } UNION { ?s a ex:Person ; ex:name ?x . FILTER(?x = 'Cy') } }") == [("10",), ("20",), ("30",), ("Cy",)]
    assert ask("SELECT ?n ?t { { ?s ex:name ?n . ?s ex:age 30 } UNION { ?s ex:name ?t ; ex:no '30' } }") == [("Cy", None), (None, "Law")]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n MINUS { ?s ex:age ?age } }") == [("Di",)]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n FILTER EXISTS { ?x ex:boss ?s } }") == [("Ann",), ("Ann",), ("Bob",), ("Cy",)]
    assert ask("SELECT ?n { ?s a ex:Person ; ex:name ?n FILTER NOT EXISTS { ?x ex:boss ?s } }") == [("Di",)]
    assert ask("SELECT ?s ?n { VALUES (?s ?n) { (<http://e.org/p/2> UNDEF) (UNDEF 'Cy') } ?s ex:name ?n }") == [(p(2)[0], "Bob"), (p(3)[0], "Cy")]
    assert ask("SELECT ?n { ?s ex:name ?n } VALUES ?n { 'Cy' 'Law' }") == [("Cy",), ("Law",)]


def test_aggregates_and_order(ask, spark):
    assert ask("SELECT ?t (COUNT(?s) AS ?c) (SUM(?age) AS ?sum) { ?s ex:in ?d ; ex:age ?age . ?d ex:name ?t } GROUP BY ?t") == [("IT", "2", "50"), ("Sales", "2", "90")]
    assert ask("SELECT ?t { ?s ex:in/ex:name ?t ; ex:age ?age } GROUP BY ?t HAVING (AVG(?age) > 30)") == [("Sales",)]
    assert ask("SELECT (COUNT(*) AS ?c) (COUNT(DISTINCT ?n) AS ?d) { ?s a ex:Person ; ex:name ?n }") == [("5", "4")]
    assert ask("SELECT (MIN(?age) AS ?lo) (MAX(?age) AS ?hi) (AVG(?age) AS ?m) (GROUP_CONCAT(?n ; SEPARATOR = '|') AS ?all) { ?s ex:name ?n ; ex:age ?age }") == [("20", "50", "35.0", "Ann|Ann|Bob|Cy")]
    got = execute_sparql(spark, PREFIX + "SELECT ?n { ?s ex:name ?n ; ex:age ?age } ORDER BY DESC(?age) LIMIT 2 OFFSET 1", r2rml(MAPPING)).collect()
    assert [r[0] for r in got] == ["Bob", "Cy"]
    got = execute_sparql(spark, PREFIX + "SELECT ?t (COUNT(*) AS ?c) { ?s ex:in/ex:name ?t } GROUP BY ?t ORDER BY DESC(COUNT(*)) ?t", r2rml(MAPPING)).collect()
    assert [tuple(r) for r in got] == [("IT", "2"), ("Sales", "2")]
    assert ask("SELECT ?n ?c { ?s a ex:Person ; ex:name ?n { SELECT ?s (COUNT(?x) AS ?c) { ?x ex:boss ?s } GROUP BY ?s } }") == [("Ann", "1"), ("Ann", "1"), ("Bob", "1"), ("Cy", "1")]
    assert ask("ASK { ?s ex:name 'Cy' }") == [(True,)] and ask("ASK { ?s ex:name 'Zed' }") == [(False,)]


def test_paths(ask):
    assert ask("SELECT ?b { <http://e.org/p/4> ex:boss+ ?b }") == [(x,) for x in p(1, 2, 3)]
    assert ask("SELECT ?b { <http://e.org/p/4> ex:boss* ?b }") == [(x,) for x in p(1, 2, 3, 4)]
    assert ask("SELECT ?b { <http://e.org/p/4> ex:boss? ?b }") == [(x,) for x in p(3, 4)]
    assert ask("SELECT ?a { ?a ex:boss+ ?a }") == [(p(5)[0],)]
    assert ask("SELECT ?n { <http://e.org/p/1> ^ex:boss/ex:name ?n }") == [("Bob",)]
    assert ask("SELECT ?x { <http://e.org/p/2> (ex:name|ex:boss) ?x }") == [("Bob",), (p(1)[0],)]
    assert ask("SELECT ?x { <http://e.org/d/10> !(ex:name|a) ?x }") == [("10",)]


def test_functions(ask):
    said = {
        "STRLEN(?n)": "3", "SUBSTR(?n, 2)": "ob", "SUBSTR(?n, 1, 2)": "Bo", "LCASE(?n)": "bob", "STRBEFORE(?n, 'o')": "B", "STRAFTER(?n, 'o')": "b",
        "REPLACE(?n, 'b', 'x', 'i')": "xox", "CONTAINS(?n, 'ob')": "true", "STRSTARTS(?n, 'Bo')": "true", "STRENDS(?n, 'Bo')": "false", "ABS(-3)": "3",
        "CEIL(1.2)": "2.0", "FLOOR(1.8)": "1.0", "ROUND(2.5)": "3.0", "7 / 2": "3.5", "2 * 3 - 1": "5", "-(2)": "-2", "MD5('a')": "0cc175b9c0f1b6a831c399e269772661",
        "SHA1('a')": "86f7e437faa5a7fce15d1ddcb9eaeaea377667b8", "xsd:integer('12')": "12", "xsd:integer('x')": None, "xsd:double('1.5')": "1.5", "xsd:boolean('true')": "true",
        "COALESCE(?zz, 'd')": None, "isIRI(?s)": "true", "isLiteral(?n)": "true", "isNumeric(1)": "true", "DATATYPE(?n)": "http://www.w3.org/2001/XMLSchema#string",
        "LANGMATCHES('en-GB', 'en')": "true", "sameTerm(?n, 'Bob')": "true", "STR(?s)": "http://e.org/p/2", "xsd:string(5)": "5", "1e8 + 0.5": "100000000.5",
    }
    del said["COALESCE(?zz, 'd')"]
    items = " ".join(f"({e} AS ?f{i})" for i, e in enumerate(said))
    got = ask(f"SELECT {items} {{ ?s ex:name ?n FILTER(?n = 'Bob') }}")
    assert dict(zip(said, got[0], strict=True)) == said


@pytest.mark.parametrize(
    "query",
    [
        "CONSTRUCT { ?s ex:name ?n } WHERE { ?s ex:name ?n }", "DESCRIBE ?s", "SELECT ?s { GRAPH ?g { ?s ex:name ?n } }", "SELECT ?s FROM NAMED <http://x> { ?s ex:name ?n }",
        "SELECT ?s { SERVICE <http://x> { ?s ex:name ?n } }", "SELECT (ENCODE_FOR_URI(?n) AS ?x) { ?s ex:name ?n }", "SELECT (NOW() AS ?x) { ?s ex:name ?n }",
        "SELECT (SHA512(?n) AS ?x) { ?s ex:name ?n }", "SELECT (ex:f(?n) AS ?x) { ?s ex:name ?n }", "SELECT ?s { ?s ex:name ?n FILTER(?zz = 1) }",
        "SELECT ?s { ?s ex:name ?n BIND(?zz AS ?y) }", "SELECT ?s { ?s ex:name ?n } ORDER BY ?zz", "SELECT ?n { ?s ex:name ?n } GROUP BY ?n HAVING (?zz > 1)", "SELECT (YEAR(?n) AS ?y) { ?s ex:name ?n }",
    ],
)
def test_rejections(query):
    with pytest.raises(TranslationError, match="SPARQL-to-SQL translation error"):
        sparql_to_sql(PREFIX + query, r2rml(MAPPING))


def test_errors(tmp_path):
    with pytest.raises(TranslationError, match="GRAPH patterns require named-graph support"):
        sparql_to_sql("SELECT ?s { GRAPH ?g { ?s ?p ?o } }", r2rml(MAPPING))
    for query in ("SELECT ?e WHERE { ?e ?p ?o", "SELECT WHERE { ?s ?p ?o }", "SELECT ?s { ?s nope:x ?o }", "SELECT ?s { ?s ?p ?o } LIMIT x"):
        with pytest.raises(SparqlParseError, match="SPARQL parse error: .*line 1, column"):
            sparql_to_sql(query, r2rml(MAPPING))
    with pytest.raises(MappingError, match="not a valid full R2RML mapping"):
        sparql_to_sql("SELECT ?s { ?s ?p ?o }", Mapping({}))
    with pytest.raises(MappingError, match="Mapping file not found"):
        sparql_to_sql("SELECT ?s { ?s ?p ?o }", str(tmp_path / "none.ttl"))


def test_catalyst_sees_tables(spark, ask):
    df = execute_sparql(spark, PREFIX + "SELECT ?s ?n { ?s ex:name ?n ; ex:age 40 }", r2rml(MAPPING)).filter("v_n = 'Bob'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "= Bob" in plan and "= 40" in plan and "Window" not in plan


def test_path_over_all_turns(spark, tmp_path):
    """Seven turns in a chain: the closure has all 28 pairs, not those of the first three."""
    from tripleframe.queries import QUERIES

    turns = [(1, t, "user", "x") for t in range(7)] + [(2, 5, "user", "x"), (1, 4, "user", "again")]
    spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(0,)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    found = {(r[0].rsplit("turn/")[1], r[1].rsplit("turn/")[1]) for r in QUERIES["sparql_path_plus"](spark, str(tmp_path)).collect()}
    assert found == {(f"1/{a}", f"1/{b}") for a in range(7) for b in range(a + 1, 8)} | {("2/5", "2/6")}


def test_exists_within_optional(ask):
    plain = ask("SELECT ?s ?n { ?s a ex:Person OPTIONAL { ?s ex:boss ?b . ?b ex:name ?n FILTER(EXISTS { ?b ex:dept 10 }) } }")
    assert plain == [(x, n) for x, n in zip(p(1, 2, 3, 4, 5), (None, "Ann", "Bob", None, None), strict=True)]
    nots = ask("SELECT ?s ?n { ?s a ex:Person OPTIONAL { ?s ex:boss ?b . ?b ex:name ?n FILTER NOT EXISTS { ?b ex:dept 10 } } }")
    assert nots == [(x, n) for x, n in zip(p(1, 2, 3, 4, 5), (None, None, None, "Cy", "Ann"), strict=True)]
    both = ask("SELECT ?s ?n { ?s a ex:Person OPTIONAL { ?s ex:boss ?b . ?b ex:name ?n FILTER(EXISTS { ?b ex:dept 10 } && ?n = 'Bob') } }")
    assert [n for _, n in both if n] == ["Bob"] and len(both) == 5


def test_joins_of_variables_that_may_be_unbound_are_by_equality(ask, spark):
    """A variable that OPTIONAL leaves open meets the same variable again: compatible as SPARQL has it, without a nested loop."""
    query = "SELECT ?s ?n ?o { ?s a ex:Person OPTIONAL { ?s ex:boss ?b . ?b ex:name ?n } . ?o ex:name ?n }"
    got = ask(query)
    names = {1: "Ann", 2: "Bob", 3: "Cy", 4: "Di", 5: "Ann"}
    depts = {10: "Sales", 20: "IT", 30: "Law"}
    boss = {2: 1, 3: 2, 4: 3, 5: 5}
    named = [(x, p(i)[0]) for i, x in names.items()] + [(x, f"http://e.org/d/{i}") for i, x in depts.items()]
    want = sorted((p(s)[0], x, o) for s in names for x, o in named if s not in boss or names[boss[s]] == x)
    assert got == want
    plan = execute_sparql(spark, PREFIX + query, r2rml(MAPPING))._jdf.queryExecution().optimizedPlan().toString()
    assert " OR isnull(" not in plan


def test_closure_of_layers(spark):
    """Two nodes in each of 14 layers: the closure has a row for each pair, whatever the number of paths."""
    from tripleframe.plans.sparql.run import transitive_closure

    edges = [(f"{i}{x}", f"{i + 1}{y}") for i in range(13) for x in "ab" for y in "ab"]
    out = transitive_closure(spark.createDataFrame(edges, "cte_from string, cte_to string"))
    assert out.count() == out.distinct().count() == sum(4 for i in range(14) for j in range(i + 1, 14))
    cycle = spark.createDataFrame([(str(i), str((i + 1) % 5)) for i in range(5)], "cte_from string, cte_to string")
    assert transitive_closure(cycle).count() == 25
