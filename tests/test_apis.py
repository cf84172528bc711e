import datetime

import pytest

from tripleframe.errors import InvalidInput, RdfError
from tripleframe.sources.reader import read_rdf
from tripleframe.sources.remote import read_sparql
from tripleframe.sqlapi import FUNCTIONS, catalog, register
from tripleframe.streaming.reader import counts_by_window, parse_stream, read_rdf_stream

from .conftest import rows
from .test_mapping import INSIDE, STAFF
from .test_read import NT, TTL, in_graph, put


def test_catalog(spark):
    got = catalog(spark).collect()
    assert len(got) == len(FUNCTIONS) and all(r["description"] and r["examples"] for r in got)


def test_sql_names(spark, tmp_path):
    register(spark)
    nt, ttl, nq = put(tmp_path, "x.nt", NT), put(tmp_path, "x.ttl", TTL), put(tmp_path, "x.nq", in_graph(NT))
    want = rows(read_rdf(spark, nt))
    assert rows(spark.sql(f"SELECT * FROM read_rdf('{nt}')")) == want
    assert rows(spark.sql(f"SELECT * FROM read_rdf('{ttl}', prefix_expansion => true)")) == want
    assert spark.sql(f"SELECT count(DISTINCT graph) FROM read_rdf('{nq}')").first()[0] == 1
    full, inside = tmp_path / "full.ttl", tmp_path / "in.ttl"
    full.write_text(STAFF)
    inside.write_text(INSIDE)
    got = spark.sql(f"SELECT is_valid_r2rml('{full}'), can_call_inside_out('{inside}'), is_valid_r2rml('none'), sparql_to_sql('ASK {{ ?s ?p ?o }}', '{full}')").first()
    assert tuple(got)[:3] == (True, True, False) and got[3].startswith("SELECT count(1) > 0")


def test_sql_table_functions(spark, tmp_path):
    """Each of them by sql(): distributed, with named arguments and lists, and under further SQL."""
    from tripleframe.operators.pivot import pivot_rdf
    from tripleframe.operators.profile import profile_rdf
    from tripleframe.sources.reader import read_rdf_prefixes
    from tripleframe.sqlapi import sql

    nt, ttl = put(tmp_path, "x.nt", NT), put(tmp_path, "y.ttl", TTL)
    put(tmp_path, "bad.nt", NT + "broken\n")
    want = rows(read_rdf(spark, nt))
    assert rows(sql(spark, f"SELECT * FROM read_rdf('{nt}')")) == want
    assert sql(spark, f"SELECT count(*) FROM read_rdf(['{nt}', '{nt}'], filename => true) AS t WHERE filename LIKE '%x.nt'").first()[0] == 2 * len(want)
    assert sql(spark, f"SELECT count(*) FROM READ_RDF ( ARRAY['{tmp_path}/b*.nt'] , strict_parsing := false, file_type = 'nt')").first()[0] == len(want)
    assert rows(sql(spark, f"SELECT * FROM read_rdf_prefixes('{ttl}')")) == rows(read_rdf_prefixes(spark, ttl))
    assert rows(sql(spark, f"SELECT predicate, subject_count FROM profile_rdf('{nt}')")) == rows(profile_rdf(spark, nt).select("predicate", "subject_count"))
    assert rows(sql(spark, f"SELECT * FROM pivot_rdf('{nt}') -- read_rdf('no call')")) == rows(pivot_rdf(spark, nt))
    full = tmp_path / "full.ttl"
    full.write_text(STAFF)
    assert tuple(sql(spark, f"SELECT is_valid_r2rml('{full}') AS a, can_call_inside_out('{full}') AS b, 'read_rdf(''x'')' AS c").first()) == (True, False, "read_rdf('x')")
    assert sql(spark, f"SELECT sparql_to_sql('ASK {{ ?s ?p ?o }}', '{full}') AS q").first()[0].startswith("SELECT count(1) > 0")
    with pytest.raises(InvalidInput, match="constant"):
        sql(spark, "SELECT * FROM read_rdf(some_column)")


def test_data_source(spark, tmp_path):
    register(spark)
    put(tmp_path, "a.nt", NT)
    put(tmp_path, "b.nt.gz", NT)
    df = spark.read.format("rdf").option("filename", "true").load(f"{tmp_path}/*.nt*")
    assert df.count() == 14 and df.select("filename").distinct().count() == 2
    want = read_rdf(spark, f"{tmp_path}/a.nt").filter("predicate = 'http://xmlns.com/foaf/0.1/name' AND object_lang IS NOT NULL").count()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = spark.read.format("rdf").option("pushdown", "true").load(f"{tmp_path}/a.nt").filter("predicate = 'http://xmlns.com/foaf/0.1/name' AND object_lang IS NOT NULL")
        assert pushed.count() == want == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="line 2"):
        spark.read.format("rdf").load(put(tmp_path, "bad.nt", NT.split("\n")[0] + "\n<x\n")).collect()


def test_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.nt", NT)
    put(tmp_path / "in", "b.nt", "broken\n" + NT)
    stream = read_rdf_stream(spark, f"{tmp_path}/in", max_files=1)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    want = rows(read_rdf(spark, f"{tmp_path}/in/a.nt"))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == sorted(want + want, key=repr)


def test_stream_windows(spark, tmp_path):
    source = tmp_path / "lines"
    at = datetime.datetime(2024, 1, 1)
    lines = [(f'<http://e/{i}> <http://e/p{i % 2}> "{i}" .', at + datetime.timedelta(minutes=i)) for i in range(20)]
    spark.createDataFrame(lines, "value string, at timestamp").write.parquet(str(source))
    stream = spark.readStream.schema("value string, at timestamp").parquet(str(source))
    counted = counts_by_window(parse_stream(stream, keep=("at",)), "at", "10 minutes", "5 minutes")
    query = counted.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").select("predicate", "n").orderBy("predicate").collect() == [("http://e/p0", 5), ("http://e/p0", 5), ("http://e/p1", 5), ("http://e/p1", 5)]


def test_remote(spark):
    asked = []

    def answer(body):
        def fetch(url):
            asked.append(url)
            return body.encode()

        return fetch

    df = read_sparql(spark, "https://h/sparql?x=1", "SELECT ?a", answer('a,b\r\n1,"x, ""y""\nz"\r\n2,\r\n3\r\n'))
    assert df.columns == ["a", "b"] and rows(df) == [("1", 'x, "y"\nz'), ("2", None), ("3", None)]
    assert asked == ["https://h/sparql?x=1&query=SELECT%20%3Fa"]
    assert rows(read_sparql(spark, "http://h", "q", answer("a\n1\n\n2\n"))) == [("1",), ("2",), (None,)]
    assert read_sparql(spark, "http://h", "q", answer("a,b\n")).count() == 0
    for endpoint, query in (("", "q"), ("http://h", ""), ("ftp://h", "q")):
        with pytest.raises(InvalidInput):
            read_sparql(spark, endpoint, query, answer("a\n"))
    with pytest.raises(RdfError, match="no header"):
        read_sparql(spark, "http://h", "q", answer(""))
    with pytest.raises(RdfError, match="IO Error"):
        read_sparql(spark, "http://127.0.0.1:9/sparql", "q")


def test_entry_and_queries(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) > 50


def test_queries_match_their_sql(spark):
    """Every query of the package on the smallest tables, against DuckDB."""
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    from tripleframe.queries import ORACLE_SQL, QUERIES

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    for name, query in QUERIES.items():
        if name not in ORACLE_SQL:
            continue
        df = query(spark, str(folder))
        columns = sorted(df.columns)
        got = sorted((tuple(str(r[c]) for c in columns) for r in df.collect()), key=repr)
        found = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        want = sorted((tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
        assert got == want, name
