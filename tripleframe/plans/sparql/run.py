"""sparql_to_sql and execute_sparql."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...errors import MappingError
from ..mapping import Mapping, TriplesMap, read_mapping
from ..write import source_frame
from .bgp import Bgps
from .compiler import Compiler
from .parser import parse


def _model(mapping: str | Mapping) -> Mapping:
    model = read_mapping(mapping) if isinstance(mapping, str) else mapping
    if not model.is_valid():
        raise MappingError(f"'{mapping if isinstance(mapping, str) else 'given'}' is not a valid full R2RML mapping")
    return model


def _schemas(spark: SparkSession | None):
    known: dict[str, T.StructType | None] = {}

    def schema_of(m: TriplesMap) -> T.StructType | None:
        """The catalog's types of a source; None if there is no session or no such table."""
        if spark is None:
            return None
        key = f"{m.table}\n{m.query}"
        if key not in known:
            try:
                known[key] = source_frame(spark, m).schema
            except AnalysisException:
                known[key] = None
        return known[key]

    return schema_of


def sparql_to_sql(query: str, mapping: str | Mapping, spark: SparkSession | None = None, unique_subjects: bool | set[str] = False) -> str:
    """The Spark SQL of a SELECT or ASK query over the mapping's tables: columns v_<variable>, or ask.

    spark: its catalog's types allow joins and conditions on the columns as they are; without it, all goes by text.
    unique_subjects: see Bgps.
    """
    model = _model(mapping)
    return Compiler(Bgps(model, _schemas(spark), unique_subjects)).query(parse(query))


def execute_sparql(spark: SparkSession, query: str, mapping: str | Mapping, unique_subjects: bool | set[str] = False) -> DataFrame:
    """The query's solutions. Lazy but for closures of paths (+ and *), which are computed here by a distributed fixpoint."""
    model = _model(mapping)

    def closure(edges: str) -> str:
        view = f"closure_{uuid.uuid4().hex}"
        transitive_closure(spark.sql(edges)).createOrReplaceTempView(view)
        return view

    return spark.sql(Compiler(Bgps(model, _schemas(spark), unique_subjects), closure).query(parse(query)))


def transitive_closure(edges: DataFrame) -> DataFrame:
    """cte_from, cte_to of all paths of one edge or more: semi-naive iteration by doubling.

    Each round joins the pairs that are new with all known ones; a reliable checkpoint in the session's shared folder
    cuts lineage, so lost executors cost the current round alone.
    """
    spark = edges.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            import tempfile

            folder = "file://" + tempfile.mkdtemp(prefix="tripleframe-")
        spark.sparkContext.setCheckpointDir(folder)
    edges = edges.select("cte_from", "cte_to").filter("cte_from is not null and cte_to is not null").distinct().checkpoint()
    # paths double in length each round, so that a chain of n edges takes log n rounds; pairs are found by their shortest halves
    known = new = edges
    while True:
        ends = lambda df, a, b: df.select(F.col("cte_from").alias(a), F.col("cte_to").alias(b))
        ahead = ends(new, "cte_from", "_via").join(ends(known, "_via", "cte_to"), "_via").select("cte_from", "cte_to")
        behind = ends(known, "cte_from", "_via").join(ends(new, "_via", "cte_to"), "_via").select("cte_from", "cte_to")
        new = ahead.union(behind).distinct().join(known, ["cte_from", "cte_to"], "left_anti").checkpoint()
        if new.isEmpty():
            return known
        known = known.union(new)  # of checkpoints: nothing is written again
