"""profile_rdf: what each predicate of a dataset holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import BLANK, IRI, KIND, LABEL_OF, LANG
from ..sources.paths import files_of, format_of
from ..sources.reader import scan


def label() -> Column:
    """The type label of a row's object."""
    known = F.create_map(*[F.lit(x) for kv in LABEL_OF.items() for x in kv])
    datatype = F.col("object_datatype")
    return (
        F.when(F.col(KIND) == "I", IRI)
        .when(F.col(KIND) == "B", BLANK)
        .when(F.col("object_lang").isNotNull(), LANG)
        .when(datatype.isNull(), "VARCHAR")
        .otherwise(F.coalesce(F.try_element_at(known, datatype), datatype))
    )


def profile(triples: DataFrame, has_graphs: bool = True) -> DataFrame:
    """The profile of a triple table with object_kind; also _multi: some subject has the predicate more than once.

    Two passes over the triples, each aggregated before any shuffle: counts and extremes by predicate, label and graph,
    and the pairs of predicate and subject, whose exchange is the only large one and which exact distinct counts need.
    """
    graph = F.coalesce("graph", F.lit("")) if has_graphs else F.lit("")
    typed = triples.select("predicate", label().alias("_label"), graph.alias("_g"), "object")
    # the empty list makes Spark aggregate strings by hash, not by sorting the table; it holds nothing
    nothing = F.collect_list(F.lit(None).cast("string"))
    by_graph = typed.groupBy("predicate", "_label", "_g").agg(F.count(F.lit(1)).alias("_n"), F.min("object").alias("_min"), F.max("object").alias("_max"), nothing.alias("_none"))
    # a graph counts with the first of its labels, so that no set of graphs is held
    said = F.struct("_label", (F.col("_n") + F.size("_none")).alias("n"), F.col("_min").alias("low"), F.col("_max").alias("high"))
    whole = by_graph.groupBy("predicate", "_g").agg(F.collect_list(said).alias("_labels")).select("predicate", F.posexplode("_labels").alias("_at", "_is"))
    by_type = whole.groupBy("predicate", F.col("_is._label").alias("_label")).agg(
        F.sum("_is.n").alias("_n"), F.min("_is.low").alias("_min"), F.max("_is.high").alias("_max"), F.sum(F.when(F.col("_at") == 0, 1).otherwise(0)).alias("_graphs")
    )
    pair = lambda value: F.map_from_entries(F.array_sort(F.collect_list(F.struct("_label", F.col(value).alias("v")))))
    types = by_type.groupBy("predicate").agg(
        F.array_sort(F.collect_list("_label")).alias("types"),
        pair("_n").alias("count"),
        pair("_min").alias("min"),
        pair("_max").alias("max"),
        F.sum("_graphs").alias("graph_count"),
    )
    by_subject = triples.groupBy("predicate", "subject").agg(F.count(F.lit(1)).alias("_n"))
    subjects = by_subject.groupBy("predicate").agg(F.count(F.lit(1)).alias("subject_count"), (F.max("_n") > 1).alias("_multi"))
    out = types.join(subjects, "predicate")
    return out.select("predicate", "types", "count", "min", "max", "graph_count", "subject_count", "_multi")


def profile_rdf(spark: SparkSession, paths: str | list[str], strict_parsing: bool = True, file_type: str | None = None) -> DataFrame:
    """One row per predicate, sorted: predicate, types, count, min, max (by type), graph_count, subject_count.

    Prefixed names are always expanded; minima and maxima compare lexical forms by bytes; the default graph counts as one.
    """
    has_graphs = any(format_of(f, file_type) in ("nquads", "trig") for f in files_of(spark, paths))
    triples = scan(spark, paths, strict_parsing, True, file_type)
    return profile(triples, has_graphs).drop("_multi").orderBy("predicate")
