"""pivot_rdf: a wide, typed table with a column for each predicate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import LANG, SPARK_TYPES, XSD
from ..sources.paths import files_of, format_of
from ..sources.reader import scan
from .profile import label, profile


@dataclass(frozen=True)
class PivotColumn:
    """A predicate's column. members: (label, type) by label; more than one is a tagged struct. lang: text with a language."""

    predicate: str
    members: tuple[tuple[str, T.DataType], ...]
    multi: bool
    lang: bool

    @property
    def data_type(self) -> T.DataType:
        if self.lang:
            one: T.DataType = T.StructType([T.StructField("object", T.StringType()), T.StructField("lang", T.StringType())])
        elif len(self.members) == 1:
            one = self.members[0][1]
        else:
            one = T.StructType([T.StructField("tag", T.StringType()), *[T.StructField(n, t) for n, t in self.members]])
        return T.ArrayType(one) if self.multi else one


def member_of(name: str) -> tuple[str, T.DataType]:
    """The name and type that a label has in a column of mixed types."""
    kind = SPARK_TYPES.get(name)
    return ("varchar", T.StringType()) if kind is None else (name, kind)


def pivot_schema(rows) -> list[PivotColumn]:
    """The columns that a profile's rows ask for, by predicate."""
    out = []
    for row in sorted(rows, key=lambda r: r["predicate"].encode()):
        members = tuple(dict(sorted(member_of(x) for x in row["types"])).items())
        out.append(PivotColumn(row["predicate"], members, row["_multi"], LANG in row["types"]))
    return out


def cast_value(text: Column, datatype: Column, kind: T.DataType, strict: bool) -> Column:
    """A lexical form as a value; a malformed one fails (strict) or is null."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return text.isin("true", "1")
    if isinstance(kind, T.BinaryType):
        return F.when(datatype == XSD + "hexBinary", F.unhex(text) if strict else F.try_to_binary(text, F.lit("hex"))).otherwise(
            F.unbase64(text) if strict else F.try_to_binary(text, F.lit("base64"))
        )
    return text.cast(kind) if strict else text.try_cast(kind)


def _value(column: PivotColumn, raw: Column, strict: bool) -> Column:
    """The value of a struct of object, datatype, lang and label."""
    text, datatype = raw["object"], raw["datatype"]
    if column.lang:
        return F.struct(text.alias("object"), F.coalesce(raw["lang"], F.lit("")).alias("lang"))
    if len(column.members) == 1:
        return cast_value(text, datatype, column.members[0][1], strict)
    fields = [F.when(raw["member"] == name, cast_value(text, datatype, kind, strict)).cast(kind).alias(name) for name, kind in column.members]
    return F.struct(raw["member"].alias("tag"), *fields)


def _values(column: PivotColumn, found: Column, strict: bool) -> Column:
    """The distinct values of a list of positions and raw structs, in order."""
    kept = ("object", "lang") if column.lang else ("object", "datatype", "member")
    ordered = F.transform(F.array_sort(found), lambda x: F.struct(*[x["_raw"][k].alias(k) for k in kept]))
    return F.transform(F.array_distinct(ordered), lambda x: _value(column, x, strict))


def pivot(triples: DataFrame, columns: list[PivotColumn], strict: bool = True) -> DataFrame:
    """One row per filename, graph and subject of a triple table with object_kind, filename and _pos; one exchange.

    Values of one predicate: the first in the file (single) or all but exact repetitions, in the file's order (lists).
    """
    names = F.create_map(*[F.lit(x) for kind in sorted(SPARK_TYPES) for x in (kind, member_of(kind)[0])])
    member = F.coalesce(F.try_element_at(names, label()), F.lit("varchar"))
    raw = F.struct(F.col("object"), F.col("object_datatype").alias("datatype"), F.col("object_lang").alias("lang"), member.alias("member"))
    wanted = [c.predicate for c in columns]
    rows = triples.select("filename", F.coalesce("graph", F.lit("")).alias("graph"), "subject", "predicate", "_pos", raw.alias("_raw"))
    rows = rows.filter(F.col("predicate").isin(wanted)) if len(wanted) <= 100 else rows
    found = []
    for i, c in enumerate(columns):
        mine = F.col("predicate") == c.predicate
        if c.multi:
            found.append(F.collect_list(F.when(mine, F.struct("_pos", "_raw"))).alias(f"_c{i}"))
        else:
            found.append(F.min_by(F.when(mine, F.col("_raw")), F.when(mine, F.col("_pos"))).alias(f"_c{i}"))
    grouped = rows.groupBy("filename", "graph", "subject").agg(*found)
    out = []
    for i, c in enumerate(columns):
        at = F.col(f"_c{i}")
        if c.multi:
            value = F.when(F.size(at) > 0, _values(c, at, strict))
        else:
            value = F.when(at.isNotNull(), _value(c, at, strict))
        out.append(value.alias(c.predicate))
    return grouped.select("graph", "subject", *out)


def pivot_rdf(spark: SparkSession, paths: str | list[str], file_type: str | None = None, strict_parsing: bool = True, prefix_expansion: bool = False) -> DataFrame:
    """graph ('' for the default one), subject and a column for each predicate, sorted by name; a row per subject, graph and file.

    A column is a list if some subject has the predicate more than once, has object and lang if some literal has a
    language, and is a struct of a tag and a field for each type if types are mixed (see union_tag, union_extract).
    Two jobs: a profile gives the schema, then one aggregation fills it.
    """
    has_graphs = any(format_of(f, file_type) in ("nquads", "trig") for f in files_of(spark, paths))
    triples = scan(spark, paths, strict_parsing, prefix_expansion, file_type)
    columns = pivot_schema(profile(triples, has_graphs).collect())  # a row for each predicate
    return pivot(triples, columns, strict_parsing)


def union_tag(column: Column) -> Column:
    """Which member of a mixed column a value is."""
    return column["tag"]


def union_extract(column: Column, member: str) -> Column:
    """The value of a mixed column, null if it is another member."""
    return column[member]
