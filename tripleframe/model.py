"""The data model: triple tables, XSD types and their Spark counterparts."""

from __future__ import annotations

from pyspark.sql import types as T

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"

COLUMNS = ("graph", "subject", "predicate", "object", "object_datatype", "object_lang")

#: Kind of the object's term: I (IRI), B (blank node) or L (literal); kept inside, not shown by read_rdf.
KIND = "object_kind"

TRIPLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
KIND_SCHEMA = T.StructType([*TRIPLE_SCHEMA.fields, T.StructField(KIND, T.StringType())])
PREFIX_SCHEMA = T.StructType([T.StructField("prefix", T.StringType()), T.StructField("uri", T.StringType()), T.StructField("is_base", T.BooleanType())])

#: XSD local names by the label that a profile shows.
LABELS = {
    "BOOLEAN": ["boolean"],
    "TINYINT": ["byte"],
    "UTINYINT": ["unsignedByte"],
    "SMALLINT": ["short"],
    "USMALLINT": ["unsignedShort"],
    "INTEGER": ["int"],
    "UINTEGER": ["unsignedInt"],
    "BIGINT": ["long"],
    "UBIGINT": ["unsignedLong"],
    "HUGEINT": ["integer", "nonNegativeInteger", "positiveInteger", "negativeInteger", "nonPositiveInteger"],
    "FLOAT": ["float"],
    "DOUBLE": ["double"],
    "DECIMAL": ["decimal"],
    "VARCHAR": ["string", "normalizedString", "token", "anyURI"],
    "DATE": ["date"],
    "TIME": ["time"],
    "TIMESTAMP": ["dateTime"],
    "TIMESTAMP WITH TIME ZONE": ["dateTimeStamp"],
    "INTERVAL": ["duration"],
    "BLOB": ["hexBinary", "base64Binary"],
}
LABEL_OF = {XSD + name: label for label, names in LABELS.items() for name in names}

#: Labels of terms that are no plain or typed literals.
IRI, BLANK, LANG = "IRI", "BLANK", "LANG_STRING"

#: Spark types of pivoted columns by label; every other label is text.
SPARK_TYPES = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "UTINYINT": T.ShortType(),
    "SMALLINT": T.ShortType(),
    "USMALLINT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "UINTEGER": T.LongType(),
    "BIGINT": T.LongType(),
    "UBIGINT": T.DecimalType(20, 0),
    "HUGEINT": T.DecimalType(38, 0),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "DECIMAL": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "BLOB": T.BinaryType(),
}


def xsd_of(kind: T.DataType) -> str | None:
    """The datatype IRI of literals made from a Spark type; None for plain literals."""
    names = {
        T.BooleanType: "boolean", T.ByteType: "byte", T.ShortType: "short", T.IntegerType: "int", T.LongType: "long",
        T.FloatType: "float", T.DoubleType: "double", T.DateType: "date", T.TimestampNTZType: "dateTime", T.TimestampType: "dateTimeStamp",
    }
    if isinstance(kind, T.DecimalType):
        return XSD + ("integer" if kind.scale == 0 and kind.precision == 38 else "decimal")
    if type(kind).__name__ == "TimeType":
        return XSD + "time"
    name = names.get(type(kind))
    return XSD + name if name else None
