"""SPARQL over mapped tables: parser, compiler to Spark SQL, recursive paths."""
