"""RDF analytics on Spark: read, profile, pivot, write and query RDF with DataFrames."""
