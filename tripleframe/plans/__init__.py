"""Mappings between tables and RDF, and the queries and writers planned from them."""
