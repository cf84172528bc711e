"""Readers of RDF documents."""
