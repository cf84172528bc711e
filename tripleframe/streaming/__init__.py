"""Triples from streams."""
