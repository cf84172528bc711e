"""Scalar expressions shared by the writers and the SPARQL compiler."""
