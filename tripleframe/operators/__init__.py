"""Operators over triple tables."""
