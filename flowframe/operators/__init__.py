"""Transforms: rows in, rows out."""
