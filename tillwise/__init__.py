"""Retail transaction analytics expressed as PySpark DataFrame transformations."""
