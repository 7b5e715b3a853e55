"""Queries over the given tables with their SQL counterparts (see ``__spark_entry__.py``)."""
