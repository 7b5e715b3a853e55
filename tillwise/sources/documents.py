"""Check documents parsed once, when they are landed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tillwise.sources.tables import write_table


def parse_documents(tx: DataFrame, check: str = "check") -> DataFrame:
    """``tx`` with the text of ``check`` replaced by its parsed form, a VARIANT.

    A text that is no JSON, or names a key twice in one object, becomes NULL; a missing one stays NULL.
    """
    return tx.withColumn(check, F.try_parse_json(check))


def land_documents(
    tx: DataFrame, path: str, check: str = "check", partition_by: str | None = None, cluster_by: Iterable[str] = ()
) -> DataFrame:
    """Write ``tx`` with parsed documents, so that no reader parses them again; read it back.

    Keys that cover the text, such as the check's, must be there before. ``items.parsed_line_items`` reads
    the items of the parsed form, for all operators that take ``items``.
    """
    return write_table(parse_documents(tx, check), path, partition_by, cluster_by)
