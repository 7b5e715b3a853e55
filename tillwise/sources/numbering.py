"""Positions 1, 2, ... over a whole table, without a window in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.sources.tables import materialize

#: Place of the row number within its partition in Spark's monotonically increasing ids.
PLACE_BITS = 33


def delivered_positions(ordered: DataFrame, name: str = "position", first: int = 1) -> DataFrame:
    """``ordered`` with its rows numbered from ``first`` in the order in which it delivers them.

    The rows are landed with their partition and their place in it; the sizes of the partitions, one
    row each, give where a partition starts.
    """
    landed = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", PLACE_BITS)
    sizes = landed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n") + first).alias("_start"))
    position = F.col("_start") + F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1)
    numbered = landed.withColumn("_part", part).join(starts, "_part")
    return numbered.select(*[F.col(f"`{c}`") for c in ordered.columns], position.alias(name))


def sorted_positions(df: DataFrame, order: Sequence[str | Column], name: str = "position", first: int = 1) -> DataFrame:
    """``df`` with its rows numbered by ``order``: dealt by range and sorted within a range."""
    return delivered_positions(df.repartitionByRange(*order).sortWithinPartitions(*order), name, first)


def out_of_order(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """(row_count, out_of_order): rows of a written table, and those that sort before the row above them
    in their file."""
    row, place = F.struct(*by), W.partitionBy("_file").orderBy("_place")
    rows = table.select(row.alias("_row"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    before = F.lag("_row").over(place)
    return rows.select((F.col("_row") < before).alias("_late")).agg(
        F.count("*").alias("row_count"), F.count_if("_late").alias("out_of_order")
    )
