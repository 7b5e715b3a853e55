"""Medians and other quantiles of any window, merged from stored sketches of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.money import cents

#: Values a sketch holds at its lowest level. Up to so many values are kept exactly; beyond, see ``rank_error``.
SKETCH_SIZE = 4096


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Error of a quantile's rank, as a share of all values, that 99 % of sketches stay under.

    The bound is the published one of KLL sketches and does not grow when sketches are merged.
    """
    return 2.296 / size**0.9021


def sketch_values(
    rows: DataFrame, keys: Sequence[str], value: str | Column, size: int = SKETCH_SIZE, name: str = "sketch"
) -> DataFrame:
    """(*keys, sketch): a KLL sketch of the integer ``value`` per key. Nulls do not count.

    Sketches are built in each task and merged after the shuffle, so a busy key is no hot task.
    """
    number = (F.col(value) if isinstance(value, str) else value).cast("bigint")
    valued = rows.select(*keys, number.alias("_value")).filter("_value IS NOT NULL")
    return valued.groupBy(*keys).agg(F.kll_sketch_agg_bigint("_value", size).alias(name))


def sketch_sales(tx: DataFrame, keys: Sequence[str] = ("store_id", "business_day"), size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of the sale amounts, in cents."""
    return sketch_values(tx, keys, cents(F.col("sale_in_dollar")), size)


def merge_sketches(sketches: DataFrame, by: Sequence[str], size: int = SKETCH_SIZE, name: str = "sketch") -> DataFrame:
    """Sketches of coarser keys; merging again gives sketches of the same quality."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint(name, size).alias(name))


def read_quantiles(sketches: DataFrame, quantiles: dict[str, float], name: str = "sketch") -> DataFrame:
    """The sketch replaced by ``value_count`` and a column per quantile, an element of the data each."""
    keys = [c for c in sketches.columns if c != name]
    columns = [F.kll_sketch_get_quantile_bigint(name, F.lit(float(q))).alias(c) for c, q in quantiles.items()]
    return sketches.select(*keys, F.kll_sketch_get_n_bigint(name).alias("value_count"), *columns)
