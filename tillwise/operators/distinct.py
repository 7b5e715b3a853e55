"""Exact distinct customer counts of any grouping, from stored bitmaps.

Customers are numbered once. A bitmap per store and day has a bit for each of its customers; the
customers of any set of stores and days are the bits of the bitmaps combined by OR. The fact is not
read again, and a new day adds its own bitmaps only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.sources.numbering import sorted_positions


def number_customers(tx: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(account_id, customer_no): every customer of ``tx`` and of ``known``, numbered from 1 without gaps.

    Customers of ``known`` (account_id, customer_no) keep their numbers, new ones follow. New customers are
    numbered store by store (the first of their stores), so a store's customers share few bitmaps.
    Rows without a customer have no number.
    """
    homes = tx.filter(F.col("account_id").isNotNull()).groupBy("account_id").agg(F.min("store_id").alias("_home"))
    first = 1
    if known is not None:
        homes = homes.join(known.select("account_id"), "account_id", "left_anti")
        first = (known.agg(F.max("customer_no")).first()[0] or 0) + 1
    numbered = sorted_positions(homes, ["_home", "account_id"], "customer_no", first).drop("_home")
    return numbered if known is None else known.select("account_id", "customer_no").unionByName(numbered)


def customer_bitmaps(tx: DataFrame, numbers: DataFrame, keys: Sequence[str] = ("store_id", "business_day")) -> DataFrame:
    """(*keys, bucket, bits): the customers of each key as bitmaps of 32,768 consecutive numbers.

    Rows are reduced to distinct customers of a key in each task before they meet their numbers, and
    only buckets that have a customer have a row. Rows without a customer are left out.
    """
    pairs = tx.filter(F.col("account_id").isNotNull()).select(*keys, "account_id").distinct()
    number = F.col("customer_no")
    return (
        pairs.join(numbers, "account_id")
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def combine_bitmaps(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser keys: the OR of the bitmaps of each group. Combining again gives the same."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_customers(bitmaps: DataFrame, by: Sequence[str], name: str = "customers") -> DataFrame:
    """Exact number of distinct customers of each group of ``by`` (empty: of all)."""
    combined = combine_bitmaps(bitmaps, by)
    return combined.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def replace_days(stored: DataFrame, fresh: DataFrame, day: str = "business_day") -> DataFrame:
    """Stored bitmaps with the days of ``fresh`` replaced, for late rows and new days alike."""
    days = fresh.select(day).distinct()
    return stored.join(days, stored[day].eqNullSafe(days[day]), "left_anti").unionByName(fresh)
