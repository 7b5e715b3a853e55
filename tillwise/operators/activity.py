"""Store activity by day and the dynamic comparison group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.clock import between_days
from tillwise.functions.money import sum_dollars
from tillwise.params import EIGHTEEN_MONTH_LAG_DAYS, YEAR_LAG_DAYS, Period


def store_day_activity(
    tx: DataFrame, keys: Sequence[str] = ("store_id",), day: str = "business_day"
) -> DataFrame:
    """Transaction count and sales per store and day.

    The count-and-sum is combined on the map side, so a store with a large share of all rows
    sends only its days through the shuffle. Everything downstream works on this small table.
    """
    return tx.groupBy(*keys, day).agg(
        F.count("*").alias("txn_count"),
        sum_dollars(F.col("sale_in_dollar")).alias("sales_amount"),
    )


def active_store_days(store_days: DataFrame, min_txn: int) -> DataFrame:
    """Store-days with strictly more than ``min_txn`` transactions."""
    return store_days.filter(F.col("txn_count") > min_txn)


def comparison_group(
    active: DataFrame,
    window: Period | None = None,
    lags: Sequence[int] = (YEAR_LAG_DAYS, EIGHTEEN_MONTH_LAG_DAYS),
    keys: Sequence[str] = ("store_id",),
    day: str = "business_day",
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Stores active on an anchor day and on every lagged day before it.

    Each active store-day votes for the anchors it can support (its own date and its date
    plus each lag), and an anchor keeps the stores that collected every vote. One aggregation
    over the small store-day table replaces a self-join per lag. The store must be active on
    the anchor itself, so anchors are observed days; ``anchors`` (``anchor_day``) narrows them.
    """
    offsets = (0, *lags)
    votes = F.array(
        *[
            F.struct(F.date_add(F.col(day), offset).alias("anchor_day"), F.lit(1 << i).alias("vote"))
            for i, offset in enumerate(offsets)
        ]
    )
    ballots = active.select(*keys, F.explode(votes).alias("b")).select(*keys, "b.anchor_day", "b.vote")
    if window is not None:
        ballots = ballots.filter(between_days(F.col("anchor_day"), window.start, window.end))
    if anchors is not None:
        ballots = ballots.join(anchors.select("anchor_day"), "anchor_day", "left_semi")
    return (
        ballots.groupBy("anchor_day", *keys)
        .agg(F.bit_or("vote").alias("votes"))
        .filter(F.col("votes") == (1 << len(offsets)) - 1)
        .select("anchor_day", *keys)
    )


def store_count_summary(group: DataFrame) -> DataFrame:
    """Largest, smallest and median daily store count.

    The median is an element of the data. Days on which no store qualifies do not appear.
    """
    daily = group.groupBy("anchor_day").agg(F.count("*").alias("stores"))
    return daily.agg(
        F.max("stores").alias("max_store"),
        F.min("stores").alias("min_store"),
        F.percentile_approx("stores", F.lit(0.5)).alias("median_store_count"),
    )
