"""Lifetime visit numbers and visit-to-visit return rates, per customer and store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.money import ratio
from tillwise.params import Period, ReturnRateParams
from tillwise.sources.buckets import VISITOR, heavy_keys, split_heavy
from tillwise.sources.tables import materialize


def store_visits(tx: DataFrame, members: DataFrame | None = None, store_id: str | None = None) -> DataFrame:
    """Transactions with a customer, optionally of the stores of a group and of one store.

    No date filter belongs here: visit numbers count over a customer's whole history.
    """
    rows = tx.filter(F.col("account_id").isNotNull())
    if store_id is not None:
        rows = rows.filter(F.col("store_id") == store_id)
    if members is not None:
        rows = rows.join(members.select("store_id"), "store_id")
    return rows


def visit_rank(
    visits: DataFrame,
    order: str = "local_time",
    tie: Sequence[str] = ("transaction_composite_key",),
) -> DataFrame:
    """Add ``visit_number``: 1, 2, ... per customer and store by local time.

    Visitors with more rows than an average task are heavy; there are fewer of them than tasks. All
    others are numbered by one window after one shuffle of the rows. The heavy ones are numbered
    by ``ranged_visit_rank``, so a shared or placeholder account spreads over many tasks.
    """
    parts = int(visits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    window = W.partitionBy(*VISITOR).orderBy(F.col(order), *[F.col(name) for name in tie])
    number = F.row_number().over(window)
    listed = heavy_keys(visits, parts, VISITOR)
    if not listed.count():
        return visits.withColumn("visit_number", number)
    light, heavy = split_heavy(visits, listed, VISITOR)
    return light.withColumn("visit_number", number).unionByName(ranged_visit_rank(heavy, order, tie))


def ranged_visit_rank(
    visits: DataFrame,
    order: str = "local_time",
    tie: Sequence[str] = ("transaction_composite_key",),
) -> DataFrame:
    """What ``visit_rank`` gives, for visitors with a large share of all rows.

    Rows are dealt into ranges of (customer, store, time, tie), so a visitor spreads over many tasks,
    even within one hour. Rows are numbered inside their range; the counts of a visitor's earlier
    ranges, a few numbers per visitor, give where its numbers start. The ranged rows are landed first,
    because both passes must see the same ranges.
    """
    sort = [F.col(order), *[F.col(name) for name in tie]]
    dealt = materialize(
        visits.repartitionByRange(*VISITOR, *sort).withColumn("_range", F.spark_partition_id())
    )
    keys = ["_range", *VISITOR]
    earlier = W.partitionBy(*VISITOR).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys).agg(F.count("*").alias("_rows")).select(
        *[F.col(name).alias(f"{name}_of") for name in keys],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
    )
    numbered = dealt.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(*sort)))
    same = [F.col(name).eqNullSafe(F.col(f"{name}_of")) for name in keys]
    return numbered.join(starts, same).select(
        *visits.columns, (F.col("_place") + F.col("_start")).cast("int").alias("visit_number")
    )


def visit_pairs(
    visits: DataFrame,
    params: ReturnRateParams,
    order: str = "local_time",
    tie: Sequence[str] = ("transaction_composite_key",),
) -> DataFrame:
    """Each start visit n of interest with the business day of visit n + 1 (NULL if none).

    Only the first few visits matter. The limit on the visit number makes Spark keep that many
    rows per visitor in every task before the shuffle, so even a visitor with a large share of
    all rows reaches the window as a handful of rows per task.
    """
    starts = params.start_visits()
    window = W.partitionBy(*VISITOR).orderBy(F.col(order), *[F.col(name) for name in tie])
    last_needed = starts[-1] + 1 if len(starts) else 0
    return (
        visits.select(*dict.fromkeys([*VISITOR, "business_day", order, *tie]))
        .withColumn("start_visit_number", F.row_number().over(window))
        .filter(F.col("start_visit_number") <= last_needed)
        .withColumn("next_business_day", F.lead("business_day").over(window))
        .filter(F.col("start_visit_number").isin(*starts) if len(starts) else F.lit(False))
        .select(*VISITOR, "start_visit_number", F.col("business_day").alias("start_business_day"), "next_business_day")
    )


def visit_return_rate(pairs: DataFrame, params: ReturnRateParams) -> DataFrame:
    """Return rate per visit pair in two periods, their difference and the second base.

    The start visit must fall in the period and on an allowed weekday; the next visit in the
    same period on any day. Rates are rounded; the change is rounded after subtracting.
    """
    start, following = F.col("start_business_day"), F.col("next_business_day")
    allowed = F.dayofweek(start).isin(*params.start_days)

    def within(day: Column, period: Period) -> Column:
        return day.between(F.lit(period.start), F.lit(period.end))

    counts = []
    for i, period in ((1, params.period_1), (2, params.period_2)):
        base = within(start, period) & allowed
        counts += [
            F.count_if(base).alias(f"base_{i}"),
            F.count_if(base & within(following, period)).alias(f"returned_{i}"),
        ]
    rate_1, rate_2 = (ratio(F.col(f"returned_{i}"), F.col(f"base_{i}")) for i in (1, 2))
    number = F.col("start_visit_number")
    return pairs.groupBy("start_visit_number").agg(*counts).select(
        F.concat(number.cast("string"), F.lit("->"), (number + 1).cast("string")).alias("visit_pair"),
        "start_visit_number",
        F.round(rate_1, 4).alias("return_rate_1"),
        F.round(rate_2, 4).alias("return_rate_2"),
        F.round(rate_2 - rate_1, 4).alias("return_rate_change"),
        F.col("base_2").alias("base_customers_2"),
    )
