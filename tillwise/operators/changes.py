"""Readouts over the pre-computed year-over-year change table of store groups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.clock import between_days, utc_wall_time, week_start, weekday_name
from tillwise.functions.items import scalar_sql
from tillwise.functions.labels import CUSTOMER_TAGS, DAYPART_TAGS, decode
from tillwise.functions.money import DOLLAR_TYPE, relative_change, ratio
from tillwise.params import Period

# The document paths of a change (tags; current and prior sale cents and visits).
_SIDE = "struct<s:struct<d:string>,t:struct<d:string>>"
CHANGE_SCHEMA = f"t array<string>, c {_SIDE}, p {_SIDE}"
CUSTOMER_TAG_POSITION = 0
DAYPART_TAG_POSITION = 2


def unpack_yoy_changes(
    changes: DataFrame, groups: Iterable[str] | None = None, window: Period | None = None
) -> DataFrame:
    """JSON change documents -> one row per group, date, store count, customer type and daypart.

    A document whose tag list is too short falls to the tag filter instead of failing the job.
    """

    def amount(path: str) -> Column:
        return F.expr(f"try_cast({scalar_sql(f'document.{path}')} AS DECIMAL(38,9))")

    def dollars(total: Column) -> Column:
        return F.round(total * F.lit(Decimal("0.01")), 2).cast(DOLLAR_TYPE)

    rows = changes.withColumn("business_date", F.to_date(utc_wall_time(changes, "date")))
    if groups is not None:
        rows = rows.filter(F.col("storeGroupId").isin(*groups))
    if window is not None:
        rows = rows.filter(between_days(F.col("business_date"), window.start, window.end))
    tags = F.col("document.t")
    return (
        rows.select(
            F.col("storeGroupId").alias("group_name"),
            F.col("storeCount").alias("store_count"),
            "business_date",
            F.explode("changes").alias("change"),
        )
        .withColumn("document", F.from_json("change", CHANGE_SCHEMA))
        .select(
            "group_name", "store_count", "business_date",
            F.get(tags, CUSTOMER_TAG_POSITION).try_cast("bigint").alias("customer_tag"),
            F.get(tags, DAYPART_TAG_POSITION).try_cast("bigint").alias("daypart_tag"),
            amount("c.s.d").alias("current_sale"),
            amount("p.s.d").alias("prior_sale"),
            amount("c.t.d").alias("current_visit"),
            amount("p.t.d").alias("prior_visit"),
        )
        .filter(F.col("customer_tag").isin(*CUSTOMER_TAGS) & F.col("daypart_tag").isin(*DAYPART_TAGS))
        .groupBy(
            "group_name", "store_count", "business_date",
            decode(F.col("customer_tag"), CUSTOMER_TAGS).alias("customer_type"),
            decode(F.col("daypart_tag"), DAYPART_TAGS).alias("daypart"),
        )
        .agg(
            dollars(F.sum("current_sale")).alias("current_sale"),
            dollars(F.sum("prior_sale")).alias("prior_sale"),
            F.sum("current_visit").alias("current_visit"),
            F.sum("prior_visit").alias("prior_visit"),
        )
        .select(
            "group_name", "store_count", "business_date",
            weekday_name(F.col("business_date")).alias("weekday_name"),
            "customer_type", "daypart",
            "current_sale", "prior_sale", "current_visit", "prior_visit",
        )
    )


def exclude_dates(df: DataFrame, excluded: Iterable[Period], day: str = "business_date") -> DataFrame:
    """Drop rows inside any of the excluded date ranges."""
    for period in excluded:
        df = df.filter(~F.col(day).between(F.lit(period.start), F.lit(period.end)))
    return df


def yoy_contribution(
    raw: DataFrame,
    dimension: str,
    excluded: Iterable[Period] = (),
    groups: Iterable[str] | None = None,
) -> DataFrame:
    """Contribution of each customer type and value of ``dimension`` to the change in sales.

    ``dimension`` is ``weekday_name`` or ``daypart``. The share is of the whole result; impact
    is change times share. ``store_numbers`` lists the store counts in order of date, daypart
    and weekday: one entry per input row, so its length is bounded by the calendar.
    """
    rows = exclude_dates(raw, excluded)
    if groups is not None:
        rows = rows.filter(F.col("group_name").isin(*groups))
    listed = F.array_sort(
        F.collect_list(F.struct("business_date", "daypart", "weekday_name", "store_count"))
    )
    base = rows.groupBy("group_name", "customer_type", dimension).agg(
        F.percentile_approx("store_count", F.lit(0.5)).alias("median_stores"),
        F.array_join(F.transform(listed, lambda e: e["store_count"].cast("string")), ",").alias("store_numbers"),
        F.sum("current_sale").alias("current_sales"),
        F.sum("prior_sale").alias("prior_sales"),
    )
    # The aggregate has a few rows per group, so a window over all of it is a small task.
    total = F.sum("current_sales").over(W.partitionBy())
    change = relative_change(F.col("current_sales"), F.col("prior_sales"))
    return (
        base.withColumn("_change", change)
        .withColumn("_share", ratio(F.col("current_sales"), total))
        .select(
            "group_name", "median_stores", "customer_type", "store_numbers", dimension,
            F.round("current_sales", 2).alias("current_sales"),
            F.round("prior_sales", 2).alias("prior_sales"),
            F.round("_change", 4).alias("yoy_change"),
            F.round("_share", 4).alias("sale_contribution"),
            F.round(F.col("_change") * F.col("_share"), 4).alias("impact"),
        )
    )


def yoy_group_pivot(
    raw: DataFrame,
    groups: Mapping[str, str],
    measure: str,
    grain: str = "day",
    excluded: Iterable[Period] = (),
    customer_type: str | None = None,
) -> DataFrame:
    """Groups side by side: prior, current and change of a measure per day or Monday week.

    ``groups`` maps a group id to the prefix of its columns, in output order. Listing the
    groups lets one conditional aggregation build the table, with no pass to find them.
    """
    rows = exclude_dates(raw, excluded)
    if customer_type is not None:
        rows = rows.filter(F.col("customer_type") == customer_type)
    if grain == "week":
        key, bucket = "week_start_date", week_start(F.col("business_date"))
    elif grain == "day":
        key, bucket = "business_date", F.col("business_date")
    else:
        raise ValueError("grain is 'day' or 'week'")
    current, prior = f"current_{measure}", f"prior_{measure}"
    sums = [
        F.sum(F.when(F.col("group_name") == group, F.col(side))).alias(f"{prefix}_{side}")
        for group, prefix in groups.items()
        for side in (prior, current)
    ]
    wide = rows.groupBy(bucket.alias(key)).agg(*sums)
    columns: list[Column] = [F.col(key)]
    for prefix in groups.values():
        now, before = F.col(f"{prefix}_{current}"), F.col(f"{prefix}_{prior}")
        columns += [before, now, relative_change(now, before).alias(f"{prefix}_yoy_{measure}_change")]
    return wide.select(*columns)

