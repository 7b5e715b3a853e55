"""Year-over-year reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import clock, labels
from tillwise.functions.money import dollars
from tillwise.operators import activity, changes, cohort, dayparts, distinct, stores, yoy
from tillwise.params import EIGHTEEN_MONTH_LAG_DAYS, YEAR_LAG_DAYS, CohortRules, Period, StoreWindow
from tillwise.sources.tables import materialize


def annual_cohort_yoy(
    transactions: DataFrame, group_map: DataFrame, groups: DataFrame, rules: CohortRules
) -> DataFrame:
    """Fixed-cohort comparison per store group, year and weekday group.

    The fact is scanned twice: once into store-days, once for the totals. Store-days and the
    cohort are small and feed several branches, so they are materialized.
    """
    valid = stores.valid_sales_channel(transactions, rules.channels, rules.window.end)
    store_days = materialize(activity.store_day_activity(valid, ("store_id", "store_name")))
    members = materialize(cohort.fixed_cohort(store_days, group_map, groups, rules))
    totals = yoy.cohort_period_totals(valid, members, rules, store_days)
    return yoy.yoy_metrics(totals, cohort.cohort_summary(members))


def land_daily_tables(transactions: DataFrame, rules: CohortRules) -> tuple[DataFrame, DataFrame]:
    """(store-days, customer bitmaps) of the valid sales: all that ``annual_cohort_yoy_stored`` reads."""
    valid = stores.valid_sales_channel(transactions, rules.channels, rules.window.end)
    store_days = materialize(activity.store_day_activity(valid, ("store_id", "store_name")))
    numbers = materialize(distinct.number_customers(valid))
    return store_days, materialize(distinct.customer_bitmaps(valid, numbers))


def annual_cohort_yoy_stored(
    store_days: DataFrame, bitmaps: DataFrame, group_map: DataFrame, groups: DataFrame, rules: CohortRules
) -> DataFrame:
    """``annual_cohort_yoy`` from stored days, without the fact."""
    members = materialize(cohort.fixed_cohort(store_days, group_map, groups, rules))
    totals = yoy.stored_period_totals(store_days, bitmaps, members, rules)
    return yoy.yoy_metrics(totals, cohort.cohort_summary(members))


def annual_cohort_yoy_pivot(
    transactions: DataFrame, group_map: DataFrame, groups: DataFrame, rules: CohortRules
) -> DataFrame:
    """The same comparison with Saturday and non-Saturday columns side by side."""
    return yoy.pivot_weekday_group(annual_cohort_yoy(transactions, group_map, groups, rules))


def group_daypart_transactions(
    tx: DataFrame,
    merchant_map: DataFrame,
    store_table: DataFrame,
    group_map: DataFrame,
    groups: DataFrame,
    group_id: str,
    window: Period,
    lookback_days: int,
) -> DataFrame:
    """Valid sales of a store group with the business day implied by the group's dayparts.

    Rows outside every daypart drop out. The window is widened by ``lookback_days``.
    """
    wanted = groups.filter(F.col("storeGroupId") == group_id)
    parts = dayparts.parse_dayparts(wanted, "storeGroupId", "store_group_id")
    zones = parts.select("store_group_id", "time_zone").distinct()
    earliest = window.start - timedelta(days=lookback_days)

    rows = stores.valid_sales(clock.within_utc_envelope(tx, earliest, window.end))
    rows = stores.attach_store(rows, merchant_map, store_table, group_map, group_id).drop("time_zone")
    rows = stores.local_time_columns(rows.join(zones, "store_group_id"))
    rows = rows.filter(F.col("local_date").between(F.lit(earliest), F.lit(window.end)))
    rows = dayparts.assign_daypart(rows, parts, owner="store_group_id")
    return dayparts.daypart_business_date(rows, "business_day").withColumn(
        "sale_in_dollar", dollars(F.col("amount"))
    )


def comparison_store_count(
    tx: DataFrame,
    merchant_map: DataFrame,
    store_table: DataFrame,
    group_map: DataFrame,
    groups: DataFrame,
    group_id: str,
    window: Period,
    active_above: int = 10,
    lags: Sequence[int] = (YEAR_LAG_DAYS, EIGHTEEN_MONTH_LAG_DAYS),
) -> DataFrame:
    """Largest, smallest and median size of the dynamic comparison group over a window."""
    rows = group_daypart_transactions(
        tx, merchant_map, store_table, group_map, groups, group_id, window, max(lags) + 1
    )
    keys = ("store_group_id", "store_id")
    days = activity.store_day_activity(rows, keys)
    active = activity.active_store_days(days, active_above)
    return activity.store_count_summary(activity.comparison_group(active, window, lags, keys))


def trial_store_yoy(
    tx: DataFrame,
    merchant_map: DataFrame,
    windows: Iterable[StoreWindow],
    analysis: Period,
    time_zone: str,
    lag_days: int = YEAR_LAG_DAYS,
) -> DataFrame:
    """Daily sales and visits of the test stores next to the same weekday a year earlier."""
    earliest = analysis.start - timedelta(days=lag_days)
    rows = stores.cutoff_sales(
        tx, merchant_map, Period(earliest, analysis.end), time_zone, windows, require_check=False
    ).withColumn("customer_type", labels.customer_type(F.col("isNewAtStore")))
    daily = yoy.daily_store_metrics(rows)
    return yoy.period_over_period(
        daily, analysis, match_keys=("store_id", "customer_type"), lag_days=lag_days
    )


def trial_store_readouts(
    pairs: DataFrame, store_id: str, customer_type: str = "Returning"
) -> dict[str, DataFrame]:
    """The three readouts of ``trial_store_yoy``: all stores, one store, one customer type."""
    return {
        "sale_by_date": yoy.yoy_rollup(pairs, ["business_date"], "sale").orderBy("business_date"),
        "visit_by_store": yoy.yoy_rollup(
            pairs, ["store_id", "store_name", "customer_type", "business_date"], "visit",
            {"store_id": store_id, "customer_type": customer_type},
        ).orderBy("business_date"),
        "visit_by_type": yoy.yoy_rollup(
            pairs, ["customer_type", "business_date"], "visit", {"customer_type": customer_type}
        ).orderBy("business_date"),
    }


def group_yoy_readouts(
    raw: DataFrame,
    groups: Mapping[str, str],
    excluded: Iterable[Period] = (),
    sale_customer_type: str | None = "Returning",
    visit_customer_type: str | None = "New",
) -> dict[str, DataFrame]:
    """Group pivots of the unpacked change table: daily for everyone, weekly by customer type.

    ``raw`` is the published change table; the weekly readouts each choose a customer type, or
    None for everyone.
    """
    excluded = tuple(excluded)

    def pivot(measure: str, grain: str, customer_type: str | None = None) -> DataFrame:
        table = changes.yoy_group_pivot(raw, groups, measure, grain, excluded, customer_type)
        return table.orderBy(table.columns[0])

    return {
        "daily_visit": pivot("visit", "day"),
        "daily_sale": pivot("sale", "day"),
        "weekly_sale": pivot("sale", "week", sale_customer_type),
        "weekly_visit": pivot("visit", "week", visit_customer_type),
    }


# Dayparts in report order.
DAYPART_ORDER = ("Breakfast", "Lunch", "Midday", "Dinner", "LateNight")


def year_to_date_contribution(
    raw: DataFrame, group: str, excluded: Iterable[Period] = ()
) -> dict[str, DataFrame]:
    """Contribution of each weekday and of each daypart, by customer type, for one group."""
    excluded = tuple(excluded)
    orders = {"weekday_name": clock.WEEKDAY_NAMES, "daypart": DAYPART_ORDER}
    return {
        dimension: changes.yoy_contribution(raw, dimension, excluded, [group]).orderBy(
            "customer_type", labels.sort_rank(F.col(dimension), order)
        )
        for dimension, order in orders.items()
    }
