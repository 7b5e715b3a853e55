"""Every operator and report as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwise.functions import items as I, labels
from tillwise.functions.money import sum_dollars
from tillwise.operators import (
    activity,
    baskets,
    changes,
    cohort,
    colocated,
    customers,
    dayparts,
    distinct,
    heavy,
    normalize,
    quantiles,
    returns,
    stores,
    visits,
    yoy,
)
from tillwise.params import SALES_CHANNELS, CohortRules, Period, ReturnRateParams, StoreWindow
from tillwise.plans import customer_reports, yoy_reports
from tillwise.sources.buckets import ColocatedFact, bucket_fact
from tillwise.sources.documents import land_documents
from tillwise.sources.incremental import sync_changed
from tillwise.sources.numbering import delivered_positions, out_of_order
from tillwise.sources.splits import read_splits, split_predicates
from tillwise.sources.tables import materialize, publish_report, scratch_root, snapshot_table, sync_tables
from tillwise.workload import views

Query = Callable[[SparkSession, str], DataFrame]

ZONE = "America/Chicago"
SALES = views.SALES_WINDOW
DIMENSIONS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
}
COMPARED = Period(date(1996, 1, 1), SALES.end)
CLOSURES = (Period(date(1997, 6, 9), date(1997, 6, 19)), Period(date(1999, 10, 4), date(1999, 10, 4)))
PIVOT_GROUPS = {"ALL": "brand", "G0": "even", "G1": "odd"}
BUCKETS = 8
SPLITS = 6
REVISED_YEAR = 2000
REVISED_DAY, MOVED_DAY = date(2024, 1, 10), date(2024, 1, 20)
CLUSTERED_LOOKUPS = {
    "store_id": "S2", "account_id": "7", "channel_group": "Online", "customer_type": "New",
}
TARGETS = (("Brand#1", "ECONOMY"), ("Brand#1", "LARGE"), ("Brand#2", "PROMO"), ("Brand#3", "SMALL"))
OLD_CODES = ("Brand#1", "Brand#2", "Brand#3", "Brand#4")
NEW_CODES = ("Brand#5", "Brand#6")
NEW_CODE = "PROMO"
LAUNCH = Period(date(2000, 7, 1), date(2000, 12, 31))
LOOKBACK = Period(date(1995, 1, 1), date(2000, 6, 30))
WINDOWS = tuple(
    StoreWindow(f"S{i}", f"Trial store {i}", date(1999, 1 + i, 5)) for i in range(views.STORES) if i != 4
)
RETURNS = ReturnRateParams(
    Period(date(2024, 1, 1), date(2024, 1, 15)), Period(date(2024, 1, 16), date(2024, 1, 31))
)
WEEKEND_RETURNS = ReturnRateParams(RETURNS.period_1, RETURNS.period_2, start_days=(1, 7))
RULES = CohortRules(
    window=Period(SALES.start, date(2001, 7, 31)),
    maturity_cutoff=date(1995, 4, 25),
    maturity_rank=50,
    monthly_minimum=6,
    daily_minimum=1,
    saturday_minimum={1996: 14, 1997: 14, 1998: 14, 1999: 14, 2000: 14, 2001: 10},
    non_saturday_rate=0.34,
    coverage_years=(1996, 1997, 1998, 1999, 2000),
    report_years=(1996, 1997, 1998, 1999, 2000, 2001),
    year_to_date=2001,
    excluded_saturdays=(date(1998, 11, 14), date(2000, 5, 20)),
    excluded_non_saturdays=(date(1998, 11, 12), date(2000, 8, 3)),
)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand over the same type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


# --- ingest and normalize ---------------------------------------------------------------


def _target(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/target-{uuid.uuid4().hex}"


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.read(spark, sf_dir, "events")
    return snapshot_table(events, _target(spark), "ts", ("event_type", "user_id"))


def snapshot_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed row of every dimension, its columns as text."""
    sources = {name: views.read(spark, sf_dir, name) for name in DIMENSIONS}
    landed = sync_tables(sources, _target(spark))
    rows = [
        table.select(
            F.lit(name).alias("table_name"),
            *[F.col(c).cast("string").alias(f"column_{i}") for i, c in enumerate(DIMENSIONS[name])],
        )
        for name, table in landed.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def split_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read in splits of a key that a third of them share, the other third without it."""
    lines = _skewed_lines(spark, sf_dir)
    return read_splits(lines.filter, split_predicates(lines, "part_key", SPLITS, spread="l_orderkey"))


def _skewed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, key = views.read(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 3
    part = F.when(key == 0, F.lit(7).cast("bigint")).when(key == 1, F.col("l_partkey"))
    return lines.select("l_orderkey", "l_linenumber", part.alias("part_key"))


def split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read through the splits, and whether the deepest split is within twice the mean."""
    lines = _skewed_lines(spark, sf_dir)
    predicates = split_predicates(lines, "part_key", SPLITS, spread="l_orderkey")
    sizes = [F.count_if(F.expr(p)) for p in predicates]
    return lines.agg(
        reduce(lambda a, b: a + b, sizes).alias("row_count"),
        (F.greatest(*sizes) * len(predicates) <= F.count("*") * 2).alias("within_bound"),
    )


def _earlier_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as they might have stood at an earlier sync: one day's values differ, one day was
    recorded a year early."""
    events, day = views.read(spark, sf_dir, "events"), F.to_date("ts")
    return events.withColumns(
        {
            "value": F.when(day == F.lit(REVISED_DAY), F.col("value") + 1).otherwise(F.col("value")),
            "ts": F.when(day == F.lit(MOVED_DAY), F.col("ts") - F.expr("INTERVAL 366 DAYS")).otherwise(F.col("ts")),
        }
    )


def _resynced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = _target(spark)
    sync_changed(_earlier_events(spark, sf_dir), target, "ts", ("event_type", "user_id"))
    return sync_changed(views.read(spark, sf_dir, "events"), target, "ts", ("event_type", "user_id"))


def snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after a second sync that rewrote the changed dates only."""
    return _resynced(spark, sf_dir)[0]


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates that the second sync rewrote or deleted."""
    return _resynced(spark, sf_dir)[1]


def _attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.attach_store(
        views.event_authorizations(spark, sf_dir), views.merchant_map(spark), views.stores(spark)
    )


def attach_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.attach_store(
        views.event_authorizations(spark, sf_dir), views.merchant_map(spark), views.stores(spark),
        views.group_map(spark), "G0",
    )
    return rows.select("event_id", "store_id", "store_name", "channel_group", "time_zone", "store_group_id")


def valid_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.valid_sales(
        views.event_authorizations(spark, sf_dir), require_check=True, require_account=True
    )
    return rows.select("event_id", "type", "amount", "accountNumberId")


def valid_sales_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.valid_sales_channel(views.sales(spark, sf_dir), SALES_CHANNELS, date(2000, 12, 31))
    return _plain(rows.select("transaction_composite_key", "store_id", "business_day", "channel_group", "sale_in_dollar"))


def check_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.with_check_columns(views.event_authorizations(spark, sf_dir))
    return rows.select("event_id", "check_hash")


def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.local_time_columns(_attached(spark, sf_dir)).select(
        "event_id", "time_zone", "local_time", "local_date", "local_weekday", "tx_minute_of_day"
    )


def business_date_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.business_date_cutoff(views.order_authorizations(spark, sf_dir, None), ZONE)
    return rows.select("o_orderkey", "local_time", "business_date")


def parse_dayparts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dayparts.parse_dayparts(views.supplier_stores(spark, sf_dir), "storeId")


def daypart_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.supplier_stores(spark, sf_dir).select("storeId", F.posexplode("dayParts").alias("position", "document"))
    raw = F.get_json_object("document", "$.n")
    return documents.select(
        "storeId", "position", raw.alias("raw_name"), labels.normalize_daypart_name(raw).alias("daypart_name")
    )


def _with_dayparts(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    rows = stores.local_time_columns(_attached(spark, sf_dir))
    return dayparts.assign_daypart(rows, dayparts.parse_dayparts(views.stores(spark), "storeId"), how=how)


_DAYPART_COLUMNS = ("event_id", "store_id", "tx_minute_of_day", "daypart_name", "daypart_order")


def assign_daypart_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dayparts(spark, sf_dir, "inner").select(*_DAYPART_COLUMNS)


def assign_daypart_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dayparts(spark, sf_dir, "left").select(*_DAYPART_COLUMNS)


def _with_minutes(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    rows = stores.local_time_columns(_attached(spark, sf_dir))
    lookup = dayparts.minute_lookup(dayparts.parse_dayparts(views.stores(spark), "storeId"))
    return dayparts.assign_daypart_by_minute(rows, lookup, how=how)


def minute_daypart_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_minutes(spark, sf_dir, "inner").select(*_DAYPART_COLUMNS)


def minute_daypart_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_minutes(spark, sf_dir, "left").select(*_DAYPART_COLUMNS)


def daypart_business_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dayparts.daypart_business_date(_with_dayparts(spark, sf_dir, "left"))
    return rows.select(
        "event_id", "local_date", "daypart_name", "business_date", "business_weekday",
        "business_month_year", "business_year",
    )


def customer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_authorizations(spark, sf_dir).select(
        "event_id", labels.customer_type(F.col("isNewAtStore")).alias("customer_type")
    )


def money_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money that arrives as DOUBLE, summed exactly to the cent."""
    lines = views.read(spark, sf_dir, "lineitem")
    return _plain(lines.groupBy("l_suppkey").agg(sum_dollars(F.col("l_extendedprice")).alias("total_price")))


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_transactions(
        views.event_authorizations(spark, sf_dir), views.merchant_map(spark), views.stores(spark),
        after=datetime(2024, 1, 1, 12),
    )


def normalize_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_normalized(spark, sf_dir))


def publish_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(normalize.publish_normalized(_normalized(spark, sf_dir), _target(spark)))


def publish_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(normalize.publish_clustered(_normalized(spark, sf_dir), _target(spark)))


def clustered_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and sales of one value of each cluster column, read from the clustered table."""
    published = normalize.publish_clustered(_normalized(spark, sf_dir), _target(spark), partition_by=None)
    parts = [
        published.filter(F.col(column) == value).agg(
            F.lit(column).alias("cluster_column"), F.count("*").alias("row_count"),
            sum_dollars(F.col("sale_in_dollar")).alias("total_sale"),
        )
        for column, value in CLUSTERED_LOOKUPS.items()
    ]
    return _plain(reduce(DataFrame.unionByName, parts))


def normalize_transactions_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_transactions(
        views.event_authorizations(spark, sf_dir), views.merchant_map(spark), views.stores(spark),
        group_map=views.group_map(spark), group_prefix="G",
    )
    return rows.select(
        "transaction_composite_key", "check_hash", "store_id", "account_id", "customer_type", "daypart_name", "business_date"
    )


def normalize_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalization from a landed snapshot, whose date partitions the time bound prunes."""
    landed = snapshot_table(
        views.event_authorizations(spark, sf_dir), _target(spark), "timestamp", ("siteIdFrontend", "terminalId")
    )
    rows = normalize.normalize_transactions(
        landed, views.merchant_map(spark), views.stores(spark), after=datetime(2024, 1, 19, 7, 30)
    )
    return _plain(rows)


def based_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(normalize.based_transactions(_normalized(spark, sf_dir)))


# --- activity and cohort ----------------------------------------------------------------


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.valid_sales_channel(views.sales(spark, sf_dir), RULES.channels, RULES.window.end)


def _store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.store_day_activity(_valid(spark, sf_dir), ("store_id", "store_name"))


def store_day_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(activity.store_day_activity(views.sales(spark, sf_dir)))


def active_store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = activity.store_day_activity(views.sales(spark, sf_dir))
    return _plain(activity.active_store_days(days, 1))


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = activity.store_day_activity(views.sales(spark, sf_dir))
    return activity.comparison_group(activity.active_store_days(days, 0), COMPARED)


def comparison_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir)


def store_count_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.store_count_summary(_comparison(spark, sf_dir))


def comparison_store_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yoy_reports.comparison_store_count(
        views.order_authorizations(spark, sf_dir, None), views.merchant_map(spark), views.stores(spark),
        views.group_map(spark), views.store_groups(spark), "ALL", COMPARED, active_above=0,
    )


def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = views.sales(spark, sf_dir).agg(
        F.min("business_day").alias("start_date"), F.max("business_day").alias("end_date")
    )
    return cohort.calendar_spine(bounds)


def maturity_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.maturity_rule(_store_days(spark, sf_dir), RULES)


def monthly_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.monthly_continuity_rule(_store_days(spark, sf_dir), RULES)


def saturday_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.saturday_coverage_rule(_store_days(spark, sf_dir), RULES)


def non_saturday_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.non_saturday_coverage_rule(_store_days(spark, sf_dir), RULES)


def _cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    store_days = materialize(_store_days(spark, sf_dir))
    return cohort.fixed_cohort(store_days, views.group_map(spark), views.store_groups(spark), RULES)


def fixed_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cohort(spark, sf_dir)


def cohort_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_summary(_cohort(spark, sf_dir))


# --- year over year ---------------------------------------------------------------------


def yoy_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yoy.yoy_date_spine(_cohort(spark, sf_dir), RULES)


def _totals(side: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store_days = materialize(_store_days(spark, sf_dir))
        members = materialize(
            cohort.fixed_cohort(store_days, views.group_map(spark), views.store_groups(spark), RULES)
        )
        totals = yoy.cohort_period_totals(_valid(spark, sf_dir), members, RULES, store_days)
        measures = [c for c in totals.columns if c.startswith(side)]
        return _plain(totals.select(*yoy.SPINE_KEYS, *measures))

    return query


def annual_cohort_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        yoy_reports.annual_cohort_yoy(
            views.sales(spark, sf_dir), views.group_map(spark), views.store_groups(spark), RULES
        )
    )


def annual_cohort_yoy_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annual comparison from landed store-days and customer bitmaps."""
    days, bitmaps = yoy_reports.land_daily_tables(views.sales(spark, sf_dir), RULES)
    return _plain(
        yoy_reports.annual_cohort_yoy_stored(days, bitmaps, views.group_map(spark), views.store_groups(spark), RULES)
    )


def annual_cohort_yoy_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        yoy_reports.annual_cohort_yoy_pivot(
            views.sales(spark, sf_dir), views.group_map(spark), views.store_groups(spark), RULES
        )
    )


def bitmap_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers by year, by store group, by weekday and by all three, from stored bitmaps."""
    sales = views.sales(spark, sf_dir)
    numbers = materialize(distinct.number_customers(sales))
    bitmaps = publish_report(distinct.customer_bitmaps(sales, numbers), _target(spark), cluster_by=("store_id", "business_day"))
    members = views.group_map(spark).select(F.col("storeId").alias("store_id"), F.col("storeGroupId").alias("store_group_id"))
    days = bitmaps.join(members, "store_id").withColumns(
        {"year": F.year("business_day"), "weekday": F.weekday("business_day")}
    )
    names = ("store_group_id", "year", "weekday")
    counts = [distinct.distinct_customers(days, by) for by in (("store_group_id",), ("year",), ("weekday",), names)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts).select(*names, "customers")


def sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 90th percentile of the sales of each store group and year, from stored sketches of days."""
    days = publish_report(quantiles.sketch_sales(views.sales(spark, sf_dir)), _target(spark))
    members = views.group_map(spark).select(F.col("storeId").alias("store_id"), F.col("storeGroupId").alias("store_group_id"))
    merged = quantiles.merge_sketches(
        days.join(members, "store_id").withColumn("year", F.year("business_day")), ("store_group_id", "year")
    )
    return quantiles.read_quantiles(merged, {"median_cents": 0.5, "p90_cents": 0.9})


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yoy_reports.trial_store_yoy(
        views.order_authorizations(spark, sf_dir, None), views.merchant_map(spark), WINDOWS, COMPARED, ZONE
    )


def period_over_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_pairs(spark, sf_dir))


def _published_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_report(_pairs(spark, sf_dir), _target(spark), cluster_by=("store_id", "customer_type", "business_date"))


def publish_trial_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_published_pairs(spark, sf_dir))


def republished_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report after one year of it was corrected: only the months concerned are written again."""
    report = materialize(_pairs(spark, sf_dir).withColumn("report_month", F.trunc("business_date", "month")))
    wrong = F.year("business_date") == REVISED_YEAR
    earlier = report.withColumn("current_visit", F.when(wrong, F.col("current_visit") + 1).otherwise(F.col("current_visit")))
    target = _target(spark)
    sync_changed(earlier, target, date_column="report_month", cluster_by=("business_date", "store_id"))
    return _plain(
        sync_changed(report, target, date_column="report_month", cluster_by=("business_date", "store_id"))[0]
    ).drop("report_month")


def _readout(name: str) -> Query:
    return lambda spark, sf_dir: _plain(
        yoy_reports.trial_store_readouts(_published_pairs(spark, sf_dir), "S2")[name]
    )


def _raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.unpack_yoy_changes(views.group_changes(spark, sf_dir), tuple(PIVOT_GROUPS), SALES)


def unpack_yoy_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_raw_changes(spark, sf_dir))


def _published_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_report(_raw_changes(spark, sf_dir), _target(spark), cluster_by=("group_name", "business_date"))


def publish_raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_published_changes(spark, sf_dir))


def _contribution(dimension: str) -> Query:
    return lambda spark, sf_dir: _plain(
        yoy_reports.year_to_date_contribution(_published_changes(spark, sf_dir), "G0", CLOSURES)[dimension]
    )


def contribution_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekday contributions in report order, each row with its position."""
    return delivered_positions(_contribution("weekday_name")(spark, sf_dir))


def published_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the published report, and those out of the order in which its files were written."""
    return out_of_order(_published_pairs(spark, sf_dir), ("store_id", "customer_type", "business_date"))


def _pivot(name: str) -> Query:
    return lambda spark, sf_dir: _plain(
        yoy_reports.group_yoy_readouts(_published_changes(spark, sf_dir), PIVOT_GROUPS, CLOSURES)[name]
    )


# --- items, baskets, customers ----------------------------------------------------------


def _brand_checks(spark: SparkSession, sf_dir: str, windows=None, group_id: str | None = None) -> DataFrame:
    return stores.cutoff_sales(
        views.order_authorizations(spark, sf_dir), views.merchant_map(spark), SALES, ZONE, windows,
        views.group_map(spark) if group_id else None, group_id,
    )


def explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_authorizations(spark, sf_dir).select("o_orderkey", "check")
    return _plain(baskets.explode_items(rows).drop("check"))


def target_orders_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_authorizations(spark, sf_dir)
    return baskets.target_orders(rows, I.matches_code_and_name(TARGETS), ("o_orderkey", "accountNumberId"))


def target_orders_priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_authorizations(spark, sf_dir)
    return baskets.target_orders(rows, I.matches_paid_code(OLD_CODES), ("o_orderkey", "accountNumberId"))


def item_share_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _brand_checks(spark, sf_dir, group_id="ALL")
    return baskets.item_share_per_customer(rows, I.matches_code_and_name(TARGETS), 5)


def share_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_reports.item_share_histogram(
        views.order_authorizations(spark, sf_dir), views.merchant_map(spark), views.group_map(spark),
        "ALL", TARGETS, SALES, ZONE, min_orders=5,
    )


def prior_buyer_rollcall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        customer_reports.menu_test_rollcall(
            _landed_orders(spark, sf_dir), views.merchant_map(spark), views.group_map(spark),
            "ALL", WINDOWS, TARGETS, SALES, ZONE,
        )
    )


def _normalized_orders(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    return normalize.normalize_transactions(
        views.order_authorizations(spark, sf_dir, code, "p_name"), views.merchant_map(spark), views.stores(spark)
    )


def _landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw authorizations as a snapshot leaves them; the view that stands for the source packs its documents anew
    for every reader."""
    return materialize(views.order_authorizations(spark, sf_dir))


def _published_orders(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    """The published columns that the adoption report reads, clustered by the date it filters on."""
    rows = _normalized_orders(spark, sf_dir, code).select(
        "store_id", "account_id", "transaction_type", "check_hash", "check", "sale_in_dollar", "timestamp", "business_date"
    )
    return publish_report(rows, _target(spark), cluster_by=("business_date",))


def _funnel(stage: str) -> Query:
    return lambda spark, sf_dir: customer_reports.launch_conversion(
        _normalized_orders(spark, sf_dir, "p_brand"), views.group_map(spark), "ALL", WINDOWS,
        OLD_CODES, NEW_CODES, SALES.start, SALES.end,
    )[stage]


def _adoption(result: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = customer_reports.adopter_baskets(
            _published_orders(spark, sf_dir, "p_type"), ("S0", "S1", "S2", "S3"), NEW_CODE, LAUNCH, LOOKBACK
        )
        return _plain(tables[result])

    return query


def heavy_compositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent compositions of the adopters' earlier checks, by counters and a recount."""
    tables = customer_reports.adopter_baskets(
        _published_orders(spark, sf_dir, "p_type"), ("S0", "S1", "S2", "S3"), NEW_CODE, LAUNCH, LOOKBACK
    )
    return heavy.top_compositions(tables["lookback_transactions"])


def _landed_checks(spark: SparkSession, sf_dir: str, windows=None, group_id: str | None = None) -> DataFrame:
    return land_documents(_brand_checks(spark, sf_dir, windows, group_id), _target(spark))


def parsed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of documents that were parsed when they were landed."""
    rows = views.order_authorizations(spark, sf_dir).select("o_orderkey", "check")
    return _plain(baskets.explode_items(land_documents(rows, _target(spark)), I.parsed_line_items()).drop("check"))


def parsed_rollcall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _landed_checks(spark, sf_dir, WINDOWS, "ALL")
    report = customers.prior_buyer_rollcall(rows, I.matches_code_and_name(TARGETS), I.parsed_line_items())
    return _plain(report)


def parsed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _landed_checks(spark, sf_dir, WINDOWS)
    rows = rows.withColumn("customer_type", labels.customer_type(F.col("isNewAtStore")))
    test = I.matches_code_and_name(TARGETS)
    return _plain(customers.target_customer_history(rows, test, items=I.parsed_line_items()))


def target_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        customer_reports.target_item_history(
            _landed_orders(spark, sf_dir), views.merchant_map(spark), WINDOWS, TARGETS, SALES, ZONE,
        )
    )


def target_customer_history_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        customer_reports.target_item_history(
            _landed_orders(spark, sf_dir), views.merchant_map(spark), WINDOWS, TARGETS, SALES, ZONE,
            with_target_details=True, display_names=True,
        )
    )


def _colocated_checks(spark: SparkSession, sf_dir: str, group_id: str | None) -> ColocatedFact:
    checks = materialize(_brand_checks(spark, sf_dir, group_id=group_id))
    return bucket_fact(checks, _target(spark), BUCKETS)


def colocated_rollcall(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _colocated_checks(spark, sf_dir, "ALL")
    return _plain(colocated.prior_buyer_rollcall(fact, I.matches_code_and_name(TARGETS), WINDOWS))


def colocated_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _colocated_checks(spark, sf_dir, None)
    light, heavy = (
        x.withColumn("customer_type", labels.customer_type(F.col("isNewAtStore"))) for x in (fact.light, fact.heavy)
    )
    fact = ColocatedFact(light, heavy, fact.keys, fact.buckets)
    return _plain(colocated.target_customer_history(fact, I.matches_code_and_name(TARGETS), WINDOWS))


def colocated_visit_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = bucket_fact(views.event_visits(spark, sf_dir), _target(spark), BUCKETS, sort_by=("local_time",))
    return colocated.visit_rank(fact)


def history_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history report in its order, each row with its position."""
    report = customer_reports.target_item_history(
        _landed_orders(spark, sf_dir), views.merchant_map(spark), WINDOWS, TARGETS, SALES, ZONE, in_order=True
    )
    return delivered_positions(report).select("store_name", "account_id", "timestamp", "check_hash", "position")


def target_item_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _brand_checks(spark, sf_dir, WINDOWS)
    details = customers.target_item_details(rows, I.matches_code_and_name(TARGETS))
    return details.drop("check_hash")


# --- visits -----------------------------------------------------------------------------


def visit_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visit_rank(visits.store_visits(views.event_visits(spark, sf_dir)))


def visit_return_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_reports.return_rates(
        views.event_visits(spark, sf_dir), views.group_map(spark), "ALL", RETURNS
    )


def visit_return_rate_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_reports.return_rates(
        views.event_visits(spark, sf_dir), views.group_map(spark), "G0", WEEKEND_RETURNS, store_id="S2"
    )


def incremental_return_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rates from a state that two deliveries brought up to date, the second with late rows."""
    rows, path, day = visits.store_visits(views.event_visits(spark, sf_dir)), _target(spark), F.col("business_day")
    late = (F.dayofmonth(day) % 3 == 0) & (F.col("store_id") == "S1")
    first, second = F.lit(RETURNS.period_1.end), F.lit(RETURNS.period_2.start) + 7
    slots = 8  # the state of the given tables is small
    returns.start_state(path, rows.filter((day <= first) & ~late), slots=slots)
    returns.update_state(path, rows.filter((day > first) & (day <= second) & ~late), slots=slots)
    state = returns.update_state(path, rows.filter((day > second) | late), slots=slots)
    members = stores.group_members(views.group_map(spark), "ALL").select("store_id")
    pairs = returns.state_pairs(state.join(members, "store_id"), RETURNS)
    return visits.visit_return_rate(pairs, RETURNS).drop("start_visit_number")


QUERIES: dict[str, Query] = {
    "snapshot_roundtrip": snapshot_roundtrip,
    "snapshot_dimensions": snapshot_dimensions,
    "snapshot_incremental": snapshot_incremental,
    "snapshot_changes": snapshot_changes,
    "split_snapshot": split_snapshot,
    "split_balance": split_balance,
    "attach_store": attach_store,
    "valid_sales": valid_sales,
    "valid_sales_channel": valid_sales_channel,
    "check_hash": check_hash,
    "local_time": local_time,
    "business_date_cutoff": business_date_cutoff,
    "parse_dayparts": parse_dayparts,
    "daypart_names": daypart_names,
    "assign_daypart_inner": assign_daypart_inner,
    "assign_daypart_left": assign_daypart_left,
    "minute_daypart_inner": minute_daypart_inner,
    "minute_daypart_left": minute_daypart_left,
    "daypart_business_date": daypart_business_date,
    "customer_type": customer_type,
    "money_double": money_double,
    "normalize_transactions": normalize_transactions,
    "publish_normalized": publish_normalized,
    "publish_clustered": publish_clustered,
    "clustered_lookups": clustered_lookups,
    "normalize_landed": normalize_landed,
    "normalize_transactions_grouped": normalize_transactions_grouped,
    "based_transactions": based_transactions,
    "store_day_activity": store_day_activity,
    "active_store_days": active_store_days,
    "comparison_group": comparison_group,
    "store_count_summary": store_count_summary,
    "comparison_store_count": comparison_store_count,
    "calendar_spine": calendar_spine,
    "maturity_rule": maturity_rule,
    "monthly_continuity": monthly_continuity,
    "saturday_coverage": saturday_coverage,
    "non_saturday_coverage": non_saturday_coverage,
    "fixed_cohort": fixed_cohort,
    "cohort_summary": cohort_summary,
    "yoy_spine": yoy_spine,
    "cohort_current_totals": _totals("current"),
    "cohort_prior_totals": _totals("prior"),
    "annual_cohort_yoy": annual_cohort_yoy,
    "annual_cohort_yoy_stored": annual_cohort_yoy_stored,
    "annual_cohort_yoy_pivot": annual_cohort_yoy_pivot,
    "bitmap_customers": bitmap_customers,
    "sketch_quantiles": sketch_quantiles,
    "period_over_period": period_over_period,
    "publish_trial_yoy": publish_trial_yoy,
    "republished_yoy": republished_yoy,
    "yoy_rollup_date": _readout("sale_by_date"),
    "yoy_rollup_store": _readout("visit_by_store"),
    "yoy_rollup_type": _readout("visit_by_type"),
    "unpack_yoy_changes": unpack_yoy_changes,
    "publish_raw_changes": publish_raw_changes,
    "contribution_weekday": _contribution("weekday_name"),
    "contribution_daypart": _contribution("daypart"),
    "contribution_in_order": contribution_in_order,
    "published_in_order": published_in_order,
    "pivot_daily_visit": _pivot("daily_visit"),
    "pivot_daily_sale": _pivot("daily_sale"),
    "pivot_weekly_sale": _pivot("weekly_sale"),
    "pivot_weekly_visit": _pivot("weekly_visit"),
    "explode_items": explode_items,
    "target_orders_name": target_orders_name,
    "target_orders_priced": target_orders_priced,
    "item_share_per_customer": item_share_per_customer,
    "share_histogram": share_histogram,
    "prior_buyer_rollcall": prior_buyer_rollcall,
    "funnel_pre_buyers": _funnel("pre_buyers"),
    "funnel_returners": _funnel("returners"),
    "funnel_new_buyers": _funnel("new_buyers"),
    "adopters": _adoption("adopters"),
    "lookback_customers": _adoption("lookback_customers"),
    "lookback_transactions": _adoption("lookback_transactions"),
    "basket_compositions": _adoption("compositions"),
    "composition_counts": _adoption("composition_counts"),
    "composition_top10": _adoption("top_compositions"),
    "heavy_compositions": heavy_compositions,
    "parsed_items": parsed_items,
    "parsed_rollcall": parsed_rollcall,
    "parsed_history": parsed_history,
    "target_customer_history": target_customer_history,
    "target_customer_history_display": target_customer_history_display,
    "history_in_order": history_in_order,
    "colocated_rollcall": colocated_rollcall,
    "colocated_history": colocated_history,
    "colocated_visit_rank": colocated_visit_rank,
    "target_item_details": target_item_details,
    "visit_rank": visit_rank,
    "visit_return_rate": visit_return_rate,
    "visit_return_rate_weekend": visit_return_rate_weekend,
    "incremental_return_rate": incremental_return_rate,
}
