"""Year-over-year comparison on calendar-aligned days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.clock import between_days, is_saturday
from tillwise.functions.money import cents, dollars, ratio, relative_change, sum_dollars
from tillwise.operators.distinct import distinct_customers
from tillwise.params import YEAR_LAG_DAYS, CohortRules, Period

SPINE_KEYS = ("store_group_id", "group_name", "year", "output_period_type", "weekday_group")


def _reported(day: Column, rules: CohortRules) -> Column:
    """A day of the report: in the window and a report year, and not an excluded day."""
    keep = between_days(day, rules.window.start, rules.window.end)
    keep = keep & F.year(day).isin(*rules.report_years)
    if rules.excluded_saturdays:
        keep = keep & ~(is_saturday(day) & day.isin(*rules.excluded_saturdays))
    if rules.excluded_non_saturdays:
        keep = keep & ~(~is_saturday(day) & day.isin(*rules.excluded_non_saturdays))
    return keep


# Labels of the report.
FULL_YEAR, YEAR_TO_DATE = "Full Year", "YTD"


def _labels(year: Column, saturday: Column, rules: CohortRules) -> dict[str, Column]:
    full_year = F.lit(FULL_YEAR)
    return {
        "year": year,
        "output_period_type": full_year
        if rules.year_to_date is None
        else F.when(year == rules.year_to_date, F.lit(YEAR_TO_DATE)).otherwise(full_year),
        "weekday_group": F.when(saturday, F.lit("Saturday")).otherwise(F.lit("Non-Saturday")),
    }


def _period_labels(day: Column, rules: CohortRules) -> dict[str, Column]:
    return _labels(F.year(day), is_saturday(day), rules)


def _bucket(day: Column, rules: CohortRules) -> Column:
    """Year and weekday group of a reported day as one number, NULL for other days."""
    return F.when(_reported(day, rules), F.year(day) * 2 + is_saturday(day).cast("int"))


def _bucket_labels(bucket: Column, rules: CohortRules) -> dict[str, Column]:
    """The label columns of a bucket number."""
    return _labels(F.floor(bucket / 2).cast("int"), bucket % 2 == 1, rules)


def yoy_date_spine(groups: DataFrame, rules: CohortRules) -> DataFrame:
    """Every reported day of each group, with the weekday-aligned day it is compared to.

    The calendar decides, not the data: exclusions apply to the current day only, and a prior
    day without activity never removes its current day.
    """
    day = F.col("current_business_day")
    first, last = F.lit(rules.window.start), F.lit(rules.window.end)
    return (
        groups.select("store_group_id", "group_name")
        .distinct()
        .withColumn("current_business_day", F.explode(F.sequence(first, last)))
        .filter(_reported(day, rules))
        .withColumn("prior_business_day", F.date_sub(day, rules.lag_days))
        .withColumns(_period_labels(day, rules))
    )


def cohort_period_totals(
    tx: DataFrame, cohort: DataFrame, rules: CohortRules, store_days: DataFrame
) -> DataFrame:
    """Date count, sales, distinct customers and transactions of both sides, side by side.

    A transaction counts as ``current`` on its own day and as ``prior`` for the day one lag
    later, so one scan of the fact serves both sides. The fact is reduced first, to one row per
    store, customer and pair of reported buckets; only then do rows fan out over sides and groups.
    Summing per customer spreads a group over its customers and makes the exact distinct counts
    of both sides plain counts of customer rows.

    ``current`` reports calendar dates, ``prior`` dates on which a cohort store had a sale;
    the latter come from ``store_days``. Spine rows without sales appear with zeros.
    """
    spine = yoy_date_spine(cohort, rules).groupBy(*SPINE_KEYS).agg(
        F.count("*").alias("current_business_date_count")
    )
    observed = (
        _side_rows(store_days, cohort, rules, {"prior": rules.lag_days})
        .groupBy(*SPINE_KEYS)
        .agg(F.count_distinct("business_day").alias("prior_business_date_count"))
    )
    sides = {"current": 0, "prior": rules.lag_days}
    per_customer, overall = [], []
    for side in sides:
        mine = F.col("side") == side
        n, total = F.col(f"{side}_n"), F.col(f"{side}_cents")
        per_customer += [F.sum(F.when(mine, F.col("n"))).alias(f"{side}_n"), F.sum(F.when(mine, F.col("cents"))).alias(f"{side}_cents")]
        overall += [
            dollars(F.sum(total)).alias(f"{side}_sales"),
            F.count_if((n > 0) & F.col("account_id").isNotNull()).alias(f"{side}_customers"),
            F.sum(n).alias(f"{side}_transaction_count"),
        ]
    day = F.col("business_day")
    buckets = {side: _bucket(F.date_add(day, lag), rules) for side, lag in sides.items()}
    reduced = (
        _reported_rows(tx, rules, sides)
        .join(cohort.select("store_id").distinct(), "store_id", "left_semi")
        .groupBy("store_id", "account_id", *[bucket.alias(side) for side, bucket in buckets.items()])
        .agg(F.count("*").alias("n"), F.sum(cents(F.col("sale_in_dollar"))).alias("cents"))
    )
    by_side = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("bucket")) for side in sides])
    totals = (
        reduced.select("store_id", "account_id", "n", "cents", F.explode(by_side).alias("s"))
        .select("store_id", "account_id", "n", "cents", "s.side", "s.bucket")
        .filter("bucket is not null")
        .join(cohort.select("store_group_id", "group_name", "store_id"), "store_id")
        .groupBy("store_group_id", "group_name", "bucket", "account_id")
        .agg(*per_customer)
        .groupBy("store_group_id", "group_name", "bucket")
        .agg(*overall)
        .withColumns(_bucket_labels(F.col("bucket"), rules))
        .drop("bucket")
    )
    # A handful of rows each; merging them by key is null-safe and needs no join.
    merged = spine.unionByName(observed, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True)
    measures = [name for name in merged.columns if name not in SPINE_KEYS]
    return merged.groupBy(*SPINE_KEYS).agg(*[F.max(name).alias(name) for name in measures]).na.fill(0, measures)


def stored_period_totals(
    store_days: DataFrame, bitmaps: DataFrame, cohort: DataFrame, rules: CohortRules
) -> DataFrame:
    """What ``cohort_period_totals`` gives, from stored store-days and customer bitmaps of store-days.

    The fact is not read: counts and sales add up over days, and the distinct customers of any set of
    stores and days are the bits of their bitmaps combined. A new day costs its own rows only.
    """
    sides = {"current": 0, "prior": rules.lag_days}
    spine = yoy_date_spine(cohort, rules).groupBy(*SPINE_KEYS).agg(
        F.count("*").alias("current_business_date_count")
    )
    side = F.col("side")
    sums = []
    for name in sides:
        sums += [
            dollars(F.sum(F.when(side == name, cents(F.col("sales_amount"))))).alias(f"{name}_sales"),
            F.sum(F.when(side == name, F.col("txn_count"))).alias(f"{name}_transaction_count"),
        ]
    prior_day = F.when(side == "prior", F.col("business_day"))
    days = _side_rows(store_days, cohort, rules, sides).groupBy(*SPINE_KEYS).agg(
        *sums, F.count_distinct(prior_day).alias("prior_business_date_count")
    )
    customers = distinct_customers(_side_rows(bitmaps, cohort, rules, sides), [*SPINE_KEYS, "side"])
    by_side = customers.groupBy(*SPINE_KEYS).agg(
        *[F.max(F.when(side == name, F.col("customers"))).alias(f"{name}_customers") for name in sides]
    )
    merged = spine.unionByName(days, allowMissingColumns=True).unionByName(by_side, allowMissingColumns=True)
    measures = [name for name in merged.columns if name not in SPINE_KEYS]
    return merged.groupBy(*SPINE_KEYS).agg(*[F.max(name).alias(name) for name in measures]).na.fill(0, measures)


def _reported_rows(rows: DataFrame, rules: CohortRules, sides: Mapping[str, int]) -> DataFrame:
    """Rows whose day can be reported on some side."""
    day = F.col("business_day")
    earliest = F.date_sub(F.lit(rules.window.start), max(sides.values()))
    return rows.filter((day >= earliest) & (day <= F.lit(rules.window.end)))


def _side_rows(
    rows: DataFrame, cohort: DataFrame, rules: CohortRules, sides: Mapping[str, int]
) -> DataFrame:
    """Rows of cohort stores, once per side (name -> lag) for which their day is reported."""
    day = F.col("business_day")
    anchors = F.array(
        *[F.struct(F.lit(side).alias("side"), F.date_add(day, lag).alias("anchor")) for side, lag in sides.items()]
    )
    members = cohort.select("store_group_id", "group_name", "store_id")
    anchor = F.col("a.anchor")
    return (
        _reported_rows(rows, rules, sides)
        .join(members, "store_id")
        .withColumn("a", F.explode(anchors))
        .filter(_reported(anchor, rules))
        .withColumn("side", F.col("a.side"))
        .withColumns(_period_labels(anchor, rules))
        .drop("a")
    )


def yoy_metrics(totals: DataFrame, summary: DataFrame) -> DataFrame:
    """Sales, transactions, customers, average checks and their relative changes.

    Money has two decimals; changes are ratios of unrounded values, rounded to four.
    """
    check = {s: ratio(F.col(f"{s}_sales"), F.col(f"{s}_transaction_count")) for s in ("current", "prior")}

    def change(name: str) -> Column:
        return F.round(ratio(F.col(f"current_{name}"), F.col(f"prior_{name}")) - 1, 4)

    return totals.join(summary, "store_group_id").select(
        "store_group_id", "group_name", "year", "output_period_type",
        "fixed_store_count", "fixed_store_names", "weekday_group",
        "current_business_date_count", "prior_business_date_count",
        "current_sales", "prior_sales",
        "current_transaction_count", "prior_transaction_count",
        "current_customers", "prior_customers",
        F.round(check["current"], 2).alias("current_average_check"),
        F.round(check["prior"], 2).alias("prior_average_check"),
        change("sales").alias("sales_yoy_pct"),
        change("transaction_count").alias("transaction_yoy_pct"),
        F.round(ratio(check["current"], check["prior"]) - 1, 4).alias("average_check_yoy_pct"),
        change("customers").alias("customer_yoy_pct"),
    )


def pivot_weekday_group(metrics: DataFrame) -> DataFrame:
    """Saturday and non-Saturday columns side by side, one row per group and year."""
    keys = ("store_group_id", "group_name", "year", "output_period_type", "fixed_store_count", "fixed_store_names")
    values = [c for c in metrics.columns if c not in keys and c != "weekday_group"]
    sides = {"saturday": "Saturday", "non_saturday": "Non-Saturday"}
    return metrics.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("weekday_group") == label, F.col(value))).alias(f"{prefix}_{value}")
            for prefix, label in sides.items()
            for value in values
        ]
    )


def daily_store_metrics(
    tx: DataFrame,
    keys: Sequence[str] = ("store_id", "store_name", "customer_type"),
    day: str = "business_date",
    check: str = "check_hash",
) -> DataFrame:
    """Daily sale and number of distinct checks per store and customer type."""
    return tx.groupBy(*keys, day).agg(
        sum_dollars(F.col("sale_in_dollar")).alias("sale"),
        F.count_distinct(check).alias("visit"),
    )


def period_over_period(
    daily: DataFrame,
    window: Period,
    keys: Sequence[str] = ("store_id", "store_name", "customer_type"),
    match_keys: Sequence[str] | None = None,
    day: str = "business_date",
    measures: Sequence[str] = ("sale", "visit"),
    lag_days: int = YEAR_LAG_DAYS,
) -> DataFrame:
    """Each day of the window next to the day ``lag_days`` earlier, with relative changes.

    Rows of ``daily`` are unique per keys and day. A row stands for its own day and as the
    prior of the day one lag later; grouping both roles by day pairs them up without a
    self-join, hence without computing ``daily`` twice. Days without a prior keep NULLs.
    ``match_keys`` must identify the remaining keys (a store id its name); NULL keys have no
    prior.
    """
    match = list(match_keys or keys)
    carried = [key for key in keys if key not in match]
    current, prior = F.col("age") == 0, F.col("age") == 1
    roles = F.array(
        F.struct(F.col(day).alias("_day"), F.lit(0).alias("age")),
        F.struct(F.date_add(F.col(day), lag_days).alias("_day"), F.lit(1).alias("age")),
    )
    matchable = F.lit(True)
    for key in match:
        matchable = matchable & F.col(key).isNotNull()
    paired = (
        daily.withColumn("_role", F.explode(roles))
        .select(*keys, *measures, "_role._day", "_role.age")
        .filter(between_days(F.col("_day"), window.start, window.end) & (current | matchable))
        .groupBy(*match, "_day")
        .agg(
            F.bool_or(current).alias("_has_current"),
            *[F.max(F.when(current, F.col(key))).alias(key) for key in carried],
            *[F.max(F.when(current, F.col(m))).alias(f"current_{m}") for m in measures],
            *[F.max(F.when(prior, F.col(m))).alias(f"prior_{m}") for m in measures],
        )
        .filter("_has_current")
    )
    columns: list[Column] = [F.col(key) for key in keys] + [F.col("_day").alias(day)]
    for m in measures:
        now, before = F.col(f"current_{m}"), F.col(f"prior_{m}")
        columns += [now, before, relative_change(now, before).alias(f"yoy_{m}_delta")]
    return paired.select(*columns, F.date_sub("_day", lag_days).alias(f"prior_{day}"))


def yoy_rollup(
    pairs: DataFrame, keys: Sequence[str], measure: str, filters: Mapping[str, object] | None = None
) -> DataFrame:
    """Current and prior sums of a measure by ``keys`` and the change of the sums.

    ``filters`` are equality conditions (one store, one customer type).
    """
    for column, value in (filters or {}).items():
        pairs = pairs.filter(F.col(column) == F.lit(value))
    current, prior = f"current_{measure}", f"prior_{measure}"
    return (
        pairs.groupBy(*keys)
        .agg(F.sum(current).alias(current), F.sum(prior).alias(prior))
        .withColumn("yoy_change", ratio(F.col(current), F.col(prior)) - 1)
    )
