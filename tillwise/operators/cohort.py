"""Fixed store cohort: the calendar, the four qualification rules and the resulting stores.

Every rule is a conditional aggregate over store-days, the small table that the fact is
reduced to once. Expected months and dates follow from the rules' window alone, so a store is
compared with their number instead of being joined to a grid of store x expected date: a
missing month or date simply does not add to the count of satisfied ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.clock import SATURDAY, between_days, month_key, weekday_name
from tillwise.params import CohortRules


def calendar_spine(bounds: DataFrame) -> DataFrame:
    """Calendar of each (start_date, end_date) row: date, year, month and weekday."""
    days = bounds.select(F.explode(F.sequence("start_date", "end_date")).alias("business_day"))
    return days.withColumns(
        {
            "business_year": F.year("business_day"),
            "business_month": month_key(F.col("business_day")),
            "business_weekday": weekday_name(F.col("business_day")),
        }
    )


def _store_day_counts(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """Per store and day: the count, the running count of all history, the month's count.

    Both windows run over days, not transactions, so a store's partition is bounded by the
    calendar whatever its share of the fact.
    """
    in_window = between_days(F.col("business_day"), rules.window.start, rules.window.end)
    by_store = W.partitionBy("store_id").orderBy("business_day").rowsBetween(W.unboundedPreceding, 0)
    return (
        store_days.groupBy("store_id", "business_day")
        .agg(F.sum("txn_count").alias("txn_count"))
        .withColumn("running_count", F.sum("txn_count").over(by_store))
        .withColumn("in_window", in_window)
        .withColumn("month", month_key(F.col("business_day")))
        .withColumn(
            "month_count",
            F.sum(F.when(F.col("in_window"), F.col("txn_count"))).over(W.partitionBy("store_id", "month")),
        )
    )


def _maturity(rules: CohortRules) -> Column:
    matured = F.min(F.when(F.col("running_count") >= rules.maturity_rank, F.col("business_day")))
    return F.coalesce(matured <= F.lit(rules.maturity_cutoff), F.lit(False))


def _monthly_continuity(rules: CohortRules) -> Column:
    if rules.monthly_minimum <= 0:
        return F.first(F.lit(True))
    enough = F.col("in_window") & (F.col("month_count") >= rules.monthly_minimum)
    return F.count_distinct(F.when(enough, F.col("month"))) == len(rules.expected_months())


def _covered(rules: CohortRules, year: int, on_saturday: bool) -> Column:
    weekday = f"dayofweek(business_day) {'=' if on_saturday else '<>'} {SATURDAY}"
    conditions = ["in_window", f"year(business_day) = {year}", weekday, f"txn_count >= {rules.daily_minimum}"]
    excluded = rules.excluded_saturdays if on_saturday else rules.excluded_non_saturdays
    if excluded:
        conditions.append(f"business_day NOT IN ({', '.join(f'DATE {str(d)!r}' for d in excluded)})")
    return F.expr(f"count_if({' AND '.join(conditions)})")


def _all(conditions: list[Column]) -> Column:
    result = F.first(F.lit(True))
    for condition in conditions:
        result = result & condition
    return result


def _saturday_coverage(rules: CohortRules) -> Column:
    return _all(
        [
            _counted(rules, year, True, expected) >= rules.saturday_minimum[year]
            for year, expected in rules.expected_saturdays().items()
        ]
    )


def _non_saturday_coverage(rules: CohortRules) -> Column:
    return _all(
        [
            _counted(rules, year, False, expected) / F.lit(float(expected)) >= rules.non_saturday_rate
            for year, expected in rules.expected_non_saturdays().items()
        ]
    )


def _counted(rules: CohortRules, year: int, on_saturday: bool, expected: int) -> Column:
    """Covered dates of a year; a minimum of zero or less is met by every expected date."""
    return F.lit(expected).cast("bigint") if rules.daily_minimum <= 0 else _covered(rules, year, on_saturday)


_RULES = {
    "baseline_maturity_pass": _maturity,
    "monthly_continuity_pass": _monthly_continuity,
    "saturday_coverage_pass": _saturday_coverage,
    "non_saturday_coverage_pass": _non_saturday_coverage,
}


def _audit(store_days: DataFrame, rules: CohortRules, names) -> DataFrame:
    """The named rules per store that traded inside the window."""
    return (
        _store_day_counts(store_days, rules)
        .groupBy("store_id")
        .agg(F.bool_or("in_window").alias("_traded"), *[_RULES[name](rules).alias(name) for name in names])
        .filter("_traded")
        .drop("_traded")
    )


def maturity_rule(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """Pass: the n-th transaction of all history falls on or before the maturity cutoff."""
    return _audit(store_days, rules, ["baseline_maturity_pass"])


def monthly_continuity_rule(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """Pass: every month of the window has the minimum count; a missing month counts 0."""
    return _audit(store_days, rules, ["monthly_continuity_pass"])


def saturday_coverage_rule(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """Pass: each audited year has its minimum number of covered Saturdays."""
    return _audit(store_days, rules, ["saturday_coverage_pass"])


def non_saturday_coverage_rule(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """Pass: in every year the covered share of expected non-Saturdays reaches the rate."""
    return _audit(store_days, rules, ["non_saturday_coverage_pass"])


def cohort_audit(store_days: DataFrame, rules: CohortRules) -> DataFrame:
    """All four rules in one pass over the store-days: a single shuffle by store."""
    return _audit(store_days, rules, list(_RULES))


def eligible_stores(
    store_days: DataFrame, group_map: DataFrame, groups: DataFrame, rules: CohortRules
) -> DataFrame:
    """Stores trading in the window with each of their (wanted) groups."""
    members = group_map.select(
        F.col("storeId").alias("store_id"), F.col("storeGroupId").alias("store_group_id")
    )
    if rules.store_groups:
        members = members.filter(F.col("store_group_id").isin(*rules.store_groups))
    named = groups.select(F.col("storeGroupId").alias("store_group_id"), F.col("name").alias("group_name"))
    in_window = between_days(F.col("business_day"), rules.window.start, rules.window.end)
    return (
        store_days.filter(in_window)
        .select("store_id", "store_name")
        .distinct()
        .join(members, "store_id")
        .join(named, "store_group_id")
        .select("store_group_id", "group_name", "store_id", "store_name")
        .distinct()
    )


def fixed_cohort(
    store_days: DataFrame, group_map: DataFrame, groups: DataFrame, rules: CohortRules
) -> DataFrame:
    """Eligible stores that pass all four rules."""
    passed = cohort_audit(store_days, rules).filter(" and ".join(_RULES)).select("store_id")
    return eligible_stores(store_days, group_map, groups, rules).join(passed, "store_id", "left_semi").select(
        "store_group_id", "group_name", "store_id", "store_name"
    )


def cohort_summary(cohort: DataFrame, separator: str = ", ") -> DataFrame:
    """Number of stores and their distinct names, sorted, per group (bounded by the stores)."""
    return cohort.groupBy("store_group_id").agg(
        F.count_distinct("store_id").alias("fixed_store_count"),
        F.array_join(F.array_sort(F.collect_set("store_name")), separator).alias("fixed_store_names"),
    )
