"""Cohort rules against a direct day-by-day evaluation."""

import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise.operators import activity, cohort, yoy
from tillwise.params import CohortRules, Period
from tillwise.plans.yoy_reports import annual_cohort_yoy, annual_cohort_yoy_pivot

WINDOW = Period(date(2022, 11, 1), date(2023, 2, 20))
RULES = CohortRules(
    window=WINDOW,
    maturity_cutoff=date(2022, 10, 20),
    maturity_rank=12,
    monthly_minimum=20,
    daily_minimum=2,
    saturday_minimum={2022: 3, 2023: 2},
    non_saturday_rate=0.4,
    report_years=(2023,),
    year_to_date=2023,
    excluded_saturdays=(date(2023, 1, 14),),
    excluded_non_saturdays=(date(2023, 1, 16), date(2022, 12, 26)),
    lag_days=28,
)
HISTORY = Period(date(2022, 10, 1), date(2023, 2, 20))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for number in range(14):
        store, mean = f"S{number}", 0.4 + 0.22 * number
        for day in HISTORY.days():
            if day < date(2022, 10, 1 + number):
                continue
            for _ in range(min(6, int(rng.expovariate(1 / mean)))):
                out.append((store, f"Store {number}", rng.choice(["a", "b", "c", "d", None]), day, Decimal(rng.randint(1, 5000)) / 100))
    out.append(("S99", "Early only", "a", date(2022, 10, 5), Decimal("1.00")))
    return out


@pytest.fixture(scope="module")
def fact(spark, rows):
    frame = spark.createDataFrame(
        [(s, n, a, d, "Online", v) for s, n, a, d, v in rows],
        "store_id string, store_name string, account_id string, business_day date, channel_group string, sale_in_dollar decimal(18,2)",
    )
    return frame.cache()


@pytest.fixture(scope="module")
def store_days(fact):
    return activity.store_day_activity(fact, ("store_id", "store_name")).cache()


@pytest.fixture(scope="module")
def dimensions(spark):
    links = [(f"S{i}", g) for i in range(14) for g in ("ALL", f"G{i % 3}")]
    members = spark.createDataFrame(links, "storeId string, storeGroupId string")
    groups = spark.createDataFrame([(g, f"Group {g}") for g in ("ALL", "G0", "G1", "G2")], "storeGroupId string, name string")
    return members, groups


def _verdicts(rows, rules):
    per_day = Counter((s, d) for s, _, _, d, _ in rows)
    verdicts = {}
    for store in {s for s, _, _, d, _ in rows if rules.window.start <= d <= rules.window.end}:
        history = sorted(d for s, _, _, d, _ in rows if s == store)
        mature = len(history) >= rules.maturity_rank and history[rules.maturity_rank - 1] <= rules.maturity_cutoff
        months, saturdays, others, expected = Counter(), Counter(), Counter(), Counter()
        for day in rules.window.days():
            n = per_day[store, day]
            months[day.strftime("%Y-%m")] += n
            saturday = day.weekday() == 5
            if day in (rules.excluded_saturdays if saturday else rules.excluded_non_saturdays):
                continue
            if saturday:
                saturdays[day.year] += n >= rules.daily_minimum
            else:
                expected[day.year] += 1
                others[day.year] += n >= rules.daily_minimum
        verdicts[store] = (
            mature,
            all(v >= rules.monthly_minimum for v in months.values()),
            all(saturdays[y] >= m for y, m in rules.saturday_minimum.items()),
            all(others[y] / expected[y] >= rules.non_saturday_rate for y in expected),
        )
    return verdicts


VARIANTS = [
    RULES,
    replace(RULES, monthly_minimum=0, daily_minimum=0),
    replace(RULES, saturday_minimum={2022: 6}, non_saturday_rate=0.7, daily_minimum=1),
    replace(RULES, maturity_rank=1, monthly_minimum=45, excluded_saturdays=(), excluded_non_saturdays=()),
]


@pytest.mark.parametrize("rules", VARIANTS)
def test_rules_match_direct_evaluation(store_days, rows, rules):
    got = {r.store_id: tuple(r)[1:] for r in cohort.cohort_audit(store_days, rules).collect()}
    assert got == _verdicts(rows, rules)


def test_variants_decide_both_ways(rows):
    verdicts = _verdicts(rows, RULES).values()
    for rule in range(4):
        assert {v[rule] for v in verdicts} == {True, False}
    assert any(all(v) for v in verdicts)


def test_single_rules_equal_the_combined_audit(store_days):
    combined = {r.store_id: r for r in cohort.cohort_audit(store_days, RULES).collect()}
    for rule in (
        cohort.maturity_rule, cohort.monthly_continuity_rule,
        cohort.saturday_coverage_rule, cohort.non_saturday_coverage_rule,
    ):
        single = rule(store_days, RULES)
        name = single.columns[1]
        assert {r.store_id: r[name] for r in single.collect()} == {s: r[name] for s, r in combined.items()}


def test_cohort_and_group_filter(store_days, dimensions, rows):
    passing = {s for s, v in _verdicts(rows, RULES).items() if all(v)}
    everyone = cohort.fixed_cohort(store_days, *dimensions, RULES).collect()
    assert {r.store_id for r in everyone} == passing
    assert len(everyone) == 2 * len(passing)
    one = cohort.fixed_cohort(store_days, *dimensions, replace(RULES, store_groups=("ALL",))).collect()
    assert {(r.store_group_id, r.store_id) for r in one} == {("ALL", s) for s in passing}
    summary = {r.store_group_id: r for r in cohort.cohort_summary(cohort.fixed_cohort(store_days, *dimensions, RULES)).collect()}
    names = sorted({n for s, n, *_ in rows if s in passing})
    assert summary["ALL"].fixed_store_count == len(passing)
    assert summary["ALL"].fixed_store_names == ", ".join(names)


def test_annual_report_matches_direct_evaluation(fact, dimensions, rows):
    passing = {s for s, v in _verdicts(rows, RULES).items() if all(v)}
    report = annual_cohort_yoy(fact, *dimensions, RULES).filter("store_group_id = 'ALL'").collect()
    assert {r.weekday_group for r in report} == {"Saturday", "Non-Saturday"}
    for r in report:
        assert (r.year, r.output_period_type) == (2023, "YTD")
        saturday = r.weekday_group == "Saturday"
        excluded = RULES.excluded_saturdays if saturday else RULES.excluded_non_saturdays
        days = [
            d for d in WINDOW.days()
            if d.year == 2023 and (d.weekday() == 5) == saturday and d not in excluded
        ]
        for side, wanted in (("current", set(days)), ("prior", {d - timedelta(days=28) for d in days})):
            mine = [x for x in rows if x[0] in passing and x[3] in wanted]
            assert r[f"{side}_sales"] == sum((x[4] for x in mine), Decimal(0))
            assert r[f"{side}_transaction_count"] == len(mine)
            assert r[f"{side}_customers"] == len({x[2] for x in mine} - {None})
            expected_dates = len(wanted) if side == "current" else len({x[3] for x in mine})
            assert r[f"{side}_business_date_count"] == expected_dates
        assert r.sales_yoy_pct == pytest.approx(float(r.current_sales) / float(r.prior_sales) - 1, abs=5.1e-5)


def test_empty_fact_side_gives_zero_rows(spark, fact, dimensions, store_days):
    """Spine rows without a transaction stay, with zeros and undefined ratios."""
    members = cohort.fixed_cohort(store_days, *dimensions, RULES)
    totals = yoy.cohort_period_totals(fact.limit(0), members, RULES, store_days.limit(0))
    row = totals.first()
    assert (row.current_sales, row.current_customers, row.current_transaction_count) == (0, 0, 0)
    assert row.current_business_date_count > 0 and row.prior_business_date_count == 0
    metrics = yoy.yoy_metrics(totals, cohort.cohort_summary(members)).first()
    assert metrics.sales_yoy_pct is None and metrics.current_average_check is None


def test_nameless_groups_keep_their_totals(spark, fact, dimensions):
    members, groups = dimensions
    nameless = groups.withColumn("name", F.lit(None).cast("string"))
    named = annual_cohort_yoy(fact, members, groups, RULES).drop("group_name")
    assert annual_cohort_yoy(fact, members, nameless, RULES).drop("group_name").exceptAll(named).isEmpty()


def test_pivot_keeps_both_weekday_groups(fact, dimensions):
    row = annual_cohort_yoy_pivot(fact, *dimensions, RULES).filter("store_group_id = 'ALL'").collect()
    assert len(row) == 1
    assert row[0].saturday_current_sales > 0 and row[0].non_saturday_current_sales > 0


def test_exclusions_apply_to_the_current_side_only(spark):
    rules = replace(RULES, excluded_saturdays=(date(2023, 1, 14),), excluded_non_saturdays=())
    groups = spark.createDataFrame([("ALL", "Group ALL")], "store_group_id string, group_name string")
    spine = yoy.yoy_date_spine(groups, rules).collect()
    assert date(2023, 1, 14) not in {r.current_business_day for r in spine}
    assert date(2023, 1, 14) in {r.prior_business_day for r in spine}
    assert len(spine) == 31 + 20 - 1
