"""Sketched quantiles, kept first visits, exact heavy hitters."""

import bisect
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwise.operators import heavy, quantiles, returns, visits
from tillwise.params import Period, ReturnRateParams
from tillwise.workload import queries as Q

DAY = date(2024, 1, 1)


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


# --- quantiles ---------------------------------------------------------------------------


def test_few_values_are_exact(spark):
    pick = random.Random(5)
    rows = [("S", DAY + timedelta(days=i % 9), pick.randrange(500)) for i in range(999)]
    frame = spark.createDataFrame([*rows, ("S", DAY, None)], "store_id string, business_day date, v int").repartition(4)
    days = quantiles.sketch_values(frame, ("store_id", "business_day"), "v")
    merged = quantiles.merge_sketches(days, ("store_id",))
    row = quantiles.read_quantiles(merged, {"median": 0.5, "low": 0.0, "high": 1.0}).first()
    ordered = sorted(r[2] for r in rows)
    assert (row["value_count"], row["median"], row["low"], row["high"]) == (999, ordered[499], ordered[0], ordered[-1])


def test_merged_quantiles_stay_within_the_rank_error(spark):
    size, n = 200, 200_000
    frame = spark.range(n).selectExpr("id % 50 AS day", "id % 4 AS store", "CAST(pow(pmod(xxhash64(id), 100003), 2) AS BIGINT) AS v")
    days = quantiles.sketch_values(frame, ("store", "day"), "v", size)
    wanted = {f"q{i}": i / 10 for i in range(1, 10)}
    for by in (["store"], []):
        twice = quantiles.merge_sketches(quantiles.merge_sketches(days, ["store"], size), by, size)
        for row in quantiles.read_quantiles(twice, wanted).collect():
            part = frame.filter(F.col("store") == row["store"]) if by else frame
            ordered = sorted(r["v"] for r in part.select("v").collect())
            assert row["value_count"] == len(ordered)
            for name, q in wanted.items():
                low, high = bisect.bisect_left(ordered, row[name]), bisect.bisect_right(ordered, row[name])
                off = max(0, low - q * len(ordered), q * len(ordered) - high) / len(ordered)
                assert off <= 2 * quantiles.rank_error(size), (by, name, off)


def test_equal_values_and_none(spark):
    frame = spark.range(10_000).selectExpr("'S' AS k", "7 AS v")
    row = quantiles.read_quantiles(quantiles.sketch_values(frame, ["k"], "v", 64), {"m": 0.5}).first()
    assert (row["value_count"], row["m"]) == (10_000, 7)
    nothing = quantiles.sketch_values(frame.withColumn("v", F.lit(None).cast("int")), ["k"], "v")
    assert quantiles.read_quantiles(quantiles.merge_sketches(nothing, ["k"]), {"m": 0.5}).collect() == []


# --- first visits ------------------------------------------------------------------------

SCHEMA = "transaction_composite_key bigint, account_id string, store_id string, local_time timestamp_ntz, business_day date"
PARAMS = ReturnRateParams(Period(date(2024, 1, 1), date(2024, 1, 10)), Period(date(2024, 1, 11), date(2024, 1, 20)))


def visit_rows(seed, n=900):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2024, 1, 1) + timedelta(hours=pick.randrange(24 * 20))
        account = "busy" if i % 3 == 0 else f"c{pick.randrange(25)}"
        rows.append((i, account, pick.choice(["A", "B"]), at, at.date()))
    return rows


def test_state_and_increments_equal_the_full_run(spark, tmp_path):
    rows, pick = visit_rows(1), random.Random(1)
    pick.shuffle(rows)  # deliveries are in no order of time, so most hold late rows
    deliveries = [rows[:300], rows[300:310], rows[310:700], rows[690:]]  # ten rows are delivered twice
    frame = lambda part: spark.createDataFrame(part, SCHEMA).repartition(3)
    path = str(tmp_path)
    returns.start_state(path, frame(deliveries[0]), slots=8)
    for part in deliveries[1:]:
        state = returns.update_state(path, frame(part), slots=8)
    full = visits.visit_pairs(frame(rows), PARAMS)
    assert same(returns.state_pairs(state, PARAMS).collect(), full.collect())
    assert state.groupBy(*visits.VISITOR).count().agg(F.max("count")).first()[0] <= returns.KEPT_VISITS
    again = returns.read_state(spark, path)
    assert again.count() == state.count()
    rates = visits.visit_return_rate(returns.state_pairs(state, PARAMS), PARAMS)
    assert same(rates.collect(), visits.visit_return_rate(full, PARAMS).collect())


def test_an_update_rewrites_the_parts_of_its_visitors_only(spark, tmp_path):
    path = str(tmp_path)
    returns.start_state(path, spark.createDataFrame(visit_rows(3), SCHEMA), slots=16)
    before = {f for f in tmp_path.rglob("*.parquet")}
    late = (5000, "c1", "A", datetime(2023, 12, 31, 5), date(2023, 12, 31))
    state = returns.update_state(path, spark.createDataFrame([late], SCHEMA), slots=16)
    after = {f for f in tmp_path.rglob("*.parquet")}
    assert len({f.parent for f in before ^ after}) == 1
    first = state.filter("account_id = 'c1' AND store_id = 'A'").orderBy("local_time").first()
    assert first["transaction_composite_key"] == 5000


def test_no_rows(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    returns.start_state(str(tmp_path), spark.createDataFrame(visit_rows(1, 30), SCHEMA), slots=4)
    assert returns.update_state(str(tmp_path), frame, slots=4).count() > 0
    assert returns.first_visits(frame).collect() == []


# --- heavy hitters -----------------------------------------------------------------------


def plain_top(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda c: (-c[1], c[0]))[:k]


CASES = {
    "skewed": [f"k{int(random.Random(i).paretovariate(0.6)) % 5000}" for i in range(6000)],
    "flat": [f"k{i % 2000:04d}" for i in range(4000)],
    "ties": [f"k{i % 40:02d}" for i in range(4000)] + ["once"],
    "one": ["x"] * 500,
    "nulls": [None] * 900 + ["a", "b", "a"],
    "all different": [f"k{i:05d}" for i in range(3000)],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("counters", [4, 4096])
def test_top_keys_are_exact(spark, case, counters):
    frame = spark.createDataFrame([(v,) for v in CASES[case]], "v string").repartition(3)
    got = [(r["v"], r["count"]) for r in heavy.top_keys(frame, "v", 10, counters=counters).collect()]
    assert got == plain_top(CASES[case], 10)


def test_units_count_once(spark):
    pick = random.Random(3)
    rows = [(f"k{min(int(pick.expovariate(0.3)), 30)}", pick.choice([None, *range(50)])) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "v string, u int").repartition(3)
    expected = plain_top([v for v, _ in {(v, u) for v, u in rows if u is not None}], 5)
    got = [(r["v"], r["n"]) for r in heavy.top_keys(frame, "v", 5, "u", 64, "n").collect()]
    assert got == expected


def test_the_recount_leaves_rare_keys_where_they_are(spark):
    rare = spark.range(50_000).selectExpr("concat('rare', id) AS v")
    often = spark.range(12_000).selectExpr("concat('often', id % 12) AS v")
    frame = Q.materialize(rare.unionByName(often))
    top = heavy.top_keys(frame, "v", 10)
    counted = top._jdf.queryExecution()
    assert len(top.collect()) == 10
    assert "LeftSemi" in counted.executedPlan().toString()
    keyed = frame.select(*[heavy._counter("v", r, heavy.COUNTERS) for r in (1, 2)])
    full = [keyed.groupBy(f"_counter_{r}").count().filter("count >= 1000").select(f"_counter_{r}") for r in (1, 2)]
    could = keyed.join(full[0], "_counter_1", "left_semi").join(full[1], "_counter_2", "left_semi").count()
    assert could <= 12_000 + 50


def test_top_compositions_equal_the_full_count(spark, sf_dir):
    row = lambda name: [tuple(r) for r in Q.QUERIES[name](spark, sf_dir).collect()]
    assert row("heavy_compositions") == row("composition_top10")
