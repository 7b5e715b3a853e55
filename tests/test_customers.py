import json
import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tillwise.functions import items as I
from tillwise.operators import baskets, customers
from tillwise.params import Period

LAUNCH = {"S1": date(2024, 2, 1), "S2": date(2024, 2, 10)}
CODES = ["10", "20", "30", "40"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for n in range(600):
        store = rng.choice(["S1", "S2"])
        # Customer "hot" makes up a third of the rows.
        account = "hot" if n % 3 == 0 else rng.choice([f"c{i}" for i in range(25)] + [None])
        lines = [
            {"p": rng.choice(CODES), "n": "item", "q": rng.choice([0, 1, 2]), "pr": rng.choice([0, 199])}
            for _ in range(rng.randint(1, 4))
        ]
        day = date(2024, 1, 10) + timedelta(days=rng.randrange(50))
        out.append((f"h{n // 2 * 2 if rng.random() < 0.2 else n}", account, store, LAUNCH[store], day, Decimal(rng.randint(1, 999)) / 100, lines))
    # Rows sharing a check key share the check.
    seen = {}
    return [seen.setdefault(r[0], r) for r in out]


@pytest.fixture(scope="module")
def tx(spark, rows):
    return spark.createDataFrame(
        [(h, a, s, l, d, v, json.dumps({"ls": ls})) for h, a, s, l, d, v, ls in rows],
        "check_hash string, account_id string, store_id string, launch_date date, business_date date, "
        "sale_in_dollar decimal(18,2), check string",
    ).cache()


def _has(row, codes, paid=False):
    return any(i["p"] in codes and i["q"] > 0 and (not paid or i["pr"] > 0) for i in row[6])


def test_share_histogram_and_summary(tx, rows):
    test = I.matches_code_and_name([("10", "item")])
    known = [r for r in rows if r[1] is not None]
    total, target = Counter(), Counter()
    for h, account in {(r[0], r[1]) for r in known}:
        total[account] += 1
    for h, account in {(r[0], r[1]) for r in known if _has(r, ["10"])}:
        target[account] += 1
    wanted = {a: (total[a], n) for a, n in target.items() if total[a] >= 5}
    summary = baskets.item_share_per_customer(tx.filter("account_id IS NOT NULL"), test, 5)
    assert {r.account_id: (r.total_order_count, r.target_order_count) for r in summary.collect()} == wanted
    bins = baskets.share_histogram(summary, "all").orderBy("bucket_sort").collect()
    assert sum(b.customer_count for b in bins) == len(wanted)
    assert abs(sum(b.customer_percent_of_total for b in bins) - 1) < 1e-12
    expected = Counter(min(n * 10 // t, 9) + 1 for t, n in wanted.values())
    assert {b.bucket_sort: b.customer_count for b in bins} == expected


def test_bin_edges(spark):
    shares = [(0.0,), (0.1,), (0.0999,), (0.9,), (1.0,), (0.3,)]
    frame = spark.createDataFrame(shares, "target_order_share double").selectExpr(
        "*", "1L AS total_order_count", "1L AS target_order_count"
    )
    got = {r.share_bucket: r.customer_count for r in baskets.share_histogram(frame).collect()}
    assert got == {"0% - <10%": 2, "10% - <20%": 1, "30% - <40%": 1, "90% - <=100%": 2}


def test_rollcall(tx, rows):
    buyers = {(r[1], r[2]) for r in rows if r[4] < r[3] and r[1] and _has(r, ["10"])}
    weeks = {}
    for r in rows:
        if (r[1], r[2]) in buyers:
            monday = r[4] - timedelta(days=r[4].weekday())
            week = weeks.setdefault(monday, [set(), set(), Decimal(0)])
            week[0].add((r[2], r[1]))
            week[1].add((r[2], r[0]))
            week[2] += r[5]
    got = customers.prior_buyer_rollcall(tx, I.matches_code_and_name([("10", "item")])).collect()
    assert {r.week_start_date: (r.prior_buyer_count, r.total_check_count, r.total_sale) for r in got} == {
        w: (len(a), len(c), s) for w, (a, c, s) in weeks.items()
    }
    assert all((r.week_end_date - r.week_start_date).days == 6 for r in got)


def test_funnel(tx, rows):
    begin, end = date(2024, 1, 12), date(2024, 2, 25)
    pre, back, new = {}, {}, {}
    for r in rows:
        if begin <= r[4] < r[3] and _has(r, ["10", "20"], paid=True):
            pre.setdefault((r[1], r[2]), set()).add(r[0])
    for r in rows:
        if r[3] <= r[4] <= end and r[1] is not None and (r[1], r[2]) in pre:
            back.setdefault(r[1], set()).add(r[0])
    for r in rows:
        if r[3] <= r[4] <= end and r[1] in back and _has(r, ["30"], paid=True):
            new.setdefault(r[1], set()).add(r[0])
    got = customers.conversion_funnel(tx, I.matches_paid_code(["10", "20"]), I.matches_paid_code(["30"]), begin, end)
    assert {(r.account_id, r.store_id): r.visit_number for r in got["pre_buyers"].collect()} == {k: len(v) for k, v in pre.items()}
    assert {r.account_id: r.visit_number for r in got["returners"].collect()} == {k: len(v) for k, v in back.items()}
    assert {r.account_id: r.visit_number for r in got["new_buyers"].collect()} == {k: len(v) for k, v in new.items()}


def test_adoption_and_compositions(tx, rows):
    launch, lookback = Period(date(2024, 2, 10), date(2024, 2, 20)), Period(date(2024, 1, 10), date(2024, 2, 8))
    adopters = {r[1] for r in rows if launch.start <= r[4] <= launch.end and any(i["p"] == "40" for i in r[6])}
    earlier = [r for r in rows if lookback.start <= r[4] <= lookback.end and r[1] is not None and r[1] in adopters]
    got = customers.adoption_lookback(tx, I.matches_code("40"), launch, lookback)
    assert {r.account_id for r in got["adopters"].collect()} == adopters
    assert {r.account_id for r in got["lookback_customers"].collect()} == {r[1] for r in earlier}
    assert got["lookback_transactions"].count() == len(earlier)
    expected = {}
    for r in earlier:
        codes = sorted({i["p"] for i in r[6] if i["pr"] != 0})
        if codes:
            expected[r[0]] = "-".join(codes)
    compositions = baskets.basket_composition(got["lookback_transactions"])
    assert {r.check_hash: r.check_composition_id for r in compositions.collect()} == expected
    counts = baskets.composition_counts(compositions)
    tally = Counter(expected.values())
    assert {r.check_composition_id: r.check_count for r in counts.collect()} == tally
    slices = baskets.top_k_plus_others(counts, 3).collect()
    ranked = sorted(tally.items(), key=lambda kv: (-kv[1], kv[0]))
    assert [tuple(r) for r in slices[:3]] == ranked[:3]
    assert tuple(slices[3]) == ("Others", sum(n for _, n in ranked[3:]))
    assert sum(r.check_count for r in slices) == sum(tally.values())


@pytest.mark.parametrize(
    "counts, k, expected",
    [
        ({"a": 3, "b": 2}, 10, [("a", 3), ("b", 2)]),
        ({"a": 3, "Others": 9, "b": 2}, 1, [("Others", 14)]),
        ({"b": 2, "a": 2, "c": 2}, 2, [("a", 2), ("b", 2), ("Others", 2)]),
        ({}, 3, []),
    ],
)
def test_top_k_edges(spark, counts, k, expected):
    frame = spark.createDataFrame(list(counts.items()), "check_composition_id string, check_count bigint")
    assert [tuple(r) for r in baskets.top_k_plus_others(frame, k).collect()] == expected


def test_history(tx, rows):
    test = I.matches_code_and_name([("20", "item")])
    frame = tx.filter("account_id IS NOT NULL").selectExpr(
        "*", "'name' AS store_name", "'New' AS customer_type",
        "timestamp_ntz'2024-01-01' AS timestamp", "timestamp_ntz'2024-01-01' AS local_time",
    )
    known = [r for r in rows if r[1] is not None]
    buyers = {(r[1], r[2]) for r in known if _has(r, ["20"])}
    got = customers.target_customer_history(frame, test, with_target_details=True).collect()
    assert len(got) == sum((r[1], r[2]) in buyers for r in known)
    flags = {r[0]: _has(r, ["20"]) for r in known}
    for r in got:
        assert r.contains_target == flags[r.check_hash]
        assert (r.target_item_details is not None) == r.contains_target
    named = customers.target_customer_history(frame, test, display_names=True)
    assert named.columns[0] == "Store Name" and "Check Contains Target Products Flag" in named.columns
    details = customers.target_item_details(tx, test)
    assert details.count() == len({(r[0], r[1], r[2], r[4]) for r in rows if _has(r, ["20"])})
