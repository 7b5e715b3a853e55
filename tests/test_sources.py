"""Parallel splits of a source and documents parsed when landed."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise.functions import items as I
from tillwise.operators import baskets
from tillwise.sources.documents import land_documents, parse_documents
from tillwise.sources.splits import literal, read_splits, split_predicates
from tillwise.sources.tables import snapshot_table
from tillwise.workload import queries as Q


def depths(frame, predicates):
    row = frame.agg(*[F.count_if(F.coalesce(F.expr(p), F.lit(False))) for p in predicates]).first()
    return list(row)


def skewed(kind, seed=4):
    pick = random.Random(seed)
    shapes = {
        "even": lambda: pick.randrange(10_000),
        "hot": lambda: 7 if pick.random() < 0.4 else pick.randrange(10_000),
        "nulls": lambda: None if pick.random() < 0.5 else pick.randrange(50),
        "all null": lambda: None,
        "constant": lambda: 3,
        "two": lambda: pick.choice([1, 2]),
        "pareto": lambda: int(pick.paretovariate(0.5)) % 10**9,
        "mostly null": lambda: None if pick.random() < 0.97 else pick.randrange(5),
    }
    return [(i, shapes[kind]()) for i in range(6000)]


@pytest.mark.parametrize("kind", ["even", "hot", "nulls", "all null", "constant", "two", "pareto", "mostly null"])
@pytest.mark.parametrize("parts", [2, 9])
def test_splits_cover_every_row_once_and_are_at_most_twice_the_mean(spark, kind, parts):
    frame = spark.createDataFrame(skewed(kind), "id bigint, k bigint").repartition(3)
    predicates = split_predicates(frame, "k", parts, spread="id")
    sizes = depths(frame, predicates)
    assert sum(sizes) == 6000
    rows = read_splits(frame.filter, predicates)
    assert rows.count() == rows.distinct().count() == 6000
    assert max(sizes) <= 2 * 6000 / parts + 1, (sizes, predicates)
    assert len(predicates) <= 3 * parts + 2


def test_without_a_spread_a_heavy_value_is_one_split(spark):
    frame = spark.createDataFrame(skewed("hot"), "id bigint, k bigint")
    predicates = split_predicates(frame, "k", 8)
    assert predicates.count("k = 7") == 1
    assert sum(depths(frame, predicates)) == 6000


@pytest.mark.parametrize(
    ("kind", "zone"),
    [("date", "UTC"), ("timestamp", "UTC"), ("timestamp", "America/New_York"), ("timestamp_ntz", "America/New_York"), ("double", "UTC"), ("decimal(12,2)", "UTC")],
)
def test_kinds_of_keys(spark, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pick = random.Random(1)
        start = datetime(2024, 2, 1)
        make = {
            "date": lambda: date(2024, 1, 1) + timedelta(days=pick.randrange(90)),
            "timestamp": lambda: start + timedelta(seconds=pick.randrange(10**6)),
            "timestamp_ntz": lambda: start + timedelta(seconds=pick.randrange(10**6)),
            "double": lambda: pick.random(),
            "decimal(12,2)": lambda: Decimal(pick.randrange(10**6)) / 100,
        }[kind]
        hot = make()
        rows = [(i, hot if i % 3 == 0 else None if i % 7 == 0 else make()) for i in range(3000)]
        frame = spark.createDataFrame(rows, f"id bigint, k {kind}")
        sizes = depths(frame, split_predicates(frame, "k", 9, spread="id"))
        assert sum(sizes) == 3000 and max(sizes) <= 2 * 3000 / 9 + 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_and_unsuited_sources(spark):
    assert split_predicates(spark.createDataFrame([], "id bigint, k bigint"), "k", 5) == ["1 = 1"]
    assert split_predicates(spark.createDataFrame(skewed("hot"), "id bigint, k bigint"), "k", 1) == ["1 = 1"]
    with pytest.raises(TypeError):
        split_predicates(spark.createDataFrame([("x",)], "k string"), "k", 5)
    assert literal("it's") == "'it''s'" and literal(date(2024, 1, 2)) == "DATE '2024-01-02'"


def test_a_snapshot_from_splits(spark, tmp_path):
    frame = spark.createDataFrame(skewed("hot"), "id bigint, k bigint")
    predicates = split_predicates(frame, "k", 6, spread="id")
    landed = snapshot_table(lambda: read_splits(frame.filter, predicates), str(tmp_path / "t"))
    assert landed.distinct().count() == 6000


# --- parsed documents --------------------------------------------------------------------

DOCUMENTS = [
    None, "", "{", "not json", "[]", "{}", '{"ls":null}', '{"ls":[]}', '{"ls":{}}', '{"ls":[null]}', '{"ls":[{}]}',
    '{"ls":[{"p":"100","n":"item a","q":2,"pr":599}]}', '{"ls":[{"p":100,"n":true,"q":"2","pr":"5.5"}]}',
    '{"ls":[{"p":"a","q":2.5,"pr":0},{"p":"b","q":"x","pr":""}]}', '{"ls":[{"p":{"x":1},"n":["y"],"q":{},"pr":[]}]}',
    '{"ls":[{"p":"","n":"Ünï \\"q\\"","q":-1,"pr":1e2}],"k":[1,{"a":null}]}',
    '{"ls":[{"p":"[x","n":"{y","q":1,"pr":1}]}', '{"ls":[{"p":"a","n":null,"q":null,"pr":null}]}',
]


def test_items_of_the_parsed_form_are_those_of_the_text(spark):
    frame = spark.createDataFrame(list(enumerate(DOCUMENTS)), "i int, check string")
    text = {r["i"]: r["x"] for r in frame.select("i", I.line_items().alias("x")).collect()}
    parsed = {r["i"]: r["x"] for r in parse_documents(frame).select("i", I.parsed_line_items().alias("x")).collect()}
    for i, document in enumerate(DOCUMENTS):
        # an entry that is no object has no fields; the text form gives it as null
        expected = [tuple(x) if x else (None,) * 5 for x in text[i]] if text[i] is not None else None
        got = [tuple(x) for x in parsed[i]] if parsed[i] is not None else None
        assert got == expected, document


def test_a_repeated_key_makes_a_document_malformed(spark):
    frame = spark.createDataFrame([('{"ls":[{"p":"a","p":"b"}]}',)], "check string")
    assert parse_documents(frame).first()[0] is None


def test_documents_are_parsed_when_landed_and_never_again(spark, sf_dir, tmp_path):
    rows = Q._brand_checks(spark, sf_dir)
    writing = parse_documents(Q.materialize(rows))._jdf.queryExecution().executedPlan().toString()
    assert writing.count("try_parse_json") + writing.count("parseJson") + writing.count("parse_json") <= 2
    landed = land_documents(rows, str(tmp_path))
    test = I.matches_code_and_name(Q.TARGETS)
    frames = [
        baskets.flag_target(landed, test, items=I.parsed_line_items()),
        baskets.basket_composition(landed, I.parsed_line_items()),
        baskets.item_share_per_customer(landed, test, items=I.parsed_line_items()),
        baskets.target_orders(landed, test, ("check_hash",), I.parsed_line_items()),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parse_json" not in plan and "parseJson" not in plan
    text = baskets.basket_composition(rows)
    assert sorted(frames[1].collect()) == sorted(text.collect())
