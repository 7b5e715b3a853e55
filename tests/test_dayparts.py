import json
from datetime import date, datetime

from tillwise.functions import labels
from tillwise.operators import dayparts, normalize, stores
from pyspark.sql import functions as F


def _document(name, order, start, duration):
    return json.dumps(
        {"n": name, "do": order, "st": {"h": start[0], "m": start[1]}, "d": {"hs": duration[0], "ms": duration[1]}}
    )


def _stores(spark, documents):
    return spark.createDataFrame(
        [("S1", "Store", "UTC", documents)], "storeId string, name string, timeZone string, dayParts array<string>"
    )


def _tx(spark, *times):
    rows = [("S1", "UTC", t) for t in times]
    frame = spark.createDataFrame(rows, "store_id string, time_zone string, timestamp timestamp_ntz")
    return stores.local_time_columns(frame)


LATE = _document("late-night", 5, (22, 30), (5, 30))
LUNCH = _document("LUNCH", 2, (11, 0), (3, 0))


def test_parse_drops_and_normalizes(spark):
    owners = _stores(
        spark,
        [LATE, LUNCH, _document("All Day", 9, (0, 0), (24, 0)), '{"do": 1}', "not json",
         '{"n": {"x": 1}, "do": 3}', '{"n": "Brunch", "do": "x", "st": {"h": "1.5", "m": 0}}'],
    )
    rows = {r.daypart_name: r for r in dayparts.parse_dayparts(owners, "storeId").collect()}
    assert set(rows) == {"Late Night", "Lunch", "Brunch"}
    assert (rows["Late Night"].start_minute_of_day, rows["Late Night"].duration_minute_total) == (1350, 330)
    assert rows["Brunch"].daypart_order is None and rows["Brunch"].start_hour is None


def test_null_dayparts_drop_the_store(spark):
    assert dayparts.parse_dayparts(_stores(spark, None), "storeId").count() == 0


def test_spellings(spark):
    names = ["Mid Day", "MIDDAY", "late night", "LateNight", "Snack", None]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in frame.select(labels.normalize_daypart_name(F.col("n"))).collect()]
    assert got == ["Midday", "Midday", "Late Night", "Late Night", "Snack", None]


def test_wrapping_and_uncovered(spark):
    parts = dayparts.parse_dayparts(_stores(spark, [LATE, LUNCH]), "storeId")
    tx = _tx(
        spark,
        datetime(2024, 5, 2, 22, 29), datetime(2024, 5, 2, 22, 30), datetime(2024, 5, 3, 0, 0),
        datetime(2024, 5, 3, 3, 59), datetime(2024, 5, 3, 4, 0), datetime(2024, 5, 3, 13, 59),
    )
    left = dayparts.daypart_business_date(dayparts.assign_daypart(tx, parts, how="left")).orderBy("timestamp").collect()
    assert [r.daypart_name for r in left] == [None, "Late Night", "Late Night", "Late Night", None, "Lunch"]
    assert [r.business_date.day for r in left] == [2, 2, 2, 2, 3, 3]
    assert left[2].business_weekday == "Thursday"
    assert (left[2].business_month_year, left[2].business_year) == ("05_2024", "2024")
    assert dayparts.assign_daypart(tx, parts).count() == 4


def test_ending_at_midnight_does_not_wrap(spark):
    parts = dayparts.parse_dayparts(_stores(spark, [_document("Dinner", 4, (20, 0), (4, 0))]), "storeId")
    tx = _tx(spark, datetime(2024, 5, 2, 23, 59), datetime(2024, 5, 3, 0, 0))
    rows = dayparts.daypart_business_date(dayparts.assign_daypart(tx, parts, how="left")).orderBy("timestamp").collect()
    assert [(r.daypart_name, r.business_date) for r in rows] == [
        ("Dinner", date(2024, 5, 2)), (None, date(2024, 5, 3))
    ]


def test_overlapping_dayparts_repeat_rows(spark):
    documents = [LUNCH, _document("Brunch", 1, (10, 0), (2, 0))]
    parts = dayparts.parse_dayparts(_stores(spark, documents), "storeId")
    assert dayparts.assign_daypart(_tx(spark, datetime(2024, 5, 2, 11, 30)), parts).count() == 2


def test_normalized_table_round_trip(spark, tmp_path):
    tx = spark.createDataFrame(
        [
            (datetime(2024, 6, 2, 1, 0), "a", "M", "T", "c1", "Purchase", 1234, True, '{"ls":[]}'),
            (datetime(2024, 6, 2, 12, 0), None, "M", "T", "c2", "Refund", -5, None, None),
            (datetime(2024, 6, 1, 0, 0), "a", "M", "T", "c3", "Purchase", 1, False, None),
            (datetime(2024, 6, 2, 1, 0), "a", "M", "other", "c4", "Purchase", 1, False, None),
        ],
        "timestamp timestamp_ntz, accountNumberId string, siteIdFrontend string, terminalId string, "
        "authCode string, type string, amount bigint, isNewAtStore boolean, check string",
    )
    merchants = spark.createDataFrame(
        [("M", "T", "S1", "In-store")], "merchantId string, terminalId string, storeId string, reportGroup string"
    )
    frame = normalize.normalize_transactions(tx, merchants, _stores(spark, [LATE, LUNCH]), datetime(2024, 6, 1))
    path = str(tmp_path / "normalized")
    published = normalize.publish_normalized(frame, path)
    rows = {r.auth_code: r for r in published.collect()}
    assert set(rows) == {"c1", "c2"}
    assert rows["c1"].business_date == date(2024, 6, 1)
    assert rows["c1"].customer_type == "New" and rows["c2"].customer_type == "Unknown"
    assert str(rows["c1"].sale_in_dollar) == "12.34" and str(rows["c2"].sale_in_dollar) == "-0.05"
    assert rows["c2"].check_hash is None and len(rows["c1"].check_hash) == 64
    assert len({r.transaction_composite_key for r in rows.values()}) == 2
    pruned = published.filter(F.col("business_date") == date(2024, 6, 1))
    assert "PartitionFilters: [isnotnull(business_date" in pruned._jdf.queryExecution().executedPlan().toString()
    fact = normalize.based_transactions(published)
    assert {"business_day", "store_id", "account_id"} <= set(fact.columns)
