from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillwise.functions import clock
from tillwise.operators import stores

CHICAGO = "America/Chicago"


def _local(spark, moments, zone=CHICAGO):
    rows = [(m,) for m in moments]
    frame = spark.createDataFrame(rows, "timestamp timestamp_ntz")
    return stores.business_date_cutoff(frame, zone).collect()


def test_business_day_starts_at_six(spark):
    before, after = _local(spark, [datetime(2025, 1, 1, 11, 59), datetime(2025, 1, 1, 12, 0)])
    assert before.local_time == datetime(2025, 1, 1, 5, 59)
    assert before.business_date == date(2024, 12, 31)
    assert after.business_date == date(2025, 1, 1)


@pytest.mark.parametrize(
    "utc, local",
    [
        (datetime(2024, 3, 10, 7, 59), datetime(2024, 3, 10, 1, 59)),
        (datetime(2024, 3, 10, 8, 0), datetime(2024, 3, 10, 3, 0)),
        (datetime(2024, 11, 3, 6, 30), datetime(2024, 11, 3, 1, 30)),
        (datetime(2024, 11, 3, 7, 30), datetime(2024, 11, 3, 1, 30)),
    ],
)
def test_daylight_saving(spark, utc, local):
    assert _local(spark, [utc])[0].local_time == local


def test_instants_do_not_depend_on_the_session_zone(spark):
    instant = datetime(2024, 7, 4, 3, 15, 30, 123456, tzinfo=timezone.utc)
    frame = spark.createDataFrame([(instant, "America/Denver")], "timestamp timestamp, time_zone string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        row = stores.local_time_columns(frame).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.timestamp == datetime(2024, 7, 4, 3, 15, 30, 123456)
    assert row.local_time == datetime(2024, 7, 3, 21, 15, 30, 123456)
    assert row.local_date == date(2024, 7, 3)
    assert row.local_weekday == "Wednesday"
    assert row.tx_minute_of_day == 21 * 60 + 15


def test_calendar_labels(spark):
    frame = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 8),)], "d date")
    saturday, monday = frame.select(
        clock.is_saturday(F.col("d")).alias("saturday"),
        clock.week_start(F.col("d")).alias("week"),
        clock.month_key(F.col("d")).alias("month"),
        F.dayofweek("d").alias("number"),
    ).collect()
    assert (saturday.saturday, saturday.number, saturday.week) == (True, 7, date(2024, 1, 1))
    assert (monday.saturday, monday.number, monday.week) == (False, 2, date(2024, 1, 8))
    assert monday.month == "2024-01"


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Pacific/Auckland", "America/Chicago"])
def test_utc_envelope_loses_nothing(spark, zone):
    """The coarse bound keeps every row whose exact business date is in range."""
    start, end = date(2024, 3, 9), date(2024, 3, 11)
    frame = spark.sql(
        "SELECT explode(sequence(timestamp_ntz'2024-03-05', timestamp_ntz'2024-03-16', interval 1 hour)) AS timestamp"
    )

    def exact(rows):
        dated = stores.business_date_cutoff(rows, zone)
        return dated.filter(clock.between_days(F.col("business_date"), start, end)).count()

    assert exact(clock.within_utc_envelope(frame, start, end)) == exact(frame) > 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_utc_range_reaches_scan_and_partitions(spark, tmp_path, kind):
    frame = spark.sql(
        f"SELECT CAST(t AS {kind}) AS timestamp FROM (SELECT explode(sequence("
        "timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-10', interval 6 hour)) AS t)"
    )
    frame.withColumn("timestamp_date", F.to_date("timestamp")).write.partitionBy("timestamp_date").parquet(str(tmp_path / "t"))
    landed = spark.read.parquet(str(tmp_path / "t"))
    picked = clock.within_utc_envelope(landed, date(2024, 1, 4), date(2024, 1, 4))
    assert picked.count() == 16
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp," in plan
    assert "PartitionFilters: [isnotnull(timestamp_date" in plan
