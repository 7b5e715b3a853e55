from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillwise.sources import tables


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_snapshot_is_a_full_partitioned_copy(spark, tmp_path, kind):
    source = spark.range(1000).select(
        F.col("id"), (F.col("id") % 7).alias("bucket"),
        F.expr(f"CAST(timestamp_ntz'2024-01-01' + make_interval(0,0,0,CAST(id % 3 AS INT)) AS {kind})").alias("timestamp"),
    )
    calls = []

    def reader():
        calls.append(1)
        return source

    landed = tables.snapshot_table(reader, str(tmp_path / "t"), "timestamp", ("bucket",))
    assert calls == [1]
    assert landed.drop("timestamp_date").exceptAll(source).isEmpty()
    assert source.exceptAll(landed.drop("timestamp_date")).isEmpty()
    assert [r[0] for r in landed.select("timestamp_date").distinct().orderBy("timestamp_date").collect()] == [
        date(2024, 1, d) for d in (1, 2, 3)
    ]
    again = tables.snapshot_table(source.filter("id < 10"), str(tmp_path / "t"), "timestamp", ("bucket",))
    assert again.count() == 10


def test_rows_are_clustered_within_files(spark, tmp_path):
    source = spark.range(5000).select((F.hash("id") % 50).alias("bucket"), F.lit(datetime(2024, 1, 1)).alias("timestamp"))
    tables.snapshot_table(source, str(tmp_path / "t"), "timestamp", ("bucket",))
    for file in Path(tmp_path / "t").rglob("*.parquet"):
        values = pq.read_table(file, columns=["bucket"]).column("bucket").to_pylist()
        assert values == sorted(values)


def test_a_hot_date_is_split_over_tasks(spark, tmp_path):
    """A date holding most rows is written by several tasks, other dates by one."""
    source = spark.range(0, 400_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") % 10 == 0, F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 30).cast("int")))
        .otherwise(F.lit(date(2024, 2, 1))).alias("day"),
    )
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * 1024 * 1024))
        tables.write_table(source, str(tmp_path / "t"), "day", ("payload",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(tmp_path / "t").iterdir() if p.is_dir()}
    assert files["day=2024-02-01"] > 3
    assert all(n <= 2 for day, n in files.items() if day != "day=2024-02-01")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def test_empty_and_undated_rows_stay_readable(spark, tmp_path):
    frame = spark.createDataFrame([(1, None)], "id int, timestamp timestamp_ntz")
    landed = tables.snapshot_table(frame, str(tmp_path / "a"), "timestamp")
    assert [tuple(r) for r in landed.collect()] == [(1, None, None)]
    assert dict(landed.dtypes)["timestamp_date"] == "date"
    empty = tables.snapshot_table(frame.limit(0), str(tmp_path / "b"), "TimeStamp")
    assert empty.count() == 0 and "timestamp" in empty.columns


def test_sync_several_tables(spark, tmp_path):
    facts = spark.range(10).select("id", F.lit(datetime(2024, 1, 1)).alias("timestamp"))
    landed = tables.sync_tables(
        {"facts": facts, "dims": lambda: spark.range(3)}, str(tmp_path), {"facts": {"timestamp_column": "timestamp"}}
    )
    assert landed["facts"].count() == 10 and "timestamp_date" in landed["facts"].columns
    assert landed["dims"].count() == 3


def test_literal_table_has_a_known_size(spark):
    frame = tables.literal_table(spark, [("a", date(2024, 1, 1), ["x"]), (None, None, None)], "s string, d date, l array<string>")
    assert [tuple(r) for r in frame.collect()] == [("a", date(2024, 1, 1), ["x"]), (None, None, None)]
    assert tables.literal_table(spark, [], "s string, n bigint").count() == 0
    plan = spark.range(100).withColumn("s", F.col("id").cast("string")).join(frame, "s")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_materialize_uses_the_shared_folder(spark):
    frame = tables.materialize(spark.range(5).withColumn("v", F.lit(1)))
    assert frame.count() == 5
    assert frame.dtypes == [("id", "bigint"), ("v", "int")]
    root = spark.conf.get("spark.checkpoint.dir", None) or tables.scratch_root(spark)
    assert all(root in name for name in frame.inputFiles())


class _Stub:
    """A session that offers only what ``scratch_root`` looks at."""

    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}
        self.sparkContext = type("Context", (), {"applicationId": "app-1", "master": "local[2]", "getCheckpointDir": lambda: None})


def test_scratch_folder_choice():
    warehouse = {"spark__sql__warehouse__dir": "s3://warehouse"}
    assert tables.scratch_root(_Stub(spark__checkpoint__dir="s3://shared", **warehouse)) == "s3://shared/tillwise/app-1"
    assert tables.scratch_root(_Stub(**warehouse)) == "s3://warehouse/tillwise/app-1"


def test_full_write_drops_old_dates_under_dynamic_overwrite(spark, tmp_path):
    two = spark.range(2).select("id", F.expr("CAST(date_add(DATE'2024-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ)").alias("timestamp"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for rows, n in ((two, 2), (two.filter("id = 0"), 1)):
            assert tables.snapshot_table(rows, str(tmp_path / "t"), "timestamp").count() == n
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


@pytest.mark.parametrize("kind", ["double", "decimal(18,2)", "decimal(18,6)"])
def test_money_of_any_type_is_rounded_to_cents(spark, kind):
    from tillwise.functions.money import sum_dollars

    amounts = spark.sql("SELECT explode(array(0.29, 1.15, 2.675, CAST(NULL AS DECIMAL(9,3)))) AS v").select(F.col("v").cast(kind).alias("v"))
    assert str(amounts.agg(sum_dollars(F.col("v")).alias("s")).first().s) == "4.12"
