"""Local session for tests, benchmarks and examples. On a cluster, bring your own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillwise")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
