"""Snapshots that rewrite only the dates whose rows changed.

Every date partition has a digest that does not depend on the order of its rows. A sync digests the
source, compares it with the digests of what is stored, rewrites the dates that differ and deletes those
that the source no longer has; all other files stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwise.functions.clock import utc_wall_time
from tillwise.sources.tables import materialize

MEASURES = ("row_count", "sum_1", "sum_2")


def row_digest(df: DataFrame, seed: int) -> Column:
    """64 bits of all values of a row. Nulls count, so (null, 1) and (1, null) differ."""
    parts = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.MapType, T.VariantType)):
            value = F.to_json(F.struct(value))
        parts += [value, value.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def date_digests(dated: DataFrame, date_column: str) -> DataFrame:
    """(date, row_count, sum_1, sum_2) per date: sums of two digests of the rows, in any order.

    Sums keep repeated rows apart, which an exclusive or would not. They are taken in each task first,
    so one row per date and task is shuffled.
    """
    sums = [F.sum(row_digest(dated, seed).cast("decimal(20,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    return dated.groupBy(date_column).agg(F.count("*").alias("row_count"), *sums)


def changed_dates(stored: DataFrame, new: DataFrame, date_column: str) -> DataFrame:
    """Dates of ``new`` digests that ``stored`` ones lack or have otherwise; null is a date too."""
    renamed = stored.select(F.col(date_column).alias("_date"), *[F.col(m).alias(f"_{m}") for m in MEASURES])
    same = [new[date_column].eqNullSafe(renamed["_date"])]
    same += [new[m].eqNullSafe(renamed[f"_{m}"]) for m in MEASURES]
    return new.join(renamed, same, "left_anti").select(date_column)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _partition_folder(date_column: str, value: str | None) -> str:
    return f"{date_column}={value or '__HIVE_DEFAULT_PARTITION__'}"


def sync_changed(
    source: DataFrame,
    target: str,
    timestamp_column: str | None = None,
    cluster_by: Iterable[str] = (),
    date_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bring the snapshot at ``target`` in line with ``source``; returns (the snapshot, its changes).

    Changes are one row per date written or, with ``gone``, deleted. The snapshot is partitioned by
    ``date_column``, a column of ``source`` such as a report's business date, or by the UTC date of
    ``timestamp_column`` (``<column>_date``); rows without one are a partition of their own. Only changed
    dates are written, dates that the source no longer has are deleted. An empty source empties the
    snapshot. Column names and types must stay the same.

    Digests are kept beside the table, in ``<target>_digests``. Dates about to be written lose their
    digest first and get that of the written files last, so an interrupted run is repaired by the next
    one, and a source that moves on while it is read is found to differ. The source is scanned once
    in whole and once for the changed dates; a report that is dear to compute should be landed first.
    The driver sees the list of vanished dates.
    """
    if (timestamp_column is None) == (date_column is None):
        raise ValueError("name either a timestamp or a date column")
    spark = source.sparkSession
    digests = f"{target}_digests"
    dated = source
    if date_column is None:
        date_column = f"{timestamp_column}_date"
        dated = source.withColumn(date_column, F.to_date(utc_wall_time(source, timestamp_column)))
    else:
        # partition columns come last when they are read back
        dated = source.select(*[F.col(f"`{c}`") for c in source.columns if c != date_column], date_column)
    new = materialize(date_digests(dated, date_column))
    has_target, has_digests = _exists(spark, target), _exists(spark, digests)
    stored = spark.read.schema(new.schema).parquet(digests) if has_digests else new.limit(0)
    there = spark.read.schema(dated.schema).parquet(target).select(date_column) if has_target else new.select(date_column).limit(0)
    there = there.distinct()
    # a digest without its files is as good as none
    stored = stored.join(there, stored[date_column].eqNullSafe(there[date_column]), "left_semi")
    present = materialize(changed_dates(stored, new, date_column))
    gone = materialize(there.join(new, there[date_column].eqNullSafe(new[date_column]), "left_anti"))
    kept = materialize(new.join(present, new[date_column].eqNullSafe(present[date_column]), "left_anti"))
    kept.write.mode("overwrite").parquet(digests)

    if present.count():
        touched = dated.join(present, dated[date_column].eqNullSafe(present[date_column]), "left_semi")
        laid_out = touched.hint("rebalance", date_column).sortWithinPartitions(date_column, *cluster_by)
        writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(date_column).parquet(target)
    as_text = F.coalesce(F.col(date_column).cast("string"), F.lit(""))
    for value in gone.agg(F.collect_list(as_text)).first()[0]:
        _delete(spark, f"{target}/{_partition_folder(date_column, value)}")

    snapshot = spark.read.schema(dated.schema).parquet(target) if _exists(spark, target) else dated.limit(0)
    written = snapshot.join(present, snapshot[date_column].eqNullSafe(present[date_column]), "left_semi")
    kept.unionByName(date_digests(written, date_column)).write.mode("overwrite").parquet(digests)
    changes = present.withColumn("gone", F.lit(False)).unionByName(gone.withColumn("gone", F.lit(True)))
    return snapshot, changes
