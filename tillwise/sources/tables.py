"""Snapshot sync, clustered table writes, literal tables and materialized intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillwise.functions.clock import utc_wall_time
from tillwise.sources.curve import write_clustered

Source = DataFrame | Callable[[], DataFrame]


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Iterable[str] = ()
) -> DataFrame:
    """Overwrite ``path`` with Parquet, optionally partitioned by a date and clustered; read it back.

    The rebalance hint groups rows by date so that a date does not scatter over all tasks,
    and lets adaptive execution cut a date that holds a large share of the rows into several
    even tasks. Sorting inside each task gives the cluster columns narrow min/max ranges, so
    later filters on them skip row groups.
    """
    cluster = list(cluster_by)
    if partition_by is not None:
        laid_out = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *cluster)
        # A full write replaces all dates, whatever overwrite mode the session has.
        writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(partition_by).parquet(path)
    else:
        laid_out = df.sortWithinPartitions(*cluster) if cluster else df
        laid_out.write.mode("overwrite").parquet(path)
    # The known schema spares the inference, and an empty table stays readable.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_report(
    report: DataFrame, path: str, partition_by: str | None = None, cluster_by: Iterable[str] = ()
) -> DataFrame:
    """Write a finished report and return the written table, from which its readouts start.

    Several readouts then scan the small table instead of computing the report once each.
    """
    return write_table(report, path, partition_by, cluster_by)


def snapshot_table(
    source: Source,
    target: str,
    timestamp_column: str | None = None,
    cluster_by: Iterable[str] = (),
    curve: bool = False,
) -> DataFrame:
    """Full copy of a source table; returns the landed copy.

    ``source`` is any DataFrame, or a function producing one (a JDBC reader with
    ``partitionColumn`` reads in parallel). With ``timestamp_column`` the copy is partitioned
    by the UTC date of that column, stored as ``<column>_date``. With ``curve`` the cluster columns count
    alike, along a curve, and the source is read three times; otherwise rows are sorted by the first of
    them, then the next.
    """
    df = source() if callable(source) else source
    date_column = None
    if timestamp_column is not None:
        date_column = f"{timestamp_column}_date"
        df = df.withColumn(date_column, F.to_date(utc_wall_time(df, timestamp_column)))
    if curve:
        return write_clustered(df, target, list(cluster_by), date_column)
    return write_table(df, target, date_column, cluster_by)


def sync_tables(
    sources: Mapping[str, Source], root: str, layouts: Mapping[str, Mapping] | None = None
) -> dict[str, DataFrame]:
    """Snapshot several tables under ``root``; ``layouts`` gives per-table snapshot options."""
    layouts = layouts or {}
    return {
        name: snapshot_table(source, f"{root}/{name}", **layouts.get(name, {}))
        for name, source in sources.items()
    }


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Small table of constants.

    Built through Arrow it becomes a LocalRelation whose exact size the optimizer knows, so
    joins to it are broadcast on evidence rather than by a hint.
    """
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(struct)
    arrow_schema = to_arrow_schema(struct)
    arrays = [pa.array(list(values), type=f.type) for values, f in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=struct)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for this application's intermediates, under the session's ``spark.checkpoint.dir``.

    Where that is unset a single-machine session uses its warehouse folder; a cluster must set it, as
    no other folder is known to be shared by driver and executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/tillwise/{context.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the intermediates of this application, once its reports are written."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that several branches read, and read it back.

    The written table survives lost executors, runs the upstream work once, and gives the optimizer the
    true size for its choice between broadcast and shuffled joins. It takes as much room as its rows, so
    land narrow columns of a fact, or what is reduced from it.
    """
    return write_table(df, f"{scratch_root(df.sparkSession)}/{uuid.uuid4().hex}")
