"""Facts stored by customer and store, so that customer questions read them without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.sources.tables import materialize

VISITOR = ("account_id", "store_id")


@dataclass(frozen=True)
class ColocatedFact:
    """A fact in two disjoint parts.

    ``light`` is a table in buckets of its keys: joins, aggregations and windows on them need no
    exchange. ``heavy`` has the rows of the few keys that would overfill a bucket (a shared account,
    rows without an account); it is an ordinary table whose tasks share a key.
    """

    light: DataFrame
    heavy: DataFrame
    keys: tuple[str, ...]
    buckets: int


def heavy_keys(fact: DataFrame, parts: int, keys: Sequence[str] = VISITOR) -> DataFrame:
    """The keys with more rows than an average one of ``parts`` parts; there are fewer of them than parts.

    Counts are taken in each task first. The list is landed, so joins to it know how short it is.
    """
    average = max(fact.count() / parts, 1.0)
    sizes = fact.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return materialize(sizes.filter(F.col("_rows") > average).select(*keys))


def split_heavy(fact: DataFrame, heavy: DataFrame, keys: Sequence[str] = VISITOR) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and those of the ``heavy`` ones; null is a key like any other."""
    same = _same_keys(fact, heavy, keys)
    return fact.join(heavy, same, "left_anti"), fact.join(heavy, same, "left_semi")


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list:
    return [left[key].eqNullSafe(right[key]) for key in keys]


def bucket_fact(
    fact: DataFrame, path: str, buckets: int, keys: Sequence[str] = VISITOR, sort_by: Sequence[str] = ()
) -> ColocatedFact:
    """Write ``fact`` under ``path`` in ``buckets`` buckets of ``keys``, sorted by them and ``sort_by``.

    One task writes one bucket, so choose ``buckets`` for files of a few hundred megabytes. A key with
    more rows than an average bucket is heavy; there are fewer of them than buckets, so their list is
    small whatever the data. Null is a key like any other. The fact is shuffled once, the heavy rows by
    range and the others by key; it is read four times, so pass a landed table where it is dear.
    """
    spark, keys = fact.sparkSession, tuple(keys)
    light, heavy = split_heavy(fact, heavy_keys(fact, buckets, keys), keys)
    name = f"tillwise_{uuid.uuid4().hex}"
    writer = light.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", f"{path}/light")
    writer.bucketBy(buckets, *keys).sortBy(*keys, *sort_by).saveAsTable(name)
    order = [*keys, *sort_by]
    heavy.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/heavy")
    return ColocatedFact(
        spark.table(name), spark.read.schema(fact.schema).parquet(f"{path}/heavy"), keys, buckets
    )


def open_fact(
    spark: SparkSession, path: str, buckets: int, keys: Sequence[str] = VISITOR, sort_by: Sequence[str] = ()
) -> ColocatedFact:
    """A fact written by ``bucket_fact`` with the same arguments, in another session."""
    schema = spark.read.parquet(f"{path}/light").schema
    name = f"tillwise_{uuid.uuid4().hex}"
    listed = ", ".join(f"`{key}`" for key in keys)
    ordered = ", ".join(f"`{key}`" for key in [*keys, *sort_by])
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
        f"CLUSTERED BY ({listed}) SORTED BY ({ordered}) INTO {int(buckets)} BUCKETS LOCATION '{path}/light'"
    )
    return ColocatedFact(spark.table(name), spark.read.schema(schema).parquet(f"{path}/heavy"), tuple(keys), buckets)
