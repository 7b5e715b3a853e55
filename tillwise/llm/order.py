"""Neighbours in a total order over a whole table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import land


def next_key(keys: DataFrame) -> DataFrame:
    """(key, next) for the distinct values of ``key``: the next smaller one, the largest after the last.

    Keys are dealt by range and landed with the number of their range, so later passes agree on it.
    Within a range the next key is a window; the last key of a range takes the first of the next
    range from a table with one row per range. A single key is its own next.
    """
    dealt = land(
        keys.select("key").repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id())
    )
    firsts = dealt.groupBy("part").agg(F.max("key").alias("first"))
    after = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(Window.orderBy("part")), F.max("first").over(Window.partitionBy())
        ).alias("after"),
    )
    inner = dealt.withColumn("inner", F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("key"))))
    return inner.join(F.broadcast(after), "part").select("key", F.coalesce("inner", "after").alias("next"))
