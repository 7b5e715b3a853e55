"""Return rates kept up to date: a visitor's state is its first few visits.

The first visits of all rows are the first of (the first so far and the new rows). So a day's rows,
late ones included, meet the state of their visitors only, and the history is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tillwise.operators.visits import VISITOR, visit_pairs
from tillwise.params import ReturnRateParams
from tillwise.sources.tables import materialize

#: Start visits 1 to 9 need the visit after the last.
KEPT_VISITS = 10
#: Parts of a stored state; an update rewrites the parts of its visitors.
SLOTS = 256
ORDER = "local_time"
TIE = ("transaction_composite_key",)


def first_visits(
    visits: DataFrame, kept: int = KEPT_VISITS, order: str = ORDER, tie: Sequence[str] = TIE
) -> DataFrame:
    """The state: the first ``kept`` visits of each customer and store, by time and tie key.

    Rows with the same visitor, time and tie key are one visit, delivered again. Tasks keep the first
    few of each visitor before the shuffle, so a visitor with a large share of the rows is no hot task.
    """
    columns = list(dict.fromkeys([*VISITOR, "business_day", order, *tie]))
    rank = F.dense_rank().over(W.partitionBy(*VISITOR).orderBy(F.col(order), *[F.col(t) for t in tie]))
    ranked = visits.select(*columns).withColumn("_rank", rank).filter(F.col("_rank") <= kept)
    return ranked.drop("_rank").dropDuplicates([*VISITOR, order, *tie])


def merge_visits(
    state: DataFrame, fresh: DataFrame, kept: int = KEPT_VISITS, order: str = ORDER, tie: Sequence[str] = TIE
) -> DataFrame:
    """The state after ``fresh`` rows, which may lie before visits already known."""
    return first_visits(state.unionByName(fresh.select(*state.columns)), kept, order, tie)


def _with_slot(rows: DataFrame, slots: int) -> DataFrame:
    return rows.withColumn("slot", F.pmod(F.xxhash64(*VISITOR), F.lit(slots)).cast("int"))


def start_state(
    path: str, visits: DataFrame, kept: int = KEPT_VISITS, slots: int = SLOTS, order: str = ORDER, tie: Sequence[str] = TIE
) -> DataFrame:
    """Write the state of ``visits`` under ``path``, in ``slots`` parts by visitor; read it back."""
    state = _with_slot(first_visits(visits, kept, order, tie), slots)
    state.repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("slot").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The stored state."""
    return spark.read.parquet(path)


def update_state(
    path: str, fresh: DataFrame, kept: int = KEPT_VISITS, slots: int = SLOTS, order: str = ORDER, tie: Sequence[str] = TIE
) -> DataFrame:
    """Bring the state under ``path`` up to date with ``fresh`` rows; read it back.

    Only the parts of the visitors of ``fresh`` are read and written. The same rows may be delivered
    again, so an interrupted update is repeated as a whole. ``kept`` and ``slots`` must be those of the
    state's start.
    """
    schema = _with_slot(first_visits(fresh.limit(0), kept, order, tie), slots).schema
    stored = fresh.sparkSession.read.schema(schema).parquet(path)
    arrived = materialize(_with_slot(first_visits(fresh, kept, order, tie), slots))
    touched = stored.join(arrived.select("slot").distinct(), "slot", "left_semi").drop("slot")
    merged = materialize(_with_slot(merge_visits(touched, arrived, kept, order, tie), slots))
    writer = merged.repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("slot").parquet(path)
    return fresh.sparkSession.read.schema(schema).parquet(path)


def state_pairs(state: DataFrame, params: ReturnRateParams, order: str = ORDER, tie: Sequence[str] = TIE) -> DataFrame:
    """``visits.visit_pairs`` from the state, which must keep one visit more than the last start visit."""
    return visit_pairs(state, params, order, tie)
