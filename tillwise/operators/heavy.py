"""The most frequent keys, counted exactly without shuffling the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions import items as I
from tillwise.sources.tables import materialize

#: Counters of the summary, for each of two hash functions.
COUNTERS = 1 << 15


def _counter(key: str, row: int, counters: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), key), F.lit(counters)).cast("int").alias(f"_counter_{row}")


def _heavy_counters(summary: DataFrame, row: int, least: int) -> DataFrame:
    listed = summary.filter((F.col("row") == row) & (F.col("rows") >= least))
    return listed.select(F.col("counter").alias(f"_counter_{row}"))


def top_keys(
    rows: DataFrame, key: str, k: int, unit: str | None = None, counters: int = COUNTERS, name: str = "count"
) -> DataFrame:
    """(key, count) of the ``k`` most frequent values of ``key``, ties by key; null is no key.

    Counted are rows, or with ``unit`` its distinct non-null values. The result is exact:

    1. Every row adds to one of ``counters`` counters for each of two hash functions. A task hands on
       that many numbers at most. No key is more frequent than either of its counters says.
    2. The keys of the fullest counters are counted exactly. The k-th of them is a bound that the
       true k-th reaches.
    3. Every key that could reach that bound has both its counters at the bound or above. All such
       keys are counted exactly, so none is missed, ties included.

    On flat data all counters reach the bound and step 3 is the plain count. The driver sees one number.
    """
    counted = [F.col(unit)] if unit else []
    keyed = rows.filter(F.col(key).isNotNull()).select(key, *counted, *[_counter(key, r, counters) for r in (1, 2)])
    if unit:
        keyed = keyed.filter(F.col(unit).isNotNull())

    def count(part: DataFrame) -> DataFrame:
        # a value of the unit met again is dropped before it counts
        units = part.select(key, unit).distinct() if unit else part
        return units.groupBy(key).agg(F.count("*").alias(name))

    counters_of = F.array(*[F.struct(F.lit(r).alias("row"), F.col(f"_counter_{r}").alias("counter")) for r in (1, 2)])
    hits = keyed.select(F.explode(counters_of).alias("hit")).groupBy("hit.row", "hit.counter")
    summary = materialize(hits.agg(F.count("*").alias("rows")))
    fullest = summary.filter("row = 1").orderBy(F.col("rows").desc(), "counter").limit(2 * k)
    fullest = materialize(fullest.select(F.col("counter").alias("_counter_1")))
    first = count(keyed.join(fullest, "_counter_1", "left_semi")).orderBy(F.col(name).desc(), key).limit(k)
    found, lowest = first.agg(F.count("*"), F.min(name)).first()
    least = lowest if found == k else 0
    could = keyed
    for row in (1, 2):
        could = could.join(materialize(_heavy_counters(summary, row, least)), f"_counter_{row}", "left_semi")
    return count(could).orderBy(F.col(name).desc(), key).limit(k)


def top_compositions(
    tx: DataFrame, k: int = 10, items: Column | None = None, others: str = "Others", counters: int = COUNTERS
) -> DataFrame:
    """``baskets.top_k_plus_others`` of the compositions of ``tx``, without moving every composition.

    Compositions of the candidates alone are shuffled; of all other checks only the digest is, to count
    the rest.
    """
    composition = I.priced_composition(I.line_items() if items is None else items)
    checks = tx.select("check_hash", composition.alias("check_composition_id")).filter("check_composition_id IS NOT NULL")
    top = materialize(top_keys(checks, "check_composition_id", k, "check_hash", counters, "check_count"))
    total = checks.select(F.unhex("check_hash").alias("digest")).distinct().agg(F.count("digest").alias("check_count"))
    rest = total.unionByName(top.select((-F.col("check_count")).alias("check_count"))).agg(
        F.lit(others).alias("check_composition_id"), F.sum("check_count").alias("check_count")
    )
    return top.unionByName(rest.filter("check_count > 0")).orderBy(
        F.col("check_composition_id") == others, F.col("check_count").desc(), "check_composition_id"
    )
