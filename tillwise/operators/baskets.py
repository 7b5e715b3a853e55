"""Line items, baskets and each customer's share of checks with a target item.

Input rows carry ``account_id``, ``check_hash`` and the ``check`` document. Functions that take ``items``
read the items from that array instead, such as ``parsed_line_items()`` of a landed document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions import items as I
from tillwise.functions.money import ratio

HISTOGRAM_BINS = 10


def _items(items: Column | None) -> Column:
    return I.line_items() if items is None else items


def explode_items(tx: DataFrame, items: Column | None = None) -> DataFrame:
    """One row per line item; rows without a readable document drop out."""
    return tx.withColumn("item", F.explode(_items(items))).select(
        *tx.columns, "item.code", "item.name", "item.quantity", "item.whole_quantity", "item.price"
    )


def flag_target(
    tx: DataFrame, test: I.ItemTest, flag: str = "has_target", items: Column | None = None
) -> DataFrame:
    """Add whether the row's check holds a target item (within the row, no shuffle)."""
    return tx.withColumn(flag, I.contains_item(_items(items), test))


def target_orders(
    tx: DataFrame, test: I.ItemTest, keys: tuple[str, ...], items: Column | None = None
) -> DataFrame:
    """Distinct checks (by ``keys``) that hold a target item."""
    return flag_target(tx, test, items=items).filter("has_target").select(*keys).distinct()


def item_share_per_customer(
    tx: DataFrame, test: I.ItemTest, min_orders: int = 5, items: Column | None = None
) -> DataFrame:
    """Target buyers with their checks, target checks and the share of the two.

    Checks are made distinct first, keyed by customer and check, so the rows of a very busy
    customer spread over the cluster; the counts per customer are then combined map-side.
    Keeping customers with a target check stands for the join to the list of buyers.
    """
    checks = (
        flag_target(tx, test, items=items)
        .groupBy("account_id", "check_hash")
        .agg(F.bool_or("has_target").alias("has_target"))
    )
    counted = F.col("check_hash").isNotNull()
    return (
        checks.groupBy("account_id")
        .agg(
            F.count_if(counted).alias("total_order_count"),
            F.count_if(counted & F.col("has_target")).alias("target_order_count"),
        )
        .filter((F.col("target_order_count") > 0) & (F.col("total_order_count") >= min_orders))
        .withColumn("target_order_share", ratio(F.col("target_order_count"), F.col("total_order_count")))
    )


# The texts of the bins.
def _bin_label(number: int) -> str:
    low, high = (number - 1) * 10, number * 10
    return f"{low}% - <=100%" if number == HISTOGRAM_BINS else f"{low}% - <{high}%"


def _bin(share: Column, value) -> Column:
    """``value(bin number)`` of the bin holding ``share``; lower edges belong to their bin."""
    result = F.lit(value(1))
    for number in range(2, HISTOGRAM_BINS + 1):
        result = F.when(share >= (number - 1) / HISTOGRAM_BINS, F.lit(value(number))).otherwise(result)
    return result


def share_histogram(summary: DataFrame, store_group: str | None = None) -> DataFrame:
    """Customers and orders per tenth of the target share; empty bins are absent."""
    share = F.col("target_order_share")
    bins = (
        summary.groupBy(
            _bin(share, _bin_label).alias("share_bucket"), _bin(share, int).alias("bucket_sort")
        )
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("total_order_count").alias("total_order_count"),
            F.sum("target_order_count").alias("target_order_count"),
        )
        # At most ten rows here.
        .withColumn(
            "customer_percent_of_total",
            ratio(F.col("customer_count"), F.sum("customer_count").over(W.partitionBy())),
        )
        .withColumn(
            "bucket_order_share", ratio(F.col("target_order_count"), F.col("total_order_count"))
        )
    )
    if store_group is not None:
        bins = bins.select(F.lit(store_group).alias("store_group"), "*")
    return bins


def basket_composition(tx: DataFrame, items: Column | None = None) -> DataFrame:
    """One row per check: its distinct non-zero-priced codes, sorted and joined by '-'.

    The check key is a digest of the document, so rows sharing a key share the composition
    and de-duplication is all that is left to shuffle; no item rows are produced.
    """
    composition = I.priced_composition(_items(items))
    return (
        tx.select("check_hash", composition.alias("check_composition_id"))
        .filter(F.col("check_composition_id").isNotNull())
        .distinct()
    )


def composition_counts(compositions: DataFrame) -> DataFrame:
    """Checks per composition."""
    return compositions.groupBy("check_composition_id").agg(F.count("*").alias("check_count"))


def top_k_plus_others(
    counts: DataFrame,
    k: int = 10,
    key: str = "check_composition_id",
    count: str = "check_count",
    others: str = "Others",
) -> DataFrame:
    """The ``k`` most frequent keys (ties by key) and the sum of the rest.

    The top is found by a bounded sort per task rather than a global ranking in one task. The
    rest is the grand total less the top; both read the same shuffled counts.
    """
    top = counts.orderBy(F.col(count).desc(), key).limit(k)
    rest = F.lit(others)
    slices = top.select(
        F.explode(
            F.array(
                F.struct(F.col(key).alias(key), F.col(count).alias(count)),
                F.struct(rest.alias(key), (-F.col(count)).alias(count)),
            )
        ).alias("slice")
    ).select(f"slice.{key}", f"slice.{count}")
    total = counts.agg(F.sum(count).alias(count)).select(rest.alias(key), count)
    return (
        slices.unionByName(total)
        .groupBy(key)
        .agg(F.sum(count).alias(count))
        .filter(F.col(count) > 0)
        .orderBy(F.col(key) == others, F.col(count).desc(), key)
    )
