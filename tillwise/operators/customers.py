"""Customer-level questions about target items: roll call, funnel, adoption, history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions import items as I
from tillwise.functions.clock import week_start
from tillwise.functions.money import cents, dollars
from tillwise.operators.baskets import flag_target
from tillwise.params import Period
from tillwise.sources.tables import materialize

# The semi-joins below match on customer, or customer and store, against a distinct list of
# buyers. The list is materialized first, so its true size is known when the join is planned:
# a list under the broadcast threshold leaves the transactions and their documents where they
# are, a longer one is joined by a shuffle whose skewed partitions adaptive execution splits.


def prior_buyer_rollcall(tx: DataFrame, test: I.ItemTest, items: Column | None = None) -> DataFrame:
    """Weekly customers, checks and sales of those who bought a target before their store's launch.

    Rows carry ``launch_date``. A buyer at a store is followed at that store, before and after
    its launch, in Monday-to-Sunday weeks.
    """
    return rollcall_report(rollcall_weeks(tx, materialize(prior_buyers(tx, test, items))))


def prior_buyers(tx: DataFrame, test: I.ItemTest, items: Column | None = None) -> DataFrame:
    """Customers and stores with a target item on a check before the store's launch."""
    return buyers(tx.filter(F.col("business_date") < F.col("launch_date")), test, items)


def buyers(tx: DataFrame, test: I.ItemTest, items: Column | None = None) -> DataFrame:
    """Customers and stores with a target item on a check."""
    return flag_target(tx, test, items=items).filter("has_target").select("account_id", "store_id").distinct()


def rollcall_weeks(tx: DataFrame, known: DataFrame) -> DataFrame:
    """Customers, checks and cents of ``known`` buyers per week."""
    # A check belongs to one customer (its key covers the account), so checks are summed before
    # customers and both distinct counts become plain counts.
    visit = ["week_start_date", "store_id", "account_id"]
    return (
        tx.join(known, ["account_id", "store_id"], "left_semi")
        .withColumn("week_start_date", week_start(F.col("business_date")))
        .groupBy(*visit, "check_hash")
        .agg(F.sum(cents(F.col("sale_in_dollar"))).alias("_cents"))
        .groupBy(*visit)
        .agg(F.count("check_hash").alias("_checks"), F.sum("_cents").alias("_cents"))
        .groupBy("week_start_date")
        .agg(F.count("*").alias("_buyers"), F.sum("_checks").alias("_checks"), F.sum("_cents").alias("_cents"))
    )


def rollcall_report(weeks: DataFrame) -> DataFrame:
    """Weekly sums of disjoint sets of customers, added up."""
    return (
        weeks.groupBy("week_start_date")
        .agg(
            F.sum("_buyers").alias("prior_buyer_count"),
            F.sum("_checks").alias("total_check_count"),
            dollars(F.sum("_cents")).alias("total_sale"),
        )
        .select(
            "week_start_date",
            F.date_add("week_start_date", 6).alias("week_end_date"),
            "prior_buyer_count", "total_check_count", "total_sale",
        )
    )


def conversion_funnel(
    tx: DataFrame, old_items: I.ItemTest, new_items: I.ItemTest, begin: date, end: date
) -> dict[str, DataFrame]:
    """Pre-launch buyers of old items -> returners to the same store -> buyers of a new item.

    Rows carry ``launch_date``. New items count at any of the test stores. The documents are read
    once: a row becomes two flags, rows are merged into checks and checks into the counts of a
    customer at a store, of which all three stages are sums. Nothing runs until a stage is read.
    """
    day = F.col("business_date")
    before = day < F.col("launch_date")
    flagged = flag_target(
        flag_target(tx.filter(day.between(F.lit(begin), F.lit(end))), old_items, "_old"), new_items, "_new"
    )
    counts = (
        flagged.filter(F.col("check_hash").isNotNull())
        .groupBy("account_id", "store_id", "check_hash", before.alias("_before"))
        .agg(F.bool_or("_old").alias("_old"), F.bool_or("_new").alias("_new"))
        .groupBy("account_id", "store_id")
        .agg(
            F.count_if(F.col("_before") & F.col("_old")).alias("_bought_old"),
            F.count_if(~F.col("_before")).alias("_came_back"),
            F.count_if(~F.col("_before") & F.col("_new")).alias("_bought_new"),
        )
    )
    known = F.col("_bought_old") > 0
    customers = counts.filter(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.coalesce(F.sum(F.when(known, F.col("_came_back"))), F.lit(0)).alias("_came_back"),
        F.sum("_bought_new").alias("_bought_new"),
    ).filter(F.col("_came_back") > 0)
    return {
        "pre_buyers": counts.filter(known).select(
            "account_id", "store_id", F.col("_bought_old").alias("visit_number")
        ),
        "returners": customers.select("account_id", F.col("_came_back").alias("visit_number")),
        "new_buyers": customers.filter(F.col("_bought_new") > 0).select(
            "account_id", F.col("_bought_new").alias("visit_number")
        ),
    }


def adoption_lookback(
    tx: DataFrame, new_item: I.ItemTest, launch: Period, lookback: Period
) -> dict[str, DataFrame]:
    """Customers who adopted a new item, those seen before, and their earlier transactions."""

    def within(period: Period):
        return F.col("business_date").between(F.lit(period.start), F.lit(period.end))

    adopters = materialize(
        flag_target(tx.filter(within(launch)), new_item)
        .filter("has_target")
        .select("account_id")
        .distinct()
    )
    earlier = tx.filter(within(lookback))
    # A lookback customer is an adopter with an earlier row, so both results share one join.
    transactions = earlier.join(adopters, "account_id", "left_semi")
    return {
        "adopters": adopters,
        "lookback_customers": transactions.select("account_id").distinct(),
        "lookback_transactions": transactions,
    }


# Display names of the history report.
HISTORY_DISPLAY_NAMES = {
    "store_name": "Store Name",
    "account_id": "accountNumberId",
    "customer_type": "isNewAtStore",
    "check_hash": "Check Number",
    "timestamp": "Timestamp",
    "local_time": "Local Timestamp",
    "sale_in_dollar": "Amount",
    "contains_target": "Check Contains Target Products Flag",
    "check_composition": "Check Composition",
    "check_details": "Check Details",
}


def target_customer_history(
    tx: DataFrame,
    test: I.ItemTest,
    with_target_details: bool = False,
    display_names: bool = False,
    items: Column | None = None,
) -> DataFrame:
    """Every check, at the same store, of customers who bought a target item there.

    The flag and the texts come from the row's own document, so the only join is the one that
    finds the customers.
    """
    return history_of(tx, materialize(buyers(tx, test, items)), test, with_target_details, display_names, items)


def history_of(
    tx: DataFrame,
    known: DataFrame,
    test: I.ItemTest,
    with_target_details: bool = False,
    display_names: bool = False,
    items: Column | None = None,
) -> DataFrame:
    """Every check of the ``known`` customers at the stores they are known for."""
    history = tx.join(known, ["account_id", "store_id"], "left_semi").withColumn(
        "_items", I.line_items() if items is None else items
    )
    columns = [
        "store_name", "account_id", "customer_type", "check_hash", "timestamp", "local_time",
        "sale_in_dollar",
        I.contains_item(F.col("_items"), test).alias("contains_target"),
        I.name_composition(F.col("_items")).alias("check_composition"),
        I.item_details(F.col("_items")).alias("check_details"),
    ]
    if with_target_details:
        columns.append(I.target_item_details(F.col("_items"), test).alias("target_item_details"))
    result = history.select(*columns)
    return result.withColumnsRenamed(HISTORY_DISPLAY_NAMES) if display_names else result


def history_order(display_names: bool = False) -> list[Column]:
    """Report order of the history: store, customer, time; rows of one moment by check."""
    names = ("store_name", "account_id", "timestamp", "check_hash")
    shown = [HISTORY_DISPLAY_NAMES[name] if display_names else name for name in names]
    return [F.col(f"`{name}`") for name in shown]


def target_item_details(tx: DataFrame, test: I.ItemTest, items: Column | None = None) -> DataFrame:
    """Readable list of the target items of each check that has one.

    Items are listed once per check, however many authorization rows carry it.
    """
    return (
        flag_target(tx, test, items=items)
        .filter("has_target")
        .select(
            "check_hash", "account_id", "store_id", "business_date",
            I.target_item_details(I.line_items() if items is None else items, test).alias("item_details"),
        )
        .distinct()
    )
