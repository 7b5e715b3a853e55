"""Customer, basket and menu-test reports."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import items as I, labels
from tillwise.operators import baskets, customers, stores, visits
from tillwise.params import SALE_TYPES, Period, ReturnRateParams, StoreWindow
from tillwise.sources.tables import materialize


def return_rates(
    transactions: DataFrame,
    group_map: DataFrame,
    group_id: str,
    params: ReturnRateParams,
    store_id: str | None = None,
) -> DataFrame:
    """Visit-to-visit return rates of a store group in two periods."""
    members = stores.group_members(group_map, group_id)
    rows = visits.store_visits(transactions, members, store_id)
    rates = visits.visit_return_rate(visits.visit_pairs(rows, params), params)
    return rates.orderBy("start_visit_number").drop("start_visit_number")


def item_share_histogram(
    tx: DataFrame,
    merchant_map: DataFrame,
    group_map: DataFrame,
    group_id: str,
    targets: Iterable[tuple[str, str]],
    period: Period,
    time_zone: str,
    min_orders: int = 5,
) -> DataFrame:
    """Histogram of target buyers by the share of their checks that hold a target item."""
    rows = stores.cutoff_sales(
        tx, merchant_map, period, time_zone, group_map=group_map, group_id=group_id
    )
    summary = baskets.item_share_per_customer(rows, I.matches_code_and_name(targets), min_orders)
    return baskets.share_histogram(summary, group_id).orderBy("bucket_sort")


def menu_test_rollcall(
    tx: DataFrame,
    merchant_map: DataFrame,
    group_map: DataFrame,
    group_id: str,
    windows: Iterable[StoreWindow],
    targets: Iterable[tuple[str, str]],
    period: Period,
    time_zone: str,
) -> DataFrame:
    """Weekly roll call of the listed stores' buyers of a target item before the launch."""
    rows = stores.cutoff_sales(tx, merchant_map, period, time_zone, windows, group_map, group_id)
    report = customers.prior_buyer_rollcall(rows, I.matches_code_and_name(targets))
    return report.orderBy("week_start_date")


def _normalized_sales(normalized: DataFrame, period: Period) -> DataFrame:
    day = F.col("business_date")
    return normalized.filter(
        F.col("transaction_type").isin(*SALE_TYPES)
        & F.col("check").isNotNull()
        & day.between(F.lit(period.start), F.lit(period.end))
    )


def launch_conversion(
    normalized: DataFrame,
    group_map: DataFrame,
    group_id: str,
    windows: Iterable[StoreWindow],
    old_codes: Iterable[str],
    new_codes: Iterable[str],
    begin: date,
    end: date,
) -> dict[str, DataFrame]:
    """Funnel from pre-launch buyers of old items to post-launch buyers of the new ones.

    Customer lists are not sorted: a sort of all customers belongs to whoever shows or writes them.
    """
    members = stores.group_members(group_map, group_id).select("store_id")
    rows = stores.attach_windows(_normalized_sales(normalized, Period(begin, end)), windows)
    return customers.conversion_funnel(
        rows.join(members, "store_id"),
        I.matches_paid_code(old_codes), I.matches_paid_code(new_codes), begin, end,
    )


def adopter_baskets(
    normalized: DataFrame,
    store_ids: Iterable[str],
    new_code: str,
    launch: Period,
    lookback: Period,
    top: int = 10,
) -> dict[str, DataFrame]:
    """What adopters of a new item used to order: customers, checks, compositions, top slices.

    Adopters are found among the dates of the launch and their earlier rows among those of the lookback, so
    of a table partitioned by date each partition is read once. The earlier rows are landed. Only the top
    slices are in order; the lists are left unsorted.
    """
    span = Period(lookback.start, launch.end)
    rows = _normalized_sales(normalized, span).filter(F.col("store_id").isin(*store_ids))
    result = customers.adoption_lookback(rows, I.matches_code(new_code), launch, lookback)
    # All other results start from these rows, which are landed once.
    earlier = materialize(
        result["lookback_transactions"].select("check_hash", "account_id", "sale_in_dollar", "timestamp", "check")
    )
    compositions = baskets.basket_composition(earlier)
    counts = baskets.composition_counts(compositions)
    return {
        "adopters": result["adopters"],
        "lookback_customers": earlier.select("account_id").distinct(),
        "lookback_transactions": earlier,
        "compositions": compositions.select("check_composition_id").distinct(),
        "composition_counts": counts,
        "top_compositions": baskets.top_k_plus_others(counts, top),
    }


def target_item_history(
    tx: DataFrame,
    merchant_map: DataFrame,
    windows: Iterable[StoreWindow],
    targets: Iterable[tuple[str, str]],
    period: Period,
    time_zone: str,
    with_target_details: bool = False,
    display_names: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """Check history of the customers who bought a target item at one of the listed stores.

    ``in_order`` sorts it by store, customer and time, for whoever shows or writes it as a sheet.
    """
    rows = stores.cutoff_sales(tx, merchant_map, period, time_zone, windows)
    rows = rows.withColumn("customer_type", labels.customer_type(F.col("isNewAtStore")))
    history = customers.target_customer_history(
        rows, I.matches_code_and_name(targets), with_target_details, display_names
    )
    return history.orderBy(*customers.history_order(display_names)) if in_order else history
