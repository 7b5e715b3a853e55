"""From raw authorizations to store-attributed, valid sales."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import clock, keys
from tillwise.functions.money import dollars
from tillwise.params import SALE_TYPES, SALES_CHANNELS, Period, StoreWindow
from tillwise.sources.tables import literal_table


def attach_store(
    tx: DataFrame,
    merchant_map: DataFrame,
    stores: DataFrame | None = None,
    group_map: DataFrame | None = None,
    group_id: str | None = None,
) -> DataFrame:
    """(merchant, terminal) -> store and channel; optionally store attributes and membership.

    Adds ``store_id`` and ``channel_group``, with ``stores`` also ``store_name`` and
    ``time_zone``, with ``group_map`` also ``store_group_id``. Unmapped rows drop out. Each
    dimension joins separately, so that its own size decides whether it is broadcast.
    """
    mapping = merchant_map.select(
        F.col("merchantId").alias("_merchant"),
        F.col("terminalId").alias("_terminal"),
        F.col("storeId").alias("store_id"),
        F.col("reportGroup").alias("channel_group"),
    )
    result = tx.join(
        mapping,
        (tx["siteIdFrontend"] == mapping["_merchant"]) & (tx["terminalId"] == mapping["_terminal"]),
    ).drop("_merchant", "_terminal")
    if stores is not None:
        result = result.join(
            stores.select(
                F.col("storeId").alias("store_id"),
                F.col("name").alias("store_name"),
                F.col("timeZone").alias("time_zone"),
            ),
            "store_id",
        )
    if group_map is not None:
        result = result.join(group_members(group_map, group_id), "store_id")
    return result


def group_members(group_map: DataFrame, group_id: str | None = None) -> DataFrame:
    """Store-to-group rows as (store_id, store_group_id), optionally of one group."""
    members = group_map.select(
        F.col("storeId").alias("store_id"), F.col("storeGroupId").alias("store_group_id")
    )
    return members if group_id is None else members.filter(F.col("store_group_id") == group_id)


def attach_windows(tx: DataFrame, windows: Iterable[StoreWindow]) -> DataFrame:
    """Keep the listed stores and add their ``store_name`` and ``launch_date``."""
    rows = [(w.store_id, w.store_name, w.launch_date) for w in windows]
    table = literal_table(tx.sparkSession, rows, "store_id string, store_name string, launch_date date")
    return tx.drop("store_name").join(table, "store_id")


def valid_sales(
    tx: DataFrame,
    types: Iterable[str] = SALE_TYPES,
    require_check: bool = False,
    require_account: bool = False,
) -> DataFrame:
    """Sale-like authorization types; optionally only rows with a check and a customer."""
    keep = F.col("type").isin(*types)
    if require_check:
        keep = keep & F.col("check").isNotNull()
    if require_account:
        keep = keep & F.col("accountNumberId").isNotNull()
    return tx.filter(keep)


def valid_sales_channel(
    tx: DataFrame, channels: Iterable[str] = SALES_CHANNELS, cutoff: date | None = None
) -> DataFrame:
    """Positive sales of the listed channels with a store and a business day up to ``cutoff``."""
    keep = (
        F.col("channel_group").isin(*channels)
        & F.col("store_id").isNotNull()
        & F.col("business_day").isNotNull()
        & (F.col("sale_in_dollar") > 0)
    )
    if cutoff is not None:
        keep = keep & (F.col("business_day") <= F.lit(cutoff))
    return tx.filter(keep)


def local_time_columns(tx: DataFrame, time_zone: str = "time_zone") -> DataFrame:
    """Add ``local_time``, ``local_date``, ``local_weekday`` and ``tx_minute_of_day``."""
    local = clock.to_local(F.col("timestamp"), F.col(time_zone))
    return (
        clock.with_utc_wall_time(tx)
        .withColumn("local_time", local)
        .withColumns(
            {
                "local_date": F.to_date("local_time"),
                "local_weekday": clock.weekday_name(F.to_date("local_time")),
                "tx_minute_of_day": clock.minute_of_day(F.col("local_time")),
            }
        )
    )


def business_date_cutoff(tx: DataFrame, time_zone: str, hours: int = 6) -> DataFrame:
    """Add ``local_time`` and the ``business_date`` of a day starting ``hours`` after midnight."""
    return (
        clock.with_utc_wall_time(tx)
        .withColumn("local_time", clock.to_local(F.col("timestamp"), time_zone))
        .withColumn("business_date", clock.cutoff_business_date(F.col("local_time"), hours))
    )


def cutoff_sales(
    tx: DataFrame,
    merchant_map: DataFrame,
    period: Period,
    time_zone: str,
    windows: Iterable[StoreWindow] | None = None,
    group_map: DataFrame | None = None,
    group_id: str | None = None,
    require_check: bool = True,
    cutoff_hours: int = 6,
) -> DataFrame:
    """Transaction base of the flat-cutoff reports.

    Valid sales of the wanted stores with check key, dollars, local time and business date.
    """
    rows = clock.within_utc_envelope(tx, period.start, period.end)
    rows = valid_sales(rows, require_check=require_check, require_account=require_check)
    rows = business_date_cutoff(rows, time_zone, cutoff_hours)
    rows = rows.filter(clock.between_days(F.col("business_date"), period.start, period.end))
    rows = attach_store(rows, merchant_map, group_map=group_map, group_id=group_id)
    if windows is not None:
        rows = attach_windows(rows, windows)
    return with_check_columns(rows, hash_missing_checks=not require_check)


def with_check_columns(tx: DataFrame, hash_missing_checks: bool = False) -> DataFrame:
    """Add ``account_id``, ``check_hash`` and ``sale_in_dollar`` to raw authorization rows."""
    return tx.withColumns(
        {
            "account_id": F.col("accountNumberId"),
            "check_hash": keys.check_hash(
                F.col("accountNumberId"), F.col("check"), F.col("amount"),
                F.col("siteIdFrontend"), F.col("terminalId"), F.col("timestamp"),
                hash_missing_checks,
            ),
            "sale_in_dollar": dollars(F.col("amount")),
        }
    )
