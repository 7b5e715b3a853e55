"""Raw authorizations -> normalized transactions, and the slimmer fact built from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import clock, keys, labels
from tillwise.operators.dayparts import assign_daypart, daypart_business_date, parse_dayparts
from tillwise.operators.stores import (
    attach_store,
    group_members,
    local_time_columns,
    with_check_columns,
)
from tillwise.sources.curve import write_clustered
from tillwise.sources.tables import write_table

NORMALIZED_COLUMNS = (
    "transaction_composite_key", "store_id", "store_name", "account_id", "auth_code",
    "terminal_id", "site_id", "customer_type", "transaction_type", "channel_group",
    "timestamp", "time_zone", "local_time", "check_hash", "check", "sale_in_dollar",
    "duration_minute_total", "daypart_name", "daypart_order", "business_date",
    "business_weekday", "business_month_year", "business_year",
)


def normalize_transactions(
    tx: DataFrame,
    merchant_map: DataFrame,
    stores: DataFrame,
    after: datetime | None = None,
    returning_label: str = "Return",
    group_map: DataFrame | None = None,
    group_prefix: str = "",
) -> DataFrame:
    """One row per authorization with keys, store, local time, daypart and business date.

    ``after`` is a strict lower bound on the UTC timestamp and reaches the scan. Rows that no
    daypart of their store covers are kept with NULL daypart columns. With ``group_map``, a
    store in several groups whose id starts with ``group_prefix`` yields a row for each of
    them; stores in none keep their single row.
    """
    rows = tx
    if after is not None:
        rows = clock.in_utc_range(rows, "timestamp", after)
        rows = rows.filter(F.col("timestamp") != clock.utc_literal(tx, "timestamp", after))
    rows = local_time_columns(attach_store(rows, merchant_map, stores))
    if group_map is not None:
        members = group_members(group_map).filter(F.col("store_group_id").startswith(group_prefix))
        rows = rows.join(members.select("store_id"), "store_id", "left")
    rows = assign_daypart(rows, parse_dayparts(stores, "storeId"), how="left")
    rows = with_check_columns(daypart_business_date(rows))
    return rows.withColumns(
        {
            "transaction_composite_key": keys.transaction_key(
                F.col("accountNumberId"), F.col("type"), F.col("amount"),
                F.col("siteIdFrontend"), F.col("timestamp"),
            ),
            "customer_type": labels.customer_type(F.col("isNewAtStore"), returning=returning_label),
            "transaction_type": F.col("type"),
            "auth_code": F.col("authCode"),
            "terminal_id": F.col("terminalId"),
            "site_id": F.col("siteIdFrontend"),
        }
    ).select(*NORMALIZED_COLUMNS)


CLUSTERS = ("store_id", "account_id", "channel_group", "customer_type")


def publish_normalized(normalized: DataFrame, path: str) -> DataFrame:
    """Write normalized transactions partitioned by business date and clustered by their filters."""
    return write_table(normalized, path, "business_date", CLUSTERS)


def publish_clustered(
    normalized: DataFrame, path: str, partition_by: str | None = "business_date", row_group_bytes: int | None = None
) -> DataFrame:
    """Write normalized transactions so that a filter on any one of their clusters skips row groups.

    The input is read three times, for its size, its cuts and its rows; pass a landed table where it is
    dear to compute.
    """
    return write_clustered(normalized, path, CLUSTERS, partition_by, row_group_bytes=row_group_bytes)


def based_transactions(normalized: DataFrame) -> DataFrame:
    """The fact read by the cohort and return-rate reports: a projection of the normalized rows.

    Every authorization row counts as one transaction, also where the same check was recorded
    under several types.
    """
    return normalized.select(
        "store_id", "store_name", "account_id", "transaction_composite_key", "channel_group",
        "sale_in_dollar", "timestamp", "local_time", "business_weekday",
        F.col("business_date").alias("business_day"),
    )
