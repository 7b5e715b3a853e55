"""The given tables, seen as retail sources.

Facts come from ``orders``, ``lineitem`` and ``events`` in whole; the store dimensions are
small literal tables. Every value here is invented.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwise.functions.clock import weekday_name
from tillwise.functions.money import dollars
from tillwise.operators.yoy import period_over_period
from tillwise.params import Period
from tillwise.sources.tables import literal_table

STORES = 8
ZONES = ("America/Chicago", "America/Denver", "America/New_York")
UNMAPPED_MERCHANT = 5
# name, order, start hour, start minute, hours, minutes; 04:00-06:00 is covered by none.
DAYPARTS = (
    ("Breakfast", 1, 6, 0, 4, 0),
    ("lunch", 2, 10, 0, 4, 0),
    ("mid-day", 3, 14, 0, 3, 0),
    ("Dinner", 4, 17, 0, 5, 0),
    ("late-night", 5, 22, 0, 6, 0),
    ("All Day", 6, 0, 0, 24, 0),
)
SALES_WINDOW = Period(date(1995, 1, 1), date(2001, 8, 1))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _daypart_documents() -> list[str]:
    return [
        json.dumps({"n": n, "do": order, "st": {"h": h, "m": m}, "d": {"hs": hours, "ms": minutes}})
        for n, order, h, m, hours, minutes in DAYPARTS
    ]


def merchant_map(spark: SparkSession) -> DataFrame:
    rows = [
        (f"M{m}", f"T{t}", f"S{m}", ("In-store", "Online")[t])
        for m in range(STORES) if m != UNMAPPED_MERCHANT
        for t in range(2)
    ]
    return literal_table(spark, rows, "merchantId string, terminalId string, storeId string, reportGroup string")


def stores(spark: SparkSession) -> DataFrame:
    rows = [(f"S{i}", f"Store {i}", ZONES[i % 3], _daypart_documents()) for i in range(STORES)]
    return literal_table(spark, rows, "storeId string, name string, timeZone string, dayParts array<string>")


def store_groups(spark: SparkSession) -> DataFrame:
    rows = [
        (group, name, ZONES[0], _daypart_documents())
        for group, name in (("ALL", "All stores"), ("G0", "Even stores"), ("G1", "Odd stores"))
    ]
    return literal_table(spark, rows, "storeGroupId string, name string, timeZone string, dayParts array<string>")


def group_map(spark: SparkSession) -> DataFrame:
    rows = [(f"S{i}", group) for i in range(STORES) for group in ("ALL", f"G{i % 2}")]
    return literal_table(spark, rows, "storeId string, storeGroupId string")


def _cents(value: str) -> Column:
    return F.round(F.col(value) * 100).cast("bigint")


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _is_new() -> Column:
    """Five priorities -> new, returning or unknown."""
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    return F.when(rank <= 2, True).when(rank.isin(3, 5), False)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order, shaped like the fact of the cohort and return-rate reports."""
    store = F.col("o_orderkey") % STORES
    day = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_composite_key"),
        _numbered("S", store).alias("store_id"),
        _numbered("Store ", store).alias("store_name"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.when(F.col("o_orderstatus") == "F", "In-store")
        .when(F.col("o_orderstatus") == "O", "Online")
        .otherwise("Other")
        .alias("channel_group"),
        _is_new().alias("isNewAtStore"),
        dollars(_cents("o_totalprice")).alias("sale_in_dollar"),
        F.col("o_orderdate").alias("local_time"),
        day.alias("business_day"),
        weekday_name(day).alias("business_weekday"),
    )


def _order_instant() -> Column:
    """Order date plus an hour and a minute that follow from the key."""
    return F.col("o_orderdate") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int"), mins=(F.col("o_orderkey") % 60).cast("int")
    )


def order_authorizations(
    spark: SparkSession, sf_dir: str, code: str | None = "p_brand", name: str = "p_type"
) -> DataFrame:
    """One raw authorization per order; its check document packs the order's lines.

    ``code`` and ``name`` choose the part columns that act as item code and name; ``code=None``
    leaves the documents out.
    """
    orders = read(spark, sf_dir, "orders")
    if code is None:
        check = F.lit(None).cast("string")
    else:
        packed = _packed_lines(spark, sf_dir, code, name)
        orders = orders.join(packed, orders["o_orderkey"] == packed["l_orderkey"], "left")
        check = F.when(F.col("o_orderkey") % 40 != 3, F.col("document"))
    status = F.col("o_orderstatus")
    return orders.select(
        "o_orderkey",
        _order_instant().alias("timestamp"),
        F.when(F.col("o_custkey") % 50 != 7, F.col("o_custkey").cast("string")).alias("accountNumberId"),
        _numbered("M", F.col("o_orderkey") % STORES).alias("siteIdFrontend"),
        _numbered("T", F.col("o_custkey") % 2).alias("terminalId"),
        _numbered("A", F.col("o_orderkey")).alias("authCode"),
        F.when(status == "F", "Purchase")
        .when(status == "O", "Pre Auth Complete")
        .when(F.col("o_orderkey") % 3 == 0, "Reversal")
        .otherwise("Pre Auth Request")
        .alias("type"),
        _cents("o_totalprice").alias("amount"),
        _is_new().alias("isNewAtStore"),
        check.alias("check"),
    )


def _packed_lines(spark: SparkSession, sf_dir: str, code: str, name: str) -> DataFrame:
    """The line items of each order as one document, in line order (an order has few lines)."""
    part = read(spark, sf_dir, "part").select("p_partkey", code, name)
    lines = read(spark, sf_dir, "lineitem")
    free = F.col("l_linenumber") % 5 == 0
    entry = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.struct(
            F.col(code).alias("p"),
            F.col(name).alias("n"),
            F.when(free, 0).otherwise(F.col("l_quantity").cast("int")).alias("q"),
            F.when(free, F.lit(0).cast("bigint")).otherwise(_cents("l_extendedprice")).alias("pr"),
        ).alias("item"),
    )
    ordered = F.array_sort(F.collect_list("entry"))
    return (
        lines.join(part, lines["l_partkey"] == part["p_partkey"])
        .select("l_orderkey", entry.alias("entry"))
        .groupBy("l_orderkey")
        .agg(F.to_json(F.struct(F.transform(ordered, lambda e: e["item"]).alias("ls"))).alias("document"))
    )


def event_authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw authorization per event; merchant M5 is not in the merchant map."""
    kind, number = F.col("event_type"), F.col("event_id")
    return read(spark, sf_dir, "events").select(
        number.alias("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("accountNumberId"),
        _numbered("M", number % 6).alias("siteIdFrontend"),
        _numbered("T", F.floor(number / 6) % 2).alias("terminalId"),
        _numbered("A", number).alias("authCode"),
        F.when(kind == "purchase", "Purchase")
        .when(kind == "click", "Pre Auth Request")
        .when(kind == "view", "Pre Auth Complete")
        .otherwise(kind)
        .alias("type"),
        _cents("value").alias("amount"),
        F.when(number % 3 == 0, True).when(number % 3 == 1, False).alias("isNewAtStore"),
        F.col("props").alias("check"),
    )


def event_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visit per event, shaped like the fact of the return-rate report."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_composite_key"),
        F.col("user_id").cast("string").alias("account_id"),
        _numbered("S", F.col("event_id") % 6).alias("store_id"),
        F.col("ts").alias("local_time"),
        F.to_date("ts").alias("business_day"),
    )


def supplier_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stores with four daypart documents each.

    One is spelled in varying ways, one covers the whole day, one has no name, one has an
    unreadable start hour.
    """
    key = F.col("s_suppkey")
    spelling = (
        F.when(key % 4 == 0, "BREAKFAST").when(key % 4 == 1, "Mid Day")
        .when(key % 4 == 2, "latenight").otherwise("Snack")
    )

    def document(name: Column | None, order: int, hour: Column) -> Column:
        named = [] if name is None else [name.alias("n")]
        return F.to_json(
            F.struct(
                *named,
                F.lit(order).alias("do"),
                F.struct(hour.alias("h"), (key * 7 % 60).alias("m")).alias("st"),
                F.struct((key % 8 + 1).alias("hs"), F.lit(0).alias("ms")).alias("d"),
            )
        )

    hour = (key % 24).cast("string")
    return read(spark, sf_dir, "supplier").select(
        _numbered("SUP", key).alias("storeId"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 3 == 0, ZONES[0])
        .when(F.col("s_nationkey") % 3 == 1, ZONES[1])
        .otherwise(ZONES[2])
        .alias("timeZone"),
        F.array(
            document(spelling, 1, hour),
            document(F.lit("All Day"), 2, hour),
            document(None, 3, hour),
            document(F.lit("Dinner"), 4, F.lit("late")),
        ).alias("dayParts"),
    )


def group_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per group and day with their 364-day prior, packed as change documents.

    The daypart tag follows from the order key (77 is not a known tag), the customer tag from
    the priority (52 is not a known tag); the store count is that of the stores selling.
    """
    members = group_map(spark).select(F.col("storeId").alias("store_id"), "storeGroupId")
    rows = (
        sales(spark, sf_dir)
        .join(members, "store_id")
        .select(
            "storeGroupId", "store_id", F.col("business_day").alias("business_date"),
            F.when(F.col("isNewAtStore"), "50").when(~F.col("isNewAtStore"), "51").otherwise("52").alias("type_tag"),
            (F.col("transaction_composite_key") % 8 + 70).cast("string").alias("part_tag"),
            (F.col("sale_in_dollar") * 100).cast("bigint").alias("cents"),
        )
    )
    keys = ("storeGroupId", "type_tag", "part_tag")
    daily = rows.groupBy(*keys, "business_date").agg(F.sum("cents").alias("sale"), F.count("*").alias("visit"))
    pairs = period_over_period(daily, SALES_WINDOW, keys)
    open_stores = rows.groupBy("storeGroupId", "business_date").agg(F.count_distinct("store_id").alias("storeCount"))

    def side(prefix: str) -> Column:
        return F.struct(
            F.struct(F.col(f"{prefix}_sale").alias("d")).alias("s"),
            F.struct(F.col(f"{prefix}_visit").alias("d")).alias("t"),
        )

    change = F.to_json(
        F.struct(
            F.array("type_tag", F.lit("x"), "part_tag").alias("t"),
            side("current").alias("c"),
            side("prior").alias("p"),
        )
    )
    packed = pairs.groupBy("storeGroupId", "business_date").agg(F.collect_list(change).alias("changes"))
    return packed.join(open_stores, ["storeGroupId", "business_date"]).select(
        "storeGroupId", "storeCount", F.col("business_date").alias("date"), "changes"
    )
