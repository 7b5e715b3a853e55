"""Daypart definitions and the business day they imply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions import clock
from tillwise.functions.items import scalar_sql
from tillwise.functions.labels import WHOLE_DAY, normalize_daypart_name

# The document paths of a daypart (name, order, start, duration).
DAYPART_SCHEMA = "n string, do string, st struct<h:string,m:string>, d struct<hs:string,ms:string>"
MINUTES_PER_DAY = 1440


def parse_dayparts(owners: DataFrame, owner_column: str, id_alias: str = "store_id") -> DataFrame:
    """One row per daypart of each store (or store group).

    Unnamed dayparts and the whole-day one are dropped; names are normalized.
    """

    def number(path: str) -> Column:
        return F.expr(f"try_cast({scalar_sql(f'document.{path}')} AS BIGINT)")

    return (
        owners.select(
            F.col(owner_column).alias(id_alias),
            F.col("name").alias("owner_name"),
            F.col("timeZone").alias("time_zone"),
            F.explode("dayParts").alias("daypart"),
        )
        .withColumn("document", F.from_json("daypart", DAYPART_SCHEMA))
        .select(
            id_alias, "owner_name", "time_zone",
            F.expr(scalar_sql("document.n")).alias("raw_name"),
            number("do").alias("daypart_order"),
            number("st.h").alias("start_hour"),
            number("st.m").alias("start_minute"),
            number("d.hs").alias("duration_hours"),
            number("d.ms").alias("duration_minutes"),
        )
        .filter(F.col("raw_name").isNotNull() & (F.col("raw_name") != WHOLE_DAY))
        .withColumns(
            {
                "start_minute_of_day": F.col("start_hour") * 60 + F.col("start_minute"),
                "duration_minute_total": F.col("duration_hours") * 60 + F.col("duration_minutes"),
                "daypart_name": normalize_daypart_name(F.col("raw_name")),
            }
        )
        .drop("raw_name")
    )


def _wraps(start: Column, duration: Column) -> Column:
    return start + duration > MINUTES_PER_DAY


def _after_midnight(minute: Column, start: Column, duration: Column) -> Column:
    return _wraps(start, duration) & (minute < F.pmod(start + duration, F.lit(MINUTES_PER_DAY)))


def in_daypart(minute: Column, start: Column, duration: Column) -> Column:
    """Minute of day inside [start, start + duration), which may run past midnight."""
    same_evening = (minute >= start) & (_wraps(start, duration) | (minute < start + duration))
    return same_evening | _after_midnight(minute, start, duration)


def assign_daypart(
    tx: DataFrame, dayparts: DataFrame, owner: str = "store_id", how: str = "inner"
) -> DataFrame:
    """Match each row to the daypart(s) holding its local minute of day.

    An equi-join on the owner with the range as a residual condition: a store has a handful
    of dayparts, so a broadcast hash join tests only those. Overlapping dayparts repeat a
    row; ``how="left"`` keeps rows no daypart covers. Should the dimension outgrow a
    broadcast, the shuffled join is split by adaptive execution when one store is hot.
    """
    parts = dayparts.select(
        F.col(owner).alias("_owner"),
        "start_minute_of_day", "duration_minute_total", "daypart_name", "daypart_order",
    )
    inside = in_daypart(
        tx["tx_minute_of_day"], parts["start_minute_of_day"], parts["duration_minute_total"]
    )
    return tx.join(parts, (tx[owner] == parts["_owner"]) & inside, how).drop("_owner")


DAYPART_FIELDS = ("start_minute_of_day", "duration_minute_total", "daypart_name", "daypart_order")


def minute_lookup(dayparts: DataFrame, owner: str = "store_id") -> DataFrame:
    """(owner, choices, choice): which dayparts cover each minute of the day, one row per store.

    ``choices`` lists the distinct sets of dayparts that cover some minute, in the order of the
    dayparts; ``choice`` has the number of a set for each of the 1,440 minutes. A store is a few
    kilobytes, however long its dayparts are and however much they overlap. A daypart without
    a readable start or duration covers no minute; a repeated one is a member twice.
    """
    part = F.struct("daypart_order", *[name for name in DAYPART_FIELDS if name != "daypart_order"])
    stores = dayparts.filter(F.col(owner).isNotNull()).groupBy(owner).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    numbers = F.sequence(F.lit(0), F.size("parts") - 1)

    def covering(minute: Column) -> Column:
        def covers(i: Column) -> Column:
            own = F.get(F.col("parts"), i)
            inside = in_daypart(minute.cast("bigint"), own["start_minute_of_day"], own["duration_minute_total"])
            return F.coalesce(inside, F.lit(False))

        return F.filter(numbers, covers)

    minutes = F.transform(F.sequence(F.lit(0), F.lit(MINUTES_PER_DAY - 1)), covering)
    sets = stores.withColumn("sets", minutes).withColumn("distinct_sets", F.array_distinct("sets"))
    return sets.select(
        owner,
        F.transform("distinct_sets", lambda s: F.transform(s, lambda i: F.get(F.col("parts"), i))).alias("choices"),
        F.transform("sets", lambda s: F.array_position(F.col("distinct_sets"), s).cast("int") - 1).alias("choice"),
    )


def assign_daypart_by_minute(
    tx: DataFrame, lookup: DataFrame, owner: str = "store_id", how: str = "inner"
) -> DataFrame:
    """What ``assign_daypart`` gives, from a ``minute_lookup``: an equi-join on the store and two array look-ups.

    No condition is tested per daypart, and the store's side has one row per store, so the join may be
    of any kind. Rows without a store or a minute, or at a minute no daypart covers, are dropped by
    ``how="inner"`` and kept by ``"left"``.
    """
    table = lookup.select(F.col(owner).alias("_owner"), "choices", "choice")
    chosen = F.get(table["choices"], F.get(table["choice"], tx["tx_minute_of_day"].cast("int")))
    explode = F.explode_outer if how == "left" else F.explode
    own = [tx[c] for c in tx.columns]
    rows = tx.join(table, tx[owner] == table["_owner"], how).select(*own, explode(chosen).alias("_part"))
    return rows.select(*tx.columns, *[F.col("_part")[name].alias(name) for name in DAYPART_FIELDS])


def daypart_business_date(tx: DataFrame, date_column: str = "business_date") -> DataFrame:
    """Business date and its labels.

    The after-midnight part of a daypart that runs past midnight belongs to the day before;
    rows without a daypart keep their local date.
    """
    late = _after_midnight(
        F.col("tx_minute_of_day"), F.col("start_minute_of_day"), F.col("duration_minute_total")
    )
    return tx.withColumn(
        date_column, F.when(late, F.date_sub("local_date", 1)).otherwise(F.col("local_date"))
    ).withColumns(
        {
            "business_weekday": clock.weekday_name(F.col(date_column)),
            "business_month_year": clock.month_year(F.col(date_column)),
            "business_year": clock.year_text(F.col(date_column)),
        }
    )
