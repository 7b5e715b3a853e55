"""Local time, business days and calendar labels.

Instants are handled as TIMESTAMP_NTZ holding UTC wall time, so no result depends on the
session time zone. Local times are TIMESTAMP_NTZ in the store's own zone.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Day numbers of F.dayofweek.
SUNDAY, MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY = range(1, 8)
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _is_instant(df: DataFrame, column: str) -> bool:
    return isinstance(df.select(column).schema[0].dataType, T.TimestampType)


def utc_wall_time(df: DataFrame, column: str) -> Column:
    """An instant column as UTC wall time, exact in any session zone; other types unchanged."""
    if _is_instant(df, column):
        seconds = (F.unix_micros(column).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.col(column)


def with_utc_wall_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Turn an instant column into UTC wall time; wall-time columns pass unchanged."""
    return df.withColumn(column, utc_wall_time(df, column))


def to_local(utc_wall_time: Column, time_zone: Column | str) -> Column:
    """UTC wall time -> wall time in ``time_zone``, which may differ per row (follows DST)."""
    zone = F.lit(time_zone) if isinstance(time_zone, str) else time_zone
    return F.convert_timezone(F.lit("UTC"), zone, utc_wall_time)


def minute_of_day(local_time: Column) -> Column:
    return F.hour(local_time) * F.lit(60) + F.minute(local_time)


# The labels below avoid date_format: taking them from the day number and the ISO text of the
# date is several times cheaper per row and independent of the session time zone.


def weekday_name(day: Column) -> Column:
    names = [WEEKDAY_NAMES[-1], *WEEKDAY_NAMES[:-1]]
    return F.get(F.lit(names), F.dayofweek(day) - SUNDAY)


def month_key(day: Column) -> Column:
    """``yyyy-MM``."""
    return F.substring(day.cast("string"), 1, 7)


def month_year(day: Column) -> Column:
    """``MM_yyyy``."""
    return F.concat(F.substring(day.cast("string"), 6, 2), F.lit("_"), year_text(day))


def year_text(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 4)


def week_start(day: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(day, "week")


def is_saturday(day: Column) -> Column:
    return F.dayofweek(day) == SATURDAY


def cutoff_business_date(local_time: Column, hours: int = 6) -> Column:
    """Business date of a day that starts ``hours`` after local midnight."""
    return F.to_date(local_time - F.expr(f"INTERVAL {int(hours)} HOURS"))


def utc_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """UTC moment as a literal of the column's own type, so that comparisons reach the scan."""
    if _is_instant(df, column):
        return F.lit(moment.replace(tzinfo=timezone.utc))
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_utc_range(
    df: DataFrame, column: str, first: datetime | None = None, before: datetime | None = None
) -> DataFrame:
    """Rows with ``first <= column < before``.

    Tables landed by ``snapshot_table`` carry the UTC date as partition column
    ``<column>_date``; where it is present, the same range prunes its partitions.
    """
    partition = f"{column}_date"
    partitioned = partition in df.columns
    if first is not None:
        df = df.filter(F.col(column) >= utc_literal(df, column, first))
        if partitioned:
            df = df.filter(F.col(partition) >= F.lit(first.date()))
    if before is not None:
        df = df.filter(F.col(column) < utc_literal(df, column, before))
        if partitioned:
            df = df.filter(F.col(partition) <= F.lit(before.date()))
    return df


def within_utc_envelope(
    df: DataFrame, start: date | None, end: date | None, column: str = "timestamp"
) -> DataFrame:
    """Coarse filter on the raw timestamp implied by a local business-date range.

    A predicate on a time-zone-shifted date cannot reach the Parquet scan. Every local date
    lies within a day or two of the UTC date, so this wider range can, and partitions and row
    groups are skipped before the exact filter runs. Apply it before any time conversion.
    """
    first = None if start is None else datetime.combine(start - timedelta(days=1), time())
    before = None if end is None else datetime.combine(end + timedelta(days=3), time())
    return in_utc_range(df, column, first, before)


def between_days(day: Column, start: date | None, end: date | None) -> Column:
    """Inclusive date range; an open side is None."""
    bound = F.lit(True)
    if start is not None:
        bound = bound & (day >= F.lit(start))
    if end is not None:
        bound = bound & (day <= F.lit(end))
    return bound
