"""Decoding of codes and free-text labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Accepted spellings of the five standard dayparts.
DAYPART_SPELLINGS = {
    "Breakfast": ("breakfast",),
    "Lunch": ("lunch",),
    "Midday": ("midday", "mid-day", "mid day"),
    "Dinner": ("dinner",),
    "Late Night": ("late night", "latenight", "late-night"),
}
WHOLE_DAY = "All Day"

# Tag codes in the pre-computed year-over-year change documents.
CUSTOMER_TAGS = {50: "New", 51: "Returning"}
DAYPART_TAGS = {
    70: "Breakfast",
    71: "Brunch",
    72: "BreakfastBrunch",
    73: "Lunch",
    74: "Midday",
    75: "Dinner",
    76: "LateNight",
}


def decode(code: Column, labels: Mapping) -> Column:
    """Code -> label; NULL for an unlisted code."""
    result = F.lit(None).cast("string")
    for key, label in labels.items():
        result = F.when(code == F.lit(key), F.lit(label)).otherwise(result)
    return result


def normalize_daypart_name(raw: Column) -> Column:
    """Standard daypart name for a known spelling (any case); other names stay as they are."""
    result = raw
    for name, spellings in DAYPART_SPELLINGS.items():
        result = F.when(F.lower(raw).isin(*spellings), F.lit(name)).otherwise(result)
    return result


def customer_type(
    is_new: Column, new: str = "New", returning: str = "Returning", unknown: str = "Unknown"
) -> Column:
    return (
        F.when(is_new, F.lit(new))
        .when(~is_new, F.lit(returning))
        .otherwise(F.lit(unknown))
    )


def sort_rank(value: Column, order) -> Column:
    """Position of ``value`` in ``order``, for report sorting; unlisted values sort last."""
    result = F.lit(len(order))
    for position, label in enumerate(order):
        result = F.when(value == F.lit(label), F.lit(position)).otherwise(result)
    return result
