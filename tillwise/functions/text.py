"""Number formatting in the style of C's printf."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_SIGNIFICANT = 6
_LOWEST = -4


def _trim_zeros(number: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(number, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _six_digits(number: Column) -> Column:
    """Rounded to six significant digits, halves to even as printf does."""
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(number))) - (_SIGNIFICANT - 1))
    # Dividing by a power of ten of at least one is exact enough to see true halves.
    return _let(
        step, lambda s: F.when(s >= 1, F.rint(number / s) * s).otherwise(F.rint(number * F.round(1 / s)) / F.round(1 / s))
    )


def fmt_g(value: Column) -> Column:
    """``%g``: six significant digits, no trailing zeros, exponent form only outside 1e-4..1e6.

    NULL stays NULL. (Spark's own ``%g`` keeps trailing zeros and prints NULL as text.)
    """
    return _let(value.cast("double"), _format_g)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, which keeps the expression tree small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _format_g(number: Column) -> Column:
    whole = (F.abs(number) < 10**_SIGNIFICANT) & (number == F.floor(number))
    return F.when(whole, number.cast("bigint").cast("string")).when(
        number.isNotNull(), _let(_six_digits(number), _format_six_digits)
    )


def _format_six_digits(number: Column) -> Column:
    scientific = F.format_string(f"%.{_SIGNIFICANT - 1}e", number)
    plain = F.format_string(f"%.{_SIGNIFICANT - 1 - _LOWEST}f", number)
    return _let(
        F.struct(F.split(scientific, "e").alias("parts"), plain.alias("plain")),
        lambda text: F.when(
            text["parts"][1].cast("int").between(_LOWEST, _SIGNIFICANT - 1), _trim_zeros(text["plain"])
        ).otherwise(F.concat(_trim_zeros(text["parts"][0]), F.lit("e"), text["parts"][1])),
    )
