"""Exact money arithmetic.

Amounts arrive as integer cents, or as dollars of any numeric type, and leave as DECIMAL dollars.
Sums run on BIGINT cents: the aggregation buffer stays a fixed-width long, and no floating-point
error builds up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

DOLLAR_TYPE = "decimal(20,2)"


def dollars(cents: Column) -> Column:
    """Integer cents -> exact dollars."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(DOLLAR_TYPE)


def cents(amount: Column) -> Column:
    """Dollars -> integer cents. DOUBLE and longer decimals are rounded to two decimals first, half up."""
    return (amount.cast(DOLLAR_TYPE) * F.lit(100)).cast("bigint")


def sum_dollars(amount: Column) -> Column:
    """SUM of a dollar column, exact to the cent, NULL when every input is NULL."""
    return dollars(F.sum(cents(amount)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Fractional division that gives NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def relative_change(current: Column, prior: Column) -> Column:
    """(current - prior) / prior, NULL where there is no prior value."""
    return ratio(current - prior, prior)
