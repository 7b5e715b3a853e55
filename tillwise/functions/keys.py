"""Surrogate keys: SHA-256 over a separated, NULL-safe text form of the identifying fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NULL_TEXT = "NULL"
SEPARATOR = "|"


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def check_hash(
    account: Column,
    check: Column,
    amount: Column,
    site: Column,
    terminal: Column,
    utc_wall_time: Column,
    hash_missing_checks: bool = False,
) -> Column:
    """Key of one check.

    ``utc_wall_time`` is TIMESTAMP_NTZ, whose text does not depend on the session zone.
    A row without a check document has no key, unless ``hash_missing_checks`` asks for the
    variant in which the missing document takes part as the JSON text ``null``.
    """
    document = F.coalesce(check, F.lit("null"))
    digest = F.sha2(
        F.concat_ws(
            SEPARATOR,
            _text(account), document, _text(amount), _text(site), _text(terminal), _text(utc_wall_time),
        ),
        256,
    )
    return digest if hash_missing_checks else F.when(check.isNotNull(), digest)


def transaction_key(
    account: Column, transaction_type: Column, amount: Column, site: Column, utc_wall_time: Column
) -> Column:
    """Key of one authorization row (the same check may appear under several types)."""
    return F.sha2(
        F.concat_ws(
            SEPARATOR,
            _text(account), _text(transaction_type), _text(amount), _text(site), _text(utc_wall_time),
        ),
        256,
    )
