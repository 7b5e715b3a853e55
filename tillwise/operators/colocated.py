"""Customer questions on a co-located fact: what ``customers`` and ``visits`` answer, without moving it.

The parts of the fact share no (customer, store), so each is answered on its own. In the bucketed part
buyers, joins, sums per customer and visit numbers stay inside a bucket. The heavy part has a short
list of customers, which is broadcast by its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions import items as I
from tillwise.operators import customers, visits
from tillwise.operators.stores import attach_windows
from tillwise.params import StoreWindow
from tillwise.sources.buckets import ColocatedFact
from tillwise.sources.tables import materialize


def _in_windows(rows: DataFrame, windows: Iterable[StoreWindow] | None) -> DataFrame:
    return rows if windows is None else attach_windows(rows, windows)


def prior_buyer_rollcall(fact: ColocatedFact, test: I.ItemTest, windows: Sequence[StoreWindow]) -> DataFrame:
    """``customers.prior_buyer_rollcall`` of the stores of ``windows``."""
    light, heavy = _in_windows(fact.light, windows), _in_windows(fact.heavy, windows)
    weeks = [
        customers.rollcall_weeks(light, customers.prior_buyers(light, test)),
        customers.rollcall_weeks(heavy, materialize(customers.prior_buyers(heavy, test))),
    ]
    return customers.rollcall_report(weeks[0].unionByName(weeks[1]))


def target_customer_history(
    fact: ColocatedFact,
    test: I.ItemTest,
    windows: Sequence[StoreWindow] | None = None,
    with_target_details: bool = False,
    display_names: bool = False,
) -> DataFrame:
    """``customers.target_customer_history``, optionally of the stores of ``windows``."""
    light, heavy = _in_windows(fact.light, windows), _in_windows(fact.heavy, windows)
    parts = [
        customers.history_of(light, customers.buyers(light, test), test, with_target_details, display_names),
        customers.history_of(heavy, materialize(customers.buyers(heavy, test)), test, with_target_details, display_names),
    ]
    return parts[0].unionByName(parts[1])


def visit_rank(
    fact: ColocatedFact, order: str = "local_time", tie: Sequence[str] = ("transaction_composite_key",)
) -> DataFrame:
    """``visits.visit_rank`` of rows that have a customer and a store."""
    known = [F.col(key).isNotNull() for key in visits.VISITOR]
    window = W.partitionBy(*visits.VISITOR).orderBy(F.col(order), *[F.col(name) for name in tie])
    light = fact.light.filter(known[0] & known[1]).withColumn("visit_number", F.row_number().over(window))
    return light.unionByName(visits.ranged_visit_rank(fact.heavy.filter(known[0] & known[1]), order, tie))
