"""Parameters of the reports. Dates, groups, stores and items are never built in; the thresholds
that have a default are marked as fixed values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

# Authorization types that represent a sale.
SALE_TYPES = ("Pre Auth Request", "Pre Auth Complete", "Purchase")
# Report groups of the two sales channels that count towards year over year.
SALES_CHANNELS = ("In-store", "Online")

# 52 and 78 whole weeks: the compared dates fall on the same weekday.
YEAR_LAG_DAYS = 364
EIGHTEEN_MONTH_LAG_DAYS = 546


@dataclass(frozen=True)
class Period:
    """Inclusive range of business dates."""

    start: date
    end: date

    def days(self) -> list[date]:
        return [self.start + timedelta(days=i) for i in range((self.end - self.start).days + 1)]


@dataclass(frozen=True)
class StoreWindow:
    """A test or control store with the (possibly borrowed) launch date of the change studied."""

    store_id: str
    store_name: str
    launch_date: date


@dataclass(frozen=True)
class CohortRules:
    """Rules a store must pass to be in the fixed cohort, and the years then reported.

    ``saturday_minimum`` maps each audited year to the covered Saturdays it needs; years that
    are not in it are not audited for Saturdays. ``coverage_years`` limits the non-Saturday
    rule (None: every year of the window).
    """

    window: Period
    maturity_cutoff: date
    saturday_minimum: Mapping[int, int]
    report_years: tuple[int, ...]
    year_to_date: int | None = None
    # Thresholds of the rules where a user sets no others.
    maturity_rank: int = 50
    monthly_minimum: int = 100
    daily_minimum: int = 10
    non_saturday_rate: float = 0.75
    coverage_years: tuple[int, ...] | None = None
    excluded_saturdays: tuple[date, ...] = ()
    excluded_non_saturdays: tuple[date, ...] = ()
    store_groups: tuple[str, ...] = ()
    channels: tuple[str, ...] = SALES_CHANNELS
    lag_days: int = YEAR_LAG_DAYS

    def expected_months(self) -> list[str]:
        return sorted({day.strftime("%Y-%m") for day in self.window.days()})

    def expected_saturdays(self) -> dict[int, int]:
        """Audited years that have at least one expected Saturday, with their count."""
        return self._count(lambda day: day.weekday() == 5 and day not in self.excluded_saturdays, self.saturday_minimum)

    def expected_non_saturdays(self) -> dict[int, int]:
        return self._count(lambda day: day.weekday() != 5 and day not in self.excluded_non_saturdays, self.coverage_years)

    def _count(self, keep, years) -> dict[int, int]:
        counts: dict[int, int] = {}
        for day in self.window.days():
            if keep(day) and (years is None or day.year in years):
                counts[day.year] = counts.get(day.year, 0) + 1
        return counts


@dataclass(frozen=True)
class ReturnRateParams:
    """Visit-to-visit return rates in two periods. Days: 1 is Sunday, 7 is Saturday."""

    period_1: Period
    period_2: Period
    # Visits that start a pair where a user sets no others.
    start_visit_min: int = 1
    start_visit_max: int = 9
    max_visit: int = 10
    start_days: tuple[int, ...] = field(default=(1, 2, 3, 4, 5, 6, 7))

    def start_visits(self) -> range:
        return range(self.start_visit_min, min(self.start_visit_max, self.max_visit - 1) + 1)
