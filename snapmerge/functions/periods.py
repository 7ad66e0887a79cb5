"""Reporting periods and date windows (P-09, P-10, F-02..F-05, F-11..F-13, X-09..X-13).

Every window is computed from an explicit ``as_of`` date on the driver and
enters the plan as literal bounds, so Catalyst folds it and the Parquet
reader receives ``PushedFilters`` such as ``GreaterThanOrEqual(report_date, …)``.
Filters are written as ranges (``d >= lo AND d < hi``), never as
``month(d) = m``, which could not be pushed down or used for partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reporting rules.
CARRYOVER_DAYS = 3        # days of the previous month kept on day 1 of a month
ROLLING_WINDOW_DAYS = 90  # retention of the rolling contracts table
SOURCE_LAST_DAYS = 30     # "last 30 days" extract window
SHORT_WINDOW_DAYS = 3     # "last 3 days" window used on month turns


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(col: str | Column) -> Column:
    """Cast a date/timestamp column to ``date`` (no-op for dates)."""
    return _c(col).cast("date")


# ---------------------------------------------------------------- driver-side calendar math
def reference_period(as_of: dt.date) -> tuple[int, int]:
    """(year, month) of the run."""
    return as_of.year, as_of.month


def yyyymm(as_of: dt.date) -> int:
    """Integer period ``year * 100 + month``."""
    return as_of.year * 100 + as_of.month


def month_start(as_of: dt.date) -> dt.date:
    return as_of.replace(day=1)


def next_month_start(as_of: dt.date) -> dt.date:
    ms = month_start(as_of)
    return (ms.replace(year=ms.year + 1, month=1) if ms.month == 12
            else ms.replace(month=ms.month + 1))


def previous_month_end(as_of: dt.date) -> dt.date:
    return month_start(as_of) - dt.timedelta(days=1)


def carryover_start(as_of: dt.date, extra_days: int = CARRYOVER_DAYS) -> dt.date:
    """Lower bound of the month window: on day 1 it reaches ``extra_days`` back."""
    ms = month_start(as_of)
    return ms - dt.timedelta(days=extra_days) if as_of.day == 1 else ms


# ---------------------------------------------------------------- predicates (Columns)
def in_current_month(col: str | Column, as_of: dt.date) -> Column:
    """F-02: date falls in the month of ``as_of`` (null / unparseable → false)."""
    d = as_date(col)
    return (d >= F.lit(month_start(as_of))) & (d < F.lit(next_month_start(as_of)))


def in_month_with_carryover(col: str | Column, as_of: dt.date,
                            extra_days: int = CARRYOVER_DAYS) -> Column:
    """F-03: current month, plus the previous ``extra_days`` days when ``as_of`` is day 1."""
    d = as_date(col)
    return (d >= F.lit(carryover_start(as_of, extra_days))) & (d < F.lit(next_month_start(as_of)))


def within_rolling_days(col: str | Column, as_of: dt.date,
                        days: int = ROLLING_WINDOW_DAYS) -> Column:
    """F-04: ``d >= as_of - days`` (inclusive, no upper bound)."""
    return as_date(col) >= F.lit(as_of - dt.timedelta(days=days))


def in_last_n_days(col: str | Column, as_of: dt.date, n: int = SOURCE_LAST_DAYS) -> Column:
    """F-11: the ``n`` days ending at ``as_of`` (today included)."""
    d = as_date(col)
    return (d >= F.lit(as_of - dt.timedelta(days=n - 1))) & (d <= F.lit(as_of))


def in_this_year(col: str | Column, as_of: dt.date) -> Column:
    """F-13 on a date column, written as a range."""
    d = as_date(col)
    return (d >= F.lit(dt.date(as_of.year, 1, 1))) & (d < F.lit(dt.date(as_of.year + 1, 1, 1)))


def period_is_current(col: str | Column, as_of: dt.date) -> Column:
    """F-05: integer period equals the run's yyyymm."""
    return _c(col) == F.lit(yyyymm(as_of))


def period_in_this_year(col: str | Column, as_of: dt.date) -> Column:
    """F-13 on an integer period column."""
    y = as_of.year
    return _c(col).between(F.lit(y * 100 + 1), F.lit(y * 100 + 12))


def period_of(col: str | Column) -> Column:
    """P-09 per row: yyyymm of a date column, as ``int``."""
    d = as_date(col)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def period_in_dates(col: str | Column, lo: dt.date, hi: dt.date) -> Column:
    """Integer period belongs to one of the months touched by ``[lo, hi]``."""
    return _c(col).between(F.lit(yyyymm(lo)), F.lit(yyyymm(hi)))


def row_year(col: str | Column) -> Column:
    """P-10 / X-02: year = first four characters of the period, as ``int``.

    Works for ``int`` yyyymm and for text periods alike; text that is not a year
    yields null instead of failing (ANSI mode is on in Spark 4).
    """
    return F.substring(_c(col).cast("string"), 1, 4).try_cast("int")


def parse_date_dayfirst(col: str | Column) -> Column:
    """X-09: text date in day-first (``d/M/yyyy``) or ISO (``yyyy-MM-dd``) form.

    ISO text stays ISO (no day/month swap); anything else becomes null.
    """
    s = F.trim(_c(col).cast("string"))
    return F.coalesce(
        F.try_to_timestamp(s, F.lit("d/M/yyyy")).cast("date"),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date"),
    )


# ---------------------------------------------------------------- per-row calendar columns
def month_start_col(col: str | Column) -> Column:
    """X-11: first day of the month of each row's date."""
    return F.trunc(as_date(col), "MM")


def previous_month_end_col(col: str | Column) -> Column:
    """X-13: last day of the previous month of each row's date."""
    return F.date_sub(F.trunc(as_date(col), "MM"), 1)


def carryover_start_col(col: str | Column, extra_days: int = CARRYOVER_DAYS) -> Column:
    """Per-row version of :func:`carryover_start`."""
    d = as_date(col)
    ms = F.trunc(d, "MM")
    return F.when(F.dayofmonth(d) == 1, F.date_sub(ms, extra_days)).otherwise(ms)
