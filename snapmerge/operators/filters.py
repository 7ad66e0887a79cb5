"""Row filters (F-01, F-06..F-10, F-14..F-16).

Period predicates live in :mod:`snapmerge.functions.periods`; this module
applies them and adds the footer/totals handling.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.calendar import month_turn_rule
from ..functions.scalars import qcol


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """F-01 / F-15: case-sensitive equality; nulls are dropped.  Pushed to the scan."""
    return df.where(qcol(column) == F.lit(value))


def drop_footer_rows(df: DataFrame, key_col: str) -> DataFrame:
    """F-06: rows with a null key are report footers, not records."""
    return df.where(qcol(key_col).isNotNull())


def split_totals(df: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """F-07: (data rows, totals rows) of a stored table; all null-key rows are totals (Q-09)."""
    return df.where(qcol(key_col).isNotNull()), df.where(qcol(key_col).isNull())


def footer_count(df: DataFrame, key_col: str) -> DataFrame:
    """A-11: number of footer rows and whether any exist."""
    n = F.count_if(qcol(key_col).isNull())
    return df.agg(n.alias("footer_rows"), (n > 0).alias("has_footer"))


def purge_stale_preview(prev: DataFrame, date_col: str, as_of: dt.date) -> DataFrame:
    """F-08 (dates): keep only the current month (+ carry-over) of a stored preview."""
    return prev.where(P.in_month_with_carryover(date_col, as_of))


def purge_stale_period(prev: DataFrame, period_col: str, as_of: dt.date) -> DataFrame:
    """F-08 (periods): keep only the current yyyymm of a stored preview."""
    return prev.where(P.period_is_current(period_col, as_of))


def with_parsed_date(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """F-10: parse a text date day-first; failures become null (and are then excluded)."""
    return df.withColumn(out, P.parse_date_dayfirst(text_col))


def source_window(df: DataFrame, date_col: str, as_of: dt.date, holiday_dates: set[dt.date],
                  short_days: int = P.SHORT_WINDOW_DAYS) -> DataFrame:
    """F-14: "this month", replaced by "last ``short_days`` days" when D-06 holds."""
    if month_turn_rule(as_of, holiday_dates):
        return df.where(P.in_last_n_days(date_col, as_of, short_days))
    return df.where(P.in_current_month(date_col, as_of))


def source_window_period(df: DataFrame, period_col: str, as_of: dt.date,
                         holiday_dates: set[dt.date], short_days: int = P.SHORT_WINDOW_DAYS) -> DataFrame:
    """F-14 on an integer yyyymm column: the months touched by the chosen window."""
    if month_turn_rule(as_of, holiday_dates):
        lo = as_of - dt.timedelta(days=short_days - 1)
        return df.where(P.period_in_dates(period_col, lo, as_of))
    return df.where(P.period_is_current(period_col, as_of))


def check_expected_period(df: DataFrame, date_col: str, as_of: dt.date) -> DataFrame:
    """F-16 re-aimed as a data check: rows, rows outside the month, min/max date."""
    d = P.as_date(date_col)
    inside = P.in_current_month(date_col, as_of)
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~inside | d.isNull()).alias("rows_outside_period"),
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
    )
