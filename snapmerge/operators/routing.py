"""Routing by year and the per-year counters (S-07, S-08, A-07, A-08, O-04, X-18).

A year is a partition column: writing with ``partitionBy("year")`` and dynamic
partition overwrite replaces exactly the years present in the batch and
leaves the others untouched, which is what the one-file-per-year layout did.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import row_year
from .merge import CHANGE, EDITED, NEW

YEAR = "year"


def with_row_year(df: DataFrame, period_col: str, out: str = YEAR) -> DataFrame:
    """S-07: route each row by the year of its own period."""
    return df.withColumn(out, row_year(period_col))


def with_run_year(df: DataFrame, as_of: dt.date, out: str = YEAR) -> DataFrame:
    """S-08: route every row by the year of the run."""
    return df.withColumn(out, F.lit(as_of.year))


def years_present(df: DataFrame, year_col: str = YEAR) -> DataFrame:
    """A-07 / O-04: distinct years, and which one is the latest.

    ``max`` comes from a second tiny aggregate over the distinct years (one row
    per year), joined back by broadcast — no cross join.
    """
    years = df.select(F.col(year_col).alias(YEAR)).where(F.col(YEAR).isNotNull()).distinct()
    latest = years.agg(F.max(YEAR).alias("_latest"))
    return (years.join(F.broadcast(latest), F.col(YEAR) == F.col("_latest"), "left")
            .select(YEAR, F.col("_latest").isNotNull().alias("is_latest")))


def yearly_counts(classified: DataFrame, year_col: str = YEAR) -> DataFrame:
    """A-08: new / edited / total rows per year, plus the all-years line (``year`` null, ``is_all_years`` true).

    Rows without a year are a line of their own (``year`` null, ``is_all_years`` false).
    """
    ct = F.col(CHANGE)
    return (classified.withColumnRenamed(year_col, YEAR).rollup(YEAR)
            .agg(F.count_if(ct == NEW).alias("new_rows"),
                 F.count_if(ct == EDITED).alias("edited_rows"),
                 F.count(F.lit(1)).alias("total_rows"),
                 (F.grouping(YEAR) == 1).alias("is_all_years")))
