"""Business-day calendar and the month-turn rule (J-05, X-14, D-06, D-07).

Holidays are an *input table* ``(holiday_date date, scope string)``.  The
library can generate the fixed-date national holidays from a rule; movable
feasts and state holidays must be supplied by the user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .periods import as_date

# Fixed-date national holidays (month, day) of the calendar the
# month-turn rule is defined on.
FIXED_NATIONAL_HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
# Days of the month on which the month-turn rule may switch to the short window.
MONTH_TURN_DAYS = (1, 2)

HOLIDAY_SCHEMA = "holiday_date date, scope string"


def national_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Fixed-date national holidays for ``[first_year, last_year]``, built by Spark."""
    md = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"))
                   for m, d in FIXED_NATIONAL_HOLIDAYS])
    return (spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
            .select("y", F.explode(md).alias("md"))
            .select(F.make_date("y", F.col("md.m"), F.col("md.d")).alias("holiday_date"),
                    F.lit("national").alias("scope")))


def holidays_from_dates(spark: SparkSession, dates: list[dt.date], scope: str = "national") -> DataFrame:
    """User-supplied holiday rows."""
    return spark.createDataFrame([(d, scope) for d in dates], HOLIDAY_SCHEMA)


def weekday_mon0(col: str | Column) -> Column:
    """X-14: weekday with Monday = 0 … Sunday = 6."""
    return F.weekday(as_date(col))


def with_business_day(df: DataFrame, date_col: str, holidays: DataFrame,
                      out: str = "is_business_day") -> DataFrame:
    """J-05: flag Mon–Fri dates that are not in the holiday table.

    The holiday table is de-duplicated and broadcast only after its size is
    proven small; otherwise the join shuffles.  No row of ``df`` is dropped.
    """
    hol = (holidays.select(F.col("holiday_date").cast("date").alias("_hol_date"))
           .where(F.col("_hol_date").isNotNull()).distinct()
           .withColumn("_is_hol", F.lit(True)))
    hol = broadcast_if_small(hol)
    joined = df.join(hol, as_date(date_col) == F.col("_hol_date"), "left")
    flag = (weekday_mon0(date_col) < 5) & F.col("_is_hol").isNull()
    return joined.withColumn(out, flag).drop("_hol_date", "_is_hol")


def with_month_turn_rule(df: DataFrame, run_date_col: str, holidays: DataFrame,
                         out: str = "use_short_window") -> DataFrame:
    """D-06 per row: the run date is day 1 or 2 and the previous month's last day
    is not a business day → the source should use the short window."""
    pme = "_prev_month_end"
    with_pme = df.withColumn(pme, F.date_sub(F.trunc(as_date(run_date_col), "MM"), 1))
    flagged = with_business_day(with_pme, pme, holidays, out="_pme_business")
    rule = (F.dayofmonth(as_date(run_date_col)).isin(*MONTH_TURN_DAYS)
            & ~F.col("_pme_business"))
    return (flagged.withColumn(out, rule)
            .withColumnRenamed(pme, "prev_month_end")
            .withColumnRenamed("_pme_business", "prev_month_end_is_business_day"))


def month_turn_rule(as_of: dt.date, holiday_dates: set[dt.date]) -> bool:
    """D-06 for one run date, evaluated on the driver from a holiday set.

    Used to choose a source predicate before a plan is built.
    """
    if as_of.day not in MONTH_TURN_DAYS:
        return False
    pme = as_of.replace(day=1) - dt.timedelta(days=1)
    return pme.weekday() >= 5 or pme in holiday_dates


def run_dates_between(df: DataFrame, date_col: str) -> DataFrame:
    """D-07: every calendar day between the min and max date of ``df``.

    The span comes from one aggregate over ``df``; the days are generated with
    ``sequence`` + ``explode`` (one row per day).
    """
    bounds = df.agg(F.min(as_date(date_col)).alias("lo"), F.max(as_date(date_col)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("run_date"))
