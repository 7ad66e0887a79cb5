"""Run-date table: month turns, weekends, holidays, January, leap day."""

import datetime as dt

import pytest

from snapmerge.functions import calendar as CAL
from snapmerge.functions import periods as P

HOLIDAYS = {dt.date(2001, 5, 1), dt.date(2001, 9, 7), dt.date(2001, 10, 12), dt.date(2001, 11, 2),
            dt.date(2001, 11, 15), dt.date(2001, 12, 25), dt.date(2024, 5, 1)}


@pytest.mark.parametrize("as_of,carry_start,short", [
    (dt.date(2001, 7, 1), dt.date(2001, 6, 28), True),    # June 30 is a Saturday
    (dt.date(2001, 7, 2), dt.date(2001, 7, 1), True),     # day 2 still uses the rule
    (dt.date(2001, 7, 3), dt.date(2001, 7, 1), False),    # day 3 never
    (dt.date(2001, 8, 1), dt.date(2001, 7, 29), False),   # July 31 is a Tuesday
    (dt.date(2001, 10, 1), dt.date(2001, 9, 28), True),   # Sept 30 is a Sunday
    (dt.date(2024, 5, 2), dt.date(2024, 5, 1), False),    # April 30 2024 is a Tuesday
    (dt.date(2001, 5, 2), dt.date(2001, 5, 1), False),    # April 30 2001 is a Monday
    (dt.date(2002, 1, 1), dt.date(2001, 12, 29), False),  # Dec 31 2001 is a Monday (January turn)
    (dt.date(2024, 3, 1), dt.date(2024, 2, 27), False),   # leap year: Feb 29 2024 is a Thursday
])
def test_month_turn_table(as_of, carry_start, short):
    assert P.carryover_start(as_of) == carry_start
    assert CAL.month_turn_rule(as_of, HOLIDAYS) is short


def test_holiday_month_end_triggers_short_window():
    # a holiday on the last day of the month behaves like a weekend
    assert CAL.month_turn_rule(dt.date(2001, 5, 1), {dt.date(2001, 4, 30)}) is True


def test_period_helpers():
    assert P.yyyymm(dt.date(2001, 12, 31)) == 200112
    assert P.next_month_start(dt.date(2001, 12, 15)) == dt.date(2002, 1, 1)
    assert P.previous_month_end(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


def test_predicates_on_dataframe(spark):
    days = [(dt.date(2001, 6, 27),), (dt.date(2001, 6, 28),), (dt.date(2001, 7, 31),), (dt.date(2001, 8, 1),), (None,)]
    df = spark.createDataFrame(days, "d date")
    got = {r.d for r in df.where(P.in_month_with_carryover("d", dt.date(2001, 7, 1))).collect()}
    assert got == {dt.date(2001, 6, 28), dt.date(2001, 7, 31)}
    got = {r.d for r in df.where(P.in_current_month("d", dt.date(2001, 7, 20))).collect()}
    assert got == {dt.date(2001, 7, 31)}
    got = {r.d for r in df.where(P.within_rolling_days("d", dt.date(2001, 9, 26), 90)).collect()}
    assert got == {dt.date(2001, 6, 28), dt.date(2001, 7, 31), dt.date(2001, 8, 1)}


def test_parse_dayfirst_keeps_iso_and_rejects_junk(spark):
    df = spark.createDataFrame([("05/04/2026",), ("2026-04-05",), ("5/4/2026",), ("31/02/2001",), ("x",)], "s string")
    got = [r.d for r in df.select(P.parse_date_dayfirst("s").alias("d")).collect()]
    assert got == [dt.date(2026, 4, 5), dt.date(2026, 4, 5), dt.date(2026, 4, 5), None, None]


def test_business_day_and_rule_on_dataframe(spark):
    days = spark.createDataFrame([(dt.date(2001, 7, 1),), (dt.date(2001, 8, 1),), (dt.date(2001, 9, 7),)], "run_date date")
    hol = CAL.holidays_from_dates(spark, sorted(HOLIDAYS))
    b = {r.run_date: r.is_business_day for r in CAL.with_business_day(days, "run_date", hol).collect()}
    assert b == {dt.date(2001, 7, 1): False, dt.date(2001, 8, 1): True, dt.date(2001, 9, 7): False}
    r = {x.run_date: x.use_short_window for x in CAL.with_month_turn_rule(days, "run_date", hol).collect()}
    assert r == {dt.date(2001, 7, 1): True, dt.date(2001, 8, 1): False, dt.date(2001, 9, 7): False}


def test_national_holidays_generated_by_rule(spark):
    h = CAL.national_holidays(spark, 2000, 2001)
    assert h.count() == 16
    assert dt.date(2001, 11, 15) in {r.holiday_date for r in h.collect()}


def test_row_year_handles_text_and_int(spark):
    df = spark.createDataFrame([(200107, "200106"), (None, "abc")], "p int, s string")
    got = [(r.a, r.b) for r in df.select(P.row_year("p").alias("a"), P.row_year("s").alias("b")).collect()]
    assert got == [(2001, 2001), (None, None)]
