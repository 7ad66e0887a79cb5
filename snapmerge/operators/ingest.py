"""From a report extract as it lands to typed rows (P-03, P-08, F-05, F-10, X-01, X-09, X-17, Q-07).

One projection over the extract: column names are stripped and mapped from the
report's display names, text is stripped, NaN becomes null, text dates are read day first,
money and percent text becomes a decimal, and the period becomes an integer.
A value that is not null and cannot be read makes its row a *reject*, as does
a missing period where rows are routed by it: rejects are kept apart with the
reasons, never turned into null and never dropped in silence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import parse_date_dayfirst
from ..functions.scalars import is_fractional_type, nan_to_null, qcol, strip_name, strip_ws
from ..specs import DatasetSpec
from .totals import is_money, is_percent

REASONS = "_reject_reasons"
READ = "_read_amounts"
# Flows that route rows by their period's year, and those whose period is an integer yyyymm
ROUTED_FLOWS = ("accumulate_by_row_year", "period_preview_by_year")
PERIOD_FLOWS = (*ROUTED_FLOWS, "upsert_with_totals")
MONEY_TYPE = T.DecimalType(18, 2)


class TooManyRejects(ValueError):
    """More rows than allowed could not be read."""


@dataclass
class Ingested:
    rows: DataFrame       # typed rows, spec names
    rejects: DataFrame    # rows that could not be read, original text, with REASONS (array of text)
    marked: DataFrame     # all rows as they came, with REASONS (empty: none)


def money_from_text(c: Column) -> Column:
    """``R$ 1.234,56``, ``1234.56``, ``(5,50)`` or ``10%`` as a decimal; null where it is none of these.

    With both marks the last one is the decimal mark; a single comma is a decimal mark; a single
    point is one unless it is followed by exactly three digits after up to three (``1.234``).

    Each step names the text before it once: a filter works out an expression again wherever it is named,
    so the steps would multiply.
    """
    def number(s: Column) -> Column:
        comma_groups = s.rlike(r"^\d{1,3}(,\d{3})+\.\d+$")
        comma_decimal = s.rlike(r"^(\d{1,3}(\.\d{3})*|\d+),\d+$")
        point_groups = s.rlike(r"^\d{1,3}(\.\d{3})+$")
        plain = s.rlike(r"^\d+(\.\d+)?$")
        return (F.when(comma_groups, F.replace(s, F.lit(","), F.lit("")))
                .when(comma_decimal, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
                .when(point_groups, F.replace(s, F.lit("."), F.lit("")))
                .when(plain, s)).try_cast(MONEY_TYPE)

    def signed(s: Column) -> Column:
        bare = _once(F.when(s.rlike(r"^[-(]|\)$"), F.regexp_replace(s, r"^[-(]|\)$", "")).otherwise(s), number)
        negative = s.rlike(r"^\(.*\)$|^-")
        return _once(bare, lambda n: F.when(negative, -n).otherwise(n)).cast(MONEY_TYPE)

    return _once(F.regexp_replace(c, r"[R$%\s\u00a0]", ""), signed)


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(c), use)[0]


def rename_headers(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Strip the column names and map the report's display names to the spec's names (T-07)."""
    to_name = {shown: name for name, shown in spec.display_names.items()}
    stripped = [strip_name(c) for c in df.columns]
    present = set(stripped)
    return df.toDF(*[to_name[c] if c in to_name and to_name[c] not in present else c for c in stripped])


def ingest(extract: DataFrame, spec: DatasetSpec, stored: T.StructType | None = None) -> Ingested:
    """Typed rows and rejects of an extract.

    ``stored``: the schema of the table the rows go to; a text column stored as a number or date is read as
    such, so a value that does not fit is a reject instead of a silent null.
    """
    df = rename_headers(extract, spec)
    types = {f.name: f.dataType for f in stored.fields} if stored is not None else {}
    periods = (spec.period_col,) if spec.flow in PERIOD_FLOWS else ()
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (spec.date_col, *periods)
             and (is_money(f.name) or is_percent(f.name) or f.name in spec.money_cols)]
    out, problems = [], []
    for f in df.schema.fields:
        raw = qcol(f.name)
        text = isinstance(f.dataType, T.StringType)
        target = types.get(f.name)
        if f.name in money:
            c = F.col(READ).getField(f.name)
            out.append(c.alias(f.name))
            # blank text is no amount and no problem
            problems.append(F.when(c.isNull() & raw.rlike(r"\S"), F.lit(f"{f.name}: unreadable")))
            continue
        c = strip_ws(raw) if text else nan_to_null(raw, f.dataType)
        if text:
            c = F.when(c != "", c)
        given = c.isNotNull()
        if f.name == spec.date_col and text:
            c = parse_date_dayfirst(c)
        elif f.name in periods and (text or is_fractional_type(f.dataType)):
            keep_text = isinstance(target, T.StringType)
            number = (F.regexp_replace(c, r"\.0+$", "") if text else c).try_cast("int")
            valid = number.between(190001, 999912) & ((number % 100).between(1, 12))
            c = F.when(valid, number.cast("string") if keep_text else number)
        elif text and target is not None and not isinstance(target, T.StringType):
            c = parse_date_dayfirst(c) if isinstance(target, T.DateType) else c.try_cast(target)
        elif target is not None and target != f.dataType and not isinstance(target, T.StringType):
            problems.append(F.when(given & c.try_cast(target).isNull(), F.lit(f"{f.name}: does not fit")))
        out.append(c.alias(f.name))
        problems.append(F.when(given & c.isNull(), F.lit(f"{f.name}: unreadable")))
        if f.name == spec.period_col and spec.flow in ROUTED_FLOWS:
            problems.append(F.when(~given, F.lit(f"{f.name}: missing")))
    reasons = F.filter(F.array(*problems), lambda x: x.isNotNull())
    # a filter on the reasons may not be pushed below the generator, which would read each amount once more
    read = df.select("*", F.explode(F.array(F.struct(*[money_from_text(qcol(c)).alias(c) for c in money]))).alias(READ)) if money else df
    marked = read.withColumn(REASONS, reasons)
    good = marked.where(F.size(REASONS) == 0).select(*out)
    marked = marked.drop(READ)
    return Ingested(good, marked.where(F.size(REASONS) > 0), marked)
