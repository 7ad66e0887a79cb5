"""Dynamic totals row (A-01..A-04, U-08).

The totals row is chosen from column *names*: money columns are summed,
percent columns averaged, everything else is null.  The choice is made on the
driver from the schema; the values come from one aggregate (partial
aggregation on every executor, a single tiny final merge).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null, qcol

IS_TOTAL = "is_total"

# Name markers of summed (money) and averaged (percent) columns.
MONEY_PREFIXES = ("R$",)
PERCENT_PREFIXES = ("%",)
MONEY_SUFFIXES = ("_amount",)
PERCENT_SUFFIXES = ("_pct",)


def is_money(name: str) -> bool:
    return name.startswith(MONEY_PREFIXES) or name.endswith(MONEY_SUFFIXES)


def is_percent(name: str) -> bool:
    return name.startswith(PERCENT_PREFIXES) or name.endswith(PERCENT_SUFFIXES)


def sum_type(dtype: T.DataType) -> T.DataType:
    """Type of an exact sum: decimals widen by 10 digits (as Spark's ``sum``)."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def totals_row(df: DataFrame, money: Callable[[str], bool] = is_money,
               percent: Callable[[str], bool] = is_percent) -> DataFrame:
    """A-01..A-03: one row — sums (empty → 0), means (empty → null), nulls elsewhere; NaN counts as missing."""
    exprs = []
    for f in df.schema.fields:
        c = nan_to_null(qcol(f.name), f.dataType)
        if money(f.name):
            st = sum_type(f.dataType)
            exprs.append(F.coalesce(F.sum(c).cast(st), F.lit(0).cast(st)).alias(f.name))
        elif percent(f.name):
            exprs.append(F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(f.name))
        else:
            exprs.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.agg(*exprs).withColumn(IS_TOTAL, F.lit(True))


def with_totals_row(data: DataFrame, money: Callable[[str], bool] = is_money,
                    percent: Callable[[str], bool] = is_percent) -> DataFrame:
    """A-04 / U-08: data rows (``is_total = false``) plus a freshly computed totals row.

    Money columns take the widened sum type for every row so that no total can
    overflow the column.
    """
    tot = totals_row(data, money, percent)
    types = dict(tot.dtypes)
    rows = data.select(*[qcol(c).cast(types[c]).alias(c) for c in data.columns]).withColumn(
        IS_TOTAL, F.lit(False))
    return rows.unionByName(tot)


def refresh_totals(table: DataFrame, key_col: str, money: Callable[[str], bool] = is_money,
                   percent: Callable[[str], bool] = is_percent,
                   drop_cols: Sequence[str] = ()) -> DataFrame:
    """A-04: drop every stored totals row (null key), recompute, append last."""
    data = table.where(qcol(key_col).isNotNull())
    if IS_TOTAL in data.columns:
        data = data.drop(IS_TOTAL)
    if drop_cols:
        data = data.drop(*drop_cols)
    return with_totals_row(data, money, percent)
