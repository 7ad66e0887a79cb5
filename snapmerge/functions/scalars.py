"""Scalar helpers: text cleanup, id canonicalisation, tolerant row equality.

All of them are built-in Catalyst expressions (they stay inside whole-stage
codegen); no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the comparison rule: numbers are compared after rounding to
# six decimals (half-even), which absorbs binary noise from re-saved files.
FLOAT_TOLERANCE_DECIMALS = 6

_WS = r"^\s+|\s+$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quote(name: str) -> str:
    """Backtick-quote a column name (names may contain dots or spaces)."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote(name))


def strip_ws(col: str | Column) -> Column:
    """X-01: strip leading/trailing whitespace including newlines and tabs.

    SQL ``trim`` removes spaces only, so a regex is used.
    """
    return F.regexp_replace(_c(col), _WS, "")


def strip_name(name: str) -> str:
    """P-03 on a column name (driver side, schema only)."""
    return name.strip()


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                              T.FloatType, T.DoubleType, T.DecimalType))


def is_fractional_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))


def nan_to_null(col: str | Column, dtype: T.DataType) -> Column:
    """P-08 / X-05: NaN becomes SQL null for float columns; other types unchanged."""
    c = _c(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(None).cast(dtype)).otherwise(c)
    return c


def number_to_text(col: str | Column, dtype: T.DataType) -> Column:
    """P-07 / X-04: render a number as text without a trailing ``.0``.

    Integral floats go through ``decimal(38,0)`` so a 14-digit tax id never
    turns into scientific notation; other values are cast and trimmed; null
    stays null.
    """
    c = _c(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        integral = (c == F.floor(c)) & (F.abs(c) < F.lit(1e38))
        return (F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
                .when(integral, c.cast(T.DecimalType(38, 0)).cast("string"))
                .otherwise(F.trim(c.cast("string"))))
    if isinstance(dtype, T.DecimalType):
        integral = c == F.floor(c)
        return (F.when(integral, F.floor(c).cast(T.DecimalType(38, 0)).cast("string"))
                .otherwise(F.trim(c.cast("string"))))
    if isinstance(dtype, T.StringType):
        return strip_ws(c)
    return c.cast("string")


def tolerant(col: str | Column, dtype: T.DataType) -> Column:
    """X-06: the comparable form of a value — fractional numbers rounded half-even."""
    c = _c(col)
    if is_fractional_type(dtype):
        return F.bround(c, FLOAT_TOLERANCE_DECIMALS)
    return c


def values_equal(a: Column, b: Column, dtype: T.DataType) -> Column:
    """Null-safe (X-07) and float-tolerant (X-06) equality of two values."""
    return tolerant(a, dtype).eqNullSafe(tolerant(b, dtype))


def rows_equal(left: str, right: str, fields: Iterable[tuple[str, T.DataType]]) -> Column:
    """Compare two struct columns field by field with :func:`values_equal`.

    Column-by-column ``<=>`` is used on purpose: hashing a row would make
    ``(null, 1)`` and ``(1, null)`` collide, and ``concat_ws`` skips nulls.
    """
    cond = F.lit(True)
    for name, dtype in fields:
        cond = cond & values_equal(F.col(left).getField(name), F.col(right).getField(name), dtype)
    return cond
