"""Size checks that guard every broadcast.

A side is broadcast only after its size is known: rows by a plain count (each
task returns one number, Parquet answers it from file footers; nothing is
moved), or by the row count its stored commit carries (:func:`with_known_rows`), and bytes
by measurement (:func:`measured_bytes`), so long strings cannot slip past a
width estimate.  Otherwise the caller's shuffle-based plan is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds for a broadcast side (rows and estimated bytes).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def type_width(dtype: T.DataType) -> int:
    """Estimated bytes of one value (strings and nested types are estimated)."""
    if isinstance(dtype, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dtype, (T.ShortType,)):
        return 2
    if isinstance(dtype, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dtype, T.DecimalType):
        return 8 if dtype.precision <= 18 else 16
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 32
    if isinstance(dtype, T.StructType):
        return sum(type_width(f.dataType) for f in dtype.fields)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return 128
    return 8


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema."""
    return max(8, sum(type_width(f.dataType) for f in df.schema.fields))


def bounded_count(df: DataFrame, max_rows: int) -> int | None:
    """Row count if it is ``<= max_rows``, else ``None``."""
    n = known_rows(df)
    n = df.count() if n is None else n
    return n if n <= max_rows else None


def with_known_rows(df: DataFrame, rows: int | None) -> DataFrame:
    """Attach the row count that a commit recorded for exactly these rows."""
    df._snapmerge_rows = rows
    return df


def known_rows(df: DataFrame) -> int | None:
    return getattr(df, "_snapmerge_rows", None)


def with_most_rows(df: DataFrame, rows: int | None) -> DataFrame:
    """Attach a count that the rows of ``df`` do not exceed (``df`` was filtered from so many)."""
    df._snapmerge_most_rows = rows
    return df


def most_rows(df: DataFrame) -> int | None:
    known = known_rows(df)
    return known if known is not None else getattr(df, "_snapmerge_most_rows", None)


def broadcast_row_limit(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                        max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> int:
    """Largest row count of ``df`` that stays within both broadcast bounds."""
    return min(max_rows, max(1, max_bytes // row_width(df)))


def measured_bytes(df: DataFrame, n_rows: int) -> int | None:
    """Upper bound of ``df``'s size as ``n_rows`` binary rows: 8 bytes per field
    slot and row header, up to 8 bytes of alignment per variable-length value,
    plus the actual bytes of the string / binary columns, summed in one
    aggregate pass.  ``None`` for nested columns, which have no such bound."""
    fields = df.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in fields):
        return None
    var = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    slots = n_rows * 8 * (len(fields) + 2 + len(var))
    if not var or n_rows == 0:
        return slots
    total = reduce(lambda a, b: a + b, [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in var])
    return slots + df.agg(total.alias("var_bytes")).first()["var_bytes"]


def proven_rows(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> int | None:
    """Row count of ``df`` when it is proven within both bounds, else ``None``.

    Rows are counted first; only then are the variable-length bytes measured,
    over a side already known to have few rows."""
    n = bounded_count(df, broadcast_row_limit(df, max_rows, max_bytes))
    if n is None:
        return None
    size = measured_bytes(df, n)
    return n if size is not None and size <= max_bytes else None


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is proven to be within both bounds."""
    return proven_rows(df, max_rows, max_bytes) is not None


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when proven small, else ``df`` unchanged (shuffle join)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
