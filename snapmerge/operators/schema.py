"""Projection and schema operators (P-01..P-07).

All of them only read ``df.schema`` on the driver and emit one projection;
none of them touches data on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_numeric_type, number_to_text, qcol, strip_name


def select_configured(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """P-01: configured columns in configured order; absent ones are skipped."""
    present = [c for c in keep if c in df.columns]
    return df.select(*[qcol(c) for c in present])


def missing_columns(keep: Sequence[str], df: DataFrame) -> list[str]:
    return [c for c in keep if c not in df.columns]


def normalize_headers(df: DataFrame) -> DataFrame:
    """P-03: strip whitespace and newlines around every column name."""
    return df.toDF(*[strip_name(c) for c in df.columns])


def align_to_schema(df: DataFrame, target: T.StructType, cast: bool = True) -> DataFrame:
    """P-04: drop extra columns, null-fill missing ones, use the target's order.

    With ``cast`` the surviving columns are ``try_cast`` to the target type, so
    an unparseable value becomes null instead of failing the job (ANSI mode).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in target.fields:
        if f.name in have:
            c = qcol(f.name)
            if cast and have[f.name] != f.dataType:
                c = c.try_cast(f.dataType)
            out.append(c.alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def reorder_current_then_legacy(df: DataFrame, current: Sequence[str]) -> DataFrame:
    """P-05: the latest extract's columns first, legacy columns last."""
    first = [c for c in current if c in df.columns]
    legacy = [c for c in df.columns if c not in current]
    return df.select(*[qcol(c) for c in first + legacy])


def harmonize_types(batch: DataFrame, existing: T.StructType) -> DataFrame:
    """P-06/P-07: give batch columns the stored table's types.

    The stored schema decides (no sampling of rows): a column stored as text
    receives numbers rendered without ``.0`` (and never in scientific
    notation); other differing types are ``try_cast``.  Batch-only columns are
    kept as they are.
    """
    stored = {f.name: f.dataType for f in existing.fields}
    out = []
    for f in batch.schema.fields:
        c = qcol(f.name)
        target = stored.get(f.name)
        if target is None or target == f.dataType:
            out.append(c)
        elif isinstance(target, T.StringType) and (is_numeric_type(f.dataType)
                                                   or isinstance(f.dataType, T.StringType)):
            out.append(number_to_text(c, f.dataType).alias(f.name))
        else:
            out.append(c.try_cast(target).alias(f.name))
    return batch.select(*out)


def drift_rows(dataset: str, expected: Sequence[str], actual: Sequence[str],
               existing: Sequence[str] | None = None) -> list[tuple[str, str, str]]:
    """P-02 on the driver (schemas only): ``(dataset, column, issue)`` tuples."""
    rows = [(dataset, c, "missing_in_extract") for c in expected if c not in actual]
    if existing is not None:
        rows += [(dataset, c, "missing_vs_table") for c in existing if c not in actual]
        rows += [(dataset, c, "extra_vs_table") for c in actual if c not in existing]
    return rows


def schema_drift_report(spark: SparkSession, df: DataFrame, dataset: str, expected: Sequence[str],
                        existing: Sequence[str] | None = None) -> DataFrame:
    """P-02 as a DataFrame: each drifted column with how many values the extract holds.

    The per-column non-null counts come from one aggregate over the extract, so
    the report also says whether an extra column actually carries data.
    """
    issues = drift_rows(dataset, expected, df.columns, existing)
    schema = "dataset string, column_name string, issue string"
    report = spark.createDataFrame(issues, schema)
    present = sorted({c for _, c, _ in issues if c in df.columns})
    if present:
        counts = df.agg(*[F.count(qcol(c)).alias(c) for c in present])
        stack = F.expr("stack({n}, {pairs}) as (column_name, non_null_values)".format(
            n=len(present),
            pairs=", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', `{c}`" for c in present)))
        long = counts.select(stack)
    else:
        long = spark.createDataFrame([], "column_name string, non_null_values bigint")
    return (report.join(F.broadcast(long), "column_name", "left")
            .select("dataset", "column_name", "issue",
                    F.coalesce("non_null_values", F.lit(0).cast("long")).alias("non_null_values")))
