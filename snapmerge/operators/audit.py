"""Run audit (A-05, A-06, A-09, A-10, S-10).

One row per dataset and run: when, which dataset, rows downloaded, rows new,
rows edited, rows in the target, a note, and ``no_data`` when nothing was
downloaded.  Counts come from a single aggregate over the tagged union of the
extract and the final table (no join between the two), or — in
:mod:`snapmerge.plans.flows` — from ``Observation`` metrics gathered while the
target is written, which costs no extra pass.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import CHANGE, EDITED, NEW

AUDIT_SCHEMA = ("run_ts timestamp_ntz, dataset string, rows_read bigint, new_rows bigint, "
                "edited_rows bigint, total_rows bigint, note string, no_data boolean")

# Fixed value: note written when a run brought no rows.
NO_DATA_NOTE = "no data in period"

_TAG = "_sm_audit_part"


def audit_counts(extract: DataFrame, final: DataFrame) -> DataFrame:
    """A-05/A-06 (+A-10): rows read, and new / edited / total rows of the target."""
    has_ct = CHANGE in final.columns
    r = extract.select(F.lit("read").alias(_TAG), F.lit(None).cast("string").alias(CHANGE))
    f = final.select(F.lit("final").alias(_TAG),
                     (F.col(CHANGE) if has_ct else F.lit(None).cast("string")).alias(CHANGE))
    part, ct = F.col(_TAG), F.col(CHANGE)
    return r.unionByName(f).agg(
        F.count_if(part == "read").alias("rows_read"),
        F.count_if((part == "final") & (ct == NEW)).alias("new_rows"),
        F.count_if((part == "final") & (ct == EDITED)).alias("edited_rows"),
        F.count_if(part == "final").alias("total_rows"),
    )


def run_audit(dataset: str, run_ts: dt.datetime, extract: DataFrame, final: DataFrame) -> DataFrame:
    """A-09 as a DataFrame: the audit row of one run."""
    counts = audit_counts(extract, final)
    return counts.select(
        # from text: a naive datetime literal would pass through the client's time zone
        F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_ts"), F.lit(dataset).alias("dataset"),
        "rows_read", "new_rows", "edited_rows", "total_rows",
        F.when(F.col("rows_read") == 0, F.lit(NO_DATA_NOTE)).otherwise(F.lit("")).alias("note"),
        (F.coalesce(F.col("rows_read"), F.lit(0)) == 0).alias("no_data"))


def audit_row(spark: SparkSession, dataset: str, run_ts: dt.datetime, rows_read: int | None,
              new_rows: int | None, edited_rows: int | None, total_rows: int | None,
              note: str = "") -> DataFrame:
    """A-09 from already observed numbers (one driver-built row); a failure
    leaves the counts null and explains itself in ``note``."""
    if not note and not rows_read:
        note = NO_DATA_NOTE
    row = (run_ts, dataset, rows_read, new_rows, edited_rows, total_rows, note, not rows_read)
    return spark.createDataFrame([row], AUDIT_SCHEMA)
