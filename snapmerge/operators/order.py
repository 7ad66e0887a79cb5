"""Stable sorts and explicit row positions (O-01..O-03, W-05).

A Spark table has no row order, so the order the reference keeps implicitly
(file position, "append after the last row") is carried in explicit columns
(``last_src/last_ord``, ``seen_src/seen_ord``).  Sorting is a range-partitioned
``orderBy``.  When the *position* itself is the result, :func:`with_position`
numbers rows without funnelling them through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID, _MID, _N, _OFF = "_sm_pid", "_sm_mid", "_sm_n", "_sm_off"


def stable_sort_keys(primary: Sequence[Column | str], src: str, ord_: str) -> list[Column]:
    """O-01/O-02: ascending primary key (nulls last), then arrival order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in primary]
    return [c.asc_nulls_last() for c in cols] + [F.col(src).asc(), F.col(ord_).asc()]


def with_position(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Global 1-based position of each row under ``order`` — fully distributed.

    1. ``orderBy`` range-partitions and sorts the rows across all tasks;
    2. the sorted result is checkpointed to the cluster's checkpoint folder,
       which fixes its partitions (and survives executor loss);
    3. per-partition row counts (one row per partition) give prefix offsets,
       broadcast back — their size is bounded by the partition count;
    4. position = offset of the partition + index inside the partition.

    ``order`` must be a total order for the result to be deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    fixed = df.orderBy(*order).checkpoint(eager=True)
    t = (fixed.withColumn(_PID, F.spark_partition_id())
         .withColumn(_MID, F.monotonically_increasing_id()))
    counts = t.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (t.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col(_OFF) + local + 1).cast("long"))
            .drop(_PID, _MID, _OFF))
