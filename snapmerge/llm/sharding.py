"""Byte-balanced shards by histogram sort.

Documents are ordered by (hash of the text, doc_id, row number).  For each of the n - 1 splitters, candidate
boundaries are probed together: one distributed pass counts the exact bytes in every interval between probes, and the
interval that holds the splitter's target is probed again, until a boundary lies within the tolerance or no two
different keys are left between candidates.  Boundaries between different texts are tried first, so equal texts share
a shard unless the tolerance needs a cut inside their group; a group of any size can be cut by doc_id, or, for repeated
rows, by row number.  Rows move once, by range, when all splitters are known.

Null text counts as empty; null doc_id sorts first; doc_ids that are no integers are put in order by their hash; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmerge.llm import common as C

SHARDS = 16
#: largest distance of a splitter from its target, as a share of a shard's bytes
TOLERANCE = 0.004
PROBES = 16
LOWEST = -(1 << 63)
KEY = ("_h", "_d", "_u")


def probes_below(keys: list[np.ndarray], probes: list[tuple[int, int, int]]) -> np.ndarray:
    """For each key, the number of sorted probes that are not above it."""
    h, d, u = keys
    tops = np.array([p[0] for p in probes], dtype=np.int64)
    n = np.searchsorted(tops, h, "left")
    tie = np.flatnonzero(np.searchsorted(tops, h, "right") > n)
    for a, b, c in probes if len(tie) else ():
        n[tie] += (h[tie] == a) & ((d[tie] > b) | ((d[tie] == b) & (u[tie] >= c)))
    return n


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in KEY]


def _histogram(keyed: DataFrame, probes: list[tuple]) -> dict[int, dict]:
    """Bytes, least and largest key of each interval between probes (len(probes) + 1 rows at most)."""
    def count(batches):
        for b in batches:
            at = probes_below(_columns(b), probes)
            yield pa.RecordBatch.from_arrays([pa.array(at), *(b.column(b.schema.get_field_index(c)) for c in (*KEY, "size"))],
                                             names=["at", *KEY, "size"])

    key = F.struct(*KEY)
    rows = (keyed.select(*KEY, "size").mapInArrow(count, "at long, _h long, _d long, _u long, size long")
            .groupBy("at").agg(F.sum("size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high")).collect())
    return {r["at"]: {"bytes": r["bytes"], "low": tuple(r["low"]), "high": tuple(r["high"])} for r in rows}


def _candidates(low: tuple, high: tuple) -> list[tuple]:
    """Both ends of the interval, and boundaries evenly spaced in the first part of the key that differs."""
    steps: set[tuple] = {low, (*high[:2], high[2] + 1)}
    for level in range(3):
        if low[level] != high[level]:
            gap = high[level] - low[level]
            return [*steps, *((*low[:level], low[level] + max(1, gap * k // PROBES), *([LOWEST] * (2 - level))) for k in range(1, PROBES + 1))]
    return [*steps]


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple]:
    """The shards - 1 boundary keys (equal boundaries leave a shard empty)."""
    whole = _histogram(keyed, []).get(0)
    if not whole:
        return [(LOWEST, LOWEST, LOWEST)] * (shards - 1)
    total = whole["bytes"]
    slack = tolerance * total / shards
    opened = {i: whole for i in range(1, shards)}  # the interval that holds the splitter's target
    best = {i: (abs(total * i / shards), whole["low"]) for i in opened}  # distance and key of the best boundary so far
    while opened:
        probes = sorted({p for span in opened.values() for p in _candidates(span["low"], span["high"])})
        found = _histogram(keyed, probes)
        below = np.cumsum([0, *(found.get(k, {"bytes": 0})["bytes"] for k in range(len(probes) + 1))], dtype=np.int64)
        for i in list(opened):
            target = total * i / shards
            k = min(int(np.searchsorted(below, target, "right")) - 1, len(probes))  # below[k] <= target < below[k + 1]
            span = found[k]
            best[i] = min([best[i], *((abs(int(below[j + 1]) - target), probes[j]) for j in (k - 1, k) if 0 <= j < len(probes))])
            if span["low"] == span["high"]:  # one key is left: cut before or after it
                low = span["low"]
                best[i] = min(best[i], (abs(int(below[k]) - target), low), (abs(int(below[k + 1]) - target), (*low[:2], low[2] + 1)))
            if best[i][0] <= slack or span["low"] == span["high"]:
                del opened[i]
            else:
                opened[i] = span
    return sorted(key for _, key in best.values())


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, keep_text: bool = True) -> DataFrame:
    """Columns of ``docs`` plus size, shard and slot (the gapless place in the shard)."""
    C.ship(docs.sparkSession)
    return C.beside(docs, ["doc_id", "text"], ["size", "shard", "slot"], lambda inner: _sharded(inner, shards, tolerance, keep_text))


def _sharded(docs: DataFrame, shards: int, tolerance: float, keep_text: bool) -> DataFrame:
    names = [c for c in docs.columns if keep_text or c != "text"]
    body = F.coalesce("text", F.lit(""))
    number = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    rank = F.col("doc_id").cast("long") if number else F.xxhash64("doc_id")  # ids that are no integers are put in order by hash
    keyed = (docs.withColumn("size", (F.octet_length(body) + 1).cast("long"))
             .withColumn("_h", F.xxhash64(body)).withColumn("_d", F.when(F.col("doc_id").isNull(), F.lit(LOWEST)).otherwise(rank))
             .withColumn("_u", F.monotonically_increasing_id()).select(*names, "size", *KEY))
    keyed = C.stage(keyed, "shards-keys")
    cuts = splitters(keyed, shards, tolerance)

    def assign(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(probes_below(_columns(b), cuts).astype(np.int32))], names=[*b.schema.names, "shard"])

    sent = keyed.mapInArrow(assign, C.with_fields(keyed, (), "shard int")).repartitionByRange("shard", *KEY).sortWithinPartitions("shard", *KEY)
    moved = C.stage(sent.withColumn("_row", F.monotonically_increasing_id()), "shards-rows")
    # rows are numbered partition by partition: a shard's part in a partition starts where its parts before it end
    runs = (moved.groupBy("shard", F.shiftright("_row", 33).alias("_p"))
            .agg(F.min("_row").alias("_first"), F.count("*").alias("_n")))  # a row per partition and shard
    earlier = Window.partitionBy("shard").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = C.stage(runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "shards-runs")
    return (moved.withColumn("_p", F.shiftright("_row", 33)).join(runs, ["shard", "_p"])
            .withColumn("slot", (F.col("_row") - F.col("_first") + F.col("_before")).cast("long"))
            .select(*names, "size", "shard", "slot"))
