"""Hard negatives by threshold joins of anchors against all rows, after L2AP.

A row's score is its inner product with the anchor; higher scores come first, ties by smaller id.  An anchor's positives
are its best ``positives`` other rows of its label.  A window is an anchor with one positive: the best ``negatives`` rows
of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's.

* Rows and anchors are dealt to blocks; a task joins one block of anchors with one block of rows (``BLOCK`` each at most),
  so memory is bounded and anchors are never broadcast.
* Components are put in order of their energy over all rows.  A row's trailing components are left out of the index of
  its block where the product of their norms (the suffix-norm bound, the largest of the block's anchors) is below the
  smallest threshold.  The others' partial scores are accumulated, ``STEP`` components at a time;
  rows whose partial scores plus the product of the remaining norms stay below every threshold go.  What is left is scored exactly.
* Thresholds start high and are lowered only for the anchors or windows that are not full, down to the least score allowed.
* A task returns at most ``positives`` or ``negatives`` rows per window; Spark ranks them again over the tasks.

Rows with a null id or label, a null vector, or any null or non-finite component take no part.  Rows with equal ids are rows of their
own (equal rows are each other's positives; an anchor's id may then occur more than once in the result).  Shorter vectors are filled up with zeros.
An empty table, a single label or a label of one row give no rows.  Ids are integers; scores are exact below 2^53.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmerge.llm import common as C
from snapmerge.llm import vectors as V

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
#: most anchors or rows of a block; blocks are smaller where the cluster has cores to spare
BLOCK = 8192
LEAST_BLOCK = 256
BLOCKS_PER_CORE = 4
#: anchors of a block scored at once
TOGETHER = 256
#: components accumulated between two looks at the bounds
STEP = 8
#: thresholds of the positives' rounds as shares of the largest score that the norms allow; then none
SHARES = (0.8, 0.4, 0.2)
#: thresholds of the windows' rounds, in hundredths of the positive's score; then ``low``
FIRST_HUNDREDTHS = 90
NO_LIMIT = -(1 << 62)


def candidates(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs with a score of at least the anchor's threshold ``least``; components by falling energy."""
    none = np.zeros(0, np.int64)
    if not len(anchors) or not len(rows):
        return none, none, np.zeros(0)
    width = anchors.shape[1]
    cuts = [*range(0, width, STEP), width]

    def suffix_norms(m: np.ndarray) -> np.ndarray:
        tail = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate([tail, np.zeros((len(m), 1))], axis=1)[:, cuts])

    rest_a, rest_r = suffix_norms(anchors), suffix_norms(rows)
    # steps indexed of each row: from there on the suffixes alone can't reach the smallest threshold
    covered = rest_r * rest_a.max(axis=0) < least.min()
    indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), len(cuts) - 1)
    order = np.argsort(-indexed, kind="stable")  # rows that index a step are a prefix
    at, indexed = order, indexed[order]
    partial = np.zeros((len(anchors), len(rows)))
    for c in range(len(cuts) - 1):
        n = int(np.searchsorted(-indexed, -c, "left"))  # rows with more than c steps
        if not n:
            break
        d = slice(cuts[c], cuts[c + 1])
        partial[:, :n] += anchors[:, d] @ rows[at[:n], d].T
        left = rest_r[at, np.minimum(indexed, c + 1)]
        alive = (partial + rest_a[:, np.minimum(indexed, c + 1)] * left[None, :] >= least[:, None] - 0.5).any(axis=0)
        if alive.mean() < 0.7:
            at, indexed, partial = at[alive], indexed[alive], partial[:, alive]
    i, j = np.nonzero(partial + rest_a[:, indexed] * rest_r[at, indexed][None, :] >= least[:, None] - 0.5)
    if len(i) * 8 > partial.size:
        score = (anchors @ rows[at].T)[i, j]
    else:
        score = partial[i, j]
        for k in np.unique(indexed).tolist():  # what the index left out
            if cuts[k] < width:
                own = np.flatnonzero(indexed[j] == k)
                for lo in range(0, len(own), 1 << 16):
                    p = own[lo:lo + (1 << 16)]
                    score[p] += np.einsum("nd,nd->n", anchors[i[p], cuts[k]:], rows[at[j[p]], cuts[k]:])
    enough = score >= least[i]
    return i[enough], at[j[enough]], score[enough]


def best(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, tie: np.ndarray, most: int) -> np.ndarray:
    """Places of each anchor's first ``most`` entries by falling score, then id."""
    order = np.lexsort((tie, ids, -score, anchor))
    a = anchor[order]
    first = np.searchsorted(a, a, "left")
    return order[np.arange(len(a)) - first < most]


class Join:
    """All usable rows, dealt to blocks, to be joined with blocks of anchors."""

    def __init__(self, rows: DataFrame, is_anchor: Column):
        spark = rows.sparkSession
        C.ship(spark)
        self.rows = C.stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", is_anchor.alias("anchor")), "negatives-rows")
        self.width = V.longest(self.rows, "vector")
        self.order, self.top = self._energy()
        n, anchors = self.rows.count(), self.rows.where("anchor").count()
        cores = spark.sparkContext.defaultParallelism
        block = min(BLOCK, max(LEAST_BLOCK, n // (BLOCKS_PER_CORE * cores)))
        self.row_blocks, self.anchor_blocks = max(1, math.ceil(n / block)), max(1, math.ceil(anchors / BLOCK))
        self.anchors = self.rows.where("anchor").select("row", "vec_id", "label", "vector")

    def _energy(self) -> tuple[np.ndarray, float]:
        """Components by falling energy, and the largest norm."""
        width = self.width

        def scan(batches):
            total, top = np.zeros(width), 0.0
            for b in batches:
                square = V.matrix(b.column(0), width) ** 2
                total += square.sum(axis=0)
                top = max(top, float(square.sum(axis=1).max(initial=0.0)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total), pa.array(np.full(width, top))], names=["at", "energy", "top"])

        found = (self.rows.select("vector").mapInArrow(scan, "at long, energy double, top double")
                 .groupBy("at").agg(F.sum("energy").alias("energy"), F.max("top").alias("top")).collect())  # one row per component
        found.sort(key=lambda r: (-r.energy, r.at))
        return np.array([r.at for r in found], np.int64), math.sqrt(max([0.0, *(r.top for r in found)]))

    def top_matches(self, wanted: DataFrame, same_label: bool, most: int) -> DataFrame:
        """(anchor, slot, row, vec_id, score, place) of the first ``most`` rows of each window.

        ``wanted`` has anchor (a row number) and windows (array of slot, least and top score).
        """
        blocks, rows_in = self.anchor_blocks, self.row_blocks
        order, width = self.order, self.width
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        own = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
        left = (self.anchors.join(wanted, self.anchors["row"] == wanted["anchor"]).select("row", "vec_id", "label", "vector", "windows")
                .withColumn("a", own(blocks)).withColumn("r", every(rows_in)).toDF("row", "vec_id", "label", "vector", "windows", "a", "r"))
        right = self.rows.select("row", "vec_id", "label", "vector").withColumn("a", every(blocks)).withColumn("r", own(rows_in)).toDF("row", "vec_id", "label", "vector", "a", "r")

        def search(some: pa.Table, rows: pa.Table) -> pa.Table:
            col = lambda t, c, kind: np.asarray(t.column(c)).astype(kind)
            if not some.num_rows or not rows.num_rows:
                return pa.table({k: pa.array([], pa.int64()) for k in ("anchor", "slot", "row", "vec_id", "score")})
            windows = some.column("windows").combine_chunks()
            flat, n_windows = windows.flatten(), np.asarray(windows.value_lengths()).astype(np.int64)
            slot, least, top = (np.asarray(flat.field(k)).astype(np.int64) for k in ("slot", "least", "top"))
            owner = np.repeat(np.arange(some.num_rows), n_windows)
            lowest = np.full(some.num_rows, np.inf)
            np.minimum.at(lowest, owner, least)
            ids, number = col(rows, "vec_id", np.int64), col(rows, "row", np.int64)
            mine = col(some, "row", np.int64)
            labels = pa.concat_tables([some.select(["label"]), rows.select(["label"])]).column("label").combine_chunks()
            tags = np.asarray(labels.dictionary_encode().indices)
            anchors, others = V.matrix(some.column("vector"), width)[:, order], V.matrix(rows.column("vector"), width)[:, order]
            first = np.cumsum(n_windows) - n_windows
            out = []
            for lo in range(0, some.num_rows, TOGETHER):
                i, j, score = candidates(anchors[lo:lo + TOGETHER], others, lowest[lo:lo + TOGETHER])
                i += lo
                same = tags[i] == tags[some.num_rows + j]
                good = (same & (mine[i] != number[j])) if same_label else ~same
                i, j, score = i[good], j[good], score[good]
                for k in range(int(n_windows.max(initial=0))):  # the k-th window of every anchor at once
                    has = n_windows[i] > k
                    w = first[i] + np.where(has, k, 0)
                    fits = np.flatnonzero(has & (score >= least[w]) & (score <= top[w]))
                    pick = fits[best(i[fits], score[fits], ids[j[fits]], number[j[fits]], most)]
                    out.append((mine[i[pick]], slot[w[pick]], number[j[pick]], ids[j[pick]], score[pick].astype(np.int64)))
            cols = [np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 5, *out)]
            return pa.table(dict(zip(("anchor", "slot", "row", "vec_id", "score"), cols)))

        found = left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(search, "anchor long, slot long, row long, vec_id long, score long")
        ranked = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= most)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, vector of whole numbers)."""
    join = Join(vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & V.usable(F.col("vector"))), is_anchor)

    def window(slot, least, top) -> Column:
        return F.struct(slot.cast("long").alias("slot"), least.cast("long").alias("least"), top.cast("long").alias("top"))

    # positives: rounds with falling thresholds for the anchors that have too few
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    open_, parts = join.anchors.select(F.col("row").alias("anchor"), norm.alias("norm")), []
    for share in (*SHARES, None):
        limit = F.lit(NO_LIMIT) if share is None else F.floor(F.col("norm") * (share * join.top))
        wanted = open_.select("anchor", F.array(window(F.lit(0), limit, F.lit(1 << 62))).alias("windows"))
        found = C.stage(join.top_matches(wanted, True, positives), "negatives-positives")
        full = found.groupBy("anchor").count().where(F.col("count") >= positives).select("anchor")
        if share is None:
            parts.append(found)
            break
        parts.append(found.join(full, "anchor"))
        open_ = C.stage(open_.join(full, "anchor", "left_anti"), "negatives-open")
        if not open_.limit(1).count():
            break
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    chosen = C.stage(chosen.select("anchor", F.col("place").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-chosen")

    # negatives: a window is open until it is full or its least score was reached
    open_, parts = chosen.select("anchor", "slot", "positive_score"), []
    for hundredths in (max(low, FIRST_HUNDREDTHS), low):
        score = F.col("positive_score")
        # least whole score s with 100 * s >= hundredths * positive, greatest with 100 * s <= high * positive
        edge = window(F.col("slot"), F.expr(f"-floor(-({hundredths} * positive_score) / 100D)"), F.expr(f"floor({high} * positive_score / 100D)"))
        wanted = open_.where(F.lit(low) * score <= F.lit(high) * score).groupBy("anchor").agg(F.collect_list(edge).alias("windows"))
        found = C.stage(join.top_matches(wanted, False, negatives), "negatives-found")
        if hundredths == low:
            parts.append(found)
            break
        full = found.groupBy("anchor", "slot").count().where(F.col("count") >= negatives).select("anchor", "slot")
        parts.append(found.join(full, ["anchor", "slot"]))
        open_ = C.stage(open_.join(full, ["anchor", "slot"], "left_anti"), "negatives-open")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    names = join.anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (found.select("anchor", "slot", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(chosen, ["anchor", "slot"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
