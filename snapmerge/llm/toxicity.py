"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios, trained on labelled text.

Text is reduced to lower-case letters, digits (as 0), other code points and blanks (all else), and its n-grams of
``SIZES`` bytes are hashed into ``2**BITS`` features, present or absent in a document.  For each feature the log-count
ratio r = log((p + 1) / (sum p + F)) - log((q + 1) / (sum q + F)) comes from the toxic and other documents that hold
it; the ``FEATURES`` ones with the most significant difference are kept, and a ridge-penalised logistic regression is
fitted on r times presence.

Training uses at most about ``MAX_TRAIN`` labelled rows (a hash of doc_id picks them if there are more); with them fixed, the
fit reads their whole texts.  The counts are summed on Spark; the driver gets two count vectors and, for each training
row, its kept features.  Every document is scored on its whole text.

Without labels of both classes the score is the share of toxic labels (0 without any).  Null and empty texts are scored
by the intercept.  A label row with null label, or labels that differ for one doc_id, count as toxic if any says so;
repeated documents get equal scores each; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C

SIZES = (4, 5, 6)
BITS = 20
FEATURES = 8192
MAX_TRAIN = 20_000
PENALTY = 3.0
THRESHOLD = 0.3

_CLASS = np.full(256, 0x20, np.uint8)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x80:] = np.arange(0x80, 0x100)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) mod parts is ``part`` (null doc_id: crc32 of no bytes)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``rows``, or about ``most`` of them picked by a hash of ``key`` (where it is null: of the text)."""
    n = rows.count()
    if n <= most:
        return rows
    h = F.xxhash64(F.col(key), F.lit("sample"))
    if "text" in rows.columns:
        h = F.when(F.col(key).isNull(), F.xxhash64("text", F.lit("sample"))).otherwise(h)
    return rows.where(F.pmod(h, F.lit(1_000_000)) < int(1_000_000 * most / n))


def bounded_rows(rows: DataFrame, most: int) -> DataFrame:
    """Rows of (doc_id, text, ...), or, where they are over a tenth more than ``most`` since ids repeat, about ``most`` of the different ones."""
    if rows.count() <= 1.1 * most:
        return rows
    h = F.xxhash64("doc_id", "text", F.lit("row"))
    keyed = rows.withColumn("_row", h)
    n = keyed.agg(F.count_distinct("_row")).first()[0]
    picked = keyed.where(F.pmod("_row", F.lit(1_000_000)) < max(1, int(1_000_000 * most / n)))
    return picked.groupBy("_row").agg(*(F.first(c).alias(c) for c in rows.columns)).drop("_row")


def ngrams(column: pa.Array, sizes: tuple[int, ...], bits: int):
    """(row, feature) of every n-gram of every text, with repeats; a blank stands before and after each text."""
    data, offsets = C.text_bytes(column)
    n = len(offsets) - 1
    at = offsets + np.arange(n + 1)  # one blank before each row, one after the last
    flat = np.full(len(data) + n + 1, 0x20, np.uint8)
    inside = np.ones(len(flat), bool)
    inside[at] = False
    flat[inside] = _CLASS[data]
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(at))
    code = flat.astype(np.uint64)
    for size in sizes:
        m = len(flat) - size + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint64)
        for j in range(size):
            h |= code[j:j + m] << np.uint64(8 * j)
        ends = np.minimum(np.arange(m) + size - 2, len(rows) - 1)
        same = rows[:m] == rows[ends]  # an n-gram may end with the blank after its row
        f = ((h ^ np.uint64(size << 56)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        yield rows[:m][same], f[same].astype(np.int64)


def _presence(column: pa.Array, bits: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, only of the wanted features if given (``wanted[feature]``: its number or -1)."""
    keys = [np.zeros(0, np.int64)]
    for rows, f in ngrams(column, SIZES, bits):
        if wanted is not None:
            f = wanted[f]
            ok = f >= 0
            rows, f = rows[ok], f[ok]
        keys.append((rows.astype(np.int64) << 32) | f)
    pairs = np.unique(np.concatenate(keys))
    return pairs >> 32, pairs & 0xFFFFFFFF


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic regression on a sparse matrix (accelerated gradient descent)."""
    n, m = len(y), int(len(values))
    x = values[cols]
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    # a bound of the loss's curvature, by power iteration on X'X / 4
    v = np.ones(m) / np.sqrt(m)
    for _ in range(12):
        z = np.bincount(cols, x * np.bincount(rows, x * v[cols], n)[rows], m)
        top = np.linalg.norm(z) + 1e-12
        v = z / top
    rate = 1 / (1.1 * (top + n) / 4 + penalty)
    pw, pb, t = w, b, 1.0
    for _ in range(steps):
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yb = w + (t - 1) / s * (w - pw), b + (t - 1) / s * (b - pb)
        e = 1 / (1 + np.exp(-np.clip(np.bincount(rows, x * yw[cols], n) + yb, -30, 30))) - y
        pw, pb, t = w, b, s
        w = yw - rate * (np.bincount(cols, x * e[rows], m) + penalty * yw)
        b = yb - rate * e.sum()
    return w, b


def train(labelled: DataFrame, bits: int = BITS, features: int = FEATURES, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weight of each hashed feature, and intercept, from staged rows (text, label 0/1)."""
    size = 1 << bits
    chunk = 1 << 14

    def counts(batches):
        held = np.zeros((3, size), np.int32)
        docs = np.zeros(2, np.int64)
        for b in batches:
            for part in C.slices(b, "text"):
                y = np.asarray(part.column(part.schema.get_field_index("label"))).astype(np.int64)
                rows, f = _presence(part.column(part.schema.get_field_index("text")), bits)
                for c in (0, 1):
                    held[c] += np.bincount(f[y[rows] == c], minlength=size).astype(np.int32)
                docs += np.bincount(y, minlength=2)
        if docs.sum():
            held[2, :2] = docs
            for lo in range(0, size, chunk):
                yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([held[:, lo:lo + chunk].tobytes()])], names=["lo", "held"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(h.as_py(), np.int32).astype(np.int64) for h in table.column("held"))
        return pa.table({"lo": table.column("lo")[:1], "held": [total.astype("<i8").tobytes()]})

    held = np.zeros((3, size))
    for r in labelled.select("text", "label").mapInArrow(counts, "lo int, held binary").groupBy("lo").applyInArrow(added, "lo int, held binary").collect():
        held[:, r["lo"]:r["lo"] + chunk] = np.frombuffer(r["held"], "<i8").reshape(3, -1)
    n0, n1 = held[2, 0], held[2, 1]
    if not n0 or not n1:
        share = n1 / max(1, n0 + n1)
        return np.zeros(size), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    q, p = held[0], held[1]
    ratio = np.log((p + 1) / (p.sum() + size)) - np.log((q + 1) / (q.sum() + size))
    share = (p + q) / (n0 + n1)
    z = np.abs(p / n1 - q / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n0 + 1 / n1))
    z[(p + q) < 3] = 0
    kept = np.sort(np.argsort(-z, kind="stable")[:features])
    kept = kept[z[kept] > 0]
    wanted = np.full(size, -1, np.int64)
    wanted[kept] = np.arange(len(kept))
    sent = labelled.sparkSession.sparkContext.broadcast(wanted.astype(np.int32))  # 4 * 2**bits bytes

    def marked(batches):
        table = sent.value
        for b in batches:
            for part in C.slices(b, "text"):
                rows, f = _presence(part.column(part.schema.get_field_index("text")), bits, table)
                at = np.searchsorted(rows, np.arange(part.num_rows + 1))
                f = f.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("label")).cast(pa.int32()), pa.array([f[a:b].tobytes() for a, b in zip(at, at[1:])])], names=["label", "held"])

    got = labelled.select("text", "label").mapInArrow(marked, "label int, held binary").collect()  # MAX_TRAIN rows, FEATURES ids each at most
    cols = [np.frombuffer(r["held"], "<u2") for r in got]
    y = np.array([r["label"] for r in got], dtype=float)
    w, b = logistic(np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols).astype(np.int64), ratio[kept], y, penalty)
    out = np.zeros(size)
    out[kept] = w * ratio[kept]
    return out, b


def score(docs: DataFrame, weights: np.ndarray, intercept: float) -> DataFrame:
    """Columns of ``docs`` without text, plus score; ``weights`` has a number for each of its 2**bits features."""
    bits = len(weights).bit_length() - 1
    kept = np.flatnonzero(weights)
    wanted = np.full(len(weights), -1, np.int32)
    wanted[kept] = np.arange(len(kept))
    sent = docs.sparkSession.sparkContext.broadcast((wanted, weights[kept]))  # fixed by BITS and FEATURES
    keep = [c for c in docs.columns if c != "text"]

    def scan(batches):
        table, w = sent.value
        for b in batches:
            for part in C.slices(b, "text"):
                rows, f = _presence(part.column(part.schema.get_field_index("text")), bits, table)
                total = np.bincount(rows, w[f], part.num_rows) if len(f) else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(total + intercept, -500, 500))))],
                    names=[*keep, "score"])

    return docs.mapInArrow(scan, C.with_fields(docs, ("text",), "score double"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, label) of a bounded sample of the labelled documents, also where an id has many rows."""
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    picked = bounded_sample(picked, "doc_id", most)
    labelled = C.stage(docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "label"), "labelled")
    return bounded_rows(labelled, most).select("text", "label")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, max_train: int = MAX_TRAIN, **fit) -> DataFrame:
    """Columns of ``docs`` without text, plus score and predicted; ``labels`` holds only rows to learn from."""
    C.ship(docs.sparkSession)
    weights, intercept = train(training_rows(docs, labels, label, max_train), **fit)
    return C.beside(docs, ["text"], ["score", "predicted"],
                    lambda inner: score(inner, weights, intercept).withColumn("predicted", (F.col("score") >= threshold).cast("int")))
