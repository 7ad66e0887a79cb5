"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are labelled documents of good quality; the unlabelled set is a sample of all documents, whatever
their labels.  The share of positives in it (the class prior) is estimated, then a linear model g on text-shape
features is fitted to the non-negative unbiased risk

    prior * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - prior * E_pos[loss(-g)]),    loss(z) = log(1 + exp(-z)).

Where the second part falls below zero on a batch, the step goes against its gradient instead.  Negative labels are never read.

Prior: a model of positives against unlabelled is fitted on one half of both sets; on the other half, above a score
threshold, the ratio of the unlabelled share to the positive share bounds the prior, and the threshold with the least
upper confidence bound is taken.

Features: square roots of the frequencies of byte classes and of pairs of them, the number of words, word length, the
share of distinct words, of words equal to the one or two before, and of words in repeated windows.

At most about ``MAX_TRAIN`` documents of each set are read for the fit (picked by a hash of doc_id), with whole texts.
All documents are scored on whole texts.  Without positives every score is 0.5.  Null and empty texts are scored
by their features, which are all zero; repeated rows get equal results each; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C
from snapmerge.llm.line_rules import word_counts
from snapmerge.llm.toxicity import bounded_rows, bounded_sample

MAX_TRAIN = 8000
THRESHOLD = 0.5
STEPS = 600
RATE = 0.02
RIDGE = 1e-4
CLASSES = 16


def _classes() -> np.ndarray:
    """Byte classes: lower, upper, digit, blank, newline, groups of marks, other ASCII, lead and other UTF-8 bytes."""
    t = np.full(256, 12, np.int64)
    t[0x61:0x7B], t[0x41:0x5B], t[0x30:0x3A], t[0x80:0xC0], t[0xC0:] = 0, 1, 2, 13, 14
    for k, marks in enumerate((b" \t", b"\n\r", b".", b",;:", b"!?", b"|", b"#*$%&<>", b"()[]{}\"'", b"-_/=+\\@~^`"), 3):
        t[np.frombuffer(marks, np.uint8)] = k
    t[:9] = t[0x0E:0x20] = 15
    return t


_CLASS = _classes()
WIDTH = CLASSES + CLASSES ** 2 + 7


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text (float32)."""
    data, offsets = C.text_bytes(column)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    c = _CLASS[data]
    single = np.bincount(rows * CLASSES + c, minlength=n * CLASSES).reshape(n, -1)
    same = rows[1:] == rows[:-1]
    pair = np.bincount((rows[:-1] * CLASSES ** 2 + c[:-1] * CLASSES + c[1:])[same], minlength=n * CLASSES ** 2).reshape(n, -1)
    starts, ends, first = C.spans(~C.SPACE_BYTES[data], offsets)
    h = C.span_hashes(data, starts, ends)
    words = np.diff(first)
    many = np.maximum(words, 1).astype(np.float64)
    row = np.repeat(np.arange(n), words)
    distinct = np.unique((row.astype(np.uint64) << np.uint64(40)) ^ (h >> np.uint64(24)))
    kinds = np.bincount((distinct >> np.uint64(40)).astype(np.int64), minlength=n)[:n] if len(distinct) else np.zeros(n)
    again = [np.bincount(row[k:][(h[k:] == h[:-k]) & (row[k:] == row[:-k])], minlength=n) if len(h) > k else np.zeros(n) for k in (1, 2)]
    counts = word_counts(column)
    extra = np.stack([np.log1p(words), np.log1p(counts["word_chars"] / many), kinds / many, again[0] / many, again[1] / many,
                      counts["n_repeat_words"] / many, np.minimum(1, words / 10)], axis=1)
    return np.concatenate([np.sqrt(single / size[:, None]), np.sqrt(pair / size[:, None]), extra], axis=1).astype(np.float32)


def _loss_slope(z: np.ndarray) -> np.ndarray:
    """Derivative of log(1 + exp(-z))."""
    return -1 / (1 + np.exp(np.clip(z, -30, 30)))


def _adam(x_pos, x_unl, gradient, steps=STEPS, rate=RATE):
    """Minimise by Adam; ``gradient`` maps the scores of both sets to the weights of their rows in the gradient."""
    w = np.zeros(x_pos.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        a, b = gradient(x_pos @ w, x_unl @ w)
        g = x_pos.T @ a + x_unl.T @ b + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (1 - k / (steps + 1)) * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return w


def estimate_prior(x_pos: np.ndarray, x_unl: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, by the best upper bin of a classifier's scores."""
    p, u = x_pos[::2], x_unl[::2]
    w = _adam(p, u, lambda a, b: (_loss_slope(a) / len(a), -_loss_slope(-b) / len(b)), steps=STEPS // 2)
    sp, su = np.sort(x_pos[1::2] @ w), np.sort(x_unl[1::2] @ w)
    if not len(sp) or not len(su):
        return 0.5
    at = sp[: max(1, int(len(sp) * 0.9))]  # thresholds with at least a tenth of the positives above them
    qp, qu = 1 - np.arange(len(at)) / len(sp), 1 - np.searchsorted(su, at, "left") / len(su)
    slack = np.sqrt(np.log(4 / delta) / 2)
    bound = (qu + slack / np.sqrt(len(su)) + qu / qp * slack / np.sqrt(len(sp))) / qp
    best = int(np.argmin(bound))
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def fit(x_pos: np.ndarray, x_unl: np.ndarray, prior: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean, deviation and weights (the last is the intercept) of the non-negative fit, and the prior it used."""
    mean, std = x_unl.mean(axis=0), x_unl.std(axis=0)
    scaled = lambda x: _scaled(x, mean, std)
    p, u = scaled(x_pos), scaled(x_unl)
    prior = estimate_prior(p, u) if prior is None else prior

    def gradient(a, b):
        soft = lambda z: np.logaddexp(0, -z)
        negative = soft(-b).mean() - prior * soft(-a).mean()
        away_p, away_u = prior * _loss_slope(-a) / len(a), -_loss_slope(-b) / len(b)
        if negative < 0:
            return -away_p, -away_u
        return prior * _loss_slope(a) / len(a) + away_p, away_u

    return mean, std, _adam(p, u, gradient), prior


def _scaled(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / np.maximum(std, 1e-3), -6, 6)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _sample(docs: DataFrame) -> np.ndarray:
    """Features of a bounded sample of documents, on the driver (MAX_TRAIN rows of WIDTH numbers)."""
    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                x = features(part.column(part.schema.get_field_index("text")))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])
    rows = docs.select("text").mapInArrow(scan, "x binary").collect()
    return np.array([np.frombuffer(r["x"], np.float32) for r in rows], dtype=np.float64).reshape(len(rows), WIDTH)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, most: int = MAX_TRAIN,
             prior: float | None = None) -> DataFrame:
    """Columns of ``docs`` without text, plus score and predicted; of ``labels`` only the positive rows are used."""
    C.ship(docs.sparkSession)
    trusted = labels.where((F.col(label) == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    trusted = C.stage(bounded_sample(trusted, "doc_id", most), "trusted")
    x_pos = _sample(bounded_rows(docs.select("doc_id", "text").join(trusted, "doc_id"), most))
    x_unl = _sample(bounded_rows(bounded_sample(docs.select("doc_id", "text"), "doc_id", most), most))
    model = fit(x_pos, x_unl, prior)[:3] if len(x_pos) > 1 and len(x_unl) > 1 else None

    return C.beside(docs, ["text"], ["score", "predicted"],
                    lambda inner: _scored(inner, model).withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def _scored(docs: DataFrame, model: tuple | None) -> DataFrame:
    keep = [c for c in docs.columns if c != "text"]

    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                if model is None:
                    s = np.full(part.num_rows, 0.5)
                else:
                    mean, std, w = model
                    s = 1 / (1 + np.exp(-np.clip(_scaled(features(part.column(part.schema.get_field_index("text"))), mean, std) @ w, -500, 500)))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(s)], names=[*keep, "score"])

    return docs.mapInArrow(scan, C.with_fields(docs, ("text",), "score double"))
