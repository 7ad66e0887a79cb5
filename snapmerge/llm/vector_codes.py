"""Compression of vectors to codes: codebooks per part, assigned through a trie over the distinct parts.

A vector of whole numbers is cut into ``PARTS`` equal consecutive parts.  Each part position has a codebook of
``ENTRIES`` entries, first the parts of the rows with the smallest ids; ``ROUNDS`` times every part goes to its nearest
entry (squared Euclidean distance, ties to the lower index) and an entry becomes the componentwise floor of the mean of
its parts.  An entry without parts stays.

* Distinct parts are counted once on Spark and written in lexicographic order (range partitions, sorted inside), so each
  file holds a run of neighbouring leaves of the position's trie, and copies cost nothing beyond the first.
* A round reads those files.  ``distances`` walks the leaves depth first, ``CHUNK`` at a time: a trie node's vector of
  distances to all entries is its parent's plus one term, computed once for all leaves that share the prefix; the path to
  the last leaf is the stack that the next chunk goes on from.  Leaves take the argmin and add their count-weighted sums.
  A task returns one row per position and entry; Spark sums them, and the driver gets PARTS * ENTRIES rows.
* The final codes walk the trie of each batch of rows, so no row is joined to its parts.

Rows whose vector is null or holds null or non-finite components are dropped.  A null id is no smallest id (only where
fewer ids than entries exist do such rows start a codebook); of repeated ids the rows with the smaller vectors come first.
Vectors shorter than the longest, and a width that PARTS does not divide, are filled up with zeros.  An empty table
gives an empty result.  Exact while components stay below 2^26 (|x| < 2^14 at scale 4096).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C
from snapmerge.llm import vectors as V

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: leaves of the trie handled at once
CHUNK = 8192


class Trie:
    """Depth-first walk over lexicographically sorted, distinct parts that come in chunks."""

    def __init__(self, book: np.ndarray):
        self.book = book  # entries x components
        self.last: np.ndarray | None = None
        self.stack: list[np.ndarray] = []  # distances of the prefixes of the last leaf

    def distances(self, leaves: np.ndarray) -> np.ndarray:
        """Squared distance of every leaf to every entry."""
        n, depth = leaves.shape
        fresh = np.ones((n, depth), bool)  # does the leaf open a node at this depth?
        before = np.empty_like(leaves)
        before[1:] = leaves[:-1]
        before[0] = leaves[0] if self.last is None else self.last
        np.logical_or.accumulate(leaves != before, axis=1, out=fresh)
        if self.last is None:
            fresh[0] = True
            self.stack = [np.zeros(len(self.book), np.int64)] * depth
        above, node_above = np.zeros((1, len(self.book)), np.int64), np.zeros(n, np.int64)
        for d in range(depth):
            opens = np.flatnonzero(fresh[:, d])
            term = leaves[opens, d][:, None] - self.book[None, :, d]
            here = np.empty((len(opens) + 1, len(self.book)), np.int64)
            here[0] = self.stack[d]
            here[1:] = above[node_above[opens]] + term * term
            above, node_above = here, np.cumsum(fresh[:, d])
            self.stack[d] = here[node_above[-1]]
        self.last = leaves[-1].copy()
        return above[node_above]


def nearest(leaves: np.ndarray, book: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of sorted, distinct leaves."""
    trie, code, error = Trie(book), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(leaves), chunk):
        d = trie.distances(leaves[lo:lo + chunk])
        code.append(d.argmin(axis=1))
        error.append(d[np.arange(len(d)), code[-1]])
    return np.concatenate(code), np.concatenate(error)


def _whole(column: pa.Array, width: int) -> np.ndarray:
    return V.matrix(column, width).astype(np.int64)


def distinct_parts(rows: DataFrame, width: int) -> DataFrame:
    """(position, part, n): how often each part occurs, in lexicographic order of position and part over the files."""
    size = width // PARTS
    zeros = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector"))
    cut = F.array(*(F.struct(F.lit(p).alias("position"), F.slice("vector", p * size + 1, size).alias("part")) for p in range(PARTS)))
    parts = (rows.select(F.concat("vector", zeros).alias("vector")).select(F.explode(cut).alias("c"))
             .groupBy("c.position", "c.part").agg(F.count("*").alias("n")))
    return C.stage(parts.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "codes-parts")


def _sums(parts: DataFrame, books: np.ndarray) -> DataFrame:
    """(position, entry, n, total): parts of each entry and their componentwise sums."""
    size = books.shape[2]

    def scan(batches):
        n = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        tries: dict[int, Trie] = {}  # a file is sorted, so its batches go on from the last leaf
        for b in batches:
            position, leaves, times = np.asarray(b.column(0)), _whole(b.column(1), size), np.asarray(b.column(2))
            for p in np.unique(position).tolist():
                at = np.flatnonzero(position == p)
                trie = tries.setdefault(p, Trie(books[p]))
                for lo in range(0, len(at), CHUNK):
                    own = at[lo:lo + CHUNK]
                    code = trie.distances(leaves[own]).argmin(axis=1)
                    weight = np.where(code[None, :] == np.arange(len(books[p]))[:, None], times[own], 0)
                    n[p] += weight.sum(axis=1)
                    total[p] += weight @ leaves[own]
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(n[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
                                         names=["position", "entry", "n", "total"])

    found = parts.mapInArrow(scan, "position long, entry long, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)]
    return found.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.array(*sums).alias("total"))


def learn(rows: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) of ``rows`` (vec_id, vector of whole numbers)."""
    first = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "vector").limit(ENTRIES).select("vector").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r.vector)] = r.vector
    books = start.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    parts = distinct_parts(rows, width)
    for _ in range(rounds):
        for r in _sums(parts, books).collect():  # at most PARTS * ENTRIES rows
            books[r.position, r.entry] = [t // r.n for t in r.total]
    return books


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Columns of ``rows`` without vector, plus code (list of entry numbers) and error."""
    width = books.shape[0] * books.shape[2]
    keep = [c for c in rows.columns if c != "vector"]

    def scan(batches):
        for b in batches:
            m = _whole(b.column(b.schema.get_field_index("vector")), width).reshape(b.num_rows, *books.shape[::2])
            code, error = np.zeros((b.num_rows, len(books)), np.int32), np.zeros(b.num_rows, np.int64)
            for p, book in enumerate(books):
                leaves, which = np.unique(m[:, p], axis=0, return_inverse=True)
                entry, d = nearest(leaves, book)
                code[:, p] = entry[which.ravel()]
                error += d[which.ravel()]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(list(code), pa.list_(pa.int32())), pa.array(error)],
                                             names=[*keep, "code", "error"])

    return rows.mapInArrow(scan, C.with_fields(rows, ("vector",), "code array<int>, error long"))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of the codebooks' components by part, entry and position within the part, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The usable rows of ``vectors`` without the vector, plus code (list of entries) and error; and the codebooks.

    ``vectors`` has ``vec_id`` and ``vector``; other columns pass through.
    """
    C.ship(vectors.sparkSession)
    books = np.zeros((PARTS, 0, 1), np.int64)

    def work(inner: DataFrame) -> DataFrame:
        nonlocal books
        rows = inner.where(V.usable(F.col(vector))).withColumn("vector", V.scaled_down(F.col(vector), scale)).drop(*({vector} - {"vector"}))
        rows = C.stage(rows, "codes-rows")
        width = -(-max(1, V.longest(rows, "vector")) // PARTS) * PARTS
        books = learn(rows, width, rounds)
        return assign(rows, books) if books.shape[1] else rows.select(*(c for c in rows.columns if c != "vector"), F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))

    out = C.beside(vectors, ["vec_id", vector], ["code", "error"], work)
    return out, books


def error_by(coded: DataFrame, label: str) -> DataFrame:
    """``coded`` plus label_error: the errors summed over equal labels, nulls together."""
    total = coded.groupBy(F.col(label).alias("_of")).agg(F.sum("error").alias("label_error"))
    total = C.stage(total, "codes-labels")  # written, so that Spark knows its size before the join
    return coded.join(total, coded[label].eqNullSafe(total["_of"])).drop("_of")
