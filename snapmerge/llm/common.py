"""Helpers shared by the corpus operators: staging tables, shipping code, byte-level text kernels."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: lower-cases the ASCII letters of UTF-8 bytes and leaves every other byte alone
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: texts are handled in slices of about this many bytes, so a task's memory does not follow the batch
SLICE_BYTES = 512 << 10
#: rows of an Arrow batch between Spark and Python
BATCH_ROWS = 1000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a private one only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{scratch_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    for kept in _SCRATCH:
        kept.append(staged)
    return staged


_SCRATCH: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables staged inside are deleted at the end, but for those that the caller takes off the list.

    For work whose result has been written; if it fails, its tables stay for inspection.
    """
    made: list[DataFrame] = []
    _SCRATCH.append(made)
    try:
        yield made
        drop(*made)
    finally:
        _SCRATCH.remove(made)


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made from them has been staged itself."""
    for t in tables:
        spark = t.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (``addPyFile``), once per Spark context, and bound Arrow batches.

    Batches of Spark's default 10,000 documents can hold a gigabyte of text; where nobody set another size they get BATCH_ROWS.
    """
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(rows):
        spark.conf.set(rows, str(BATCH_ROWS))
    if getattr(sc, "_corpus_code_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="corpus-code-"), "corpus_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    sc._corpus_code_sent = True


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def beside(docs: DataFrame, needs: list[str], adds: list[str], work) -> DataFrame:
    """``work`` on the columns it needs, the others kept out of its way under private names and given back after.

    Of the needed columns those come back that ``work`` returns; a column that it adds takes the place of one of ``docs`` with that name.
    """
    new = {a.lower() for a in adds}
    others = [c for c in docs.columns if c not in needs]
    out = work(docs.select(*needs, *(F.col(f"`{c}`").alias(f"_extra{i}") for i, c in enumerate(others))))
    back = [F.col(c) for c in needs if c in out.columns and c.lower() not in new]
    back += [F.col(f"_extra{i}").alias(c) for i, c in enumerate(others) if c.lower() not in new and f"_extra{i}" in out.columns]
    return out.select(*back, *adds)


def with_fields(docs: DataFrame, without: tuple[str, ...], added: str) -> T.StructType:
    """Schema of the columns of ``docs`` but some, followed by those of the DDL text ``added``."""
    return T.StructType([f for f in docs.schema.fields if f.name not in without] + T.StructType.fromDDL(added).fields)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its rows (nulls: empty)."""
    a = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of ``batch`` with about ``limit`` bytes of ``column`` each (a longer row stands alone)."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over byte values, true inside the inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


#: separators of the words ``[^\x20\x09-\x0D]+``
SPACE_BYTES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased
ALNUM_BYTES = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross rows: starts, ends, and the number of runs before each row."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant modulo 2^64 and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (256 << 10))
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _POWERS[name] = np.multiply.accumulate(t)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one prefix sum over the slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive values of ``h`` (shorter input: none)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    g = h[:len(h) - k + 1].copy()
    for j in range(1, k):
        g = mix(g * np.uint64(_ODD) + h[j:len(h) - k + 1 + j])
    return g


def row_of(index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The row that each item index belongs to, given the number of items before each row."""
    return np.searchsorted(first, index, "right") - 1
