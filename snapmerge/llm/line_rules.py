"""Quality rules: per-text word rules, and lines that too many documents of a host share.

Lines are normalised (lower case, digits to 0, white space to one space) and hashed.  Within a host (``source``) the
distinct documents of each line are counted; equal texts of a host count as one document, so a mere copy makes no line
common.  A whole corpus is cleaned with one vote per class of edited copies (``copy_classes``), so a group of near copies
does not outvote its own lines and is left for the near-duplicate stage.  A line is boilerplate if more than ``MIN_DOCS`` documents and more than ``MAX_SHARE`` of the host's documents
hold it.  Boilerplate lines go; a document that loses more than ``MAX_LOSS`` of its words is depleted and rejected.

Null text has no words (it fails the base rule); null source is a host of its own; repeated rows get equal results;
other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C
from snapmerge.llm import simhash

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
MIN_DOCS = 10
MAX_SHARE = 0.05
MAX_LOSS = 0.5
#: a text with this share of its words in lines that more than ``MIN_DOCS`` texts hold may be an edited copy of another
COPY_SHARE = 0.8
#: copies agree in all ROWS weighted minimum hashes of one of BANDS bands
BANDS, ROWS = 32, 7

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
WHITE = " \t\n\x0b\x0c\r"
_DIGITS = str.maketrans("123456789", "000000000")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_key(line: str) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh3_64_intdigest(" ".join(line.lower().split()).translate(_DIGITS).encode()) - (1 << 63)


def text_lines(text: str) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier line, and the words of each normalised line's key (lines without words left out)."""
    seen, repeated, words = set(), 0, {}
    for line in text.split("\n"):
        if line.strip(WHITE):
            if line in seen:
                repeated += 1
            seen.add(line)
            k = line_key(line)
            words[k] = words.get(k, 0) + len(line.encode().split())
    return repeated, words


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[offsets])


def word_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols and n_repeat_words of each text."""
    data, offsets = C.text_bytes(column)
    inside = ~C.SPACE_BYTES[data]
    starts, ends, first = C.spans(inside, offsets)
    h = C.span_hashes(data, starts, ends)
    covered = np.zeros(len(h), np.int64)
    g = C.gram_hashes(h, REPEAT_WINDOW)
    if len(g):
        rows = C.row_of(np.arange(len(g)), first)
        at = np.flatnonzero(np.arange(len(g)) + REPEAT_WINDOW <= first[rows + 1])
        _, which, count = np.unique(C.mix(g[at] + C.mix(rows[at].astype(np.uint64))), return_inverse=True, return_counts=True)
        twice = at[count[which] > 1]
        mark = np.zeros(len(h) + 1, np.int64)
        np.add.at(mark, twice, 1)
        np.add.at(mark, twice + REPEAT_WINDOW, -1)
        covered = (np.cumsum(mark[:-1]) > 0).astype(np.int64)
    return {"n_words": np.diff(first), "word_chars": _per_row(inside & ((data & 0xC0) != 0x80), offsets),
            "n_symbols": _per_row(SYMBOLS[data], offsets), "n_repeat_words": _per_row(covered, first)}


def measure(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Columns of ``docs`` plus the base counts, ``host``, ``text_key`` and ``lines`` (key and words of each line)."""
    C.ship(docs.sparkSession)
    docs = docs.withColumn("host", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    keep = [c for c in docs.columns if with_text or c != "text"]

    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                col = part.column(part.schema.get_field_index("text"))
                n = word_counts(col)
                texts = [t or "" for t in col.to_pylist()]
                found = [text_lines(t) for t in texts]
                n["n_dup_lines"] = np.array([f[0] for f in found], np.int64)
                lines = pa.array([[{"k": k, "n": w} for k, w in f[1].items()] for f in found],
                                 pa.list_(pa.struct([("k", pa.int64()), ("n", pa.int32())])))
                keys = pa.array([xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), *(pa.array(n[c], pa.int64()) for c in _COUNTS), keys, lines],
                    names=[*keep, *_COUNTS, "text_key", "lines"])

    counts = "".join(f"{c} long, " for c in _COUNTS)
    return docs.mapInArrow(scan, C.with_fields(docs, () if with_text else ("text",), f"{counts}text_key long, lines array<struct<k: long, n: int>>"))


def copy_buckets(keys: np.ndarray, words: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per band of a text's lines, each line weighted by its words."""
    out = np.zeros(bands, np.uint64)
    step = max(1, (1 << 20) // (rows * len(keys)))
    for lo in range(0, bands, step):
        n = min(step, bands - lo)
        seeds = C.mix(np.arange(lo * rows + 1, (lo + n) * rows + 1, dtype=np.uint64))
        draws = (C.mix(keys[:, None] ^ seeds[None, :]) >> np.uint64(11)).astype(np.float64) + 0.5
        low = keys[np.argmin(-np.log(draws / (1 << 53)) / words[:, None], axis=0)].reshape(n, rows)
        h = np.arange(lo + 1, lo + n + 1, dtype=np.uint64)
        for j in range(rows):
            h = C.mix(h * np.uint64(C._ODD) + low[:, j])
        out[lo:lo + n] = h
    return out


def copy_classes(texts: DataFrame, held: DataFrame) -> DataFrame:
    """(host, text_key, vote): texts of a host whose common lines are nearly the same words share a vote."""
    words = texts.select("host", "text_key", F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("words"))
    shared = held.groupBy("host", "text_key").agg(F.sum("n").alias("shared"), F.collect_list(F.struct("k", "n")).alias("lines"))
    copies = (shared.join(words, ["host", "text_key"]).where(F.col("shared") >= COPY_SHARE * F.col("words"))
              .select(F.xxhash64("host").alias("h"), F.xxhash64("host", "text_key").alias("a"), "lines"))

    def buckets(batches):
        for b in batches:
            hosts, own, lines = np.asarray(b.column(0)).view(np.uint64), np.asarray(b.column(1)), b.column(2)
            edges = np.asarray(lines.offsets)
            keys, words = (np.asarray(lines.values.field(c)) for c in ("k", "n"))
            found = np.zeros((b.num_rows, BANDS), np.uint64)
            for i, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                found[i] = copy_buckets(keys[lo:hi].view(np.uint64), words[lo:hi].astype(np.float64)) + hosts[i]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, BANDS)), pa.array(C.mix(found.ravel()).view(np.int64))], names=["a", "b"])

    roots = simhash.components(copies.mapInArrow(buckets, "a long, b long")).toDF("v", "root")
    return (texts.select("host", "text_key", F.xxhash64("host", "text_key").alias("v")).join(roots, "v", "left")
            .select("host", "text_key", F.coalesce("root", "v").alias("vote")))


def boilerplate(measured: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, copies_once: bool = False) -> DataFrame:
    """(host, k) of the lines above the limits; with ``copies_once`` a class of edited copies counts as one document."""
    texts = measured.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    if copies_once:
        texts = C.stage(texts, "rules-texts")
        held = texts.select("host", "text_key", F.explode("lines").alias("l")).select("host", "text_key", F.col("l.k").alias("k"), F.col("l.n").alias("n"))
        often = C.stage(held.groupBy("host", "k").count().where(F.col("count") > min_docs).select("host", "k"), "rules-often")
        held = C.stage(held.join(often, ["host", "k"]), "rules-held")
        votes = C.stage(copy_classes(texts, held), "rules-votes")
        hosts = votes.groupBy("host").agg(F.count_distinct("vote").alias("host_docs"))
        common = held.join(votes, ["host", "text_key"]).groupBy("host", "k").agg(F.count_distinct("vote").alias("n"))
        C.drop(texts, often)
    else:
        hosts = measured.groupBy("host").agg(F.count_distinct("text_key").alias("host_docs"))
        common = texts.select("host", F.explode("lines.k").alias("k")).groupBy("host", "k").agg(F.count("*").alias("n"))
    common = common.where(F.col("n") > min_docs)
    return common.join(hosts, "host").where(F.col("n") > max_share * F.col("host_docs")).select("host", "k")


def judge(docs: DataFrame, with_text: bool = False, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_loss: float = MAX_LOSS,
          copies_once: bool = False) -> DataFrame:
    """Columns of ``docs`` plus the base counts, base_failed, removed_words, removed (keys of the lines to remove) and kept."""
    return C.beside(docs, ["text", "source"], [*_COUNTS, "base_failed", "removed_words", "removed", "kept"],
                    lambda inner: _judged(inner, with_text, min_docs, max_share, max_loss, copies_once))


def _judged(docs: DataFrame, with_text: bool, min_docs: int, max_share: float, max_loss: float, copies_once: bool) -> DataFrame:
    measured = C.stage(measure(docs, with_text), "rules-docs")
    limits = C.stage(boilerplate(measured, min_docs, max_share, copies_once), "rules-lines")
    lost = (measured.select("host", "text_key", "lines").where(F.size("lines") > 0)
            .select("host", "text_key", F.explode("lines").alias("l")).select("host", "text_key", F.col("l.k").alias("k"), F.col("l.n").alias("n"))
            .join(limits, ["host", "k"]).distinct()
            .groupBy("host", "text_key").agg(F.sum("n").alias("removed_words"), F.collect_list("k").alias("removed")))
    lost = C.stage(lost, "rules-lost")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (measured.drop("lines").join(lost, ["host", "text_key"], "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= max_loss * F.col("n_words"))))


def without(text: str | None, keys: list[int] | None) -> str | None:
    """The text without the lines of these keys."""
    if text is None or not keys:
        return text
    gone = set(keys)
    return "\n".join(x for x in text.split("\n") if not (x.strip(WHITE) and line_key(x) in gone))


def clean(docs: DataFrame, **limits) -> DataFrame:
    """Rows of ``docs`` that are kept, boilerplate lines removed from their text, columns unchanged (n_chars set anew).

    Edited copies vote once, so the near-duplicate stage still finds all of them.
    """
    needs = [c for c in ("text", "source", "n_chars") if c in docs.columns]
    return C.beside(docs, needs, [], lambda inner: _cleaned(inner, limits)).select(*(f"`{c}`" for c in docs.columns))


def _cleaned(docs: DataFrame, limits: dict) -> DataFrame:
    names = docs.columns
    found = judge(docs, with_text=True, **{"copies_once": True, **limits}).where("kept").select(*names, "removed")

    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                cols = {c: part.column(part.schema.get_field_index(c)) for c in names}
                removed = part.column(part.schema.get_field_index("removed")).to_pylist()
                texts = [without(t, r) for t, r in zip(cols["text"].to_pylist(), removed)]
                if "n_chars" in cols:
                    old = cols["n_chars"].to_pylist()
                    cols["n_chars"] = pa.array([len(t) if r and t is not None else o for t, r, o in zip(texts, removed, old)], cols["n_chars"].type)
                cols["text"] = pa.array(texts, cols["text"].type)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return found.mapInArrow(scan, docs.schema)
