"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words (a shorter item, if it has words, is one window).  A window is a
set of word shingles, and a document contains it only if it holds all of them, so for full containment one necessary
prefix token is enough: the window's rarest shingle, rarity being the shingle's count in the documents.

1. Documents are scanned once.  A bitmap of fixed size (``2**BITS`` bits, whatever the benchmark's size) tells which
   shingles may occur in the benchmark.  A window of n words shows as n - k + 1 consecutive such shingles, so only
   runs of at least the shortest such length are kept: the length filter.  False hits of the bitmap are harmless.
2. The shingles of the kept runs are counted; each window takes its rarest one as its prefix.
3. Prefix join on the shingle, positional bound (the window must fit around the shingle's place in the run), then
   word-by-word comparison of the window.

Null and word-less texts have no hits; items without words or without ``item_id`` have no windows; repeated items and
rows count once per item_id; everything is derived from the text alone, so repeated rows get equal results each.
Extra columns are ignored except in :func:`remove_contaminated`, which keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C

WINDOW = 13
#: words of a prefix shingle (windows with fewer words: the whole window)
SHINGLE = 5
#: log2 of the bits of the benchmark's bitmap (2 MB)
BITS = 24
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(C.ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 1)


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, words, len, k) and their items (wid, item_id)."""
    items = (benchmark.select(F.col("item_id"), _words(F.col("text")).alias("w"))
             .where(F.col("item_id").isNotNull() & (F.size("w") > 0)))
    each = items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))),
        lambda i: F.slice("w", i + 1, window))).alias("words"))
    each = each.withColumn("wid", F.md5(F.array_join("words", " "))).dropDuplicates(["wid", "item_id"])
    windows = (each.dropDuplicates(["wid"])
               .select("wid", "words", F.size("words").alias("len"),
                       F.least(F.size("words"), F.lit(shingle)).alias("k")))
    return windows, each.select("wid", "item_id")


def _scan(batch: pa.RecordBatch, column: str):
    """Slices of the batch with the place, hash and row of every word."""
    for part in C.slices(batch, column):
        data, offsets = C.text_bytes(part.column(part.schema.get_field_index(column)))
        data = np.frombuffer(data.tobytes().translate(C.LOWER_TABLE), dtype=np.uint8)
        starts, ends, first = C.spans(C.ALNUM_BYTES[data], offsets)
        yield part, data, starts, ends, first, C.span_hashes(data, starts, ends)


def _bitmap(windows: DataFrame, bits: int) -> tuple[np.ndarray, dict[int, int]]:
    """The bitmap of all shingles of all windows, and for each shingle length the shortest run of shingles a window needs."""
    least = {int(r["k"]): int(r["least"]) for r in
             windows.groupBy("k").agg(F.min(F.col("len") - F.col("k") + 1).alias("least")).collect()}  # at most SHINGLE rows

    def hashed(batches):
        for b in batches:
            for part, _, _, _, first, h in _scan(b, "text"):
                k = np.asarray(part.column(part.schema.get_field_index("k")))
                for size in np.unique(k):
                    g = C.gram_hashes(h, int(size))
                    rows = C.row_of(np.arange(len(g)), first)
                    whole = (np.arange(len(g)) + size <= first[rows + 1]) & (k[rows] == size)
                    at = np.unique((g[whole] + np.uint64(size)) >> np.uint64(64 - bits))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((at >> np.uint64(6)).astype(np.int64)),
                         pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["slot", "bits"])

    rows = (windows.select(F.array_join("words", " ").alias("text"), "k")
            .mapInArrow(hashed, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).collect())
    table = np.zeros(1 << (bits - 6), dtype=np.int64)  # the collected rows are its non-zero words: 2 MB at most
    for r in rows:
        table[r["slot"]] = r["bits"]
    return table.view(np.uint64), least


def _candidates(docs: DataFrame, windows: DataFrame, bits: int) -> DataFrame:
    """docs' columns other than text, plus text_key, n_words, segs: the runs of words that may hold a window."""
    table, least = _bitmap(windows, bits)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    keep = [c for c in docs.columns if c != "text"]
    schema = pa.list_(pa.struct([("at", pa.int32()), ("words", pa.string())]))

    def scan(batches):
        bitmap = shared.value
        for b in batches:
            for part, data, starts, ends, first, h in _scan(b, "text"):
                segs = [[] for _ in range(part.num_rows)]
                for size, run in least.items():
                    g = C.gram_hashes(h, size)
                    if not len(g):
                        continue
                    at = (g + np.uint64(size)) >> np.uint64(64 - bits)
                    ok = (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
                    index = np.arange(len(g))
                    inner = np.searchsorted(first, index + size - 1, "right") == np.searchsorted(first, index, "right")
                    s, e, _ = C.spans((ok == 1) & inner, np.minimum(first, len(g)))
                    long = e - s >= run
                    for lo, hi in zip(s[long].tolist(), (e[long] + size - 1).tolist()):
                        row = int(C.row_of(np.array([lo]), first)[0])
                        text = b" ".join(data[i:j].tobytes() for i, j in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist()))
                        segs[row].append({"at": lo - int(first[row]), "words": text.decode("utf-8")})
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                out = [part.column(part.schema.get_field_index(c)) for c in keep]
                out += [pa.array([xxhash.xxh3_128_hexdigest((t or "").encode()) for t in texts]),
                        pa.array(np.diff(first), pa.int64()), pa.array(segs, schema)]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "text_key", "n_words", "segs"])

    return docs.mapInArrow(scan, C.with_fields(docs, ("text",), "text_key string, n_words long, segs array<struct<at: int, words: string>>"))


def find_hits(found: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact occurrences (text_key, start, len, wid) by the prefix join over the candidate runs."""
    runs = (found.where(F.size("segs") > 0).select("text_key", "segs").dropDuplicates(["text_key"])
            .select("text_key", F.explode("segs").alias("s"))
            .select("text_key", F.col("s.at").alias("at"), F.split("s.words", " ").alias("w"))
            .dropDuplicates(["text_key", "at", "w"]))
    places = None
    for k in range(1, SHINGLE + 1):  # windows shorter than a shingle are their own shingle
        part = (runs.where(F.size("w") >= k)
                .select("text_key", "at", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("pos"))
                .select("text_key", "at", "pos", F.lit(k).alias("k"), F.size("w").alias("run_len"),
                        F.array_join(F.slice("w", F.col("pos") + 1, k), " ").alias("sh"),
                        F.greatest(F.col("pos") - window, F.lit(0)).alias("lo"),
                        F.slice("w", F.greatest(F.col("pos") - window, F.lit(0)) + 1, 2 * window + 1).alias("near")))
        places = part if places is None else places.unionByName(part)
    sizes = [r["k"] for r in windows.select("k").distinct().collect()]  # at most SHINGLE values
    places = C.stage(places.where(F.col("k").isin(sizes)), "decontam-places")
    rarity = places.groupBy("k", "sh").agg(F.count("*").alias("n"))
    tokens = windows.select("wid", "words", "len", "k",
                            F.posexplode(F.transform(F.sequence(F.lit(0), F.col("len") - F.col("k")),
                                                     lambda i: F.array_join(F.slice("words", i + 1, F.col("k")), " "))).alias("off", "sh"))
    # a window with a shingle that no document holds can't occur: it keeps no prefix
    ranked = (tokens.join(rarity, ["k", "sh"], "left").groupBy("wid")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("sh"), F.col("off"))).alias("p"),
                   F.first("words").alias("words"), F.first("len").alias("len"), F.first("k").alias("k"))
              .where(F.col("p.n") > 0)
              .select("wid", "words", "len", "k", F.col("p.sh").alias("sh"), F.col("p.off").alias("off")))
    start = F.col("pos") - F.col("off")
    return (places.join(ranked, ["k", "sh"])
            .where((start >= 0) & (start + F.col("len") <= F.col("run_len")))
            .where(F.slice("near", start - F.col("lo") + 1, F.col("len")) == F.col("words"))
            .select("text_key", (F.col("at") + start).alias("start"), "len", "wid")
            .distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, bits: int = BITS) -> DataFrame:
    """Columns of ``docs`` without text, plus text_key (a hash of the text), n_words, n_hit, n_items, items (sorted strings) and contaminated.

    contaminated: n_hit > 0 and 20 * n_hit >= n_words.
    """
    C.ship(docs.sparkSession)
    return C.beside(docs, ["text"], ["text_key", "n_words", "n_hit", "n_items", "items", "contaminated"],
                    lambda inner: _judged(inner, benchmark, window, bits))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, bits: int) -> DataFrame:
    windows, owners = item_windows(benchmark, window)
    windows = C.stage(windows, "decontam-windows")
    found = C.stage(_candidates(docs, windows, bits), "decontam-runs")
    hits = C.stage(find_hits(found, windows, window), "decontam-hits")
    # words covered by a document's sorted hits, each hit counted from where the hits before it end
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("len")).alias("end")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["to"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(a["to"], x["end"]).cast("long").alias("to")))["n"]
    spans = hits.select("text_key", "start", "len").distinct().groupBy("text_key").agg(covered.alias("n_hit"))
    items = (hits.select("text_key", "wid").distinct().join(owners, "wid")
             .select("text_key", F.col("item_id").cast("string").alias("item_id")).distinct()
             .groupBy("text_key").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    # one row per contaminated text, staged: a plain join of two tables can be split where a text has many copies
    summary = C.stage(spans.join(items, "text_key"), "decontam-summary")
    out = (found.drop("segs").join(summary, "text_key", "left")
           .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
           .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
           .withColumn("n_items", F.size("items").cast("long"))
           .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, columns unchanged."""
    key = C.free_name(docs, "text_key")
    bad = (decontaminate(docs.select("text"), benchmark, **options).where("contaminated")
           .select(F.col("text_key").alias(key)).distinct())
    C.ship(docs.sparkSession)
    return with_key(docs, key).join(bad, key, "left_anti").drop(key)


def with_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and the 128-bit key of its text (null: the key of the empty text)."""
    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                texts = part.column(part.schema.get_field_index("text"))
                keys = [xxhash.xxh3_128_hexdigest((t.as_py() or "").encode()) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.string())], names=[*part.schema.names, name])
    return docs.mapInArrow(scan, C.with_fields(docs, (), f"`{name}` string"))
