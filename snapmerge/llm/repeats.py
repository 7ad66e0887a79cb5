"""Repeated byte strings across a corpus by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else goes; strings do not cross documents.

* Parsing.  A rolling hash over ``WINDOW`` bytes is a trigger where it is 0 modulo ``MODULUS``.  The string that
  starts at byte i belongs to its first trigger (if it holds none, to its smallest hash), a choice that only the
  string's own bytes decide.  Neighbouring starts with the same trigger form a phrase; the phrase with the bytes its
  strings reach is its entry, and ``CORE`` bytes beside the trigger that all its strings hold are its core.
* Dictionary.  Entries are counted by core.  Most cores belong to one entry seen once: nothing there repeats.  A core with one
  entry seen more often repeats as a whole, whatever the number of copies.
* Corpus order.  Only cores with several different entries need byte-level work.  Their distinct entries meet by core,
  the suffixes of these dictionary entries are sorted, and neighbours in that order that agree in ``LENGTH`` bytes are
  repeats; entries seen more than once repeat in any case.  Equal strings have equal triggers and so equal cores:
  the orders of separate cores never need to be merged.  A core with more than ``CROWD`` strings is not sorted in one
  task: its entries are cut into pieces, ever smaller ones (``WIDTHS``), and those are counted by hash with partial
  aggregation, like the entries themselves: only pieces that differ but share the bytes common to all their strings are
  cut again, so the rows follow the places where copies differ, not the length of the entries.

Work at byte level therefore follows the places where repeats begin and end, not the repeated bytes.  Texts are known by
128-bit keys, entries by 64-bit hashes of core and entry together; Python sees texts in slices bounded by bytes.  Null text is empty; texts shorter than ``LENGTH`` lose nothing;
results follow from the text alone, so null or repeated doc_ids do no harm; other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C

LENGTH = 400
WINDOW = 16
MODULUS = 128
#: most strings (of ``LENGTH`` bytes, in all entries of one core) that one task sorts
CROWD = 40_000
#: in a crowded core, how many neighbouring strings make a piece, round by round (each divides the one before)
WIDTHS = (64, 8, 1)
#: the two halves of a text's key
KEY = ["k1", "k2"]
SPAN = "array<struct<start: long, end: long>>"


def rolling(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hash of the ``window`` (a multiple of 8) bytes from each position."""
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    h = np.zeros(n, np.uint64)
    for j in range(0, window, 8):
        h = C.mix((h ^ words[j:j + n]) * np.uint64(0x9E3779B97F4A7C15))
    return h


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (the first of equals, by their upper bits) in every ``width`` consecutive values."""
    n = len(h) - width + 1
    out = []
    for lo in range(0, n, 1 << 19):  # positions take 20 bits
        part = h[lo:min(len(h), lo + (1 << 19) + width - 1)]
        key = (part & ~np.uint64(0xFFFFF)) | np.arange(len(part), dtype=np.uint64)
        pad = -len(key) % width
        grid = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        m = len(part) - width + 1
        best = np.minimum(back[:m], ahead[width - 1:width - 1 + m])
        out.append((best & np.uint64(0xFFFFF)).astype(np.int64) + lo)
    return np.concatenate(out)


def phrases(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, modulus: int = MODULUS):
    """Rows (row, first start, last start, trigger) over the slice; positions are those of the slice."""
    h = rolling(data)
    size = np.diff(offsets)
    docs = np.flatnonzero(size >= length)
    if not len(docs):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    begin, stop = offsets[docs], offsets[docs + 1]
    at = np.flatnonzero(h % np.uint64(modulus) == 0)
    doc = np.searchsorted(offsets, at, "right") - 1
    at, doc = (x[(size[doc] >= length) & (at + WINDOW <= offsets[doc + 1])] for x in (at, doc))
    reach = length - WINDOW  # farthest trigger of a string
    # the trigger of each phrase, with one past the last string of every document standing in for "no more triggers"
    t = np.concatenate([at, stop + length])
    d = np.concatenate([doc, docs])
    order = np.argsort(t + d * (2 * length + 1), kind="stable")
    t, d, real = t[order], d[order], (order < len(at))
    lower = np.empty(len(t), np.int64)
    lower[1:] = np.where(d[1:] == d[:-1], t[:-1] + 1, offsets[d[1:]])
    lower[0] = offsets[d[0]]
    last = offsets[d + 1] - length
    s, e = np.maximum(lower, t - reach), np.minimum(t, last)
    own = real & (s <= e)
    parts = [(d[own], s[own], e[own], t[own])]
    # strings without a trigger: from the lower end of a long gap to where the next trigger comes within reach
    top = np.minimum(np.where(real, t - reach - 1, last), last)
    for g in np.flatnonzero(lower <= top):
        a, b = int(lower[g]), int(top[g])
        least = smallest(h[a:b + reach + 1], reach + 1) + a
        cut = np.flatnonzero(np.diff(least)) + 1
        first, final = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(least) - 1]])
        parts.append((np.full(len(first), d[g]), first + a, final + a, least[first]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def entries(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, modulus: int = MODULUS):
    """(row, first start in the row, last start, place of the trigger, core hash, entry hash) of every phrase, split where its strings hold no common core."""
    core = length // 2
    row, s, e, t = phrases(data, offsets, length, modulus)
    near, far = np.maximum(s, t - core), np.minimum(e, t - core - 1)
    a, b = near <= e, s <= far
    side = np.concatenate([np.zeros(a.sum(), np.int64), np.ones(b.sum(), np.int64)])
    row, t = np.concatenate([row[a], row[b]]), np.concatenate([t[a], t[b]])
    s, e = np.concatenate([near[a], s[b]]), np.concatenate([e[a], far[b]])
    raw = memoryview(data.tobytes())
    lo, hi = np.where(side == 0, t, t - core), np.where(side == 0, t + core, t + WINDOW)
    hashed = xxhash.xxh3_64_intdigest
    cores = np.fromiter((hashed(raw[i:j], k) for i, j, k in zip(lo.tolist(), hi.tolist(), side.tolist())), np.uint64, len(row))
    whole = np.fromiter((hashed(raw[i:j]) for i, j in zip(s.tolist(), (e + length).tolist())), np.uint64, len(row))
    base = offsets[row]
    return row, s - base, e - base, t - base, cores.view(np.int64), whole.view(np.int64)


def text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128-bit keys of the rows' bytes, as two columns."""
    raw = memoryview(data.tobytes())
    found = b"".join(xxhash.xxh3_128_digest(raw[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    return np.frombuffer(found, "<i8").reshape(-1, 2)


def _parsed(docs: DataFrame, length: int, modulus: int) -> DataFrame:
    """(k1, k2, s, e, t, core, entry) of every phrase of every text."""
    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                data, offsets = C.text_bytes(part.column(part.schema.get_field_index("text")))
                row, s, e, t, core, entry = entries(data, offsets, length, modulus)
                keys = text_keys(data, offsets)[row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[:, 0], keys[:, 1], s, e, t, core, entry)],
                                                 names=[*KEY, "s", "e", "t", "core", "entry"])
    return docs.select("text").mapInArrow(scan, "k1 long, k2 long, s long, e long, t long, core long, entry long")


def equal_suffixes(found: list[tuple[bytes, int, int, int]], length: int) -> list[np.ndarray]:
    """For each (bytes, place of its first start relative to the trigger, starts, times seen): which starts repeat.

    The suffixes of the entries are put in order; equal neighbours in their first ``length`` bytes repeat.
    """
    repeated = [np.full(n, c > 1) for _, _, n, c in found]
    order = sorted(((x[j:j + length], i, j) for i, (x, _, n, _) in enumerate(found) for j in range(n)), key=lambda v: v[0])
    for (x, i, j), (y, k, m) in zip(order, order[1:]):
        if x == y:
            repeated[i][j] = repeated[k][m] = True
    return repeated


def parts_of(raw: bytes, lead: int, first: int, last: int, length: int, width: int) -> list[tuple[int, int, int, int, int]]:
    """(block, key, piece, first start, last start) of the strings of an entry that start from ``first`` to ``last``.

    Strings whose distances from start to trigger agree in the quotient by ``width`` are of a block.  Equal strings have equal
    distances.  key: hash of the bytes that every string of the block holds, whatever its entry; piece: of all bytes of those at hand.
    """
    hashed, out = xxhash.xxh3_64_intdigest, []
    while first <= last:
        block = (lead - first) // width
        start = lead - block * width
        end = min(last, start)
        out.append((block, hashed(raw[start:max(start, start - width + 1 + length)]), hashed(raw[first:end + length], lead - first), first, end))
        first = end + 1
    return out


def _counted(entries: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """(core, entry, runs) of the repeating starts in entries (core, entry, c, lead, bytes), and the staged tables it reads."""
    place = ["core", "block", "key"]
    asked = entries.withColumn("asked", F.array(F.struct(F.lit(0).alias("first"), (F.length("bytes") - length).alias("last"), "c")))
    found, used = None, []
    for width in WIDTHS:
        def split(batches, width=width):
            for b in batches:
                rows = [(core, entry, r["c"], *part) for core, entry, lead, raw, ask in zip(*(b.column(i).to_pylist() for i in range(5)))
                        for r in ask for part in parts_of(raw, lead, r["first"], r["last"], length, width)]
                cols = [np.array(x, np.uint64).view(np.int64) if i in (4, 5) else np.array(x, np.int64) for i, x in enumerate(zip(*rows))]
                if cols:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["core", "entry", "c", "block", "key", "piece", "first", "last"])

        parts = C.stage(asked.select("core", "entry", "lead", "bytes", "asked").mapInArrow(
            split, "core long, entry long, c long, block long, key long, piece long, first long, last long"), "repeats-parts")
        keys = (parts.groupBy(place).agg(F.sum("c").alias("n"), F.min("piece").alias("low"), F.max("piece").alias("high"))
                .where(F.col("n") > 1).select(*place, (F.col("low") != F.col("high")).alias("mixed")))
        live = C.stage(parts.join(keys, place), "repeats-parts-live")
        # of equal pieces one goes on, for all of them
        pieces = C.stage(live.where("mixed").groupBy(*place, "piece").agg(F.sum("c").alias("c"), F.min(F.struct("entry", "first", "last")).alias("at")),
                         "repeats-pieces")
        again = live.where("mixed").join(pieces.where("c > 1").select(*place, "piece"), [*place, "piece"], "left_semi")
        runs = (live.where("NOT mixed").unionByName(again.select(live.columns))
                .select("core", "entry", F.array(F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("end"))).alias("runs")))
        found = runs if found is None else found.unionByName(runs)
        C.drop(parts)
        used += [live, pieces]
        if pieces.isEmpty():
            break
        asked = entries.join(pieces.groupBy("core", F.col("at.entry").alias("entry"))
                             .agg(F.collect_list(F.struct("at.first", "at.last", "c")).alias("asked")), ["core", "entry"])
    return found, used


def _runs(flags: np.ndarray, start: int, length: int) -> list[dict]:
    """Byte spans covered by the strings that start at the flagged places."""
    s, e, _ = C.spans(flags, np.array([0, len(flags)]))
    return [{"start": int(a) + start, "end": int(b) - 1 + start + length} for a, b in zip(s, e)]


def find_spans(docs: DataFrame, length: int = LENGTH, modulus: int = MODULUS, crowd: int = CROWD) -> DataFrame:
    """(k1, k2, spans): the byte spans to remove, possibly overlapping, of the texts that have any."""
    C.ship(docs.sparkSession)
    parsed = C.stage(_parsed(docs, length, modulus), "repeats-parsed")
    cores = (parsed.groupBy("core").agg(F.count("*").alias("n"), F.min("entry").alias("low"), F.max("entry").alias("high"))
             .where(F.col("n") > 1).select("core", (F.col("low") != F.col("high")).alias("mixed")))
    cores = C.stage(cores, "repeats-cores")
    live = C.stage(parsed.join(cores, "core"), "repeats-phrases")
    C.drop(parsed, cores)
    dictionary = (live.where("mixed").groupBy("core", "entry")
                  .agg(F.count("*").alias("c"), F.min(F.struct(*KEY, "s", "e", "t")).alias("at")))
    dictionary = C.stage(dictionary.select("core", "entry", "c", "at.*"), "repeats-dictionary")
    whole = live.join(dictionary.where("c > 1").select("core", "entry", F.lit(True).alias("again")), ["core", "entry"], "left")
    spans = (whole.where("NOT mixed OR again")
             .select(*KEY, F.col("s").alias("start"), (F.col("e") + length).alias("end")))
    # the bytes of the mixed cores' entries: one text each is enough
    asked = dictionary.groupBy(*KEY).agg(F.collect_list(F.struct("core", "entry", "c", "s", "e", "t")).alias("asked"))

    def fetch(batches):
        for b in batches:
            texts, asks = b.column(0), b.column(1)
            for text, ask in zip(texts, asks):
                raw = text.as_py().encode()
                rows = ask.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["core"] for r in rows], pa.int64()), pa.array([r["entry"] for r in rows], pa.int64()), pa.array([r["c"] for r in rows], pa.int64()),
                     pa.array([r["t"] - r["s"] for r in rows], pa.int64()), pa.array([raw[r["s"]:r["e"] + length] for r in rows], pa.binary())],
                    names=["core", "entry", "c", "lead", "bytes"])

    # copies of a text are dropped before the exchange
    texts = _with_key(docs.select("text"), []).groupBy(*KEY).agg(F.first("text").alias("text")).join(asked, KEY)
    known_bytes = C.stage(texts.select("text", "asked").mapInArrow(fetch, "core long, entry long, c long, lead long, bytes binary"), "repeats-entries")
    sizes = C.stage(dictionary.groupBy("core").agg(F.sum(F.col("e") - F.col("s") + 1).alias("m")), "repeats-sizes")
    known = known_bytes.join(sizes, "core")

    def ordered(table: pa.Table) -> pa.Table:
        raw, lead, c = (table.column(k).to_pylist() for k in ("bytes", "lead", "c"))
        flags = equal_suffixes([(x, a, len(x) - length + 1, n) for x, a, n in zip(raw, lead, c)], length)
        return pa.table({"core": table.column("core"), "entry": table.column("entry"),
                         "runs": pa.array([_runs(f, 0, length) for f in flags], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    sorted_runs = known.where(F.col("m") <= crowd).groupBy("core").applyInArrow(ordered, f"core long, entry long, runs {SPAN}")

    crowded = C.stage(known.where(F.col("m") > crowd).select("core", "entry", "c", "lead", "bytes"), "repeats-crowded")
    counted, used = _counted(crowded, length)
    partial = (sorted_runs.unionByName(counted).select("core", "entry", F.explode("runs").alias("r"))
               .join(dictionary.where("c = 1").select("core", "entry", *KEY, "s"), ["core", "entry"])
               .select(*KEY, (F.col("s") + F.col("r.start")).alias("start"), (F.col("s") + F.col("r.end")).alias("end")))
    found = C.stage(spans.unionByName(partial).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans")), "repeats-spans")
    C.drop(live, dictionary, known_bytes, sizes, crowded, *used)
    return found


def _with_key(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Some columns of ``docs`` and its text, with the key of the text's bytes."""
    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                data, offsets = C.text_bytes(part.column(part.schema.get_field_index("text")))
                keys = text_keys(data, offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=[*part.schema.names, *KEY])
    docs = docs.select(*keep, "text")
    return docs.mapInArrow(scan, C.with_fields(docs, (), "k1 long, k2 long"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The spans in order, overlapping and touching ones joined."""
    out: list[list[int]] = []
    for s in sorted(spans or [], key=lambda x: x["start"]):
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [tuple(x) for x in out]


def mark_repeats(docs: DataFrame, tidy: bool = True, **options) -> DataFrame:
    """``docs`` plus removed: the maximal byte spans to remove (empty: none).

    Without ``tidy`` they come as found: in no order, some overlapping, null for none; ``digest`` takes either.
    """
    return C.beside(docs, ["text"], ["removed"], lambda inner: _marked(inner, tidy, options))


def _marked(docs: DataFrame, tidy: bool, options: dict) -> DataFrame:
    names = docs.columns
    found = find_spans(docs, **options).withColumnRenamed("spans", "removed")
    joined = _with_key(docs, [c for c in names if c != "text"]).join(found, KEY, "left").select(*names, "removed")
    if not tidy:
        return joined

    def in_order(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            for part in C.slices(b, "text"):
                spans = [[{"start": s, "end": e} for s, e in merged(x)] for x in part.column(part.schema.get_field_index("removed")).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(spans, kind)], names=[*names, "removed"])

    return joined.mapInArrow(in_order, joined.schema)


def digest(marked: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from marked documents."""
    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                n_bytes, n_removed, n_spans, sha = [], [], [], []
                for text, found in zip(part.column(1), part.column(2).to_pylist()):
                    raw, spans = (text.as_py() or "").encode(), merged(found)
                    h, at = hashlib.sha256(), 0
                    for s, e in spans:
                        h.update(raw[at:s])
                        at = e
                    h.update(raw[at:])
                    n_bytes.append(len(raw))
                    n_removed.append(sum(e - s for s, e in spans))
                    n_spans.append(len(spans))
                    sha.append(h.hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(sha, pa.string())],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return marked.select("doc_id", "text", "removed").mapInArrow(
        scan, f"doc_id {dict(marked.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(text: str | None, spans: list[dict]) -> str | None:
    """The text without the spans; a code point only partly inside a span stays whole."""
    if text is None or not spans:
        return text
    raw, out, at = text.encode(), [], 0
    for s in spans:
        a, b = s["start"], s["end"]
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out).decode()


def worth(raw: bytes, spans: list[tuple[int, int]], min_words: int, enough: int = LENGTH) -> list[tuple[int, int]]:
    """The spans with at least ``min_words`` words (parts of words count), or ``enough`` bytes where a script has no blanks."""
    return [(a, b) for a, b in spans if b - a >= enough or len(raw[a:b].split()) >= min_words]


def remove_repeats(docs: DataFrame, min_words: int = 0, **options) -> DataFrame:
    """``docs`` with the repeated bytes cut from the text, columns unchanged (n_chars set anew where text was cut).

    With ``min_words``, repeats of fewer words (and fewer than ``LENGTH`` bytes) stay.
    """
    needs = [c for c in ("text", "n_chars") if c in docs.columns]
    return C.beside(docs, needs, [], lambda inner: _cut_out(inner, min_words, options)).select(*(f"`{c}`" for c in docs.columns))


def _cut_out(docs: DataFrame, min_words: int, options: dict) -> DataFrame:
    names = docs.columns

    def scan(batches):
        for b in batches:
            for part in C.slices(b, "text"):
                cols = {c: part.column(part.schema.get_field_index(c)) for c in names}
                texts, spans = cols["text"].to_pylist(), [merged(x) for x in part.column(part.schema.get_field_index("removed")).to_pylist()]
                if min_words:
                    spans = [worth(t.encode(), s, min_words) if s else s for t, s in zip(texts, spans)]
                texts = [cut(t, [{"start": a, "end": e} for a, e in s]) for t, s in zip(texts, spans)]
                if "n_chars" in cols:
                    old = cols["n_chars"].to_pylist()
                    cols["n_chars"] = pa.array([len(t) if s else o for t, s, o in zip(texts, spans, old)], cols["n_chars"].type)
                cols["text"] = pa.array(texts, cols["text"].type)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return mark_repeats(docs, tidy=False, **options).select(*names, "removed").mapInArrow(scan, docs.schema)
