"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts are tokenised whole; ``END`` follows each document.  Documents longer than the capacity are cut into full pieces
(each a sequence of its own) and a last, shorter piece.  The short pieces are dealt into groups of about ``GROUP``
pieces.  In each group ``ISLANDS`` populations of packings evolve on their own:

* crossover injects whole well-filled bins of one parent into the other, drops the bins that hold an injected piece a
  second time, and best-fits the pieces displaced by that, longest first;
* mutation opens a few of the emptier bins and best-fits their pieces;
* fitness: fewer bins, then the mean squared fill.

After each epoch an island's best packing migrates to the next island of its group.  The best packing of a group
stands, except for its ill-filled bins (under ``GOOD_FILL``): their pieces are dealt into new groups and packed once more, ``ROUNDS`` times.
Groups are independent Spark rows, so work and memory follow the data, and a lost task is recomputed from a staged
table (the random state is derived from group, island and epoch).

Null text is the empty text: one ``END``.  Repeated rows are packed as documents of their own; other columns pass through.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C

CAPACITY = 2048
END = 0
GROUP = 1024
ISLANDS = 2
POPULATION = 6
EPOCHS = 2
GENERATIONS = 8
ROUNDS = 2
GOOD_FILL = 0.97
#: entries of a worker's cache of token ids (about 200 bytes each) beyond which those not used since it was last full go
CACHE = 250_000

# In Latin-1 text the tokenizer's word rule,
# 's|'t|'re|'ve|'m|'ll|'d|letters+|number|[^white space, letters, numbers]+,
# can be told from the kinds of its bytes; its normaliser only lower-cases and treats white space as a separator, which the rule drops.
_LOWERED = bytes(range(256)).decode("latin-1").lower().encode("latin-1")
_SPACE, _LETTER, _NUMBER, _SIGN = range(4)
_KINDS = np.full(256, _SIGN, np.uint8)
_KINDS[list("\t\n\x0b\x0c\r \x85\xa0".encode("latin-1"))] = _SPACE
_KINDS[[i for i in range(256) if chr(i).isalpha()]] = _LETTER
_KINDS[list("0123456789²³¹¼½¾".encode("latin-1"))] = _NUMBER


def latin_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of lower-cased Latin-1 bytes begin, and which bytes belong to one; from a beginning to the next it is one."""
    n = len(data)
    data = np.concatenate([data, np.full(3, 0x20, np.uint8)])
    kind = _KINDS[data]
    begin = kind != _SPACE
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    quote = np.flatnonzero(begin & (data == ord("'")))
    one, two = data[quote + 1], data[quote + 2]
    short = np.isin(one, list(b"stmd"))
    long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    begin[quote[short | long] + 1] = False
    rest = np.concatenate([quote[short] + 2, quote[long] + 3])
    begin[rest[kind[rest] == _LETTER]] = True
    return np.flatnonzero(begin[:n]), kind[:n] != _SPACE


class WordCache:
    """Token ids of a text, joined from the cached ids of its parts.

    Parts are the tokenizer's own pre-tokens for Latin-1 texts and white-space separated chunks for others: no token
    crosses a part, so each part is tokenised once and alone.  Pre-tokens are known by their Latin-1 bytes, chunks by their text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes | str, bytes] = {}
        self.older: dict[bytes | str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a pre-token
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """:meth:`encode` of several texts; their unknown parts are tokenised together."""
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        found: list[bytes] = [b""] * len(texts)
        latin: dict[int, bytes] = {}
        chunks: dict[int, list[str]] = {}
        for i, t in enumerate(texts):
            if "<|" in t:  # may hold the name of a special token
                found[i] = _packed_ids(self.tokenizer.encode(t, add_special_tokens=False).ids)
            elif (raw := _latin(t)) is not None:
                latin[i] = raw
            else:
                chunks[i] = [p for p in re.split("[\t-\r ]+", t) if p]
        for i, ids in zip(latin, self._encode_latin(list(latin.values()))):
            found[i] = ids
        every = list(dict.fromkeys(p for parts in chunks.values() for p in parts))
        ids = dict(zip(every, self._ids(every, self._learn)))
        for i, parts in chunks.items():
            found[i] = b"".join(map(ids.__getitem__, parts))
        return found

    def _encode_latin(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b" ".join(texts).translate(_LOWERED), np.uint8)
        first, inside = latin_tokens(data)
        stop = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        if not len(first):
            return [b""] * len(texts)
        bounds = np.append((np.cumsum(inside, dtype=np.int64) - 1)[first], np.count_nonzero(inside))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]).dictionary_encode()
        ids = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist(), self._learn_tokens)
        which = words.indices.to_numpy()
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin, count = (np.cumsum(size) - size)[which], size[which]
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], count)
        raw = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        cut = 4 * ends[np.concatenate([[0], np.searchsorted(first, stop)])]
        return [raw[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def _ids(self, parts: list, learn) -> list[bytes]:
        """The ids of each of some different parts."""
        found = list(map(self.known.get, parts))
        new = [i for i, x in enumerate(found) if x is None]
        for i in new:
            if (x := self.older.get(parts[i])) is not None:
                self.known[parts[i]] = x
        learn([parts[i] for i in new if parts[i] not in self.known])
        for i in new:
            found[i] = self.known[parts[i]]
        return found

    def _learn(self, parts: list[str]) -> None:
        for p, e in zip(parts, self.tokenizer.encode_batch(parts, add_special_tokens=False)):
            self.known[p] = _packed_ids(e.ids)

    def _learn_tokens(self, parts: list[bytes]) -> None:
        """Pre-tokens, many in one text with blanks between: a token that ends a word ends a pre-token."""
        groups = [parts[i:i + 200] for i in range(0, len(parts), 200)]
        for group, e in zip(groups, self.tokenizer.encode_batch([b" ".join(g).decode("latin-1") for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(group):
                alone = self.tokenizer.encode_batch([p.decode("latin-1") for p in group], add_special_tokens=False)
                self.known.update((p, _packed_ids(x.ids)) for p, x in zip(group, alone))
                continue
            raw, at = ids.tobytes(), 0
            for p, end in zip(group, ends.tolist()):
                self.known[p] = raw[at:end]
                at = end


def _packed_ids(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


_CACHES: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    """The worker process's cache for a vocabulary file; it outlives the task."""
    if path not in _CACHES:
        _CACHES.clear()
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: columns of ``docs`` without text, plus piece, start, length, ids (little-endian uint32)."""
    C.ship(docs.sparkSession)
    return C.beside(docs, ["text"], ["piece", "start", "length", "ids"], lambda inner: _cut(inner, tokenizer_path, capacity))


def _cut(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    keep = [c for c in docs.columns if c != "text"]

    def cut(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = word_cache(tokenizer_path)
        end = np.array([END], dtype="<u4").tobytes()
        step = 4 * capacity
        for b in batches:
            for part in C.slices(b, "text"):
                row, piece, ids = [], [], []
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                for i, whole in enumerate(words.encode_all(texts)):
                    whole += end
                    for j in range(0, len(whole), step):
                        row.append(i)
                        piece.append(j // step)
                        ids.append(whole[j:j + step])
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)).take(at) for c in keep), pa.array(piece, pa.int32()),
                     pa.array([p * capacity for p in piece], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[*keep, "piece", "start", "length", "ids"])

    return docs.mapInArrow(cut, C.with_fields(docs, ("text",), "piece int, start long, length long, ids binary"))


# --- packings of one group: a packing is a list of bins, a bin a tuple of piece numbers -------------------------------

def best_fit(lengths: list[int], items: list[int], bins: list[list[int]], free: list[int], capacity: int) -> None:
    """Put each item, in order, in the bin with the least room that holds it; open a bin if none does."""
    rooms: dict[int, list[int]] = {}
    mask = 0
    for i, f in enumerate(free):
        rooms.setdefault(f, []).append(i)
        mask |= 1 << f
    for x in items:
        need = lengths[x]
        fit = mask >> need
        if fit:
            room = need + (fit & -fit).bit_length() - 1
            same = rooms[room]
            i = same.pop()
            if not same:
                mask &= ~(1 << room)
            bins[i].append(x)
        else:
            i, room = len(bins), capacity
            bins.append([x])
            free.append(capacity)
        left = room - need
        free[i] = left
        rooms.setdefault(left, []).append(i)
        mask |= 1 << left


def _free(lengths: list[int], bins: list[list[int]], capacity: int) -> list[int]:
    return [capacity - sum(lengths[x] for x in b) for b in bins]


def fitness(lengths: list[int], bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """(-bins, mean squared fill): larger is better."""
    return -len(bins), sum((1 - f / capacity) ** 2 for f in _free(lengths, bins, capacity)) / max(1, len(bins))


def crossover(lengths, mother, father, capacity, rng):
    """A copy of mother with some well-filled bins of father injected whole."""
    order = np.argsort(_free(lengths, father, capacity), kind="stable")
    best = order[:max(1, len(order) // 2)]
    inject = [list(father[i]) for i in rng.choice(best, size=max(1, len(best) // 3), replace=False)]
    inside = {x for b in inject for x in b}
    kept, loose = [], []
    for b in mother:
        if inside.isdisjoint(b):
            kept.append(list(b))
        else:
            loose += [x for x in b if x not in inside]
    bins = inject + kept
    loose.sort(key=lengths.__getitem__, reverse=True)
    best_fit(lengths, loose, bins, _free(lengths, bins, capacity), capacity)
    return bins


def mutate(lengths, bins, capacity, rng):
    """Open a few bins, the emptier the likelier, and best-fit their pieces in slightly shuffled order."""
    free = np.array(_free(lengths, bins, capacity), dtype=float) + 1
    out = set(rng.choice(len(bins), size=min(len(bins), 2 + len(bins) // 20), replace=False, p=free / free.sum()).tolist())
    loose = [x for i in out for x in bins[i]]
    kept = [list(b) for i, b in enumerate(bins) if i not in out]
    loose.sort(key=lambda x: lengths[x] * rng.uniform(0.8, 1.0), reverse=True)
    best_fit(lengths, loose, kept, _free(lengths, kept, capacity), capacity)
    return kept


def first_population(lengths: list[int], size: int, capacity: int, rng) -> list[list[list[int]]]:
    """Best-fit packings: longest first, then with ever more shuffling."""
    out = []
    for k in range(size):
        bins: list[list[int]] = []
        order = sorted(range(len(lengths)), key=lambda x: lengths[x] * rng.uniform(1 - 0.15 * k, 1.0), reverse=True)
        best_fit(lengths, order, bins, [], capacity)
        out.append(bins)
    return out


def evolve(lengths, population, capacity, generations, rng):
    """``generations`` of steady-state crossover and mutation; returns the population, best first."""
    floor = -math.ceil(sum(lengths) / capacity)
    scored = sorted(((fitness(lengths, p, capacity), i, p) for i, p in enumerate(population)), reverse=True)
    serial = len(scored)
    for _ in range(generations):
        if scored[0][0][0] >= floor:  # no packing has fewer bins
            break
        a, b = rng.choice(len(scored), size=2, replace=False) if len(scored) > 1 else (0, 0)
        child = crossover(lengths, scored[min(a, b)][2], scored[max(a, b)][2], capacity, rng)
        child = mutate(lengths, child, capacity, rng)
        scored[-1] = (fitness(lengths, child, capacity), serial, child)
        serial += 1
        scored.sort(key=lambda s: s[:2], reverse=True)
    return [s[2] for s in scored]


def _coded(bins: list[list[int]], n: int) -> bytes:
    at = np.zeros(n, dtype="<i4")
    for i, b in enumerate(bins):
        at[b] = i
    return at.tobytes()


def _decoded(code: bytes) -> list[list[int]]:
    at = np.frombuffer(code, dtype="<i4")
    bins: list[list[int]] = [[] for _ in range(int(at.max()) + 1 if len(at) else 0)]
    for x, i in enumerate(at.tolist()):
        bins[i].append(x)
    return bins


_ISLAND = pa.schema([("grp", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("population", pa.list_(pa.binary()))])


def _epoch(islands: DataFrame, epoch: int, capacity: int, generations: int, population: int) -> DataFrame:
    """One epoch of every island: rows (grp, island, lengths, population, elite, bins)."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                lengths = np.frombuffer(r["lengths"], dtype="<i4").tolist()
                rng = np.random.default_rng([abs(r["grp"]), r["island"], epoch])
                old = [_decoded(p) for p in r["population"]] or first_population(lengths, population, capacity, rng)
                new = evolve(lengths, old, capacity, generations, rng)
                r["population"] = [_coded(p, len(lengths)) for p in new]
                r["elite"], (r["bins"], r["fill"]) = r["population"][0], fitness(lengths, new[0], capacity)
                yield pa.RecordBatch.from_pylist([r], schema=schema)

    schema = pa.schema([*_ISLAND, ("elite", pa.binary()), ("bins", pa.int64()), ("fill", pa.float64())])
    return islands.mapInArrow(run, "grp long, island int, lengths binary, population array<binary>, elite binary, bins long, fill double")


def pack_groups(items: DataFrame, capacity: int, group: int, islands: int, epochs: int, generations: int, population: int) -> DataFrame:
    """items (uid, length) packed: uid, grp, bin, offset, fill (tokens of the bin)."""
    n = max(1, math.ceil(items.count() / group))
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(n)))
    spark = items.sparkSession
    wide = max(1, min(n * islands, 4 * spark.sparkContext.defaultParallelism, 100_000))

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        return pa.table({"grp": table.column("grp")[:1], "uids": [np.asarray(table.column("uid"), dtype="<i8").tobytes()],
                         "lengths": [np.asarray(table.column("length")).astype("<i4").tobytes()]})

    groups = C.stage(dealt.groupBy("grp").applyInArrow(gather, "grp long, uids binary, lengths binary"), "pack-groups")
    state = groups.select("grp", F.explode(F.array(*(F.lit(i) for i in range(islands)))).alias("island"), "lengths",
                          F.array().cast("array<binary>").alias("population"))
    for epoch in range(epochs):
        state = C.stage(_epoch(state.repartition(wide, "grp", "island"), epoch, capacity, generations, population), "pack-islands")
        if epoch + 1 < epochs:  # the elite of each island replaces the worst packing of the next one
            guests = state.select("grp", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("elite").alias("guest"))
            state = (state.join(guests, ["grp", "island"])
                     .select("grp", "island", "lengths",
                             F.concat(F.array("guest"), F.slice("population", 1, max(1, population - 1))).alias("population")))
    best = state.groupBy("grp").agg(F.max_by("elite", F.struct("bins", "fill", "island")).alias("elite"))

    def laid(batches):
        for b in batches:
            for r in b.to_pylist():
                uid, length = np.frombuffer(r["uids"], "<i8"), np.frombuffer(r["lengths"], "<i4").astype(np.int64)
                at = np.frombuffer(r["elite"], "<i4").astype(np.int64)
                order = np.argsort(at, kind="stable")
                total = np.cumsum(length[order]) - length[order]
                first = np.searchsorted(at[order], np.arange(int(at.max()) + 1))
                fill = np.bincount(at, weights=length).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[order]), pa.array(length[order]), pa.array(np.full(len(uid), r["grp"], np.int64)), pa.array(at[order]),
                     pa.array(total - total[first[at[order]]]), pa.array(fill[at[order]])],
                    names=["uid", "length", "grp", "bin", "offset", "fill"])

    return groups.join(best, "grp").mapInArrow(laid, "uid long, length long, grp long, bin long, offset long, fill long")


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP, islands: int = ISLANDS, epochs: int = EPOCHS,
         generations: int = GENERATIONS, population: int = POPULATION, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (with a ``length`` of 1 to capacity) plus sequence_id and offset."""
    C.ship(rows.sparkSession)
    return C.beside(rows, ["length"], ["length", "sequence_id", "offset"],
                    lambda inner: _packed(inner, capacity, group, islands, epochs, generations, population, rounds))


def _packed(rows: DataFrame, capacity: int, group: int, islands: int, epochs: int, generations: int, population: int, rounds: int) -> DataFrame:
    uid = "_uid"
    rows = C.stage(rows.withColumn(uid, F.monotonically_increasing_id()), "pack-pieces")
    items = rows.where(F.col("length") < capacity).select(F.col(uid).alias("uid"), "length")
    placed = None
    for k in range(rounds):
        done = C.stage(pack_groups(items, capacity, group, islands, epochs, generations, population), "pack-round")
        last = k + 1 == rounds
        good = done if last else done.where(F.col("fill") >= GOOD_FILL * capacity)
        good = good.select("uid", ((F.lit(k) * (1 << 50)) + F.col("grp") * group * 64 + F.col("bin")).alias("sequence_id"), "offset")
        placed = good if placed is None else placed.unionByName(good)
        if not last:
            items = C.stage(done.where(F.col("fill") < GOOD_FILL * capacity).select("uid", "length"), "pack-rest")
    # a full piece is a sequence of its own
    return (rows.join(placed.withColumnRenamed("uid", uid), uid, "left")
            .withColumn("sequence_id", F.coalesce("sequence_id", -F.col(uid) - 1))
            .withColumn("offset", F.coalesce("offset", F.lit(0)).cast("long")).drop(uid))
