"""SimHash near-duplicates: exact pairs within a Hamming distance through a distributed vantage-point tree.

Fingerprints that link at ``max_bits`` or fewer differing bits form components; a component is named by its smallest
doc_id.  Equal fingerprints are one point of the search, so copies cost nothing beyond the first.

* A tree of shards, as deep as the cluster has work for (deeper only where shards would outgrow a task), is built on a bounded sample of fingerprints (``SAMPLE``): each node has a vantage point and
  the median distance to it.  Only the balance of the shards depends on the sample, not the pairs found.
* Every fingerprint has a home shard (nearer branches left, farther right).  By the triangle bound it can only have
  partners in a branch that its ball of radius ``max_bits`` reaches, so it also visits those shards; it visits only
  shards with a larger number than its home, as a pair needs to meet once.  Crowded shards are split in blocks,
  and the visitors of a block in chunks, so a task holds about ``SHARD`` visitors and a block's home points.
* Inside a shard block a tree of its own goes on in memory, pruned by the same bound, down to small sets that are
  compared directly.  A block returns a spanning star of each group it joined, never all pairs.
* Components of the stars: smallest-label propagation with pointer jumping over DataFrames.

A text without words has fingerprint 0 and is linked like any other; null counts as empty.  Rows without doc_id keep
their row, and take part in their component without naming it (null component_id if nobody else is in it).
``keep_one`` chooses by row, so repeated or missing ids neither keep a second row nor take another text along.
"""

from __future__ import annotations

import math
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: fingerprints the tree is built on
SAMPLE = 4096
#: most home points per shard aimed at; below it the number of shards follows the cluster, not the data
SHARD = 250_000
SHARDS_PER_CORE = 4
MAX_DEPTH = 16
#: home points below which a branch of a shard's own tree is compared directly
LEAF = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles (unsigned)."""
    words = (text or "").encode().translate(C.LOWER_TABLE).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts = [0, *(e + 1 for e in ends[:-shingle])]
        hashes = list(map(xxhash.xxh64_intdigest, [line[a:b] for a, b in zip(starts, ends[shingle - 1:])], repeat(SEED)))
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Columns of ``docs`` without text, plus fp (the fingerprint's bits as a long)."""
    C.ship(docs.sparkSession)
    keep = [c for c in docs.columns if c != "text"]

    def scan(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(fp.view(np.int64))],
                                             names=[*keep, "fp"])

    return docs.mapInArrow(scan, C.with_fields(docs, ("text",), "fp long"))


def build_tree(sample: np.ndarray, depth: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree in heap order (node i has children 2i+1 and 2i+2)."""
    rng = np.random.default_rng(seed)
    vantage = np.zeros((1 << depth) - 1, dtype=np.uint64)
    radius = np.zeros(len(vantage), dtype=np.int64)
    inside = {0: sample}
    for node in range(len(vantage)):
        points = inside.pop(node, sample)
        if not len(points):
            points = sample
        vantage[node] = points[rng.integers(len(points))]
        d = np.bitwise_count(points ^ vantage[node]).astype(np.int64)
        radius[node] = int(np.median(d))
        inside[2 * node + 1], inside[2 * node + 2] = points[d <= radius[node]], points[d > radius[node]]
    return vantage, radius


def route(points: np.ndarray, vantage: np.ndarray, radius: np.ndarray, depth: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home shard of each point, and (point index, shard) of the later shards that its ball overlaps."""
    index, node, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
    for _ in range(depth):
        d = np.bitwise_count(points[index] ^ vantage[node]).astype(np.int64)
        r = radius[node]
        left, right = d - reach <= r, d + reach > r
        index, home, node = (np.concatenate([index[left], index[right]]),
                             np.concatenate([(home & (d <= r))[left], (home & (d > r))[right]]),
                             np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]))
    cell = node - ((1 << depth) - 1)
    own = np.empty(len(points), np.int64)
    own[index[home]] = cell[home]
    later = cell > own[index]
    return own, index[later], cell[later]


def joined(home: np.ndarray, others: np.ndarray, max_bits: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint joined with it) for the linked points of home with home and others.

    A vantage-point tree over the home points: a branch keeps the points that its triangle bound can't rule out.
    """
    points = np.concatenate([home, others])
    label = np.arange(len(points))

    def union(i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            li, lj = label[i], label[j]
            different = li != lj
            if not different.any():
                return
            i, j, li, lj = i[different], j[different], li[different], lj[different]
            np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
            while not np.array_equal(label[label], label):
                label[:] = label[label]

    branches = [(np.arange(len(home)), np.arange(len(points)))] if len(home) and len(points) > 1 else []
    while branches:
        h, a = branches.pop()
        if len(h) > leaf:
            vantage = points[h[len(h) // 2]]
            dh, da = (np.bitwise_count(points[x] ^ vantage).astype(np.int64) for x in (h, a))
            radius = int(np.median(dh))
            inner = dh <= radius
            if 0 < inner.sum() < len(h):
                branches.append((h[inner], a[da <= radius + max_bits]))
                branches.append((h[~inner], a[da > radius - max_bits]))
                continue
        for lo in range(0, len(h), 256):
            part = h[lo:lo + 256]
            i, j = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[a][None, :]) <= max_bits)
            i, j = part[i], a[j]
            union(i[i != j], j[i != j])
    low = points.copy()
    np.minimum.at(low, label, points)
    low = low[label]
    differs = low != points
    return points[differs], low[differs]


def links(points: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Stars (a, b) that join exactly the groups of the distinct fingerprints ``points.fp``."""
    n = points.count()
    cores = points.sparkSession.sparkContext.defaultParallelism
    wanted = max(min(SHARDS_PER_CORE * cores, n / LEAF), n / shard, 1)
    depth = min(MAX_DEPTH, math.ceil(math.log2(wanted)))
    some = points.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()  # a bounded sample, for vantage points only
    vantage, radius = build_tree(np.array([r["fp"] for r in some], dtype=np.int64).view(np.uint64), depth)

    def homes(batches):
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            own, _, cell = route(fp, vantage, radius, depth, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, cell])), pa.array(np.concatenate([np.ones(len(own), bool), np.zeros(len(cell), bool)]))],
                                             names=["shard", "home"])

    counted = points.mapInArrow(homes, "shard long, home boolean").groupBy("shard", "home").count().collect()  # 2 * 2**depth rows
    sizes, visits = ({r["shard"]: r["count"] for r in counted if r["home"] == h} for h in (True, False))
    crowd = max(LEAF, 2 * n >> depth)  # a shard beyond twice the mean is split
    blocks = np.array([max(1, math.ceil(sizes.get(s, 0) / crowd)) for s in range(1 << depth)], dtype=np.int64)
    # those who visit a block, its shard's other blocks among them, come in chunks, each with the block's home points
    chunks = np.array([max(1, math.ceil((visits.get(s, 0) + (sizes.get(s, 0) if blocks[s] > 1 else 0)) / shard)) for s in range(1 << depth)], dtype=np.int64)

    def placed(batches):
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            own, index, cell = route(fp, vantage, radius, depth, max_bits)
            block = (C.mix(fp.copy()) % blocks[own].astype(np.uint64)).astype(np.int64)
            # a home point meets the later blocks of its own shard, and every block of the later shards it visits
            who, where = np.concatenate([np.arange(len(fp)), index]), np.concatenate([own, cell])
            first = np.concatenate([block + 1, np.zeros(len(index), np.int64)])
            times = np.maximum(blocks[where] - first, 0)
            rep = np.repeat(np.arange(len(who)), times)
            nth = np.arange(len(rep)) - np.repeat(np.cumsum(times) - times, times) + first[rep]
            guest = fp[who[rep]]
            seat = (C.mix(guest ^ np.uint64(SEED)) % chunks[where[rep]].astype(np.uint64)).astype(np.int64)
            host = np.repeat(np.arange(len(fp)), chunks[own])
            every = np.arange(len(host)) - np.repeat(np.cumsum(chunks[own]) - chunks[own], chunks[own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own[host], where[rep]])), pa.array(np.concatenate([block[host], nth])), pa.array(np.concatenate([every, seat])),
                 pa.array(np.concatenate([fp[host], guest]).view(np.int64)),
                 pa.array(np.concatenate([np.ones(len(host), bool), np.zeros(len(rep), bool)]))],
                names=["shard", "block", "chunk", "fp", "home"])

    def search(table: pa.Table) -> pa.Table:
        fp, home = np.asarray(table.column("fp")).view(np.uint64), np.asarray(table.column("home"))
        a, b = joined(fp[home], fp[~home], max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (points.mapInArrow(placed, "shard long, block long, chunk long, fp long, home boolean")
            .groupBy("shard", "block", "chunk").applyInArrow(search, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex reachable from each vertex of the edges (a, b)."""
    both = C.stage(edges.union(edges.select("b", "a")).toDF("v", "u"), "simhash-edges")
    labels = C.stage(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("root")), "simhash-labels")
    while True:
        seen = both.join(labels.select(F.col("v").alias("u"), "root"), "u").select("v", "root")
        low = seen.union(labels).groupBy("v").agg(F.min("root").alias("low"))
        jump = labels.select(F.col("v").alias("low"), F.col("root").alias("lower"))
        new = low.join(jump, "low").select("v", F.least("low", "lower").alias("root"))
        new = C.stage(new, "simhash-labels")
        if not new.exceptAll(labels).limit(1).count():
            return new
        labels = new


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """Columns of ``docs`` without text, plus fp (long), fingerprint (16 hex digits) and component_id."""
    return C.beside(docs, ["doc_id", "text"], ["fp", "fingerprint", "component_id"], lambda inner: _grouped(inner, shingle, max_bits, shard))


def _rooted(points: DataFrame, max_bits: int, shard: int) -> DataFrame:
    """Columns of ``points`` (one row per fp), plus the root of each fp's component."""
    points = C.stage(points, "simhash-points")
    stars = C.stage(links(points.select("fp"), max_bits, shard), "simhash-links")
    roots = components(stars).toDF("fp", "root")
    return points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int, shard: int) -> DataFrame:
    marked = C.stage(fingerprints(docs, shingle), "simhash-docs")
    named = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), max_bits, shard)
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = named.join(names, "root").select("fp", "component_id")
    return (marked.join(ids, "fp")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """One row of ``docs`` per component: the smallest doc_id, null last; of texts that share it the smallest hash, once."""
    key = F.xxhash64("text")
    marked = C.stage(fingerprints(docs.select("doc_id", key.alias("key"), "text"), shingle), "simhash-docs")
    pairs = C.stage(marked.groupBy("fp", "doc_id", "key").agg(F.count("*").alias("times")), "simhash-pairs")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    named = C.stage(_rooted(pairs.groupBy("fp").agg(F.min(name).alias("low")), max_bits, shard), "simhash-named")
    first = named.groupBy("root").agg(F.min("low").alias("first"))
    judged = pairs.join(named.join(first, "root").select("fp", "first"), "fp").withColumn("stays", (name == F.col("first")))
    judged = C.stage(judged.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "stays", "times"), "simhash-judged")

    def those(rows: DataFrame, which: DataFrame, how: str) -> DataFrame:
        which = which.select("_id", "_key")
        return rows.join(which, rows["doc_id"].eqNullSafe(which["_id"]) & (F.xxhash64(rows["text"]) == which["_key"]), how)

    again = judged.where("stays AND times > 1")
    left = those(docs, judged.where("NOT stays OR times > 1"), "left_anti")
    own = C.free_name(docs, "_own")
    once = those(docs, again, "left_semi").withColumn(own, key).dropDuplicates(["doc_id", own]).drop(own)
    return left.unionByName(once)
