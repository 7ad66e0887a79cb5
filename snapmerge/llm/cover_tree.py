"""Embedding near-duplicates: exact pairs above a cosine within each label, by dual traversal of cover trees.

On unit vectors a cosine of at least ``min_cosine`` is a distance of at most ``sqrt(2 - 2 * min_cosine)``.  Equal vectors of a
label are one point with a count, so copies cost nothing beyond the first.

* Top of the tree, over the cluster: a label with more points than a block is cut into cells around centers from the
  farthest-first order of a bounded sample (the nested nets of a cover tree), each point in the cell of its nearest
  center; Spark takes every cell's covering radius over all its points.  A pair of cells is pruned where the distance of
  their centers less both radii exceeds the limit, and a point joins the pairs of its cell only with cells whose covering radius its own distance reaches.
  The sample decides the balance of the cells, not the pairs found.  Cells are dealt to blocks of about ``BLOCK`` points; small labels share tasks.
* A task joins two blocks.  Each gets a cover tree in memory: nested levels with halving radii, children separated by
  their level's radius, actual covering radii kept (``build``).  ``dual`` walks both trees at once: a node pair goes where its centers are farther apart
  than the limit plus both covering radii; it is accepted whole, without looking at its pairs, where they are within the limit less both; else its children are paired.  Small pairs are compared by exact
  cosine in double precision.
* A task returns one row per linked point: its number of links there and the point it was joined with, never all pairs.  Spark sums the links
  and joins the stars to components (smallest-label propagation).

Rows with a null label, a null or zero vector, or null or non-finite components link with nothing, nor do vectors of
different lengths.  A row that links with nothing has n_links 0 and its own id as component.  Repeated ids are rows of their own; a null id names no component, and a
row without id has a null component where no linked row has one (kept is then false).  Extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmerge.llm import common as C
from snapmerge.llm import vectors as V
from snapmerge.llm.simhash import components

MIN_COSINE = 0.98
#: most points of a block; blocks are smaller where the cluster has cores to spare
BLOCK = 2048
LEAST_BLOCK = 256
BLOCKS_PER_CORE = 4
#: rows and components of the sample that centers are taken from
SAMPLE, SAMPLE_VALUES = 4096, 1 << 20
#: points of a node below which it is not split
LEAF = 32
#: pairs of points that are compared directly
DIRECT = 1 << 16
#: room for rounding where distances prune or accept; exact cosines decide inside it
SLACK = 1e-7


def unit(m: np.ndarray) -> np.ndarray:
    """Rows divided by their norms (scaled first, so that no square overflows)."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


@dataclass
class Node:
    """A ball around a point with all its points; level radii halve from parent to child."""
    center: int
    points: np.ndarray
    radius: float  # largest distance of a point from the center
    children: list["Node"] = field(default_factory=list)


def net(points: np.ndarray, members: np.ndarray, first: int, radius: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(center, its members, their distances): centers more than ``radius`` apart that cover the members; ``first`` is one."""
    out, left = [], members[members != first]
    chosen = [first]
    owner, far = np.full(len(points), -1), np.full(len(points), np.inf)
    owner[first], far[first] = first, 0.0
    fresh = np.array([first])
    while True:
        if len(left):
            d = distance(points[left], points[fresh])
            near = d.argmin(axis=1)
            low = d[np.arange(len(left)), near]
            closer = low < far[left]
            owner[left[closer]], far[left[closer]] = fresh[near[closer]], low[closer]
            left = left[far[left] > radius]
        if not len(left):
            break
        some = left[:256]  # the next centers, separated from one another
        d = distance(points[some], points[some])
        open_, fresh = np.ones(len(some), bool), []
        for k in range(len(some)):
            if open_[k]:
                fresh.append(k)
                open_ &= d[k] > radius
        fresh = some[fresh]
        chosen.extend(fresh.tolist())
        left = left[~np.isin(left, fresh)]
        owner[fresh], far[fresh] = fresh, 0.0
    by = members[np.argsort(owner[members], kind="stable")]
    starts = np.searchsorted(owner[by], np.array(sorted(chosen)))
    for c, own in zip(sorted(chosen), np.split(by, starts[1:])):
        out.append((c, own, far[own]))
    return out


def build(points: np.ndarray, leaf: int = LEAF) -> Node:
    """Cover tree of unit vectors: the root's level has radius 2, the next ones 1, 1/2, 1/4 ..."""
    everything = np.arange(len(points))
    root = Node(0, everything, float(distance(points, points[:1]).max()))
    todo = [(root, 1.0)]
    while todo:
        node, level = todo.pop()
        if len(node.points) <= leaf or node.radius <= SLACK:
            continue
        while level > node.radius:  # levels that would hold the node alone
            level /= 2
        for center, own, far in net(points, node.points, node.center, level):
            child = Node(center, own, float(far.max()))
            node.children.append(child)
            todo.append((child, level / 2))
    return root


class Links:
    """Links counted for every point of two sets, and their spanning groups."""

    def __init__(self, n: int, weight: np.ndarray):
        self.weight = weight
        self.count = np.zeros(n, np.int64)
        self.label = np.arange(n)

    def union(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            li, lj = label[i], label[j]
            apart = li != lj
            if not apart.any():
                return
            i, j, li, lj = i[apart], j[apart], li[apart], lj[apart]
            np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
            while not np.array_equal(label[label], label):
                label[:] = label[label]

    def whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """Every point of ``a`` is linked with every point of ``b``; counted for ``a``."""
        self.count[a] += self.weight[b].sum()
        self.union(np.repeat(a[:1], len(b)), b)
        self.union(a, np.repeat(b[:1], len(a)))

    def some(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        self.count[a] += linked @ self.weight[b]
        i, j = np.nonzero(linked)
        self.union(a[i], b[j])


def dual(points: np.ndarray, left: Node, right: Node, links: Links, min_cosine: float, shift: int = 0) -> None:
    """Count for the points of ``left`` their links with those of ``right``, whose places in ``links`` are shifted."""
    limit = math.sqrt(2.0 - 2.0 * min_cosine)
    todo = [(left, right)]
    while todo:
        a, b = todo.pop()
        if not a.children and not b.children or len(a.points) * len(b.points) <= DIRECT:
            for lo in range(0, len(a.points), 256):
                own = a.points[lo:lo + 256]
                links.some(own, b.points, points[own] @ points[b.points].T >= min_cosine)
            continue
        lefts, rights = a.children or [a], b.children or [b]
        ca, cb = np.array([x.center for x in lefts]), np.array([x.center for x in rights])
        ra, rb = np.array([x.radius for x in lefts]), np.array([x.radius for x in rights])
        for lo in range(0, len(ca), 256):
            d = distance(points[ca[lo:lo + 256]], points[cb])
            reach = ra[lo:lo + 256, None] + rb[None, :]
            for i, j in zip(*np.nonzero(d - reach <= limit + SLACK)):
                if d[i, j] + reach[i, j] <= limit - SLACK:
                    links.whole(lefts[lo + i].points, rights[j].points)
                else:
                    todo.append((lefts[lo + i], rights[j]))


def _shifted(node: Node, by: int) -> Node:
    """The tree with its points' numbers moved up."""
    if by:
        todo = [node]
        while todo:
            x = todo.pop()
            x.center, x.points = x.center + by, x.points + by
            todo.extend(x.children)
    return node


def joined(left: np.ndarray, right: np.ndarray | None, weight: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, smallest place joined with) of every unit vector of ``left`` and ``right`` (None: ``left`` with itself)."""
    points = left if right is None else np.concatenate([left, right])
    links = Links(len(points), weight)
    if len(left) and (right is None or len(right)):
        a = build(left)
        if right is None:
            dual(points, a, a, links, min_cosine)
            links.count -= weight  # a point's cosine with itself is 1
        else:
            b = _shifted(build(right), len(left))
            dual(points, a, b, links, min_cosine)
            dual(points, b, a, links, min_cosine)
    return links.count, links.label


# --- the top of the tree, over the cluster -----------------------------------------------------------------------------

def farthest_first(points: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` of the unit vectors in farthest-first order."""
    chosen, far = [0], distance(points, points[:1])[:, 0]
    while len(chosen) < most and far.max() > SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distance(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


@dataclass
class Cells:
    """Cells of one label: centers, covering radii, and the number of the first block of each (and one past the last)."""
    centers: np.ndarray
    radius: np.ndarray
    first: np.ndarray


def _groups(vectors: pa.Array, labels: pa.Array) -> dict:
    """Places of the rows of each (label, vector length)."""
    found: dict = {}
    for i, k in enumerate(zip(labels.to_pylist(), np.asarray(vectors.value_lengths()).tolist())):
        found.setdefault(k, []).append(i)
    return {k: np.array(v) for k, v in found.items()}


def _column(b, name):
    return b.column(b.schema.get_field_index(name))


def _place(points: DataFrame, n: int, block: int, min_cosine: float) -> DataFrame:
    """Every point once for each task it takes part in: (kind, key, u, v, side, pid, copies, label, vector)."""
    spark = points.sparkSession
    limit = math.sqrt(2.0 - 2.0 * min_cosine) + SLACK
    sizes = C.stage(points.groupBy("label", "width").agg(F.count("*").alias("n")), "cover-sizes")
    sized = points.join(sizes, ["label", "width"])
    some = sized.where(F.col("n") > block)
    widest = V.longest(points, "vector")
    most = max(1, min(SAMPLE, SAMPLE_VALUES // max(1, widest)))
    sample = some.select("label", "vector", "n").orderBy(F.xxhash64("pid"), "pid").limit(most).collect()  # bounded, for centers only
    seen: dict = {}
    for r in sample:
        seen.setdefault((r.label, len(r.vector)), (r.n, []))[1].append(r.vector)
    centers = {k: farthest_first(unit(np.array(v, dtype=np.float64)), math.ceil(size / block)) for k, (size, v) in seen.items()}
    number = {k: i for i, k in enumerate(centers)}

    def measure(batches):
        for b in batches:
            vectors, out = _column(b, "vector"), []
            for k, at in _groups(vectors, _column(b, "label")).items():
                if k in centers:
                    d = distance(unit(V.matrix(vectors.take(pa.array(at)), k[1])), centers[k])
                    cell = d.argmin(axis=1)
                    for c in np.unique(cell).tolist():
                        own = d[cell == c, c]
                        out.append((number[k], c, len(own), float(own.max())))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                             names=["label", "cell", "n", "radius"])

    found = (some.select("label", "vector").mapInArrow(measure, "label long, cell long, n long, radius double")
             .groupBy("label", "cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()) if centers else []  # at most one row per center
    cells, at = {}, 0
    for k, c in centers.items():
        size, radius = np.zeros(len(c), np.int64), np.zeros(len(c))
        for r in found:
            if r.label == number[k]:
                size[r.cell], radius[r.cell] = r.n, r.radius
        blocks = np.maximum(1, -(-size // block))
        first = np.concatenate([[0], np.cumsum(blocks)]) + at
        cells[k], at = Cells(c, radius, first), int(first[-1])
    shared = max(1, math.ceil(n / block))

    def deal(batches):
        for b in batches:
            vectors, labels, pid = _column(b, "vector"), _column(b, "label"), np.asarray(_column(b, "pid"))
            sizes_, tag = np.asarray(_column(b, "n")), np.asarray(_column(b, "tag"))
            spread = C.mix(pid.astype(np.uint64)).astype(np.uint64)
            row, kind, key, u, v, side = ([np.zeros(0, np.int64)] for _ in range(6))

            def put(rows, kinds, keys, own, other):
                for target, x in zip((row, kind, key, u, v, side), (rows, np.full(len(rows), kinds), keys, np.minimum(own, other), np.maximum(own, other), (own > other).astype(np.int64))):
                    target.append(x)

            for k, at_ in _groups(vectors, labels).items():
                if k in cells:
                    cell = cells[k]
                    d = distance(unit(V.matrix(vectors.take(pa.array(at_)), k[1])), cell.centers)
                    home = d.argmin(axis=1)
                    count = np.diff(cell.first)
                    own = cell.first[home] + (spread[at_] % count[home].astype(np.uint64)).astype(np.int64)
                    between = distance(cell.centers, cell.centers)
                    meets = (between - cell.radius[:, None] - cell.radius[None, :] <= limit)[home] & (d - cell.radius[None, :] <= limit)
                    meets[np.arange(len(home)), home] = True
                    i, c = np.nonzero(meets)
                    times = count[c]
                    again = np.repeat(np.arange(len(i)), times)
                    nth = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                    put(at_[i[again]], 0, np.zeros(len(again), np.int64), own[i[again]], cell.first[c[again]] + nth)
                elif sizes_[at_[0]] <= block:  # a task of several labels
                    put(at_, 1, tag[at_] % shared, np.zeros(len(at_), np.int64), np.zeros(len(at_), np.int64))
                else:  # a large label that the sample missed: every block meets every other
                    count = int(-(-sizes_[at_[0]] // block))
                    own = (spread[at_] % np.uint64(count)).astype(np.int64)
                    put(np.repeat(at_, count), 2, np.repeat(tag[at_], count), np.repeat(own, count), np.tile(np.arange(count), len(at_)))
            rows = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.concatenate(x)) for x in (kind, key, u, v, side)), *(_column(b, c).take(rows) for c in ("pid", "copies", "label", "vector"))],
                names=["kind", "key", "u", "v", "side", "pid", "copies", "label", "vector"])

    tag = F.xxhash64("label", "width").bitwiseAND(F.lit((1 << 63) - 1)).alias("tag")
    given = sized.select("pid", "copies", "label", "vector", "n", tag)
    label = points.schema["label"].dataType.simpleString()
    return given.mapInArrow(deal, f"kind long, key long, u long, v long, side long, pid long, copies long, label {label}, vector {dict(points.dtypes)['vector']}")


def links(points: DataFrame, min_cosine: float = MIN_COSINE, block: int | None = None) -> DataFrame:
    """(pid, links, joined): for points with links, task by task, how many vectors they link with and a point they are joined with.

    ``points`` is a written table of (pid, copies, label, width, vector), distinct vectors of a label.
    """
    spark = points.sparkSession
    C.ship(spark)
    n = points.count()
    if block is None:
        block = min(BLOCK, max(LEAST_BLOCK, n // (BLOCKS_PER_CORE * spark.sparkContext.defaultParallelism)))

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        pid, copies, side = (np.asarray(table.column(c)) for c in ("pid", "copies", "side"))
        vectors, labels = (table.column(c).combine_chunks() for c in ("vector", "label"))
        got = [(np.zeros(0, np.int64),) * 3]
        for k, at in _groups(vectors, labels).items():
            m = unit(V.matrix(vectors.take(pa.array(at)), k[1]))
            if table.column("u")[0].as_py() == table.column("v")[0].as_py():
                count, low = joined(m, None, copies[at], min_cosine)
            else:
                order = np.argsort(side[at], kind="stable")
                at, m, split = at[order], m[order], int((side[at] == 0).sum())
                count, low = joined(m[:split], m[split:], copies[at], min_cosine)
            linked = count > 0
            got.append((pid[at][linked], count[linked], pid[at[low]][linked]))
        return pa.table(dict(zip(("pid", "links", "joined"), (np.concatenate(x) for x in zip(*got)))))

    return _place(points, n, block, min_cosine).groupBy("kind", "key", "u", "v").applyInArrow(search, "pid long, links long, joined long")


def near_duplicates(vectors: DataFrame, vector: str = "embedding", min_cosine: float = MIN_COSINE, block: int | None = None) -> DataFrame:
    """Columns of ``vectors`` without the vector, plus n_links, component_id and kept."""
    def work(inner: DataFrame) -> DataFrame:
        v = F.col(vector)
        counts = V.usable(v) & F.col("label").isNotNull() & F.exists(v, lambda x: x != 0)
        rows = inner.withColumn("_ok", F.coalesce(counts, F.lit(False)))
        key = [F.xxhash64(v).alias("_k1"), F.xxhash64(F.lit("second"), v).alias("_k2")]  # 128 bits
        points = (rows.where("_ok").select("vec_id", "label", vector, *key).groupBy("label", "_k1", "_k2")
                  .agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first(vector).alias("vector")))
        points = C.stage(points.select(F.monotonically_increasing_id().alias("pid"), F.size("vector").alias("width"), "*"), "cover-points")
        found = C.stage(links(points.select("pid", "copies", "label", "width", "vector"), min_cosine, block), "cover-links")
        total = found.groupBy("pid").agg(F.sum("links").alias("links"))
        roots = components(found.where("pid != joined").select(F.col("pid").alias("a"), F.col("joined").alias("b")).distinct()).toDF("pid", "root")
        named = (points.select("pid", "label", "_k1", "_k2", "copies", "low").join(total, "pid", "left").join(roots, "pid", "left")
                 .withColumn("root", F.coalesce("root", "pid")))
        named = C.stage(named, "cover-named")
        lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
        named = C.stage(named.join(lowest, "root").select(F.col("label").alias("_label"), "_k1", "_k2", "component_id",
                                                          (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "cover-classes")
        rows = rows.select(*(c for c in rows.columns if c != vector), F.when(F.col("_ok"), key[0]).alias("_a"), F.when(F.col("_ok"), key[1]).alias("_b"))
        met = rows.join(named, (rows["label"] == named["_label"]) & (rows["_a"] == named["_k1"]) & (rows["_b"] == named["_k2"]), "left")
        mine = F.when(F.col("_ok"), F.col("component_id")).otherwise(F.col("vec_id"))
        return (met.withColumn("component_id", mine).withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
                .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))

    return C.beside(vectors, ["vec_id", "label", vector], ["n_links", "component_id", "kept"], work)
