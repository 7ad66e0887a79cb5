"""Vector operators against plain NumPy: near-duplicates, hard negatives, codes."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmerge.llm import cover_tree, hard_negatives, vector_codes, vectors

SCHEMA = "vec_id long, label int, embedding array<float>"
CLASH = ["n_links", "component_id", "kept", "pid", "copies", "low", "vector", "code", "error", "label_error", "n", "_k1", "_extra0"]


def vector_rows(n=260, dim=16, seed=5, odd=True):
    """Random vectors with copies, chains of near copies, multiples, and unusable rows."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base[40:80] = base[3] + rng.normal(size=(40, dim)) * 0.12  # a cloud whose pairs lie on both sides of the limit
    base[80:90] = base[4]
    base[90:95] = base[5] * rng.uniform(0.5, 3, size=(5, 1))
    labels = rng.integers(0, 3, n)
    labels[40:95] = 1
    labels[:40:2] = 1
    rows = [(i, int(labels[i]), [float(np.float32(x)) for x in base[i]]) for i in range(n)]
    if odd:
        rows += [(n, 1, None), (n + 1, None, rows[3][2]), (n + 2, 1, [0.0] * dim), (n + 3, 1, [float("nan")] + [1.0] * (dim - 1)),
                 (n + 4, 1, [float("inf")] + [1.0] * (dim - 1)), (n + 5, 1, [None] + [1.0] * (dim - 1)), (n + 6, 1, []),
                 (None, 1, rows[4][2]), rows[7], (7, 1, rows[41][2])]
    return rows


def usable(e):
    return e is not None and all(x is not None and np.isfinite(x) for x in e)


def plain_links(rows, limit):
    """(links, smallest reachable id) of every row."""
    ok = [usable(e) and lab is not None and any(e) for _, lab, e in rows]
    m = np.array([np.array(e) / np.linalg.norm(e) if k else np.zeros(16) for (_, _, e), k in zip(rows, ok)])
    lab = np.array([r[1] if k else -1 - i for i, (r, k) in enumerate(zip(rows, ok))])
    g = (m @ m.T >= limit) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(g, False)
    ids = np.array([np.inf if r[0] is None else r[0] for r in rows])
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(g, low[None, :], np.inf).min(axis=1))
        if (new == low).all():
            return [(None if r[0] is None else r[0], int(c), None if np.isinf(x) else int(x)) for r, c, x in zip(rows, g.sum(axis=1), low)]
        low = new


def spark_frame(spark, rows, clash=False):
    schema = SCHEMA + "".join(f", `{c}` string" for c in CLASH if clash)
    return spark.createDataFrame([(*r, *(["z"] * len(CLASH) if clash else [])) for r in rows], schema).repartition(3)


def text_sorted(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("block", [None, 40])
def test_cover_tree_links(spark, block):
    rows = vector_rows()
    got = cover_tree.near_duplicates(spark_frame(spark, rows, clash=True), block=block)
    assert set(got.columns) == {"vec_id", "label", *CLASH} and got.count() == len(rows)
    want = plain_links(rows, 0.98)
    assert max(c for _, c, _ in want) > 9
    assert text_sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == text_sorted(want)
    for r in got.collect():
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id) and r.pid == "z"


def test_cover_tree_missed_sample(spark, monkeypatch):
    """Large labels that the sample of centers missed are joined block by block."""
    monkeypatch.setattr(cover_tree, "SAMPLE", 1)
    rows = vector_rows(odd=False)
    got = cover_tree.near_duplicates(spark_frame(spark, rows), block=30)
    assert text_sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == text_sorted(plain_links(rows, 0.98))


def test_cover_tree_levels():
    rng = np.random.default_rng(2)
    points = cover_tree.unit(np.concatenate([rng.normal(size=(300, 8)), rng.normal(size=(1, 8)) + rng.normal(size=(300, 8)) * 0.05]))
    root = cover_tree.build(points, leaf=4)
    todo, seen = [root], 0
    while todo:
        x = todo.pop()
        seen += 1
        d = cover_tree.distance(points[x.points], points[[x.center]])[:, 0]
        assert abs(d.max() - x.radius) < 1e-6
        if x.children:
            assert sorted(np.concatenate([c.points for c in x.children]).tolist()) == sorted(x.points.tolist())
            assert x.center in [c.center for c in x.children]  # nested
            gap = cover_tree.distance(points[[c.center for c in x.children]], points[[c.center for c in x.children]])
            level = 2.0 ** np.floor(np.log2(max(x.radius, 1e-12)))
            assert (gap[~np.eye(len(gap), dtype=bool)] > level / 2 - 1e-9).all() and all(c.radius <= level + 1e-9 for c in x.children)
        todo.extend(x.children)
    assert seen > 50
    for limit in (0.5, 0.9, 0.98, 0.999):
        count, _ = cover_tree.joined(points[:350], points[350:], np.ones(600, np.int64), limit)
        g = points @ points.T >= limit
        assert (count[:350] == g[:350, 350:].sum(axis=1)).all() and (count[350:] == g[350:, :350].sum(axis=1)).all()


def test_cover_tree_prunes(monkeypatch):
    """Well-separated clusters are not compared with one another."""
    compared = []
    real = cover_tree.Links.some
    monkeypatch.setattr(cover_tree.Links, "some", lambda self, a, b, linked: (compared.append(len(a) * len(b)), real(self, a, b, linked))[1])
    rng = np.random.default_rng(3)
    points = cover_tree.unit(np.repeat(rng.normal(size=(40, 32)), 60, axis=0) + rng.normal(size=(2400, 32)) * 0.005)
    count, label = cover_tree.joined(points, None, np.ones(2400, np.int64), 0.98)
    assert (count == 59).all() and len(set(label.tolist())) == 40
    assert sum(compared) < 0.05 * 2400 ** 2


def plain_negatives(rows, anchor, k=5):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and usable(r[2])]
    m = np.zeros((len(rows), 16))
    for i, r in enumerate(rows):
        m[i, :len(r[2])] = r[2]
    ids, lab, out = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), []
    for a in np.flatnonzero([anchor(i) for i in ids]):
        s = (m @ m[a]).astype(np.int64)
        order = np.lexsort((ids, -s))
        for p in [j for j in order if lab[j] == lab[a] and j != a][:k]:
            fit = [j for j in order if lab[j] != lab[a] and 80 * s[p] <= 100 * s[j] <= 100 * s[p]][:k]
            out += [(ids[a], ids[p], r, ids[j], s[p], s[j]) for r, j in enumerate(fit, 1)]
    return sorted(tuple(map(int, x)) for x in out)


@pytest.mark.parametrize("block", [64, 8192])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "TOGETHER", 7)
    rows = [(i, lab, None if e is None else [x if x is None or not np.isfinite(x) else float(np.floor(9 * x)) for x in e]) for i, lab, e in vector_rows()]
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>").repartition(3)
    got = sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 6 == 0).collect())
    assert got == plain_negatives(rows, lambda i: i % 6 == 0) and len(got) > 200


def test_candidates_are_exact():
    rng = np.random.default_rng(4)
    a, r = np.floor(rng.normal(size=(30, 40)) * 20), np.floor(rng.normal(size=(500, 40)) * 20 * np.linspace(3, 0.1, 40))
    for low in (-1e9, 0, 2000, 9000, 1e9):
        least = low + rng.integers(0, 500, 30)
        i, j, s = hard_negatives.candidates(a, r, least)
        want = {(x, y): v for x, row in enumerate(a @ r.T) for y, v in enumerate(row) if v >= least[x]}
        assert dict(zip(zip(i.tolist(), j.tolist()), s.tolist())) == want and len(i) == len(want)


def plain_codes(rows, scale=64):
    kept = [r for r in rows if usable(r[2])]
    q = np.zeros((len(kept), 16), np.int64)
    for i, r in enumerate(kept):
        q[i, :len(r[2])] = np.floor(scale * np.array(r[2]))
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:16]
    code, error, books = np.zeros((len(kept), 8), int), np.zeros(len(kept), int), []
    for p in range(8):
        x = q[:, 2 * p:2 * p + 2]
        book = x[first].copy()
        for _ in range(7):
            d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            c = d.argmin(axis=1)
            code[:, p], last = c, book.copy()
            for e in range(len(book)):
                if (c == e).any():
                    book[e] = x[c == e].sum(axis=0) // (c == e).sum()
        error += d.min(axis=1)
        books.append(last)
    return kept, code, error, hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()


def test_codes(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "CHUNK", 5)
    rows = vector_rows()
    kept, code, error, digest = plain_codes(rows)
    coded, books = vector_codes.compress(spark_frame(spark, rows, clash=True), scale=64)
    assert vector_codes.books_digest(books) == digest
    got = vector_codes.error_by(coded.drop("label_error"), "label").collect()
    total = {}
    for r, e in zip(kept, error):
        total[r[1]] = total.get(r[1], 0) + int(e)
    want = [(r[0], r[1], [int(c) for c in cs], int(e), total[r[1]]) for r, cs, e in zip(kept, code, error)]
    assert text_sorted((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got) == text_sorted(want)


def test_trie_shares_prefixes():
    rng = np.random.default_rng(6)
    leaves = np.unique(rng.integers(-3, 3, size=(900, 6)), axis=0)
    book = rng.integers(-3, 3, size=(16, 6))
    code, error = vector_codes.nearest(leaves, book, chunk=7)
    d = ((leaves[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cover_tree.near_duplicates(none).count() == 0
    assert hard_negatives.mine(none.withColumnRenamed("embedding", "vector"), F.col("vec_id") % 2 == 0).count() == 0
    coded, _ = vector_codes.compress(none)
    assert vector_codes.error_by(coded, "label").count() == 0
    only = spark.createDataFrame([(1, 1, None), (2, 1, [float("nan")])], SCHEMA)
    assert vector_codes.compress(only)[0].count() == 0 and {r.n_links for r in cover_tree.near_duplicates(only).collect()} == {0}
    assert only.where(vectors.usable(F.col("embedding"))).count() == 0
