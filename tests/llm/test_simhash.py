"""SimHash components against all pairs, and odd inputs."""

import os
import tempfile
import uuid

import numpy as np
import pytest
import xxhash

from corpus_rows import docs, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import simhash


def plain_fingerprint(text, k=4):
    w = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, bits):
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= bits and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    low = {}
    for i, r in enumerate(root):
        if ids[i] is not None:
            low[r] = min(low.get(r, ids[i]), ids[i])
    return [low.get(r) for r in root]


@pytest.mark.parametrize("shard", [250_000, 4])
@pytest.mark.parametrize("bits", [4, 9])
def test_matches_all_pairs(docs, shard, bits):
    got = simhash.near_duplicates(docs, max_bits=bits, shard=shard).select("doc_id", "fingerprint", "component_id").collect()
    raw = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [plain_fingerprint(t) for _, t in raw]
    want = zip([i for i, _ in raw], [f"{f:016x}" for f in fps], plain_components([i for i, _ in raw], fps, bits))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_tree_in_memory_is_exact():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    pts = np.unique(np.concatenate([base, near]))
    rng.shuffle(pts)
    a = dict(zip(*(x.tolist() for x in simhash.joined(pts, pts[:0], 4, leaf=8))))
    b = dict(zip(*(x.tolist() for x in simhash.joined(pts, pts[:0], 4, leaf=10_000))))
    assert a == b and a


def test_every_close_pair_meets_in_a_shard():
    rng = np.random.default_rng(6)
    p = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    q = p.copy()
    for _ in range(4):
        q ^= np.uint64(1) << rng.integers(0, 64, len(q)).astype(np.uint64)
    v, r = simhash.build_tree(p[:500], 6)
    (own_p, ip, cp), (own_q, iq, cq) = simhash.route(p, v, r, 6, 4), simhash.route(q, v, r, 6, 4)
    visits_p, visits_q = set(zip(ip.tolist(), cp.tolist())), set(zip(iq.tolist(), cq.tolist()))
    for i in range(len(p)):
        a, b = int(own_p[i]), int(own_q[i])
        assert a == b or (a < b and (i, b) in visits_p) or (b < a and (i, a) in visits_q)


def test_chain_of_components(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    got = {r.v: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_keep_one(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd_docs).collect()}
    assert sorted({r.doc_id for r in kept.collect()}, key=str) == sorted({d for d, c in found.items() if d is None or d == c}, key=str)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_keep_one_by_row(spark):
    def text(i):
        return " ".join(f"t{i}w{k}" for k in range(40))
    rows = [(7, text(1)), (None, text(1)), (None, text(1)), (9, text(1)),  # a copy without id beside a row that names the group
            (3, text(2)), (3, text(2)), (3, text(2)),  # repeated rows
            (None, text(3)), (None, text(3)),  # nobody has an id
            (8, text(1)), (8, text(4)),  # one id, two texts, one of them a copy
            (5, text(5)), (5, text(6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(got, key=str) == sorted([(7, text(1)), (3, text(2)), (None, text(3)), (8, text(4)), (5, text(5)), (5, text(6))], key=str)


def test_keep_one_leaves_as_many_rows_as_groups(odd_docs):
    raw = [(r.doc_id, r.text) for r in odd_docs.collect()]
    groups = plain_components(list(range(len(raw))), [plain_fingerprint(t) for _, t in raw], 4)
    assert simhash.keep_one(odd_docs).count() == len(set(groups))


def test_no_task_holds_more_than_a_chunk(spark, monkeypatch):
    rng = np.random.default_rng(8)
    fps = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    fps = np.unique(np.concatenate([fps, fps[:1000] ^ np.uint64(5)]))
    points = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").cache()
    whole = {tuple(r) for r in simhash.components(simhash.links(points)).collect()}
    folder = tempfile.mkdtemp(prefix="simhash-chunks-")
    plain = simhash.joined

    def noting(home, others, max_bits, folder=folder, plain=plain):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{len(home)} {len(others)}")
        return plain(home, others, max_bits)
    monkeypatch.setattr(simhash, "joined", noting)
    monkeypatch.setattr(simhash, "MAX_DEPTH", 4)
    shard = 300
    cut = {tuple(r) for r in simhash.components(simhash.links(points, shard=shard)).collect()}
    assert cut == whole and len(whole) >= 2000
    held = [tuple(map(int, open(f"{folder}/{n}").read().split())) for n in os.listdir(folder)]
    assert max(others for _, others in held) < 1.5 * shard and max(home for home, _ in held) <= 1.5 * (2 * len(fps) >> 4)
