"""Repeated strings against brute force on bytes, and odd inputs."""

import hashlib
import random

import numpy as np
import pytest
from corpus_rows import docs, kept_bytes, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import repeats


def _check(docs, **options):
    got = repeats.digest(repeats.mark_repeats(docs, **options)).collect()
    raw = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest())
            for (i, _), (n, gone, spans, kept) in zip(raw, kept_bytes([t for _, t in raw], options.get("length", 400)))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return want


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"length": 64, "modulus": 8}, {"length": 64, "modulus": 8, "crowd": 0}, {"length": 48, "modulus": 1000}])
def test_matches_brute_force(docs, options):
    want = _check(docs, **options)
    assert any(w[2] for w in want) and any(not w[2] for w in want)


def test_periodic_and_random_texts(spark):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcd") for _ in range(700))
    texts = ["ab" * 500, "ab" * 500 + "c", "abc" * 300, shared, "q" + shared[100:650] + "r", shared[:399], "é" * 450, "z" * 400, "z" * 399, None, ""]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(900))) for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check(frame)
    _check(frame, length=40, modulus=4)


def test_smallest_is_the_first_minimum():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 5, 1000, dtype=np.uint64) << np.uint64(60)
    got = repeats.smallest(h, 17)
    assert got.tolist() == [i + int(np.argmin(h[i:i + 17])) for i in range(1000 - 16)]


def test_equal_suffixes():
    flags = repeats.equal_suffixes([(b"abcdef", 0, 3, 1), (b"xbcdeq", 0, 3, 1), (b"zzzzz", 0, 2, 2)], 4)
    assert [f.tolist() for f in flags] == [[False, True, False], [False, True, False], [True, True]]


def test_text_without_repeats_stays_and_columns_too(odd_docs, no_docs):
    out = repeats.remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    marked = {(r.doc_id, r.text): r.removed for r in repeats.mark_repeats(odd_docs).collect()}
    assert sorted((str(k[0]), str(repeats.cut(k[1], v))) for k, v in marked.items()) == sorted({(str(r.doc_id), str(r.text)) for r in out.collect()})
    assert repeats.remove_repeats(no_docs).count() == 0


def test_parts_of_equal_strings_share_a_key():
    rng = random.Random(3)
    middle = bytes(rng.randrange(97, 100) for _ in range(100))
    a, b = b"left" + middle + b"1234", b"xeft" + middle + b"12z4"  # triggers at 44 and 44, strings of 60 bytes
    for width in (64, 8, 1):
        found = [{a0: (block, key, (first, last)) for block, key, _, first, last in repeats.parts_of(x, 44, 0, len(x) - 60, 60, width)
                  for a0 in range(first, last + 1)} for x in (a, b)]
        assert all(sorted(f) == list(range(len(a) - 59)) for f in found)
        for j in range(len(a) - 59):
            same = a[j:j + 60] == b[j:j + 60]
            assert not same or found[0][j][:2] == found[1][j][:2]
            assert width > 1 or same == (found[0][j][1] == found[1][j][1])


def test_crowded_cores_are_not_cut_into_all_their_strings(spark, monkeypatch):
    """Copies that each differ in a place of their own: the pieces counted are far fewer than the strings."""
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    texts = [base[:p] + "#" + base[p + 1:] for p in rng.sample(range(200, 800), 60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    staged, stage = {}, repeats.C.stage

    def kept(df, name):
        out = stage(df, name)
        staged.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(repeats.C, "stage", kept)
    want = _check(frame, crowd=0)
    assert any(w[2] for w in want)
    parsed = stage(repeats._parsed(frame, repeats.LENGTH, repeats.MODULUS), "parsed")
    strings = parsed.dropDuplicates(["core", "entry"]).selectExpr("sum(e - s + 1)").first()[0]
    assert sum(staged["repeats-parts"]) < strings / 3


def test_cut_keeps_code_points_whole():
    assert repeats.cut("aéb", [{"start": 2, "end": 4}]) == "aé"
    assert repeats.cut("aéb", [{"start": 1, "end": 3}]) == "ab"
    assert repeats.cut("aéb", [{"start": 0, "end": 2}]) == "éb"
    assert repeats.cut(None, []) is None


def test_passages_by_words(spark):
    """Repeats of fewer words stay; without blanks 400 bytes are enough."""
    rng = random.Random(4)

    def some(n):
        return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    long, short, solid = some(60), some(40), "日本語テキスト" * 30
    texts = [some(30) + " " + x + " " + some(30) for x in (long, short, solid)] + [some(20) + " " + x + " " + some(50) for x in (long, short, solid)]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in repeats.remove_repeats(frame, length=240, min_words=50).collect()}
    want = [k.decode() for *_, k in kept_bytes(texts, 240, 50)]
    assert [out[i].text for i in range(6)] == want and [out[i].n_chars for i in range(6)] == [len(t) for t in want]
    assert [out[i].text == texts[i] for i in range(6)] == [False, True, False] * 2
