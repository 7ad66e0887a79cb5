"""Tokens against the tokenizer itself, packings for gaps and fill, odd inputs."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpus_rows import docs, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_cached_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(1)
    alphabet = "abcXYZ'stredvmlß éÀµªº²½09.,!?-_\t\n\x0b\x85\xa0\x1c\x00\x7f×÷¡"
    texts = ["", "It's THEY'RE we'll I'd don't 's 'S", "Ünïcode ÀÉ ñandú ²³½ µm ªº", "日本語 テキスト", "é ä ́x", "a <|endoftext|> b <|start",
             "ΑΣ Σ ς İstanbul", "a b c\u0085d", "emoji 😀 👩‍👩‍👧", "it’s"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["".join(rng.choice(alphabet + "́Ωжя ") for _ in range(rng.randrange(60))) for _ in range(400)]
    cache = packing.WordCache(PATH)
    for t in texts:
        assert np.frombuffer(cache.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_in_use_are_tokenised_once(monkeypatch):
    """A full cache lets go of the words that no longer come, however long the others are."""
    monkeypatch.setattr(packing, "CACHE", 100)
    cache, learnt = packing.WordCache(PATH), []
    learn = cache._learn_tokens
    monkeypatch.setattr(cache, "_learn_tokens", lambda parts: (learnt.extend(parts), learn(parts)))
    for i in range(10):
        rare = " ".join(f"{a}{b}rareword" for a in "abcdefghij"[i] for b in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîï")
        assert cache.encode(f"frequently {rare} x{chr(97 + i) * 9}") == packing.WordCache(PATH).encode(f"frequently {rare} x{chr(97 + i) * 9}")
    names = [p.decode("latin-1") if isinstance(p, bytes) else p for p in learnt]
    assert names.count("frequently") == 1 and len(cache.known) + len(getattr(cache, "older", ())) < 300


def _packed(docs, capacity, **options):
    rows = packing.pack(packing.pieces(docs, PATH, capacity), capacity, **options).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return rows, bins


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_and_sequences(docs, tokenizer, capacity):
    rows, bins = _packed(docs, capacity, group=16)
    total = sum(r.length for r in rows)
    assert len(bins) <= math.ceil(total / capacity) * 1.1 + 1
    got = sorted((str(r.doc_id), r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows)
    want = []
    for d in docs.collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        want += [(str(d.doc_id), k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes()))
                 for k in range(0, len(ids), capacity)]
    assert got == sorted(want)


def test_odd_inputs(odd_docs, no_docs):
    rows, _ = _packed(odd_docs.drop("length"), 2048)
    assert {r.text_key for r in rows} == {"z"}
    assert packing.pack(packing.pieces(no_docs, PATH)).count() == 0


def test_genetic_steps_keep_all_pieces():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 200).tolist()
    population = packing.first_population(lengths, 4, 100, rng)
    for p in packing.evolve(lengths, population, 100, 30, rng):
        assert sorted(x for b in p for x in b) == list(range(200))
        assert all(sum(lengths[x] for x in b) <= 100 for b in p)
    best = packing.evolve(lengths, population, 100, 30, np.random.default_rng(4))[0]
    assert packing.fitness(lengths, best, 100) >= max(packing.fitness(lengths, p, 100) for p in population)
    assert packing._decoded(packing._coded(best, 200)) == [sorted(b) for b in best]


def test_hard_instance_improves_on_best_fit():
    """Triplets that fill bins exactly, where best fit alone leaves gaps."""
    rng = np.random.default_rng(8)
    lengths = []
    for _ in range(20):
        a = int(rng.integers(30, 45))
        b = int(rng.integers(25, 70 - a + 20))
        lengths += [a, b, 100 - a - b]
    start = packing.first_population(lengths, 6, 100, rng)
    end = packing.evolve(lengths, start, 100, 400, rng)[0]
    assert len(end) <= min(map(len, start))
