"""Small documents for the corpus tests, and plain Python versions of the operators' rules."""

import random
import re

import pytest


def words(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def document_rows(seed=3):
    """Small documents: nulls, blanks, non-ASCII, copies, near copies, shared passages, repeated rows, one long text."""
    rng = random.Random(seed)
    passage = words(rng, 90, 10_000)
    rows = []
    for i in range(60):
        rows.append((i, words(rng, rng.randrange(1, 160), 5000), f"src{i % 3}"))
    base = words(rng, 400, 5000)
    for i in range(60, 66):
        rows.append((i, base, "src0"))
    for i in range(66, 72):
        at = rng.randrange(len(base) - 10)
        rows.append((i, base[:at] + "X" + base[at + 1:], "src1"))
    for i in range(72, 78):
        rows.append((i, words(rng, 30, 5000) + "\n" + passage + "\n" + words(rng, 20, 5000), "src2"))
    rows += [(78, None, "src0"), (79, "", None), (80, "   \n\t ", "src1"), (81, "Élan über ñandú", None), (82, "日本語 テキスト", "src1"),
             (83, words(rng, 30_000, 4000), "src2"), (84, "aaaa " * 700, "src0"), (85, "x" * 3000, "src0"), (None, "a row without an id", "src0"),
             (86, None, None), (5, rows[5][1], "src2"), (5, rows[5][1], "src2"), (87, "é" * 900, "src1"), (88, "ab" + "é" * 900, "src1")]
    return rows


#: names that the operators use themselves
CLASHING = ["text_key", "n_words", "fp", "score", "size", "shard", "slot", "spans", "removed", "lines", "host", "label", "length", "_uid", "_extra0"]


def frame(spark, rows, clash=False):
    schema = "doc_id long, text string, source string" + "".join(f", `{c}` string" for c in CLASHING if clash)
    return spark.createDataFrame([(*r, *(["z"] * len(CLASHING) if clash else [])) for r in rows], schema)


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3)


@pytest.fixture(scope="session")
def odd_docs(spark, rows):
    return frame(spark, rows, clash=True).repartition(2)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hit_table(docs, items, window=13):
    owners = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        if item is not None and w:
            for a in range(max(1, len(w) - window + 1)):
                owners.setdefault(tuple(w[a:a + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in owners}:
            for a in range(len(w) - n + 1):
                who = owners.get(tuple(w[a:a + n]))
                if who:
                    hit.update(range(a, a + n))
                    found |= who
        out.append((doc, len(w), len(hit), tuple(sorted(map(str, found))), len(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def kept_bytes(texts, length=400, min_words=0):
    """(bytes, removed, spans, what is left) of each text; with ``min_words``, spans of fewer words and under 400 bytes stay."""
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for a in range(len(b) - length + 1):
            seen[b[a:a + length]] = seen.get(b[a:a + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if seen[b[a:a + length]] > 1:
                gone[a:a + length] = b"\1" * length
        for m in re.finditer(b"\1+", bytes(gone)):
            if len(m[0]) < 400 and len(b[m.start():m.end()].split()) < min_words:
                gone[m.start():m.end()] = bytes(len(m[0]))
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out
