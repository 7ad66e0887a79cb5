"""Benchmark decontamination against brute force, and odd inputs."""

import re

import pytest
from corpus_rows import docs, hit_table, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import decontam


@pytest.fixture(scope="module")
def items(spark, rows):
    long = dict((r[0], r[1]) for r in rows if r[0] is not None)
    picked = [(1, " ".join(long[60].split()[10:40])), (2, long[72].split("\n")[1].upper()), (3, "w1"), (4, "WITHOUT an"), (5, None), (6, " ... "),
              (7, "Élan über"), (2, "日本語"), (8, " ".join(long[60].split()[10:40])), (None, "w2 w3"), (9, long[3]), (10, "aaaa " * 20)]
    return spark.createDataFrame(picked, "item_id long, text string")


def test_matches_brute_force(docs, items):
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.n_items, r.contaminated) for r in decontam.decontaminate(docs, items).collect()), key=str)
    want = hit_table([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == sorted(want, key=str)
    assert any(g[5] for g in got) and not all(g[5] for g in got)


def test_small_bitmap_changes_nothing(docs, items):
    a = decontam.decontaminate(docs, items).select("doc_id", "n_hit", "n_items").collect()
    b = decontam.decontaminate(docs, items, bits=8).select("doc_id", "n_hit", "n_items").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_filter_keeps_columns_and_clean_rows(odd_docs, items):
    kept = decontam.remove_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    bad = {(r.doc_id) for r in decontam.decontaminate(odd_docs, items).where("contaminated").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in odd_docs.collect()} - bad


def test_empty_tables(docs, no_docs, items):
    assert decontam.decontaminate(no_docs, items).count() == 0
    none = decontam.decontaminate(docs, items.limit(0)).collect()
    assert len(none) == docs.count() and not any(r.n_hit or r.contaminated for r in none)


def test_word_rule():
    assert re.findall(decontam.WORD, "ab-c1 Élan_x") == ["ab", "c1", "Élan", "x"]
