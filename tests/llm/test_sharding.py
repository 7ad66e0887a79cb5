"""Histogram sort: balance, gapless slots, odd inputs."""

import zlib

import pytest

from corpus_rows import docs, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import sharding


def _check(out, shards):
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert set(by) <= set(range(shards))
    return [sum(r.size for r in by.get(s, [])) for s in range(shards)]


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_balance_and_slots(docs, shards):
    out = sharding.shard_documents(docs, shards).collect()
    sizes = _check(out, shards)
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(r.doc_id), len((r.text or "").encode()) + 1) for r in docs.collect())
    largest = max(r.size for r in out)
    assert max(sizes) - min(sizes) <= 2 * largest + 0.02 * sum(sizes) / shards


def test_equal_texts_share_a_shard_unless_too_many(spark):
    rows = [(i, f"text {i}" * 20) for i in range(800)] + [(1000 + i, f"copy {i % 40}" * 20) for i in range(200)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8, tolerance=0.05).collect()
    sizes = _check(out, 8)
    assert max(sizes) <= 1.1 * sum(sizes) / 8 and min(sizes) >= 0.9 * sum(sizes) / 8  # a splitter at either end
    places = {}
    for r in out:
        places.setdefault(zlib.crc32(r.text.encode()), set()).add(r.shard)
    assert all(len(s) == 1 for s in places.values())


@pytest.mark.parametrize("same_id", [False, True])
def test_a_group_of_any_size_is_cut(spark, same_id):
    rows = [(0 if same_id else i, "all the same") for i in range(1000)]
    sizes = _check(sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 16).collect(), 16)
    assert max(sizes) - min(sizes) <= 2 * 13


def test_odd_inputs(odd_docs, no_docs):
    out = sharding.shard_documents(odd_docs, 4)
    assert "text_key" in out.columns and out.columns.count("size") == 1 and out.count() == odd_docs.count()
    assert sharding.shard_documents(no_docs, 4).count() == 0


def test_ids_that_are_no_numbers(spark):
    rows = [(None if i % 7 == 0 else f"id-{i % 50}", "same text" if i % 3 else f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    out = sharding.shard_documents(docs, 4).collect()
    _check(out, 4)
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted((str(a), b) for a, b in rows)
