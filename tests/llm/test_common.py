"""Byte kernels and helpers shared by the corpus operators."""

import re

import numpy as np
import pyarrow as pa
import pytest

from snapmerge.llm import common as C

TEXTS = ["ab cd", None, "", "x", "  y\tz ", "é ü", "ab cd"]


def test_text_bytes_of_a_slice():
    a = pa.array(["zz", *TEXTS]).slice(1)
    data, offsets = C.text_bytes(a)
    assert data.tobytes() == "".join(t or "" for t in TEXTS).encode()
    assert np.diff(offsets).tolist() == [len((t or "").encode()) for t in TEXTS]


def test_spans_stay_in_rows_and_equal_words_hash_equal():
    data, offsets = C.text_bytes(pa.array(TEXTS))
    starts, ends, first = C.spans(~C.SPACE_BYTES[data], offsets)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert words == [w for t in TEXTS for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert np.diff(first).tolist() == [len((t or "").split()) for t in TEXTS]
    h = C.span_hashes(data, starts, ends)
    assert {w: len({int(x) for x, v in zip(h, words) if v == w}) for w in words} == dict.fromkeys(words, 1)
    assert len(set(h.tolist())) == len(set(words))
    g = C.gram_hashes(h, 2)
    assert len(g) == len(h) - 1 and g[0] == g[-1] and len(C.gram_hashes(h[:1], 2)) == 0


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 50, 3, 3, 3)])], names=["text"])
    parts = [p.column(0).to_pylist() for p in C.slices(batch, "text", limit=8)]
    assert [t for p in parts for t in p] == batch.column(0).to_pylist()
    assert [len(p) for p in parts] == [2, 1, 2, 1]
    assert list(C.slices(batch.slice(0, 0), "text")) == []


def test_beside_keeps_other_columns_and_lets_new_ones_win(spark):
    df = spark.createDataFrame([(1, "t", "old", "x")], "id long, text string, score string, `a.b` string")
    out = C.beside(df, ["text"], ["score"], lambda d: d.selectExpr("*", "length(text) AS score"))
    assert out.columns == ["text", "id", "a.b", "score"] and tuple(out.first()) == ("t", 1, "x", 1)


def test_scratch_folder_is_the_configured_one(spark):
    assert C.scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")

    class Cluster:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": staticmethod(dict)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        C.scratch_root(Cluster)


def test_scratch_tables_go(spark):
    import os
    with C.scratch() as made:
        a = C.stage(spark.range(3).toDF("a"), "scratch-a")
        b = C.stage(a.where("a > 0"), "scratch-b")
        assert made == [a, b] and made.pop() is b
    assert not os.path.exists(a._staged_at) and b.count() == 2
