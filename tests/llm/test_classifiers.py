"""Toxicity and quality: held-out accuracy on planted signals, odd inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_rows import no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import quality_pu, toxicity


def _corpus(spark, n=900):
    rng = random.Random(4)
    syllables = ["ra", "to", "mi", "ke", "lo", "san", "ber", "qui", "ple", "do"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(20, 120))]
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["zwux", "grolf"])
        text = " ".join(w).capitalize() + "."
        docs.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


@pytest.fixture(scope="module")
def corpus(spark):
    return _corpus(spark)


def _accuracy(scored, labels, name):
    rows = scored.join(labels, "doc_id").select("predicted", name, "held_out").collect()
    held = [r for r in rows if r.held_out]
    assert held and len(held) < len(rows)
    return np.mean([r["predicted"] == r[name] for r in held])


def test_toxicity_held_out(corpus):
    docs, labels = corpus
    docs = docs.withColumn("held_out", toxicity.held_out(F.col("doc_id"), 4, 2))
    out = toxicity.classify(docs, labels.where(~toxicity.held_out(F.col("doc_id"), 4, 2)), bits=16)
    assert _accuracy(out, labels, "toxic") > 0.95
    small = toxicity.classify(docs, labels.where(~toxicity.held_out(F.col("doc_id"), 4, 2)), max_train=300, bits=16)
    assert _accuracy(small, labels, "toxic") > 0.9


def test_labels_held_out_are_not_read(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id"), 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.classify(docs, x.where(~toxicity.held_out(F.col("doc_id"), 4, 2)), bits=16).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_log_count_ratio_and_presence():
    import pyarrow as pa
    rows, f = toxicity._presence(pa.array(["abab", "ABAB!", None, ""]), 16)
    assert 0 < len(f[rows == 0]) and set(f[rows == 0]) <= set(f[rows == 1]) and not (rows > 1).any()  # the mark is one more blank
    found = [r.tolist() for r, _ in toxicity.ngrams(pa.array(["ab", "cd"]), (4,), 16)]
    assert found == [[0, 1]]  # " ab " and " cd ", never across rows


def test_logistic_matches_the_optimum():
    rng = np.random.default_rng(0)
    x = (rng.random((200, 6)) < 0.4).astype(float)
    values = rng.normal(size=6)
    y = (x @ values + rng.normal(size=200) > 0).astype(float)
    r, c = np.nonzero(x)
    w, b = toxicity.logistic(r, c, values, y, 1.0, steps=3000)
    e = 1 / (1 + np.exp(-(x * values) @ w - b)) - y
    assert np.abs((x * values).T @ e + w).max() < 1e-3 and abs(e.sum()) < 1e-3


def test_quality_held_out(corpus):
    docs, labels = corpus
    docs = docs.withColumn("held_out", toxicity.held_out(F.col("doc_id"), 3, 1))
    learn = labels.where(~toxicity.held_out(F.col("doc_id"), 3, 1))
    out = quality_pu.classify(docs, learn)
    assert _accuracy(out, labels, "quality") > 0.95
    only_positive = quality_pu.classify(docs, learn.where("quality = 1"))
    assert sorted(out.collect(), key=str) == sorted(only_positive.collect(), key=str)  # negatives are never read


def test_prior_is_estimated():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(2, 1, (4000, 3)), rng.normal(-2, 1, (1200, 3))
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1)
    assert abs(quality_pu.estimate_prior(one(pos[:1200]), one(np.concatenate([pos[1200:], neg]))) - 0.7) < 0.07


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_pu, "quality")])
def test_odd_inputs(spark, odd_docs, no_docs, corpus, module, label):
    _, labels = corpus
    out = module.classify(odd_docs, labels)
    assert out.columns.count("score") == 1 and "text_key" in out.columns
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.classify(no_docs, labels).count() == 0
    strange = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (strange, strange.limit(0)):
        rows = module.classify(odd_docs, some).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_samples_are_bounded_where_ids_repeat_or_are_null(spark):
    rows = [(i % 20, f"text {i}") for i in range(20_000)] + [(None, f"null {i}") for i in range(20_000)] + [(None, "copy")] * 5000 + [(3, "copy")] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for sample in (toxicity.bounded_rows(toxicity.bounded_sample(docs, "doc_id", 2000), 2000), toxicity.bounded_rows(docs, 2000)):
        assert 200 < sample.count() <= 2400
    assert toxicity.bounded_rows(docs, 2000).where("text = 'copy'").count() <= 2
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.training_rows(docs, labels, "toxic", 2000).count() <= 2400
    only_null = docs.where("doc_id IS NULL")
    assert toxicity.bounded_rows(toxicity.bounded_sample(only_null, "doc_id", 500), 500).count() > 100
    assert quality_pu.classify(docs, labels, most=1000).agg(F.count_distinct("score")).first()[0] > 1
