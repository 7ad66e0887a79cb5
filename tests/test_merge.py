"""Keep-last accumulation and classification on hand-written frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmerge.operators import merge as M

SCHEMA = "k long, name string, amount double, d date"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def labels(df, key="k"):
    return {r[key]: r[M.CHANGE] for r in df.collect()}


@pytest.fixture()
def prev(spark):
    return spark.createDataFrame([
        (1, "a", 10.0, dt.date(2001, 7, 1)),
        (2, "b", None, dt.date(2001, 7, 2)),
        (3, None, 30.0, None),
        (None, "nullkey", 1.0, dt.date(2001, 7, 3)),
    ], SCHEMA)


def test_new_edited_unchanged_with_nulls_and_float_noise(spark, prev):
    batch = spark.createDataFrame([
        (1, "a", 10.0 + 1e-8, dt.date(2001, 7, 1)),   # float noise only -> unchanged
        (2, "b", None, dt.date(2001, 7, 2)),          # null cell equals null -> unchanged
        (3, "c", 30.0, None),                          # null -> value: edited
        (4, "d", 40.0, dt.date(2001, 7, 4)),          # new
        (None, "nullkey", 1.0, dt.date(2001, 7, 3)),  # null key matches null key
    ], SCHEMA)
    out = M.accumulate_and_classify(prev, batch, "k")
    assert labels(out) == {1: "unchanged", 2: "unchanged", 3: "edited", 4: "new", None: "unchanged"}
    assert out.count() == 5


def test_half_even_rounding_is_the_tolerance(spark):
    p = spark.createDataFrame([(1, 2.5e-6)], "k long, x double")
    b = spark.createDataFrame([(1, 2.0e-6)], "k long, x double")
    # bround(2.5e-6, 6) = 2e-6 (half-even); a half-up round would call this an edit.
    assert labels(M.accumulate_and_classify(p, b, "k")) == {1: "unchanged"}


def test_keep_last_inside_batch_uses_order_column(spark):
    batch = spark.createDataFrame([(1, "first", 1), (1, "second", 2), (2, "only", 1)], "k long, v string, o int")
    out = M.keep_last(batch, "k", ord_col="o")
    assert rows(out, "k", "v") == [(1, "second"), (2, "only")]


def test_batch_wins_over_previous_regardless_of_order_values(spark):
    p = spark.createDataFrame([(1, "old", 99)], "k long, v string, o int")
    b = spark.createDataFrame([(1, "new", 1)], "k long, v string, o int")
    out = M.accumulate(p, b, "k", ord_col="o")
    assert rows(out, "k", "v") == [(1, "new")]


def test_empty_batch_returns_previous(spark, prev):
    out = M.accumulate_and_classify(prev, prev.limit(0), "k")
    assert rows(out.drop(M.CHANGE)) == rows(prev)
    assert set(labels(out).values()) == {"unchanged"}


def test_first_run_everything_new(spark, prev):
    out = M.accumulate_and_classify(None, prev, "k")
    assert set(labels(out).values()) == {"new"}


def test_schema_drift_lost_and_added_columns(spark, prev):
    batch = spark.createDataFrame([(1, "a", dt.date(2001, 7, 1), "x")], "k long, name string, d date, extra string")
    out = M.accumulate_and_classify(prev, batch, "k")
    assert "extra" in out.columns and "amount" in out.columns
    lab = labels(out)
    assert lab[1] == "edited"  # amount lost (null now) and a non-null new column
    r = {x["k"]: x for x in out.collect()}
    assert r[1]["amount"] is None and r[1]["extra"] == "x"
    assert r[2]["extra"] is None and lab[2] == "unchanged"


def test_previous_with_duplicate_keys_is_read_last_wins(spark):
    p = spark.createDataFrame([(1, "old", 1), (1, "newer", 2)], "k long, v string, o int")
    b = spark.createDataFrame([(1, "newer", 3)], "k long, v string, o int")
    assert labels(M.accumulate_and_classify(p, b, "k", ord_col="o")) == {1: "unchanged"}


def test_count_new_keys_and_summary(spark, prev):
    batch = spark.createDataFrame([(4, "d", 1.0, None), (4, "d2", 2.0, None), (1, "a", 10.0, None)], SCHEMA)
    assert M.count_new_keys(batch, prev, "k").first()["new_keys"] == 1
    assert M.count_new_keys(batch, prev, "k", max_broadcast_rows=1).first()["new_keys"] == 1  # union plan
    assert M.count_new_keys(batch, None, "k").first()["new_keys"] == 2
    s = M.change_summary(M.accumulate_and_classify(prev, batch, "k")).first()
    assert s["new_rows"] + s["edited_rows"] + s["unchanged_rows"] == s["total_rows"] == 5


def test_count_new_keys_plans_agree(spark):
    prev = spark.createDataFrame([(None, 1), (1, 1), (1, 2), (2, None), (3, 3)], "a int, b int")
    batch = spark.createDataFrame([(None, 1), (None, 1), (1, 2), (2, None), (2, 2), (None, None), (5, 5)],
                                  "a int, b int")
    want = len({tuple(r) for r in batch.collect()} - {tuple(r) for r in prev.collect()})   # 3
    for limit in (None, 1):
        got = M.count_new_keys(batch, prev, ["a", "b"], max_broadcast_rows=limit)
        assert got.first()["new_keys"] == want
        assert dict(got.dtypes) == {"new_keys": "bigint"}
    plan = M.count_new_keys(batch, prev, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_properties_idempotence_monotone_one_row_per_key(spark):
    base = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"))
    batch = spark.range(150, 260).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("x"))
    once = M.accumulate(base, batch, "k")
    twice = M.accumulate(once, batch, "k")
    assert rows(once) == rows(twice)                                   # idempotent
    assert {r.k for r in base.collect()} <= {r.k for r in once.collect()}  # monotone keys
    assert once.count() == once.select("k").distinct().count() == 260  # one row per key
    rerun = M.accumulate_and_classify(once, batch, "k")
    assert set(labels(rerun).values()) == {"unchanged"}                # same batch again: no-op


def test_result_independent_of_partitioning(spark):
    base = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 1.5).alias("x"))
    batch = spark.range(0, 500, 3).select((F.col("id") % 50).alias("k"), F.col("id").alias("o"),
                                          (F.col("id") * 2.0).alias("x"))
    a = M.accumulate(base.repartition(1), batch.repartition(1), "k", ord_col="o")
    b = M.accumulate(base.repartition(13), batch.repartition(7, "o"), "k", ord_col="o")
    assert rows(a) == rows(b)


def test_touched_only_plan_equals_shuffle_plan(spark):
    base = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 9).cast("double").alias("x"))
    batch = spark.range(990, 1010).select(F.col("id").alias("k"), (F.col("id") % 4).cast("double").alias("x"))
    shuffle = M.accumulate_and_classify(base, batch, "k", strategy="shuffle", with_order=True)
    touched = M.accumulate_and_classify(base, batch, "k", prev_unique=True, with_order=True)
    assert rows(shuffle) == rows(touched)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_lookup_plan_equals_shuffle_plan(spark, tmp_path):
    path = str(tmp_path / "stored")
    (spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 9).cast("double").alias("x"),
                                 F.lit("s").alias("only_stored"))
     .write.parquet(path))
    base = spark.read.parquet(path)
    (spark.range(990, 1010).select(F.col("id").alias("k"), (F.col("id") % 4).cast("double").alias("x"),
                                   F.col("id").alias("o"))
     .unionByName(spark.createDataFrame([(None, 1.0, 3), (995, 7.0, 99)], "k long, x double, o long"))
     .write.parquet(path + "_batch"))
    batch = spark.read.parquet(path + "_batch")
    for with_order in (False, True):
        shuffle = M.accumulate_and_classify(base, batch, "k", ord_col="o", strategy="shuffle", with_order=with_order)
        lookup = M.accumulate_and_classify(base, batch, "k", ord_col="o", prev_unique=True, strategy="lookup",
                                           with_order=with_order)
        assert lookup.columns == shuffle.columns
        assert rows(shuffle) == rows(lookup)
    lookup.collect()
    plan = lookup._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the batch is shuffled once for both uses, and the stored table is read
    # once in full plus once for its key column only
    assert "ReusedExchange" in plan
    scans = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert sum("only_stored" in schema for schema in scans) == 1       # stored rows: one full read
    assert sorted(scans).count("struct<k:bigint>") == 2                # stored keys, batch keys
    assert len(scans) == 4                                             # + the batch rows


def test_stored_plan_choice(spark, monkeypatch):
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    small = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit(1.0).alias("x"))
    big = spark.range(0, 900).select(F.col("id").alias("k"), F.lit(1.0).alias("x"))

    def plan(batch):
        return M._stored_plan(base, batch, batch.select("k").distinct(), ["k"], None, None)

    assert plan(small) == "touched"            # history under LOOKUP_MIN_ROWS
    spark.conf.set(M.LOOKUP_MIN_ROWS_CONF, "100")
    try:
        assert plan(small) == "lookup"         # threshold from the session
    finally:
        spark.conf.unset(M.LOOKUP_MIN_ROWS_CONF)
    assert plan(small) == "touched"
    monkeypatch.setattr(M, "LOOKUP_MIN_ROWS", 100)
    assert plan(small) == "lookup"             # history proven large, batch rows fit
    assert plan(big) == "shuffle"              # history not TOUCHED_RATIO x the batch keys
    long_text = small.withColumn("note", F.repeat(F.lit("x"), 4 * 1024 * 1024))
    assert plan(long_text) == "touched"        # measured text bytes exceed the broadcast bound


def test_collapsed_batch_bound_is_measured(spark):
    b = spark.range(10).select(F.col("id").alias("k"), F.lit("abc").alias("s"))
    assert M._collapsed_batch_fits(b, 10)
    assert not M._collapsed_batch_fits(b.withColumn("s", F.repeat(F.lit("y"), 4 * 1024 * 1024)), 10)
    assert not M._collapsed_batch_fits(b.withColumn("a", F.array(F.lit(1))), 10)     # nested: no bound
    assert not M._collapsed_batch_fits(b, 2_000_000)                                 # slots alone too big


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    # a third of the rows share one key; the partial aggregate runs map-side
    hot = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("o"))
    out = M.keep_last(hot, "k", ord_col="o")
    assert out.where("k = 0").first()["o"] == 2997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2  # partial + final


def test_split_by_change(spark, prev):
    batch = spark.createDataFrame([(9, "n", 1.0, None), (1, "a", 11.0, None)], SCHEMA)
    parts = M.split_by_change(M.classify_changes(batch, prev, "k"))
    assert parts["new"].count() == 1 and parts["edited"].count() == 1 and parts["unchanged"].count() == 0
