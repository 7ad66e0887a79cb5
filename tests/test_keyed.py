"""Tables in key slices: equal to the plain merge, and only touched slices are read and written."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapmerge.operators import merge as M
from snapmerge.operators import totals as TT
from snapmerge.plans import keyed as KT
from snapmerge.sources.store import TableStore

SCHEMA = "id long, branch string, price_amount decimal(18,2), weight_amount double, rate_pct double, seen date, pos int"
KEYS = ["id", "branch"]


def rows(rng, n, ids=400):
    def one(i):
        return (rng.choice([None, rng.randrange(ids)]) if rng.random() < 0.05 else rng.randrange(ids), rng.choice(["A", "B", None, "ü\"x"]),
                rng.choice([None, Decimal(rng.randrange(10 ** 6)) / 100]), rng.choice([None, float("nan"), rng.randrange(1000) / 8]),
                rng.choice([None, float("nan"), rng.random()]), rng.choice([None, dt.date(2001, 1, rng.randrange(1, 29))]), i)
    return [one(i) for i in range(n)]


def plain(df, *drop):
    return sorted(map(str, df.drop(*M.STAMPS, *drop).select(*sorted(c for c in df.columns if c not in (*M.STAMPS, *drop))).collect()))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def store(spark, workdir):
    return TableStore(spark, workdir)


def test_equals_the_plain_merge(spark, store):
    """Seeds, batches with repeated and null keys, edits, NaN and nulls; totals and digests kept from changes."""
    rng = random.Random(11)
    t = KT.KeyedTable(store, "t", KEYS, slices=8, buckets=3, ord_col="pos")
    want = None
    for i, n in enumerate((500, 60, 0, 200)):
        batch = spark.createDataFrame(rows(rng, n), SCHEMA).repartition(3)
        report = t.merge(batch, f"r{i}", run_seq=i)
        want = M.accumulate_and_classify(want, batch, KEYS, ord_col="pos")
        counts = M.change_summary(want).first()
        assert (report.new_rows, report.edited_rows, report.total_rows) == (counts.new_rows, counts.edited_rows, counts.total_rows) or n == 0
        want = spark.createDataFrame(want.drop(M.CHANGE).collect(), SCHEMA)
        assert plain(t.read(), "change_type", "pos") == plain(want, "pos")  # pos is not compared: equal rows stay as stored
        assert t.verify() == [] and report.published == (n > 0)
        got, full = t.totals().first(), TT.totals_row(t.read().drop(M.CHANGE, *M.STAMPS)).first()
        assert got.price_amount == full.price_amount and got.id is None and got.is_total
        assert got.weight_amount == pytest.approx(full.weight_amount) and got.rate_pct == pytest.approx(full.rate_pct, abs=1e-6)
    stamps = {r[0] for r in t.read().select(M.STAMP_RUN).distinct().collect()}
    assert stamps == {0, 1, 3} and KT.KeyedTable(store, "t", KEYS).slices == 8


def test_labels_are_those_of_the_last_version(spark, store):
    t = KT.seed(store, "t", spark.range(1000).withColumn("v", F.lit(1)), ["id"], slices=16, buckets=2)
    t.merge(spark.createDataFrame([(5, 2), (6, 1), (2000, 1)], "id long, v int"), "r1")
    labels = {r.id: r.change_type for r in t.read().where("change_type <> 'unchanged'").collect()}
    assert labels == {5: "edited", 2000: "new"}


def test_only_touched_slices_are_read_and_written(spark, store, workdir):
    base = spark.range(100_000).select("id", (F.col("id") * 2.0).alias("v_amount"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    t = KT.seed(store, "t", base, ["id"], slices=64, buckets=2)
    whole, before = store.bytes_of(f"{workdir}/t"), files(workdir)
    batch = base.where("id between 41000 and 41999").withColumn("v_amount", F.col("v_amount") + 1)  # one hundredth
    r = t.merge(batch, "r1")
    assert (r.new_rows, r.edited_rows, r.total_rows) == (0, 1000, 100_000)
    assert r.slices_read == r.slices_written <= 4 and r.bytes_written < whole / 10
    assert before < files(workdir)
    untouched = {k: v for k, v in store.latest_commit("t").parts.items() if k not in r.written}
    assert len(untouched) >= 50 and all("v=seed" in v for v in untouched.values())
    after = files(workdir)
    again = t.merge(batch, "r2")
    assert not again.published and again.bytes_written == 0 and files(workdir) == after
    assert t.totals().first().v_amount == pytest.approx(2.0 * sum(range(100_000)) + 1000)


def test_stored_rows_are_not_shuffled(spark, store):
    """Any number of batch keys: one exchange, of the batch, whatever the session's shuffle partitions are."""
    t = KT.seed(store, "t", spark.range(5000).withColumn("v", F.lit(1)), ["id"], slices=4, buckets=4)
    seen = []
    real = t.merged

    def merged(*args):
        out = real(*args)
        seen.append(out[0]._jdf.queryExecution().executedPlan().toString())
        return out
    t.merged = merged
    before = spark.conf.get("spark.sql.shuffle.partitions")
    t.merge(spark.range(2500, 9000).withColumn("v", F.lit(2)), "r1")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert seen[0].count("Exchange") == 1 and "Bucketed: true" in seen[0] and "SortMergeJoin" in seen[0]
    assert t.read().agg(F.sum("v")).first()[0] == 2500 + 2 * 6500


def test_digest_finds_every_change(spark):
    rng = random.Random(3)
    data = rows(rng, 40)

    def digest(some):
        a, b = KT.row_digest([f.name for f in frame(some).schema])
        return tuple(frame(some).agg(a, b).first())

    def frame(some):
        return spark.createDataFrame(some, SCHEMA)
    first = digest(data)
    assert digest(rng.sample(data, len(data))) == first
    assert digest(data + data[:1]) != first and digest(data[1:]) != first
    for _ in range(12):
        changed, i, j = [list(r) for r in data], rng.randrange(40), rng.randrange(7)
        old = changed[i][j]
        changed[i][j] = {0: 10 ** 6, 1: "changed", 2: Decimal("0.01"), 3: -1.5, 4: 2.5, 5: dt.date(1999, 1, 1), 6: 999}[j]
        assert digest([tuple(r) for r in changed]) != first
        if old is None:
            continue
        changed[i][j] = None
        assert digest([tuple(r) for r in changed]) != first
    swapped = [(r[0], r[1], r[2], r[4], r[3], *r[5:]) for r in data]  # equal values in other columns
    assert digest(swapped) != first
    a, b = KT.row_digest([*[f.name for f in frame(data).schema], "more"])
    assert tuple(frame(data).withColumn("more", F.lit(None).cast("string")).agg(a, b).first()) == first


def test_columns_that_come_and_go(spark, store):
    t = KT.seed(store, "t", spark.createDataFrame([(1, "a"), (2, "b")], "id long, old string"), ["id"], slices=4, buckets=1)
    r = t.merge(spark.createDataFrame([(2, 7), (3, 8)], "id int, more int"), "r1")
    assert (r.new_rows, r.edited_rows, r.total_rows) == (1, 1, 3) and t.verify() == []
    assert plain(t.read(), "change_type") == sorted(map(str, spark.createDataFrame(
        [(1, None, "a"), (2, 7, None), (3, 8, None)], "id long, more int, old string").collect()))


def test_empty_table(spark, store):
    t = KT.KeyedTable(store, "t", ["id"])
    r = t.merge(spark.createDataFrame([], "id long, v_amount double"), "r0")
    assert (t.slices, t.buckets, t.run) == (16, 4, 1)
    assert not r.published and t.read() is None and t.totals() is None and t.verify() == []


def test_buckets_grow_with_the_first_batch(spark, store, monkeypatch):
    """A task of a merge holds a bucket: its rows stay bounded, also where the caller names the least number of buckets."""
    monkeypatch.setattr(KT, "ROWS_PER_TASK", 100)
    rows = spark.range(1950).withColumn("v", F.lit(1))
    for name, layout in (("named", {"slices": 4, "buckets": 2}), ("own", {})):
        t = KT.seed(store, name, rows, ["id"], **layout)
        assert t.buckets == 20 and t.slices == layout.get("slices", 16)
        assert t.merge(rows.withColumn("v", F.lit(2)), "r1").edited_rows == 1950 and not t.verify()
        assert KT.KeyedTable(store, name, ["id"]).buckets == 20
