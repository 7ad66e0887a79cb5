"""Stream = batch and the distributed position operator."""

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapmerge.operators import merge as M
from snapmerge.operators.order import with_position
from snapmerge.plans import standins as SI
from snapmerge.plans.keyed import KeyedTable
from snapmerge.sources import extract as X
from snapmerge.sources.store import TableStore
from snapmerge.streaming.stream import stream_accumulate

from conftest import SF_SMALL


def _land(spark, land, epoch, df):
    tmp = f"{land}/_tmp_{epoch}"
    df.coalesce(1).write.parquet(tmp)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    part = [p.path for p in spark.read.format("binaryFile").load(tmp).select("path").collect()
            if p.path.endswith(".parquet")][0]
    src = fs_path(part)
    src.getFileSystem(conf).rename(src, fs_path(f"{land}/in/commission_{epoch}.parquet"))


@pytest.mark.parametrize("files_per_trigger", [1, None])
def test_stream_equals_batch(spark, workdir, files_per_trigger):
    land = f"{workdir}/landing"
    c = SI.commission(spark, SF_SMALL).drop("ord")
    batches = [c.where(F.col("period") <= 199812),
               c.where(F.col("period") >= 199806).withColumn("gross_amount", (F.col("gross_amount") + 1).cast("decimal(18,2)")),
               c.where(F.col("contract_code") % 2 == 0)]
    for i, b in enumerate(batches):
        _land(spark, land, 1000000000 + i, b)
    schema = c.schema
    store = TableStore(spark, f"{workdir}/store")
    q = stream_accumulate(spark, f"{land}/in", schema, store, "commission_stream", ["contract_code", "period"],
                          f"{workdir}/ckpt", max_files_per_trigger=files_per_trigger)
    q.awaitTermination()
    streamed = store.read("commission_stream").drop(M.CHANGE, X.ORD, X.EPOCH)
    # batch: all files at once, keep-last by run epoch then position inside the extract
    allx = X.read_extract(spark, f"{land}/in", schema)
    batch = M.keep_last(allx.drop(X.FILE), ["contract_code", "period"], ord_col=X.ORD,
                        seq_col=X.EPOCH).drop(X.ORD, X.EPOCH)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, streamed.collect())) == sorted(map(key, batch.select(*streamed.columns).collect()))
    # replaying the stream (same checkpoint) changes nothing
    before = store.latest_commit("commission_stream").version
    q2 = stream_accumulate(spark, f"{land}/in", schema, store, "commission_stream", ["contract_code", "period"],
                           f"{workdir}/ckpt", max_files_per_trigger=files_per_trigger)
    q2.awaitTermination()
    assert store.latest_commit("commission_stream").version == before


def test_sliced_stream_equals_batch_and_writes_what_it_touches(spark, workdir):
    land, key = f"{workdir}/landing", ["contract_code", "period"]
    c = SI.commission(spark, SF_SMALL).drop("ord")
    few = c.where("contract_code between 100 and 150").withColumn("gross_amount", (F.col("gross_amount") + 1).cast("decimal(18,2)"))
    for i, b in enumerate((c, few, few)):
        _land(spark, land, 1000000000 + i, b)
    store, reports = TableStore(spark, f"{workdir}/store"), []

    def run():
        stream_accumulate(spark, f"{land}/in", c.schema, store, "t", key, f"{workdir}/ckpt", max_files_per_trigger=1,
                          sliced=True, on_merge=reports.append).awaitTermination()
    run()
    drop = {M.CHANGE, X.ORD, X.EPOCH, *M.STAMPS}
    allx = X.read_extract(spark, f"{land}/in", c.schema)
    batch = M.keep_last(allx.drop(X.FILE), key, ord_col=X.ORD, seq_col=X.EPOCH)
    table = KeyedTable(store, "t", key)
    streamed = table.read()
    rows = lambda df: sorted(map(str, df.select(*sorted(x for x in df.columns if x not in drop)).collect()))
    assert rows(streamed) == rows(batch)
    first, edit, again = reports
    assert first.edited_rows == 0 and edit.new_rows == 0 < edit.edited_rows and edit.bytes_written < first.bytes_written / 3
    assert again.edited_rows == 0 and again.bytes_written == 0 and not again.published
    assert table.changes().count() == edit.edited_rows and set(r[0] for r in table.changes().select(M.CHANGE).distinct().collect()) == {"edited"}
    run()  # nothing new has landed
    assert len(reports) == 3 and not store._list(f"{workdir}/store/t_batch/data")


def test_with_position_matches_row_number(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 97).alias("g")).repartition(7)
    got = with_position(df, [F.col("g").asc(), F.col("id").asc()], "pos")
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("g", "id")))
    assert sorted(got.select("id", "pos").collect()) == sorted(want.select("id", "pos").collect())


def test_multi_part_landing_entry_keeps_file_order(spark, workdir):
    # an extract written by Spark: a folder of part files named like a landing file
    land = f"{workdir}/landing"
    df = spark.range(0, 3000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    df.repartition(3).write.parquet(f"{land}/commission_1000000005.parquet")
    ext = X.read_extract(spark, f"{land}/commission_1000000005.parquet")
    rows = ext.select("k", "v", X.ORD, X.EPOCH, X.FILE, F.col("_metadata.file_name").alias("f")).collect()
    assert {r[X.EPOCH] for r in rows} == {1000000005}
    assert {r[X.FILE] for r in rows} == {"commission_1000000005.parquet"}
    assert len({r[X.ORD] for r in rows}) == len(rows)                 # no position collides across parts
    for r in rows:                                                   # position = (part number, row index)
        assert r[X.ORD] >> 40 == int(r.f.split("-")[1])
    want = {}
    for r in sorted(rows, key=lambda r: r[X.ORD]):
        want[r.k] = r.v                                              # last one in file order wins
    got = {r.k: r.v for r in M.keep_last(ext.drop(X.FILE), "k", ord_col=X.ORD, seq_col=X.EPOCH).collect()}
    assert got == want
    files = X.landing_files(spark, land).collect()
    assert len(files) == 1 and files[0].dataset == "commission" and files[0].parts == 3
