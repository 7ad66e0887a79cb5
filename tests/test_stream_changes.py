"""The keyed stateful stream of changes: equal to batch results, written bytes follow the batch."""

import pyarrow as pa
import pyarrow.parquet as pq

from snapmerge.operators import merge as M
from snapmerge.sources import extract as X
from snapmerge.streaming import changes as SC

SCHEMA = "k long, g string, amount double, price decimal(18,2), day date, at timestamp, note string"
ARROW = pa.schema([("k", pa.int64()), ("g", pa.string()), ("amount", pa.float64()), ("price", pa.decimal128(18, 2)), ("day", pa.date32()),
                   ("at", pa.timestamp("us", "UTC")), ("note", pa.string())])
KEY = ["k", "g"]


def _row(k, g="a", amount=1.0, price=None, note=None, micros=0):
    import datetime as dt
    from decimal import Decimal
    return {"k": k, "g": g, "amount": amount, "price": Decimal(price) if price else None, "day": dt.date(2001, 1, 20),
            "at": dt.datetime(2001, 1, 20, 1, 2, 3, micros, tzinfo=dt.timezone.utc), "note": note}


def _land(land, epoch, rows):
    import os
    os.makedirs(land, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows, schema=ARROW), f"{land}/commission_{epoch}.parquet")


def _run(spark, workdir, per_trigger=1, **kw):
    schema = spark.createDataFrame([], SCHEMA).schema
    SC.change_stream(spark, f"{workdir}/landing", schema, KEY, f"{workdir}/log", f"{workdir}/ckpt", max_files_per_trigger=per_trigger, **kw).awaitTermination()
    return spark.read.parquet(f"{workdir}/log")


def _shown(df):
    return sorted((str(r.k), str(r.g), r[M.CHANGE], r.change_no, str(r.amount), str(r.price), str(r.note), r.at.microsecond) for r in df.collect())


def test_changes_of_each_batch(spark, workdir):
    land = f"{workdir}/landing"
    nan = float("nan")
    first = [_row(1), _row(2, amount=nan), _row(None, None, note="old"), _row(None, None, note="null key"), _row(3, amount=0.0), _row(4, price="1.10"),
             _row(5, note='q"\\\n ü'), _row(6, micros=1), _row(7, amount=None), _row(8, "")]
    same = [_row(1, amount=1.0000000001), _row(2, amount=nan), _row(None, None, note="null key"), _row(3, amount=-0.0), _row(4, price="1.10"),
            _row(5, note='q"\\\n ü'), _row(6, micros=1), _row(7, amount=None), _row(8, "")]
    edits = [_row(1, amount=2.0), _row(2, amount=None), _row(None, None, note="x"), _row(None, None, note="null key"), _row(6, micros=2), _row(8, None), _row(1, amount=3.0)]
    for epoch, rows in ((1000000005, first), (1000000006, same), (1000000007, edits)):
        _land(land, epoch, rows)
    log = _run(spark, workdir)
    assert _shown(log.where("change_no = 1 and not (k <=> 8 and g is null)")) == sorted(
        (str(r["k"]), str(r["g"]), "new", 1, str(r["amount"]), str(r["price"]), str(r["note"]), r["at"].microsecond)
        for r in first if r["note"] != "old")  # in a batch the last row of a key counts
    assert _shown(log.where("change_no > 1")) == [("1", "a", "edited", 2, "3.0", "None", "None", 0), ("2", "a", "edited", 2, "None", "None", "None", 0),
                                                  ("6", "a", "edited", 2, "1.0", "None", "None", 2)]
    assert log.where("k = 8 and g is null").count() == 1 and log.where("k is null").count() == 1
    # an extract that lands late, with an older epoch, is the last one seen; a second run of the stream adds its changes only
    _land(land, 1000000001, [_row(1, amount=9.0), _row(3)])
    files = set(log.inputFiles())
    log = _run(spark, workdir)
    assert files <= set(log.inputFiles())
    assert _shown(log.where("change_no = 3 or (k = 3 and change_no = 2)")) == [("1", "a", "edited", 3, "9.0", "None", "None", 0), ("3", "a", "edited", 2, "1.0", "None", "None", 0)]
    before = log.count()
    assert _run(spark, workdir).count() == before


def test_change_log_equals_batch_and_follows_the_batch(spark, workdir):
    land = f"{workdir}/landing"
    rows = [_row(i % 400 if i % 3 else None, amount=float(i)) for i in range(3000)]  # a third of the rows has one key
    _land(land, 1000000001, rows)
    _land(land, 1000000002, [_row(i, amount=-1.0) for i in range(10)] + [_row(1000)])
    log = _run(spark, workdir, per_trigger=None)
    allx = X.read_extract(spark, land, spark.createDataFrame([], SCHEMA).schema)
    want = M.keep_last(allx.drop(X.FILE), KEY, ord_col=X.ORD, seq_col=X.EPOCH)
    rows_of = lambda df: sorted(map(str, df.select("k", "g", "amount", "price", "at", X.ORD, X.EPOCH).collect()))
    assert rows_of(SC.latest(log, KEY)) == rows_of(want)
    known = log.count()
    _land(land, 1000000003, [_row(i, amount=-2.0) for i in range(5)])
    after = _run(spark, workdir, per_trigger=None)
    assert after.count() == known + 5  # a micro-batch adds the rows it changed, nothing else
    assert rows_of(SC.latest(after, KEY).where(f"{X.EPOCH} = 1000000003")) == rows_of(after.where(f"{X.EPOCH} = 1000000003"))


def test_history_before_the_first_start(spark, workdir):
    _land(f"{workdir}/landing", 1000000001, [_row(1), _row(2, amount=2.0), _row(3), _row(None, None)])
    stored = spark.createDataFrame([tuple(r.values()) for r in (_row(1), _row(2), _row(None, None), _row(77))], SCHEMA)
    log = _run(spark, workdir, initial=stored)
    assert [(r.k, r[M.CHANGE], r.change_no) for r in log.orderBy("k").collect()] == [(2, "edited", 2), (3, "new", 1)]


def test_empty_extract(spark, workdir):
    _land(f"{workdir}/landing", 1000000001, [])
    assert _run(spark, workdir).count() == 0


def test_keys_share_states(spark, workdir, monkeypatch):
    """The calls to the state store follow the groups, not the keys; a restart keeps the number of groups."""
    land = f"{workdir}/landing"
    _land(land, 1000000001, [_row(i) for i in range(300)])
    stored = spark.createDataFrame([tuple(_row(i, amount=float(i % 2)).values()) for i in range(200)], SCHEMA)
    log = _run(spark, workdir, initial=stored, groups=3)
    assert log.where("change_no = 2").count() == 100 and log.where("change_no = 1").count() == 100
    q = SC.change_stream(spark, land, stored.schema, KEY, f"{workdir}/log", f"{workdir}/ckpt")
    q.awaitTermination()
    _land(land, 1000000002, [_row(i, amount=7.0) for i in range(400)])
    log = _run(spark, workdir)
    assert [r["count"] for r in log.groupBy("change_no").count().orderBy("change_no").collect()] == [200, 300, 100]
    from pyspark.sql import functions as F
    state = spark.read.format("statestore").option("path", f"{workdir}/ckpt").option("operatorId", 0).option("stateVarName", "keys").load()
    assert state.count() == 3 and state.agg(F.sum(F.length("value.known"))).first()[0] == 400 * 72


def test_last_row_of_a_key_over_arrow_batches(spark, workdir):
    """Rows of one key that meet from several Arrow batches: the greatest place counts, for every kind of value."""
    import random
    land, nan, inf = f"{workdir}/landing", float("nan"), float("inf")
    rows = [_row(1, amount=a, price=p, note=n, micros=m) for a in (None, -inf, -2.5, 1e-7, 3e20, inf, nan) for p in (None, "-10.00", "9.00", "10.50")
            for n in (None, "", "a", "é") for m in (0, 9, 10)]
    kinds = [rows, rows[:200], [r for r in rows if r["amount"] is None], [r for r in rows if r["amount"] == -inf]]
    landed = []
    for k, some in enumerate(kinds):
        some = [{**r, "k": k} for r in some]
        random.Random(k).shuffle(some)
        landed += some
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _land(land, 1000000001, landed)
        schema = spark.createDataFrame([], SCHEMA).schema
        SC.change_stream(spark, land, schema, KEY, f"{workdir}/log", f"{workdir}/ckpt", ord_col="nothing",
                         transform=lambda df: df.drop(X.ORD)).awaitTermination()
        log = spark.read.parquet(f"{workdir}/log")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = M.keep_last(X.read_extract(spark, land, schema).drop(X.FILE, X.ORD), KEY, seq_col=X.EPOCH)
    rows_of = lambda df: sorted(map(str, df.select("k", "amount", "price", "at", "note").collect()))
    assert len(rows_of(want)) == 4 and rows_of(log) == rows_of(want)


def test_bytes_of_a_row_on_its_way(spark, workdir):
    """A row reaches the state operator with each value once and without digests: under 120 bytes of shuffle files a row."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def written():
        files = disk.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    n = 20000
    _land(f"{workdir}/landing", 1000000001, [_row(i * 7919 % 1000003, amount=i / 4, price=f"{i * 31 % 90000}.25", note=str(i)) for i in range(n)])
    before = written()
    log = _run(spark, workdir, groups=64)
    moved = sum(length for name, length in written().items() if name not in before)
    assert log.count() == n and moved < 120 * n


def test_values_of_every_text_come_back(spark, workdir):
    """Rounded values (doubles, decimals beyond six digits) are read back as they came, also in the key and where a column is absent."""
    from decimal import Decimal
    schema = "k double, fine decimal(20,9), ok boolean, name string, parts array<int>"
    rows = [(0.1, Decimal("1.123456789"), True, "a", [1, None]), (float("nan"), None, None, "", None), (None, Decimal("-2.000000001"), False, None, [])]
    spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/landing")
    SC.change_stream(spark, f"{workdir}/landing", spark.createDataFrame([], schema).schema, ["k"], f"{workdir}/log", f"{workdir}/ckpt").awaitTermination()
    log = spark.read.parquet(f"{workdir}/log")
    assert sorted(map(str, log.select("k", "fine", "ok", "name", "parts").collect())) == sorted(map(str, spark.createDataFrame(rows, schema).collect()))
