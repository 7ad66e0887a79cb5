"""Versioned store and multi-run sequences (FIXTURES §B run 1..5, SURVEY §7 steps 5 and 7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmerge.operators import merge as M
from snapmerge.plans import runner as RN
from snapmerge.plans import standins as SI
from snapmerge.sources.extract import landing_files, latest_extract_per_dataset, read_extract
from snapmerge.sources.store import TableStore

from conftest import SF_SMALL

AS_OF = SI.A_MID


@pytest.fixture(params=["auto", "lookup"])
def merge_plan(request, monkeypatch):
    """Run a store test as is, and again with the lookup plan allowed for any stored table size."""
    if request.param == "lookup":
        monkeypatch.setattr(M, "LOOKUP_MIN_ROWS", 0)
    return request.param


def test_read_or_empty_and_publish(spark, workdir):
    store = TableStore(spark, workdir)
    assert store.read("missing") is None
    assert store.read("missing", spark.createDataFrame([], "a int").schema).count() == 0
    df = spark.range(5).withColumn("year", (F.col("id") % 2 + 2000).cast("int"))
    c = store.write("t", df, "r1", partition_col="year")
    assert store.read("t") is None            # written but not visible
    store.publish("t", c)
    assert store.read("t").count() == 5


def test_untouched_years_are_not_rewritten(spark, workdir):
    store = TableStore(spark, workdir)
    df = spark.range(6).withColumn("year", (F.col("id") % 3 + 1999).cast("int"))
    store.overwrite("t", df, "r1", partition_col="year")
    first = store.latest_commit("t").parts
    only_2001 = spark.range(100, 103).withColumn("year", F.lit(2001))
    store.overwrite("t", only_2001, "r2", partition_col="year")
    second = store.latest_commit("t").parts
    assert second["1999"] == first["1999"] and second["2000"] == first["2000"]
    assert second["2001"] != first["2001"]
    assert sorted(r.id for r in store.read("t").where("year = 2001").collect()) == [100, 101, 102]


def _extract(spark, as_of):
    return SI.contracts_extract(spark, SF_SMALL, as_of)


def test_contracts_run_sequence(spark, workdir, merge_plan):
    store = TableStore(spark, workdir)
    # run 1: empty store, everything new
    r1 = RN.run_dataset(spark, store, "numero_contratos", _extract(spark, AS_OF), AS_OF, "r1")
    assert r1.published and r1.edited_rows == 0 and r1.new_rows == r1.total_rows > 0
    quarter1 = store.read("contracts_quarter")
    # run 2: the same extract again -> nothing new or edited, nothing published (S-11)
    r2 = RN.run_dataset(spark, store, "numero_contratos", _extract(spark, AS_OF), AS_OF, "r2")
    assert not r2.published and r2.new_rows == 0 and r2.edited_rows == 0
    assert store.latest_commit("contracts_quarter").version == "r1"
    # run 3: an empty extract leaves the tables as they are
    r3 = RN.run_dataset(spark, store, "numero_contratos", _extract(spark, SI.A_EMPTY), AS_OF, "r3")
    assert r3.rows_read == 0 and "no data" in r3.note
    assert store.read("contracts_quarter").count() == quarter1.count()
    # run 4: a changed extract -> edits are detected against the stored table
    changed = _extract(spark, AS_OF).withColumn("principal", F.col("principal") + 1)
    r4 = RN.run_dataset(spark, store, "numero_contratos", changed, AS_OF, "r4")
    assert r4.published and r4.edited_rows > 0 and r4.new_rows == 0
    # run 5: an extract with a lost and an extra column still merges
    drift = _extract(spark, AS_OF).drop("insurance").withColumn("channel", F.lit("web"))
    r5 = RN.run_dataset(spark, store, "numero_contratos", drift, AS_OF, "r5")
    assert r5.total_rows == quarter1.count()
    hist = store.read_log(RN.HISTORY_TABLE)
    assert hist.count() == 5
    assert hist.where("no_data").count() == 1


def test_failure_is_isolated(spark, workdir):
    store = TableStore(spark, workdir)
    bad = spark.createDataFrame([(1,)], "unexpected int")
    reports = RN.run(spark, store, {"numero_contratos": bad,
                                    "dias_sem_producao": SI.store_activity(spark, SF_SMALL),
                                    "comissao_a_vista": None}, AS_OF, "r1")
    by = {r.dataset: r for r in reports}
    assert by["numero_contratos"].note.startswith("failed")
    assert by["dias_sem_producao"].published
    assert by["comissao_a_vista"].note == "no extract for this run"
    assert store.read_log(RN.HISTORY_TABLE).count() == 3


def test_commission_official_keeps_one_totals_row(spark, workdir, merge_plan):
    store = TableStore(spark, workdir)
    ext = SI.commission_raw_headers(spark, SF_SMALL, SI.A_TURN)
    RN.run_dataset(spark, store, "comissao_a_vista", ext, SI.A_TURN, "r1")
    changed = ext.withColumn("\n    gross_amount\n    ", (F.col("\n    gross_amount\n    ") + 1).cast("decimal(18,2)"))
    r = RN.run_dataset(spark, store, "comissao_a_vista", changed, SI.A_TURN, "r2")
    off = store.read("commission_official")
    assert off.where("is_total").count() == 1
    data = off.where("not is_total")
    total = off.where("is_total").first()["gross_amount"]
    assert total == data.agg(F.sum("gross_amount")).first()[0]
    assert r.edited_rows > 0


def test_landing_files_and_read_extract(spark, workdir):
    land = f"{workdir}/landing"
    for epoch, frac in ((1000000001, 0.5), (1000000002, 1.0)):
        SI.contracts(spark, SF_SMALL).sample(False, frac, seed=1).coalesce(1) \
            .write.parquet(f"{land}/tmp_{epoch}")
        part = [p for p in spark.read.format("binaryFile").load(f"{land}/tmp_{epoch}").select("path").collect()
                if p.path.endswith(".parquet")][0].path
        # place the part file under its landing name
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        src = fs_path(part)
        src.getFileSystem(conf).rename(src, fs_path(f"{land}/numero_contratos_{epoch}.parquet"))
    files = landing_files(spark, land)
    latest = latest_extract_per_dataset(files, ["numero_contratos", "comissao_a_vista"]).collect()
    by = {r.dataset: r for r in latest}
    assert by["numero_contratos"].epoch == 1000000002 and by["comissao_a_vista"].path is None
    ext = read_extract(spark, by["numero_contratos"].path)
    assert ext.select("extract_epoch").distinct().first()[0] == 1000000002
    assert ext.count() == ext.select("extract_ord").distinct().count()


def test_classify_labels_survive_store_roundtrip(spark, workdir, merge_plan):
    store = TableStore(spark, workdir)
    RN.run_dataset(spark, store, "dias_sem_producao", SI.store_activity(spark, SF_SMALL), AS_OF, "r1")
    off = store.read("store_activity_official")
    assert M.CHANGE in off.columns and {r[0] for r in off.select(M.CHANGE).distinct().collect()} == {"new"}
    r2 = RN.run_dataset(spark, store, "dias_sem_producao", SI.store_activity(spark, SF_SMALL), AS_OF, "r2")
    assert r2.new_rows == 0 and r2.edited_rows == 0 and not r2.published
    # the stored run is the accumulated one, with its own day of labels
    assert store.latest_commit("store_activity_official").version == "r1"
    assert dt.date(2001, 1, 1) < AS_OF


def test_year_routed_run_reads_only_years_present(spark, workdir):
    store = TableStore(spark, workdir)
    t = SI.targets(spark, SF_SMALL)
    RN.run_dataset(spark, store, "meta_financiamento_seguro", t, AS_OF, "r1")
    first = store.latest_commit("targets_official").parts
    assert len(first) > 2
    only_2001 = t.where("period >= 200101").withColumn("production", F.col("production") + 1)
    # the preview still holds every year, so every year is routed again ...
    r2 = RN.run_dataset(spark, store, "meta_financiamento_seguro", only_2001, AS_OF, "r2")
    assert r2.edited_rows > 0
    # ... while a portfolio extract of one year opens and rewrites that year only
    p = SI.portfolio_extract(spark, SF_SMALL, AS_OF)
    RN.run_dataset(spark, store, "carteira_parceiros", SI.portfolio(spark, SF_SMALL), AS_OF, "p1")
    before = store.latest_commit("portfolio_official").parts
    RN.run_dataset(spark, store, "carteira_parceiros", p.withColumn("balance", F.col("balance") + 1), AS_OF, "p2")
    after = store.latest_commit("portfolio_official").parts
    assert {k for k in after if after[k] != before[k]} == {"2001"}
    assert RN.years_in(p, period_col="period") == [2001]


def test_append_order_persists_across_runs(spark, workdir, merge_plan):
    store = TableStore(spark, workdir)
    s1 = SI.store_activity(spark, SF_SMALL).where("vintage < 200001")
    RN.run_dataset(spark, store, "dias_sem_producao", s1, AS_OF, "r1",
                   run_ts=dt.datetime(2001, 7, 1, 6))
    first = {(r.store_id, r.vintage): (r.first_seen_run, r.first_seen_ord)
             for r in store.read("store_activity_official").collect()}
    s2 = SI.store_activity(spark, SF_SMALL).withColumn("financed_count", F.col("financed_count") + 1)
    RN.run_dataset(spark, store, "dias_sem_producao", s2, AS_OF, "r2", run_ts=dt.datetime(2001, 7, 2, 6))
    after = store.read("store_activity_official").collect()
    stamps = {(r.store_id, r.vintage): (r.first_seen_run, r.first_seen_ord) for r in after}
    # existing rows keep their first stamp, new rows come after them
    assert all(stamps[k] == v for k, v in first.items())
    new_runs = {v[0] for k, v in stamps.items() if k not in first}
    assert new_runs and min(new_runs) > max(v[0] for v in first.values())
    assert {r.change_type for r in after if (r.store_id, r.vintage) in first} == {"edited"}


def test_keep_absent_keeps_stored_value(spark):
    from snapmerge.plans import flows as G
    stored = spark.createDataFrame([(1, "200101", "a", 10.0, 1), (None, None, None, 10.0, None)],
                                   "contract_code long, period string, note string, gross_amount double, ord int")
    preview = spark.createDataFrame([(1, "200101", 11.0, 1)],
                                    "contract_code long, period string, gross_amount double, ord int")
    kept = G.commission_official(preview, stored, keep_absent=True).where("not is_total").first()
    nulled = G.commission_official(preview, stored).where("not is_total").first()
    assert kept["note"] == "a" and nulled["note"] is None
    assert kept["change_type"] == "edited"


def test_vacuum_keeps_versions_in_use(spark, workdir):
    store = TableStore(spark, workdir)
    df = spark.range(6).withColumn("year", (F.col("id") % 3 + 1999).cast("int"))
    store.overwrite("t", df, "r1", partition_col="year")
    for i in (2, 3, 4):
        store.overwrite("t", spark.range(i).withColumn("year", F.lit(2001)), f"r{i}", partition_col="year")
    store.write("t", spark.range(1).withColumn("year", F.lit(2001)), "r5", partition_col="year")  # unpublished
    deleted = store.vacuum("t", keep_commits=1)
    name = lambda p: p.rsplit("/", 1)[1].rsplit("-", 1)[0]  # noqa: E731 — without the attempt
    assert sorted(map(name, deleted)) == ["v=r2", "v=r3"]   # r1 still holds 1999/2000
    assert store.read("t").count() == 4 + 4
    assert list(map(name, store.vacuum("t", keep_commits=1, include_unpublished=True))) == ["v=r5"]


def test_job_runs_latest_extract_per_dataset(spark, workdir):
    from snapmerge.job import run_job, select_datasets
    land = f"{workdir}/landing"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    SI.store_activity(spark, SF_SMALL).coalesce(1).write.parquet(f"{land}/tmp")
    part = [p.path for p in spark.read.format("binaryFile").load(f"{land}/tmp").select("path").collect()
            if p.path.endswith(".parquet")][0]
    fs_path(part).getFileSystem(conf).rename(fs_path(part), fs_path(f"{land}/dias_sem_producao_1000000001.parquet"))
    datasets = select_datasets(None, "weekly")
    reports = run_job(spark, land, f"{workdir}/store", AS_OF, datasets + ["comissao_a_vista"], "j1")
    by = {r.dataset: r for r in reports}
    assert by["dias_sem_producao"].published and by["dias_sem_producao"].new_rows > 0
    assert by["comissao_a_vista"].note == "no extract for this run"


def test_job_keep_last_follows_file_order_and_reruns_are_noops(spark, workdir, merge_plan):
    from snapmerge.job import run_job
    land = f"{workdir}/landing"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = [("A", 200101, "x", 1.0), ("B", 200101, "y", 5.0), ("A", 200101, "x", 2.0)]  # A twice: last wins
    spark.createDataFrame(rows, "branch string, period int, segment string, balance double") \
        .withColumn("store_tax_id", F.lit(7).cast("long")).coalesce(1).write.parquet(f"{land}/tmp")
    part = [p.path for p in spark.read.format("binaryFile").load(f"{land}/tmp").select("path").collect()
            if p.path.endswith(".parquet")][0]
    fs_path(part).getFileSystem(conf).rename(fs_path(part), fs_path(f"{land}/carteira_parceiros_1000000001.parquet"))
    as_of = dt.date(2001, 1, 20)
    r1 = run_job(spark, land, f"{workdir}/store", as_of, ["carteira_parceiros"], "j1")[0]
    off = {r.branch: r.balance for r in TableStore(spark, f"{workdir}/store").read("portfolio_official").collect()}
    assert off == {"A": 2.0, "B": 5.0} and r1.new_rows == 2
    # nothing new has landed: the entry that was run is not run again
    r2 = run_job(spark, land, f"{workdir}/store", as_of, ["carteira_parceiros"], "j2")[0]
    assert r2.note == "no extract for this run" and not r2.published


def test_new_dataset_by_spec_only(spark, workdir):
    from snapmerge.specs import REGISTRY, DatasetSpec, register
    spec = register(DatasetSpec(dataset_id="supplier_balances", name="Supplier balances", key=("s_suppkey",),
                                cadence="weekly", keep_columns=("s_suppkey", "s_name", "s_acctbal"),
                                flow="accumulate", table_prefix="supplier_balances"))
    try:
        store = TableStore(spark, workdir)
        sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
        r1 = RN.run_dataset(spark, store, spec.dataset_id, sup, AS_OF, "r1")
        r2 = RN.run_dataset(spark, store, spec.dataset_id, sup.withColumn("s_acctbal", F.col("s_acctbal") + 1),
                            AS_OF, "r2")
        assert r1.new_rows == sup.count() and r2.edited_rows == sup.count()
        assert store.read("supplier_balances_official").count() == sup.count()
    finally:
        REGISTRY.pop(spec.dataset_id, None)


def test_rows_leaving_a_table_are_published(spark, workdir, merge_plan):
    store = TableStore(spark, workdir)
    ext = SI.contracts_extract(spark, SF_SMALL, AS_OF)
    RN.run_dataset(spark, store, "numero_contratos", ext, AS_OF, "r1")
    before = store.read("contracts_quarter").count()
    # the same extract 120 days later: nothing new or edited, but July leaves the month preview
    # and ages out of the 90-day window
    later = AS_OF + dt.timedelta(days=120)
    r = RN.run_dataset(spark, store, "numero_contratos", ext, later, "r2")
    assert r.new_rows == 0 and r.edited_rows == 0 and r.published
    after = store.read("contracts_quarter")
    assert after.count() < before
    assert after.where(F.col("report_date") < F.lit(later - dt.timedelta(days=90))).count() == 0
    n = after.count()
    assert store.latest_commit("contracts_quarter").part_rows == ({"2001": n} if n else {})
    assert store.read("contracts_preview").count() == 0


def _files(spark, path):
    return sorted((r.path, r.modificationTime, bytes(r.content)) for r in
                  spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect())


def test_published_run_id_changes_nothing(spark, workdir):
    store = TableStore(spark, workdir)
    ext = SI.store_activity(spark, SF_SMALL)
    assert RN.run_dataset(spark, store, "dias_sem_producao", ext, AS_OF, "r1").published
    before = _files(spark, f"{workdir}/store_activity_official"), _files(spark, f"{workdir}/store_activity_preview")
    again = RN.run_dataset(spark, store, "dias_sem_producao", ext.withColumn("financed_count", F.col("financed_count") + 1), AS_OF, "r1")
    assert not again.published and "published before" in again.note
    assert before == (_files(spark, f"{workdir}/store_activity_official"), _files(spark, f"{workdir}/store_activity_preview"))
    with pytest.raises(ValueError, match="published before"):
        store.write("store_activity_official", store.read("store_activity_official"), "r1")


def test_crash_between_targets_shows_neither(spark, workdir, monkeypatch):
    store = TableStore(spark, workdir)
    ext = SI.store_activity(spark, SF_SMALL)
    write = TableStore._write_text

    def stop(self, path, text):
        if "/_log/" in path:
            raise RuntimeError("lost before the commit")
        write(self, path, text)

    monkeypatch.setattr(TableStore, "_write_text", stop)
    r = RN.run_dataset(spark, store, "dias_sem_producao", ext, AS_OF, "r1")
    assert r.note.startswith("failed") and store.read("store_activity_preview") is None and store.read("store_activity_official") is None
    monkeypatch.setattr(TableStore, "_write_text", write)
    assert RN.run_dataset(spark, store, "dias_sem_producao", ext, AS_OF, "r1").published  # a retry of the same run id


def test_two_writers(spark, workdir):
    from snapmerge.sources.store import PublishConflict
    store = TableStore(spark, workdir)
    a, b, c = (store.write(t, spark.range(n), v) for t, n, v in (("t", 1, "a"), ("t", 2, "b"), ("u", 3, "c")))
    store.publish("t", a)
    store.publish("u", c)                      # another table: goes on top of the first commit
    with pytest.raises(PublishConflict):
        store.publish("t", b)
    assert store.read("t").count() == 1 and store.read("u").count() == 3
    store._write_text(f"{workdir}/_log/000000000002.json", "{half a com")   # a writer that died while committing
    assert store.read("t").count() == 1
    store.publish("t", store.write("t", spark.range(4), "d"))
    assert store.read("t").count() == 4 and store.has_version("t", "a")


def test_ingest_reads_or_rejects(spark):
    from snapmerge.operators.ingest import REASONS, ingest, money_from_text
    from snapmerge.specs import CONTRACTS, PORTFOLIO
    texts = ["R$ 1.234,56", "1234.56", "5,50", "(7,00)", "-3", "1,234.5", "1.234", "10%", "abc", "1,2,3", " "]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(money_from_text(F.col("t")).alias("v")).collect()]
    assert [None if v is None else float(v) for v in got] == [1234.56, 1234.56, 5.5, -7.0, -3.0, 1234.5, 1234.0, 10.0, None, None, None]
    rows = [(1, "10/07/2001", "R$ 1,00", float("nan")), (2, "n/a", "2,00", 1.0), (3, None, "x", 1.0), (4, "2001-07-05", None, 2.0)]
    df = spark.createDataFrame(rows, "`ID Proposta` long, `\nDt Relatório ` string, `Vl Principal` string, other double")
    out = ingest(df, CONTRACTS)
    assert {r.proposal_id: (str(r.report_date), r.other) for r in out.rows.collect()} == {1: ("2001-07-10", None), 4: ("2001-07-05", 2.0)}
    assert {r.proposal_id: r[REASONS] for r in out.rejects.collect()} == {2: ["report_date: unreadable"], 3: ["principal: unreadable"]}
    p = spark.createDataFrame([("7", "A", "200101"), ("7", "B", "bad"), ("7", "C", None), ("7", "D", "200113")], "store_tax_id string, branch string, period string")
    out = ingest(p, PORTFOLIO)
    assert [(r.branch, r.period) for r in out.rows.collect()] == [("A", 200101)] and out.rejects.count() == 3


def test_too_many_rejects_fail_the_run(spark, workdir):
    store = TableStore(spark, workdir)
    bad = SI.targets(spark, SF_SMALL).withColumn("period", F.lit("none"))
    r = RN.run_dataset(spark, store, "meta_financiamento_seguro", bad, AS_OF, "r1")
    assert r.note.startswith("failed: TooManyRejects") and store.read("targets_official") is None


def test_plain_counts_move_nothing(spark, workdir):
    from snapmerge.operators.sizing import bounded_count
    store = TableStore(spark, workdir)
    store.publish("t", store.write("t", spark.range(1000), "a"))
    c = store.latest_commit("t")
    c.rows, c.seq, c.version = 1000, 1, "b"
    store.publish("t", c)
    assert bounded_count(store.read("t"), 10) is None and bounded_count(store.read("t"), 5000) == 1000
    assert bounded_count(spark.range(7), 10) == 7


def _put(spark, path, content):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(content))
    out.close()


def test_job_isolates_and_catches_up(spark, workdir):
    from snapmerge.job import run_job
    land = f"{workdir}/landing"
    schema = "store_tax_id long, branch string, period int, balance double"
    spark.createDataFrame([(7, "A", 200101, 1.0)], schema).write.parquet(f"{land}/carteira_parceiros_1000000001.parquet")
    spark.createDataFrame([(7, "B", 200101, 2.0)], schema).write.parquet(f"{land}/carteira_parceiros_1000000002.parquet")
    _put(spark, f"{land}/comissao_a_vista_1000000001.parquet/part-00000.parquet", b"no Parquet file")
    reports = run_job(spark, land, f"{workdir}/store", dt.date(2001, 1, 20), ["comissao_a_vista", "carteira_parceiros"], "j1")
    assert [r.note.startswith("failed") for r in reports] == [True, False, False]
    store = TableStore(spark, f"{workdir}/store")
    # the entry that the newer one overtook was merged too
    assert {r.branch: r.balance for r in store.read("portfolio_official").collect()} == {"A": 1.0, "B": 2.0}
    assert store.mark("carteira_parceiros") == 1000000002 and store.mark("comissao_a_vista") is None
    assert store.read_log(RN.HISTORY_TABLE).count() == 3


def test_job_reads_csv_in_file_order(spark, workdir):
    from snapmerge.job import run_job
    land = f"{workdir}/landing"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = fs_path(f"{land}/carteira_parceiros_1000000001.csv")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray("Cnpj Da Loja,Filial,Anomes,balance_amount\n7,A,200101,\"R$ 9,00\"\n7,B,200101,\"5,00\"\n7,A,200101,\"2,50\"\n".encode()))
    out.close()
    r = run_job(spark, land, f"{workdir}/store", dt.date(2001, 1, 20), ["carteira_parceiros"], "j1")[0]
    assert r.published, r.note
    got = {r.branch: float(r.balance_amount) for r in TableStore(spark, f"{workdir}/store").read("portfolio_official").collect()}
    assert got == {"A": 2.5, "B": 5.0}


def _portfolio(spark, path, rows):
    spark.createDataFrame(rows, "store_tax_id long, branch string, period int, balance double").write.parquet(path)


def test_empty_landing_entry_fails_its_run_only(spark, workdir):
    from snapmerge.job import run_job
    land = f"{workdir}/landing"
    _put(spark, f"{land}/carteira_parceiros_1000000001.parquet", b"")
    _portfolio(spark, f"{land}/carteira_parceiros_1000000002.parquet", [(7, "B", 200101, 2.0)])
    as_of, name = dt.date(2001, 1, 20), ["carteira_parceiros"]
    first, second = run_job(spark, land, f"{workdir}/store", as_of, name, "j1")
    assert first.note == "failed: landing entry carteira_parceiros_1000000001.parquet is empty" and first.rows_read is None
    assert second.published and second.rows_read == 1
    store = TableStore(spark, f"{workdir}/store")
    notes = sorted(r.note or "" for r in store.read_log(RN.HISTORY_TABLE).collect())
    assert len(notes) == 2 and notes[1].startswith("failed: landing entry")
    assert [r.note for r in run_job(spark, land, f"{workdir}/store", as_of, name, "j2")] == ["no extract for this run"]
    # the export lands again under its name, now with content
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{land}/carteira_parceiros_1000000001.parquet")
    fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, True)
    _portfolio(spark, f"{land}/carteira_parceiros_1000000001.parquet", [(7, "A", 200101, 1.0)])
    again = run_job(spark, land, f"{workdir}/store", as_of, name, "j3")
    assert len(again) == 1 and again[0].published and "landed late: epoch 1000000001 after 1000000002" in again[0].note
    assert {r.branch: r.balance for r in store.read("portfolio_official").collect()} == {"A": 1.0, "B": 2.0}


def test_late_entry_with_an_older_epoch_is_run(spark, workdir):
    from snapmerge.job import run_job
    land, as_of = f"{workdir}/landing", dt.date(2001, 1, 20)
    _portfolio(spark, f"{land}/carteira_parceiros_1000000005.parquet", [(7, "A", 200101, 5.0)])
    run_job(spark, land, f"{workdir}/store", as_of, ["carteira_parceiros"], "j1")
    _portfolio(spark, f"{land}/2001/carteira_parceiros_1000000003.parquet", [(7, "C", 200101, 3.0)])
    _portfolio(spark, f"{land}/carteira_parceiros_1000000006.parquet", [(7, "D", 200101, 6.0)])
    notes = [r.note for r in run_job(spark, land, f"{workdir}/store", as_of, ["carteira_parceiros"], "j2")]
    assert len(notes) == 2 and "landed late" in notes[0] and "landed late" not in notes[1]
    store = TableStore(spark, f"{workdir}/store")
    assert {r.branch for r in store.read("portfolio_official").collect()} == {"A", "C", "D"}
    assert {e[2] for e in store.ledger("carteira_parceiros")} == {1000000005, 1000000003, 1000000006}
    assert [r.note for r in run_job(spark, land, f"{workdir}/store", as_of, ["carteira_parceiros"], "j3")] == ["no extract for this run"]


def test_history_survives_a_writer_that_died(spark, workdir):
    """What the newest commit added is known from it, before any marker file is written; commits do not grow with runs."""
    store = TableStore(spark, workdir)
    sizes = []
    for i in range(6):
        store.publish_all({"t": store.write("t", spark.range(i + 1), f"run {i}/x")}, {"d": (f"d_{i}.parquet", 10, i)})
        assert store.has_version("t", f"run {i}/x") and (f"d_{i}.parquet", 10, i) in store.ledger("d")
        sizes.append(len(store._read_text(f"{workdir}/_log/{i:012d}.json")))
    assert all(store.has_version("t", f"run {i}/x") for i in range(6)) and len(store.ledger("d")) == 6
    assert max(sizes[1:]) - min(sizes[1:]) < 10
    with pytest.raises(ValueError, match="published before"):
        store.write("t", spark.range(1), "run 2/x")
    store.publish_all({"t": store.write("t", spark.range(1), "late")}, {"d": ("d_0b.parquet", 3, 0)})
    assert store.mark("d") == 5


@pytest.fixture()
def keyed_tables(spark):
    spark.conf.set(RN.KEYED_CONF, "true")
    yield
    spark.conf.unset(RN.KEYED_CONF)


def _plain(df):
    drop = {*M.STAMPS, M.CHANGE, "is_total"}
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in drop)).collect()))


@pytest.mark.parametrize("dataset", ["dias_sem_producao", "comissao_a_vista"])
def test_key_slices_hold_what_whole_tables_hold(spark, workdir, keyed_tables, dataset):
    """The same runs into both layouts; a run without changes writes no data file."""
    if dataset == "comissao_a_vista":
        first, as_of = SI.commission_extract(spark, SF_SMALL, SI.A_TURN), SI.A_TURN
        second = first.withColumn("gross_amount", (F.col("gross_amount") + 1).cast("decimal(18,2)"))
    else:
        first, as_of = SI.store_activity(spark, SF_SMALL), AS_OF
        second = first.withColumn("financed_count", F.col("financed_count") + F.when(F.col("store_id") < 50, 1).otherwise(0))
    sliced, whole = TableStore(spark, f"{workdir}/sliced"), TableStore(spark, f"{workdir}/whole")
    reports = [RN.run_dataset(spark, sliced, dataset, e, as_of, f"r{i}") for i, e in enumerate((first, second, second))]
    spark.conf.set(RN.KEYED_CONF, "false")
    want = [RN.run_dataset(spark, whole, dataset, e, as_of, f"r{i}") for i, e in enumerate((first, second, second))]
    official = RN.targets_of(dataset)["official"].table
    assert RN.keyed(sliced, dataset) and not RN.keyed(whole, dataset)  # a table keeps its layout
    assert [(r.rows_read, r.new_rows, r.edited_rows, r.published) for r in reports] == [(r.rows_read, r.new_rows, r.edited_rows, r.published) for r in want], [r.note for r in reports]
    stored = whole.read(official)
    data = stored.where("not is_total") if "is_total" in stored.columns else stored
    kept = sliced.read(official)
    if "rate_pct" in data.columns:  # a mean stands in the same column of the whole table
        kept = kept.withColumn("rate_pct", F.col("rate_pct").cast("double"))
    assert _plain(kept) == _plain(data)
    assert [p["bytes_written"] for p in reports[2].per_target.values()] == [0, 0]
    assert sliced.latest_commit(official).version == "r1" and not sliced._list(f"{workdir}/sliced/{official.replace('official', 'batch')}/data")
    if dataset == "comissao_a_vista":
        assert RN.totals_of(sliced, dataset).first().gross_amount == RN.totals_of(whole, dataset).first().gross_amount
        assert RN.totals_of(sliced, dataset).first().rate_pct == pytest.approx(RN.totals_of(whole, dataset).first().rate_pct)


def test_rows_with_equal_order_are_written_by_many_tasks(spark, workdir):
    """An extract without positions: all rows are first seen at the same place, and still no task writes them all."""
    store = TableStore(spark, f"{workdir}/equal_order")
    rows = spark.range(4000).select(
        F.col("id").alias("store_id"), F.lit("s").alias("store_name"), F.lit(200107).alias("vintage"), F.lit(dt.date(2001, 7, 1)).alias("last_contract_date"),
        F.lit(1).cast("decimal(28,2)").alias("financed_value"), F.lit(1).cast("long").alias("financed_count"))
    conf, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(conf, "false")
    try:
        report = RN.run_dataset(spark, store, "dias_sem_producao", rows, dt.date(2001, 7, 15), "r1")
    finally:
        spark.conf.set(conf, before)
    assert report.total_rows == 4000
    files = store.read("store_activity_official").groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < 2000


# ------------------------------------------------------------------ amounts as text, first runs
def _amounts(spark, n=400, plus=0):
    return spark.range(n).select((F.col("id") % 300).alias("contract_code"), F.lit("200107").alias("period"), F.lit(7).alias("master_tax_id"),
                                 F.concat(F.lit("R$ 1."), F.lpad((F.col("id") + plus).cast("string"), 3, "0"), F.lit(",50")).alias("gross_amount"),
                                 F.col("id").cast("int").alias("ord"))


def test_amount_text_is_read_once_a_pass(spark):
    from snapmerge.operators.ingest import ingest
    from snapmerge.specs import COMMISSION
    rows = ingest(_amounts(spark), COMMISSION).rows
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 6, plan  # of the period, and two of the amount
    assert rows.count() == 400 and float(rows.agg(F.max("gross_amount")).first()[0]) == 1399.5


def test_large_batches_are_not_counted_by_key(spark, workdir, monkeypatch):
    """Keys are counted only where the count can change the merge's plan: not on a first run, not for a batch the size of the table."""
    from snapmerge.operators import sizing

    def counted(df, *a, **kw):
        assert sizing.known_rows(df) is not None, "keys were counted"
        return sizing.proven_rows(df, *a, **kw)

    monkeypatch.setattr(M, "proven_rows", counted)
    store = TableStore(spark, workdir)
    for run, plus in (("r1", 0), ("r2", 1)):
        report = RN.run_dataset(spark, store, "comissao_a_vista", _amounts(spark, plus=plus), AS_OF, run)
        assert report.note == "" and report.total_rows == 300 and (report.new_rows, report.edited_rows) == ((300, 0) if run == "r1" else (0, 300))
    stored = store.read("commission_official").where("not is_total")
    # the last of a contract's rows counts
    assert {r.contract_code: float(r.gross_amount) for r in stored.collect()} == {k: 1001.5 + (k + 300 if k < 100 else k) for k in range(300)}


def test_first_run_of_a_unique_batch_groups_nothing(spark):
    batch = spark.createDataFrame([(1, "a", 5, 10), (None, "b", 2, 11), (2, None, 3, 0)], "k long, v string, o int, seq long")
    kw = {"ord_col": "o", "seq_col": "seq", "with_order": True}
    direct, grouped = (M.accumulate_and_classify(None, batch, "k", batch_unique=u, **kw) for u in (True, False))
    assert direct.dtypes == grouped.dtypes and sorted(map(str, direct.collect())) == sorted(map(str, grouped.collect()))
    assert "Aggregate" not in direct._jdf.queryExecution().executedPlan().toString()


def test_shuffle_files_go_with_their_write(spark, workdir):
    import time
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def left():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before = left()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    c = TableStore(spark, workdir).write("t", rows, "a")
    for _ in range(100):
        if not left() - before:
            break
        time.sleep(0.1)
    assert not left() - before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert rows.count() == 7 and TableStore(spark, workdir).read_commit(c).count() == 7
