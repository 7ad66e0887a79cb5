"""Datasets that run side by side (G-10): same result as one after the other; a failing or cancelled one leaves the others alone."""

import datetime as dt
import threading
import time

from pyspark.sql import functions as F

from snapmerge.job import run_job
from snapmerge.plans import runner as RN
from snapmerge.plans import standins as SI
from snapmerge.plans.side_by_side import SideBySide, own_session
from snapmerge.sources.store import TableStore

from conftest import SF_SMALL

AS_OF = dt.date(2001, 1, 20)
EXTRACTS = {
    "numero_contratos": lambda s: SI.contracts_extract(s, SF_SMALL, AS_OF),
    "dias_sem_producao": lambda s: SI.store_activity(s, SF_SMALL),
    "meta_financiamento_seguro": lambda s: SI.targets(s, SF_SMALL),
    "carteira_parceiros": lambda s: SI.portfolio_extract(s, SF_SMALL, AS_OF),
    "comissao_a_vista": lambda s: SI.commission_extract(s, SF_SMALL, AS_OF),
}


def _rows(store, table):
    df = store.read(table)
    return None if df is None else sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_five_at_once_equal_one_after_the_other(spark, workdir):
    land = f"{workdir}/landing"
    for epoch in (1000000001, 1000000002):
        for name, rows in EXTRACTS.items():
            rows(spark).write.parquet(f"{land}/{name}_{epoch}.parquet")
    reports = {}
    for at_once in (1, 5):
        reports[at_once] = run_job(spark, land, f"{workdir}/store{at_once}", AS_OF, list(EXTRACTS), "j1", at_once=at_once)
    assert [r.dataset for r in reports[1]] == [r.dataset for r in reports[5]] and reports[1] == reports[5]
    one, five = TableStore(spark, f"{workdir}/store1"), TableStore(spark, f"{workdir}/store5")
    for name in EXTRACTS:
        assert one.ledger(name) == five.ledger(name) and len(five.ledger(name)) == 2
        for t in RN.targets_of(name).values():
            assert _rows(one, t.table) == _rows(five, t.table)
    assert five.read_log(RN.HISTORY_TABLE).count() == 10
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()


def test_a_failing_dataset_leaves_the_others_alone(spark, workdir):
    land = f"{workdir}/landing"
    for name in ("dias_sem_producao", "meta_financiamento_seguro"):
        EXTRACTS[name](spark).write.parquet(f"{land}/{name}_1000000001.parquet")
    spark.range(5).withColumn("period", F.lit("none")).write.parquet(f"{land}/carteira_parceiros_1000000001.parquet")
    got = {r.dataset: r for r in run_job(spark, land, f"{workdir}/store", AS_OF, ["carteira_parceiros", "dias_sem_producao", "meta_financiamento_seguro"], "j1", at_once=3)}
    assert got["carteira_parceiros"].note.startswith("failed") and got["dias_sem_producao"].published and got["meta_financiamento_seguro"].published


def _slow(rows):
    def wait(frames):
        for f in frames:
            time.sleep(120)
            yield f
    return rows.repartition(2).mapInPandas(wait, rows.schema)


def test_a_cancelled_dataset_leaves_the_others_alone(spark, workdir):
    control, got = SideBySide(spark, f"{workdir}/store", 2), {}

    def work(store, name):
        rows = EXTRACTS[name](store.spark)
        return [RN.run_dataset(store.spark, store, name, _slow(rows) if name == "carteira_parceiros" else rows, AS_OF, "r1", entry=(name, 1, 1))]

    names = ["carteira_parceiros", "dias_sem_producao", "meta_financiamento_seguro", "comissao_a_vista"]
    run = threading.Thread(target=lambda: got.update((r.dataset, r) for r in control.run(names, work)))
    start = time.time()
    run.start()
    control.wait_for("carteira_parceiros")
    control.cancel("comissao_a_vista")       # before its turn
    control.wait_for("meta_financiamento_seguro")  # another one is through, so the slow one is in its first job
    control.cancel("carteira_parceiros")
    run.join(100)
    assert not run.is_alive() and time.time() - start < 100
    store = TableStore(spark, f"{workdir}/store")
    for name in ("carteira_parceiros", "comissao_a_vista"):
        assert got[name].note == "failed: cancelled" and not store.ledger(name)
        assert all(store.read(t.table) is None for t in RN.targets_of(name).values())
    assert got["dias_sem_producao"].published and got["meta_financiamento_seguro"].published
    notes = {r.dataset: r.note for r in store.read_log(RN.HISTORY_TABLE).collect()}
    assert len(notes) == 4 and list(notes.values()).count("failed: cancelled") == 2


def test_own_session_keeps_the_settings_apart(spark):
    spark.conf.set("snapmerge.test.setting", "7")
    try:
        own = own_session(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions") and own.conf.get("snapmerge.test.setting") == "7"
        own.conf.set("spark.sql.shuffle.partitions", "3")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.unset("snapmerge.test.setting")
