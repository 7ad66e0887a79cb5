"""Scheduled consolidation job (E1 of the survey) for ``spark-submit``.

    python -m snapmerge.job --landing s3a://…/landing --store s3a://…/tables \
        --as-of 2026-12-03 [--cadence daily | --datasets numero_contratos comissao_a_vista]

(or a spark-submit driver script that calls :func:`main`).  For each requested
dataset every landing entry that the store's ledger does not name (by name,
length and epoch) is read with its landing columns (S-01) and run through the
runner (G-10), oldest first.  So an extract that a later one overtook is not
lost, and one that lands late, with an older epoch than others already run, is
run when it is there (its rows are the last ones seen, and the audit note says so).  An entry
without a byte is a failed run with an audit row; it is named in the ledger, so
later entries go on, and is run when it lands again with content.  An entry that
cannot be read or run stops its own dataset only (later entries wait, so the
order is kept); every dataset gets an audit row — "no extract for this run" when
nothing new has landed.  ``--at-once n`` runs n datasets side by side
(:mod:`snapmerge.plans.side_by_side`).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .plans import runner as RN
from .plans.side_by_side import SideBySide
from .session import build_session
from .sources.extract import landing_files, read_extract
from .sources.store import TableStore
from .specs import REGISTRY, by_cadence


def select_datasets(datasets: list[str] | None, cadence: str | None) -> list[str]:
    if datasets:
        unknown = [d for d in datasets if d not in REGISTRY]
        if unknown:
            raise SystemExit(f"unknown datasets: {unknown}; known: {sorted(REGISTRY)}")
        return datasets
    if cadence:
        return [s.dataset_id for s in by_cadence(cadence)]
    return list(REGISTRY)


def run_job(spark: SparkSession, landing: str, store_root: str, as_of: dt.date,
            datasets: list[str], run_id: str | None = None, at_once: int = 1,
            control: SideBySide | None = None) -> list[RN.RunReport]:
    """``at_once``: datasets that run side by side; ``control`` (for :meth:`SideBySide.cancel`) brings its own number."""
    run_id = run_id or as_of.strftime("%Y%m%d") + dt.datetime.now(dt.timezone.utc).strftime("T%H%M%S")
    if control is None and at_once > 1:
        control = SideBySide(spark, store_root, at_once)
    if control is not None:
        return control.run(datasets, lambda store, dataset: run_entries(store, landing, dataset, as_of, run_id))
    store = TableStore(spark, store_root)
    return [r for dataset in datasets for r in run_entries(store, landing, dataset, as_of, run_id)]


def run_entries(store: TableStore, landing: str, dataset: str, as_of: dt.date, run_id: str) -> list[RN.RunReport]:
    """The dataset's waiting landing entries, oldest first, up to one that fails."""
    spark, reports = store.spark, []
    try:
        entries = new_entries(spark, landing, store, dataset)
    except Exception:
        if not store.cancelled():
            raise
        entries = []
    if not entries:
        return [RN.run_dataset(spark, store, dataset, None, as_of, run_id)]
    for e in entries:
        entry = (e.file_name, e.length, e.epoch)
        report = RN.run_dataset(spark, store, dataset, lambda p=e.path: open_entry(spark, p), as_of,
                                f"{run_id}-{e.epoch}", entry=entry)
        reports.append(report)
        if report.note.startswith("failed") and (e.length or store.cancelled()):
            break
    return reports


def new_entries(spark: SparkSession, landing: str, store: TableStore, dataset: str) -> list[Row]:
    """Landing entries of the dataset that are not in the ledger, oldest first (path, file_name, length, epoch; one row per waiting run)."""
    done = store.ledger(dataset)
    files = landing_files(spark, landing).where(F.col("dataset") == dataset).orderBy("epoch", "path")
    return [r for r in files.select("path", "file_name", "length", "epoch").collect() if (r.file_name, r.length, r.epoch) not in done]


def open_entry(spark: SparkSession, path: str) -> DataFrame:
    """A landing entry by its format; CSV text is typed by the ingest step."""
    if path.endswith(".csv"):
        return read_extract(spark, path, fmt="csv", options={"header": "true", "inferSchema": "false", "multiLine": "true"})
    return read_extract(spark, path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="snapmerge.job")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--cadence", choices=sorted({s.cadence for s in REGISTRY.values()}))
    ap.add_argument("--datasets", nargs="*")
    ap.add_argument("--run-id")
    ap.add_argument("--at-once", type=int, default=1, help="datasets that run side by side")
    a = ap.parse_args(argv)
    spark = build_session(app_name="snapmerge-job")
    reports = run_job(spark, a.landing, a.store, dt.date.fromisoformat(a.as_of),
                      select_datasets(a.datasets, a.cadence), a.run_id, a.at_once)
    for r in reports:
        print(f"{r.dataset}: read={r.rows_read} new={r.new_rows} edited={r.edited_rows} "
              f"total={r.total_rows} published={r.published} {r.note}")


if __name__ == "__main__":
    main()
