"""Run datasets against a :class:`~snapmerge.sources.store.TableStore` (G-09, G-10, S-11, A-09).

One run of one dataset:

1. open the extract and ingest it (:mod:`snapmerge.operators.ingest`): typed rows go on, rejects go to the
   dataset's quarantine log; over ``MAX_REJECT_SHARE`` of the rows rejected fails the run;
2. read the stored targets (only the partitions the flow can touch);
3. build and write the preview, then the other targets on the written preview — one Spark job each, with
   ``Observation`` metrics (new / edited / total) collected during the write.  Rows are range-partitioned and
   sorted by the target's order columns, so the files in name order hold the table in order (O-01..O-03);
4. publish all targets in one commit, after every write succeeded; publish nothing when no target has a
   new or edited row (S-11);
5. append the audit row, with schema drift, footer rows and rejects in its note.

A run id that was published before changes nothing.  A failing dataset writes an audit row with null counts
and the error, and never blocks the other datasets.
"""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import row_year
from ..operators import merge as M
from ..operators import schema as S
from ..operators.audit import audit_row
from ..operators.ingest import REASONS, Ingested, TooManyRejects, ingest
from ..operators.routing import YEAR
from ..operators.schema import drift_rows
from ..operators.sizing import known_rows, most_rows, with_known_rows, with_most_rows
from ..operators.totals import IS_TOTAL
from ..sources import extract as EX
from ..sources.store import Cancelled, TableStore
from ..specs import DatasetSpec, get_spec
from . import flows as G
from . import keyed as KT

BOOKKEEPING = [M.CHANGE, M.LAST_SRC, M.LAST_ORD, M.SEEN_SRC, M.SEEN_ORD]
HISTORY_TABLE = "run_history"
QUARANTINE_SCHEMA = "run_id string, reasons array<string>, row string"
# Set to false, tables in append order (the permanent ones) are sorted inside files only: the
# rewritten partitions then need no shuffle, and readers that want the order sort by the stamps.
ORDER_HISTORY_CONF = "snapmerge.orderHistory"
# Set to true, the accumulating and the upserted datasets are stored in key slices (:mod:`.keyed`): a run then reads and
# writes the slices its rows touch, and totals are kept with the commit (:func:`totals_of`).  A table keeps the layout it was made with.
KEYED_CONF = "snapmerge.keyedTables"
KEYED_FLOWS = ("accumulate", "upsert_with_totals")
# Share of an extract's rows that may be rejected before the run fails.
MAX_REJECT_SHARE = 0.2


@dataclass
class Target:
    table: str
    partition_col: str | None = None
    run_year_only: bool = False          # stored rows of the run year only (S-08)
    sort_within: list[str] = field(default_factory=list)


# Fixed layout per flow kind: which stored table (suffix after the dataset's
# table prefix) feeds / receives each flow output.
FLOW_TARGETS: dict[str, dict[str, Target]] = {
    "month_preview_rolling": {
        "preview": Target("preview", sort_within=["report_date", M.LAST_SRC, M.LAST_ORD]),
        "quarter": Target("quarter", YEAR, run_year_only=True, sort_within=["report_date", M.LAST_SRC, M.LAST_ORD]),
        "annual": Target("annual", YEAR, run_year_only=True, sort_within=list(M.STAMPS)),
    },
    "accumulate": {
        "preview": Target("preview"),
        "official": Target("official", sort_within=list(M.STAMPS)),
    },
    "accumulate_by_row_year": {
        "preview": Target("preview"),
        "official": Target("official", YEAR, sort_within=list(M.STAMPS)),
    },
    "period_preview_by_year": {
        "preview": Target("preview", sort_within=["period", M.LAST_SRC, M.LAST_ORD]),
        "official": Target("official", YEAR, sort_within=["period", M.LAST_SRC, M.LAST_ORD]),
    },
    "upsert_with_totals": {
        "preview": Target("preview"),
        "official": Target("official", sort_within=[IS_TOTAL, *M.STAMPS]),
    },
}


def targets_of(dataset: str) -> dict[str, Target]:
    """Targets of a dataset, with table names ``{table_prefix}_{suffix}``."""
    spec = get_spec(dataset)
    try:
        layout = FLOW_TARGETS[spec.flow]
    except KeyError:
        raise ValueError(f"dataset {dataset!r} has no known flow ({spec.flow!r})") from None
    return {name: replace(t, table=f"{spec.table_prefix}_{t.table}") for name, t in layout.items()}


def strip_bookkeeping(df: DataFrame | None, partition_col: str | None = None) -> DataFrame | None:
    """Stored rows as merge input: last run's labels and the routing column removed."""
    if df is None:
        return None
    drop = [c for c in BOOKKEEPING + ([partition_col] if partition_col else []) if c in df.columns]
    return with_known_rows(df.drop(*drop), known_rows(df))


def _stored(store: TableStore, dataset: str, name: str, as_of: dt.date,
            years: list[int] | None = None) -> DataFrame | None:
    """Stored rows a flow can touch: only the run year (S-08) or only the years
    present in the batch (S-07) are opened; other year folders are never read."""
    t = targets_of(dataset)[name]
    if t.run_year_only:
        years = [as_of.year]
    df = store.read(t.table, partitions=[str(y) for y in years] if years is not None else None)
    return strip_bookkeeping(df, t.partition_col)


def years_in(*frames: DataFrame | None, period_col: str) -> list[int]:
    """Distinct routing years of some frames, collected to the driver.

    The result is bounded by the calendar (a year is four digits, so at most
    10^4 values) — never by the data volume.
    """
    years: set[int] = set()
    for df in frames:
        if df is not None and period_col in df.columns:
            rows = df.select(row_year(period_col).alias("y")).where(F.col("y").isNotNull()).distinct().collect()
            years.update(r.y for r in rows)
    return sorted(years)


def prepare_extract(extract: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DatasetSpec]:
    """Landing columns → the dataset's order columns.

    The entry name is dropped; the run epoch becomes the run sequence and the
    position inside the extract (``extract_ord``) the spec's order column, so
    keep-last follows run order, then the report's row order, and neither is
    ever compared as data.
    """
    if EX.FILE in extract.columns:
        extract = extract.drop(EX.FILE)
    if EX.EPOCH in extract.columns and spec.seq_col is None:
        spec = replace(spec, seq_col=EX.EPOCH)
    if EX.ORD not in extract.columns:
        return extract, spec
    if spec.ord_col is None:
        return extract, replace(spec, ord_col=EX.ORD)
    if spec.ord_col not in extract.columns:
        return extract.withColumnRenamed(EX.ORD, spec.ord_col), spec
    return extract.drop(EX.ORD), spec


def build_flow(store: TableStore, dataset: str, extract: DataFrame, as_of: dt.date) -> G.FlowResult:
    """G-09: dispatch by dataset; unknown datasets are an error.

    Only the preview's plan is built here; the flow's ``rest`` builds the other targets.
    """
    s = lambda name: _stored(store, dataset, name, as_of)
    most = most_rows(extract)
    extract, spec = prepare_extract(extract, get_spec(dataset))
    extract = with_most_rows(extract, most)
    # Tables written by this store hold one row per key, so the touched-only
    # merge plan is allowed when the batch's keys are proven small.
    flow = spec.flow
    if flow == "month_preview_rolling":
        return G.contracts_flow(extract, s("preview"), s("quarter"), s("annual"), as_of, prev_unique=True, spec=spec)
    if flow == "accumulate":
        return G.store_activity_flow(extract, s("preview"), s("official"), as_of, spec=spec, prev_unique=True)
    if flow == "accumulate_by_row_year":
        preview = s("preview")
        years = years_in(preview, extract, period_col=spec_period(dataset))
        official = _stored(store, dataset, "official", as_of, years)
        return G.targets_flow(extract, preview, official, as_of, spec=spec, prev_unique=True)
    if flow == "period_preview_by_year":
        years = years_in(extract, period_col=spec_period(dataset))
        official = _stored(store, dataset, "official", as_of, years)
        return G.portfolio_flow(extract, s("preview"), official, as_of, spec=spec, prev_unique=True)
    if flow == "upsert_with_totals":
        return G.commission_flow(extract, s("preview"), s("official"), spec=spec, prev_unique=True)
    raise ValueError(f"dataset {dataset!r} has no known flow ({flow!r})")


def with_first_seen(df: DataFrame, run_seq: int) -> DataFrame:
    """O-03 across runs: a row keeps the (run, position) at which its key was
    first stored; rows seen for the first time get this run's stamp and their
    position in this run (existing rows first, then new ones in report order)."""
    if M.SEEN_ORD not in df.columns:
        return df
    run = F.col(M.STAMP_RUN) if M.STAMP_RUN in df.columns else F.lit(None).cast("long")
    pos = F.col(M.STAMP_ORD) if M.STAMP_ORD in df.columns else F.lit(None).cast("long")
    return (df.withColumn(M.STAMP_RUN, F.coalesce(run, F.lit(run_seq).cast("long")))
              .withColumn(M.STAMP_ORD, F.coalesce(pos, F.col(M.SEEN_ORD).cast("long"))))


def spec_period(dataset: str) -> str:
    return get_spec(dataset).period_col


@dataclass
class RunReport:
    dataset: str
    rows_read: int | None
    new_rows: int | None
    edited_rows: int | None
    total_rows: int | None
    published: bool
    note: str = ""
    per_target: dict = field(default_factory=dict)


def ingest_for(store: TableStore, dataset: str, extract: DataFrame) -> tuple[Ingested, list[str]]:
    """The dataset's typed rows and rejects, and notes on columns that differ from the spec and the stored table."""
    spec = get_spec(dataset)
    stored = next((c.schema for c in (store.latest_commit(t.table) for t in targets_of(dataset).values()) if c is not None), None)
    got = ingest(extract, spec, stored)
    own = {EX.FILE, EX.EPOCH, EX.ORD, spec.ord_col, spec.seq_col, YEAR, IS_TOTAL, *BOOKKEEPING, *M.STAMPS}
    have = [c for c in got.rows.columns if c not in own]
    kept = [f.name for f in stored.fields if f.name not in own] if stored is not None else None
    drift = drift_rows(spec.name, spec.keep_columns or (), have, kept)
    if spec.keep_columns is not None:  # columns beyond the configured ones are not kept by design
        drift = [d for d in drift if d[2] != "extra_vs_table"]
    return got, [f"{column} {issue}" for _, column, issue in drift]


def quarantine(store: TableStore, dataset: str, rejects: DataFrame, run_id: str) -> None:
    """Append rejected rows, as they came, with their reasons."""
    names = [c for c in rejects.columns if c != REASONS]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    store.append(f"{get_spec(dataset).table_prefix}_quarantine",
                 rejects.select(F.lit(run_id).alias("run_id"), F.col(REASONS).alias("reasons"), row.alias("row")))


def run_dataset(spark: SparkSession, store: TableStore, dataset: str,
                extract: DataFrame | Callable[[], DataFrame] | None,
                as_of: dt.date, run_id: str, run_ts: dt.datetime | None = None,
                entry: tuple[str, int, int] | None = None) -> RunReport:
    """Run one dataset end to end; always appends exactly one audit row.

    ``extract`` may be a function that opens it, so that an unreadable one fails this dataset only.
    ``entry``: the landing entry (name, length, epoch), recorded with the commit (:meth:`TableStore.ledger`); one
    without a byte is a failed run, and recorded so that later entries are not held up.
    """
    run_ts = run_ts or dt.datetime.combine(as_of, dt.time())
    spec = get_spec(dataset)
    try:
        if store.cancelled():
            raise Cancelled("cancelled")
        if extract is None:
            report = RunReport(dataset, None, None, None, None, False, "no extract for this run")
        elif entry is not None and not entry[1]:
            report = RunReport(dataset, None, None, None, None, False, f"failed: landing entry {entry[0]} is empty")
            store.publish_all({}, {dataset: entry})
        elif any(store.has_version(t.table, run_id) for t in targets_of(dataset).values()):
            report = RunReport(dataset, None, None, None, None, False, f"run {run_id} was published before; nothing done")
        else:
            report = _run(store, dataset, extract() if callable(extract) else extract, as_of, run_id, run_ts, entry)
    except Exception as e:  # noqa: BLE001 — one dataset must not block the others
        note = "failed: cancelled" if store.cancelled() else f"failed: {type(e).__name__}: {e}"
        report = RunReport(dataset, None, None, None, None, False, note)
        if not store.cancelled():
            traceback.print_exc()
    row = audit_row(spark, spec.name, run_ts, report.rows_read, report.new_rows, report.edited_rows, report.total_rows, report.note)
    tags = spark.sparkContext.getJobTags()
    spark.sparkContext.clearJobTags()  # the audit row is written also while the dataset's jobs are being cancelled
    try:
        store.append(HISTORY_TABLE, row)
    finally:
        for t in tags:
            spark.sparkContext.addJobTag(t)
    return report


def _run(store: TableStore, dataset: str, extract: DataFrame, as_of: dt.date, run_id: str,
         run_ts: dt.datetime, entry: tuple[str, int, int] | None) -> RunReport:
    spec = get_spec(dataset)
    got, notes = ingest_for(store, dataset, extract)
    notes = [f"columns: {', '.join(notes)}"] if notes else []
    newest = store.mark(dataset)
    if entry is not None and newest is not None and entry[2] < newest:
        notes.append(f"landed late: epoch {entry[2]} after {newest}")
    # one pass over the extract: rows, rejects, and footers among the rows that can be read
    ok = F.size(REASONS) == 0
    footer = F.col(f"`{spec.footer_key}`").isNull() if spec.footer_key in got.marked.columns else F.lit(False)
    seen = got.marked.select(ok.alias("ok"), footer.alias("footer")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("ok")).alias("rejected"),
        F.count_if(F.col("ok") & F.col("footer")).alias("footers")).first()
    if seen["rejected"]:
        if seen["rejected"] > MAX_REJECT_SHARE * seen["rows"]:
            raise TooManyRejects(f"{seen['rejected']} of {seen['rows']} rows can't be read")
        quarantine(store, dataset, got.rejects, run_id)
        notes.append(f"{seen['rejected']} rows in quarantine")
    if seen["footers"]:
        notes.append(f"{seen['footers']} footer rows dropped")
    rows_read = seen["rows"] - seen["rejected"] - seen["footers"]
    with_most_rows(got.rows, seen["rows"] - seen["rejected"])
    run_seq = int(run_ts.replace(tzinfo=dt.timezone.utc).timestamp())
    entries = {dataset: entry} if entry is not None else None
    if keyed(store, dataset):
        changed, primary, metrics = _run_keyed(store, dataset, got.rows, run_id, run_seq, entries)
    else:
        changed, primary, metrics = _run_targets(store, dataset, got.rows, as_of, run_id, run_seq, entries)
    if not rows_read:
        notes.insert(0, "no data in period")
    elif not changed:
        notes.insert(0, "no new or edited rows; nothing published")
    return RunReport(dataset, rows_read, primary["new_rows"], primary["edited_rows"], primary["total_rows"],
                     changed, "; ".join(notes), metrics)


def keyed(store: TableStore, dataset: str) -> bool:
    """Whether the dataset's tables are (or, not made yet, will be) in key slices."""
    if get_spec(dataset).flow not in KEYED_FLOWS:
        return False
    made = [c for c in (store.latest_commit(t.table) for t in targets_of(dataset).values()) if c is not None]
    if made:
        return "layout" in (made[0].extra or {})
    return store.spark.conf.get(KEYED_CONF, "false").lower() == "true"


def _run_keyed(store: TableStore, dataset: str, rows: DataFrame, run_id: str, run_seq: int, entries: dict | None) -> tuple[bool, dict, dict]:
    """G-04, G-07, G-08 on key slices: the batch, written once, is merged into both tables; one commit publishes them.

    Rows of the preview that the batch does not hold were merged into the official table by the run that brought them.
    """
    extract, spec = prepare_extract(rows, get_spec(dataset))
    batch = G.commission_batch(extract, spec) if spec.flow == "upsert_with_totals" else S.select_configured(extract, G._keep(spec))
    commits, metrics = {}, {}
    with KT.staged(store, spec.table_prefix, batch, run_id) as batch:
        for name, t in targets_of(dataset).items():
            table = KT.KeyedTable(store, t.table, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col)
            commit, r = table.prepare(batch, run_id, run_seq)
            metrics[name] = {"new_rows": r.new_rows, "edited_rows": r.edited_rows, "total_rows": r.total_rows, "bytes_written": r.bytes_written}
            if commit is not None:
                commits[t.table] = commit
        if commits or entries:
            store.publish_all(commits, entries)
    return bool(commits), metrics["official"], metrics


def totals_of(store: TableStore, dataset: str, target: str = "official") -> DataFrame | None:
    """A-01..A-03: the totals row of a stored table: from its commit (key slices), else the stored totals row."""
    t, spec = targets_of(dataset)[target], get_spec(dataset)
    if keyed(store, dataset):
        return KT.KeyedTable(store, t.table, spec.key).totals()
    rows = store.read(t.table)
    return rows.where(IS_TOTAL) if rows is not None and IS_TOTAL in rows.columns else None


def _run_targets(store: TableStore, dataset: str, rows: DataFrame, as_of: dt.date, run_id: str, run_seq: int,
                 entries: dict | None) -> tuple[bool, dict, dict]:
    """Preview and other targets by the flow's plans; (published?, counts of the primary target, all counts)."""
    spec = get_spec(dataset)
    flow = build_flow(store, dataset, rows, as_of)
    commits, metrics = {}, {}
    commits["preview"], metrics["preview"] = _write_target(
        store, dataset, "preview", flow.preview, run_id, run_seq, spec, as_of)
    written = with_known_rows(store.read_commit(commits["preview"]), commits["preview"].rows)
    for name, df in flow.rest(written).items():
        commits[name], metrics[name] = _write_target(store, dataset, name, df, run_id, run_seq, spec, as_of)
    primary = metrics[flow.primary]
    changed = any(_target_changed(store, targets_of(dataset)[n], commits[n], metrics[n]) for n in commits)
    if changed:
        store.publish_all({targets_of(dataset)[n].table: c for n, c in commits.items()}, entries)
    elif entries:
        store.publish_all({}, entries)
    return changed, primary, metrics


def _write_target(store: TableStore, dataset: str, name: str, df: DataFrame, run_id: str, run_seq: int,
                  spec: DatasetSpec, as_of: dt.date):
    """Stamp, put the table in order, observe the change counts, write a version."""
    t = targets_of(dataset)[name]
    df = with_first_seen(df, run_seq)
    sort = [c for c in t.sort_within if c in df.columns]
    if sort:
        order = [c for c in (t.partition_col,) if c] + sort
        # rows of one run may have equal order columns (an extract without positions): the key splits them into ranges too
        order += [k for k in spec.key if k in df.columns and k not in order]
        whole = sort != list(M.STAMPS) or store.spark.conf.get(ORDER_HISTORY_CONF, "true").lower() != "false"
        df = (df.repartitionByRange(*order) if whole else df).sortWithinPartitions(*order)
    obs = Observation(f"{dataset}_{name}_{run_id}")
    ct = F.col(M.CHANGE)
    out = df.observe(obs, F.count_if(ct == M.NEW).alias("new_rows"),
                     F.count_if(ct == M.EDITED).alias("edited_rows"),
                     F.count_if(ct.isNotNull()).alias("total_rows"),
                     F.count(F.lit(1)).alias("rows_written"))
    out = out.drop(*[c for c in BOOKKEEPING[1:] if c in out.columns])
    # a run-year table is rebuilt whole for its year: an emptied year must not be carried over
    replace = [str(as_of.year)] if t.run_year_only else None
    commit = store.write(t.table, out, run_id, partition_col=t.partition_col, key=list(spec.key),
                         replace_parts=replace)
    metrics = obs.get
    if t.partition_col:
        prev = store.latest_commit(t.table)
        counts = dict(prev.part_rows or {}) if prev is not None and prev.partition_col == t.partition_col else {}
        counts = {k: v for k, v in counts.items() if k in commit.parts}
        rewritten = store.rewritten_parts(commit)
        if len(rewritten) == 1:
            counts[rewritten[0]] = metrics["rows_written"]
        else:
            counts.update(store.count_parts(commit, rewritten))
        commit.part_rows = counts
        commit.rows = sum(counts.values()) if set(counts) == set(commit.parts) else None
    else:
        commit.rows = metrics["rows_written"]
    return commit, metrics


def _target_changed(store: TableStore, t: Target, commit, m: dict) -> bool:
    """S-11: a target changed when a row is new or edited, or when rows left it
    (month purge of a preview, 90-day retention): a row count differs."""
    if m["new_rows"] or m["edited_rows"]:
        return True
    prev = store.latest_commit(t.table)
    if prev is None:
        return m["rows_written"] > 0
    if t.partition_col:
        return (commit.part_rows or {}) != (prev.part_rows or {})
    return commit.rows != prev.rows


def run(spark: SparkSession, store: TableStore, extracts: dict[str, DataFrame | None], as_of: dt.date,
        run_id: str, cadence: str | None = None) -> list[RunReport]:
    """G-10: run several datasets (optionally only one cadence); failures are isolated."""
    reports = []
    for dataset, extract in extracts.items():
        if cadence and get_spec(dataset).cadence != cadence:
            continue
        reports.append(run_dataset(spark, store, dataset, extract, as_of, run_id))
    return reports
