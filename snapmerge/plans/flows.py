"""Dataset flows (G-01..G-08) as pure DataFrame → DataFrame compositions.

Each flow takes the run's extract, the stored snapshots it merges into, and
``as_of``; it returns lazy DataFrames (nothing is collected).  The runner in
:mod:`snapmerge.plans.runner` reads the stored tables, calls a flow, writes
every target in one job each and appends the audit row.

Row order is carried, not imposed: outputs keep ``last_src/last_ord`` (keep-last
order) or ``seen_src/seen_ord`` (append order) so the writer can sort with a
range-partitioned ``orderBy`` (O-01..O-03) only where a sorted layout is wanted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import periods as P
from ..operators import filters as FL
from ..operators import merge as M
from ..operators import schema as S
from ..operators import totals as TT
from ..operators.routing import with_row_year, with_run_year
from ..operators.sizing import known_rows, most_rows, with_known_rows, with_most_rows
from ..specs import COMMISSION, CONTRACTS, PORTFOLIO, STORE_ACTIVITY, TARGETS, DatasetSpec


@dataclass
class FlowResult:
    """Targets of one run, plus the extract for the audit counts.

    ``rest`` builds the targets that follow from the preview; the runner calls
    it once, on the preview's written files.
    """
    extract: DataFrame
    preview: DataFrame
    rest: Callable[[DataFrame], dict[str, DataFrame]]
    primary: str

    @property
    def targets(self) -> dict[str, DataFrame]:
        """All targets in one lazy plan, built on the unwritten preview."""
        return {"preview": self.preview, **self.rest(self.preview)}


# ------------------------------------------------------------------ contracts (G-01..G-03)
def contracts_batch(extract: DataFrame, as_of: dt.date, spec: DatasetSpec = CONTRACTS) -> DataFrame:
    """F-01 → P-01 → F-03: paid rows, configured columns, current month (+ carry-over)."""
    col, value = spec.status_filter
    paid = FL.filter_equals(extract, col, value)
    kept = S.select_configured(paid, _keep(spec))
    return with_most_rows(kept.where(P.in_month_with_carryover(spec.date_col, as_of)), most_rows(extract))


def contracts_preview(extract: DataFrame, stored_preview: DataFrame | None, as_of: dt.date,
                      spec: DatasetSpec = CONTRACTS, prev_unique: bool = False) -> DataFrame:
    """G-01: purge the stored preview to the month (F-08), merge the batch
    keep-last by key (U-05), classify against the purged preview (Q-13)."""
    batch = contracts_batch(extract, as_of, spec)
    prev = FL.purge_stale_preview(stored_preview, spec.date_col, as_of) if stored_preview is not None else None
    return M.accumulate_and_classify(prev, batch, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col, with_order=True,
                                     prev_unique=prev_unique)


def contracts_quarter(preview: DataFrame, stored_quarter: DataFrame | None, as_of: dt.date,
                      spec: DatasetSpec = CONTRACTS, prev_unique: bool = False) -> DataFrame:
    """G-02: merge the preview into the rolling table (U-02), keep 90 days (F-04),
    classify against the stored table (J-01), route by run year (S-08)."""
    merged = M.accumulate_and_classify(stored_quarter, _data_only(preview), spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
                                       with_order=True, prev_unique=prev_unique, batch_unique=True)
    return with_run_year(merged.where(P.within_rolling_days(spec.date_col, as_of)), as_of)


def contracts_annual(preview: DataFrame, stored_annual: DataFrame | None, as_of: dt.date,
                     spec: DatasetSpec = CONTRACTS, prev_unique: bool = False) -> DataFrame:
    """G-03: merge the preview into the permanent table — nothing ever leaves it."""
    merged = M.accumulate_and_classify(stored_annual, _data_only(preview), spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
                                       with_order=True, prev_unique=prev_unique, batch_unique=True)
    return with_run_year(merged, as_of)


def _keep(spec: DatasetSpec) -> tuple[str, ...]:
    """Configured columns plus the extract's order columns, when the spec has them."""
    keep = tuple(spec.keep_columns)
    extra = tuple(c for c in (spec.seq_col, spec.ord_col) if c and c not in keep)
    return keep + extra


def _data_only(df: DataFrame) -> DataFrame:
    """A flow output as the next target's input: labels, order columns, the
    routing column and the previous target's first-seen stamps removed."""
    drop = [c for c in (M.CHANGE, M.LAST_SRC, M.LAST_ORD, M.SEEN_SRC, M.SEEN_ORD, "year", *M.STAMPS)
            if c in df.columns]
    return with_known_rows(df.drop(*drop), known_rows(df))


def contracts_flow(extract: DataFrame, stored_preview, stored_quarter, stored_annual,
                   as_of: dt.date, prev_unique: bool = False, spec: DatasetSpec = CONTRACTS) -> FlowResult:
    """G-01..G-03."""
    preview = contracts_preview(extract, stored_preview, as_of, spec, prev_unique=prev_unique)
    return FlowResult(extract, preview, lambda p: {
        "quarter": contracts_quarter(p, stored_quarter, as_of, spec, prev_unique=prev_unique),
        "annual": contracts_annual(p, stored_annual, as_of, spec, prev_unique=prev_unique),
    }, primary="quarter")


# ------------------------------------------------------------------ store activity (G-04)
def store_activity_flow(extract: DataFrame, stored_preview, stored_official, as_of: dt.date,
                        spec: DatasetSpec = STORE_ACTIVITY, prev_unique: bool = False) -> FlowResult:
    """G-04: configured columns → accumulate the preview → accumulate the official table."""
    batch = with_most_rows(S.select_configured(extract, _keep(spec)), most_rows(extract))
    preview = M.accumulate_and_classify(stored_preview, batch, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
                                        with_order=True, prev_unique=prev_unique)

    def rest(p: DataFrame) -> dict[str, DataFrame]:
        return {"official": M.accumulate_and_classify(
            stored_official, _data_only(p), spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
            with_order=True, prev_unique=prev_unique, batch_unique=True)}

    return FlowResult(extract, preview, rest, primary="official")


# ------------------------------------------------------------------ targets (G-05)
def targets_flow(extract: DataFrame, stored_preview, stored_official, as_of: dt.date,
                 spec: DatasetSpec = TARGETS, prev_unique: bool = False) -> FlowResult:
    """G-05: accumulate the preview, then merge every year present in it into
    that year's official table (routing by the row's own year)."""
    batch = with_most_rows(S.select_configured(extract, _keep(spec)), most_rows(extract))
    preview = M.accumulate_and_classify(stored_preview, batch, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
                                        with_order=True, prev_unique=prev_unique)
    return FlowResult(extract, preview,
                      lambda p: {"official": targets_official(p, stored_official, spec, prev_unique)}, primary="official")


def targets_official(preview: DataFrame, stored_official: DataFrame | None, spec: DatasetSpec = TARGETS,
                     prev_unique: bool = False) -> DataFrame:
    """Year routing is a partition column: the key already contains the period,
    so merging all years at once equals merging each year's table separately.
    Only stored years present in the preview are part of the output (the
    others stay untouched under dynamic partition overwrite)."""
    rows = with_row_year(_data_only(preview), spec.period_col)
    prev = with_row_year(stored_official, spec.period_col) if stored_official is not None else None
    if prev is not None:
        # distinct routing years: at most 10^4 four-digit values, whatever the data size
        years = rows.select("year").distinct()
        prev = prev.join(F.broadcast(years), "year", "left_semi")
    return M.accumulate_and_classify(prev, rows, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col, with_order=True,
                                     prev_unique=prev_unique, batch_unique=True)


# ------------------------------------------------------------------ portfolio (G-06)
def portfolio_flow(extract: DataFrame, stored_preview, stored_official, as_of: dt.date,
                   spec: DatasetSpec = PORTFOLIO, prev_unique: bool = False) -> FlowResult:
    """G-06: the preview holds the current month only (F-05 on both sides);
    every year present in the *whole* extract is merged into its official
    table, with the extract's column order first and legacy columns last."""
    current = with_most_rows(extract.where(P.period_is_current(spec.period_col, as_of)), most_rows(extract))
    prev_preview = (FL.purge_stale_period(stored_preview, spec.period_col, as_of)
                    if stored_preview is not None else None)
    preview = M.accumulate_and_classify(prev_preview, current, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col,
                                        with_order=True, prev_unique=prev_unique)
    return FlowResult(extract, preview,
                      lambda p: {"official": portfolio_official(extract, stored_official, spec, prev_unique)},
                      primary="official")


def portfolio_official(extract: DataFrame, stored_official: DataFrame | None,
                       spec: DatasetSpec = PORTFOLIO, prev_unique: bool = False) -> DataFrame:
    rows = with_most_rows(with_row_year(extract, spec.period_col), most_rows(extract))
    prev = with_row_year(stored_official, spec.period_col) if stored_official is not None else None
    if prev is not None:
        # distinct routing years: at most 10^4 four-digit values, whatever the data size
        years = rows.select("year").distinct()
        prev = prev.join(F.broadcast(years), "year", "left_semi")
    merged = M.accumulate_and_classify(prev, rows, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col, with_order=True,
                                       prev_unique=prev_unique)
    return S.reorder_current_then_legacy(merged, extract.columns)


# ------------------------------------------------------------------ commission (G-07, G-08)
def commission_batch(raw_extract: DataFrame, spec: DatasetSpec = COMMISSION) -> DataFrame:
    """P-03 → F-06: clean headers, drop the report footer."""
    return with_most_rows(FL.drop_footer_rows(S.normalize_headers(raw_extract), spec.footer_key), most_rows(raw_extract))


def commission_flow(raw_extract: DataFrame, stored_preview: DataFrame | None, stored_official: DataFrame | None,
                    spec: DatasetSpec = COMMISSION, prev_unique: bool = False) -> FlowResult:
    """G-07 and G-08."""
    batch = commission_batch(raw_extract, spec)
    preview = commission_preview(batch, stored_preview, spec, prev_unique)
    return FlowResult(batch, preview,
                      lambda p: {"official": commission_official(p, stored_official, spec, prev_unique)}, primary="official")


def commission_preview(batch: DataFrame, stored_preview: DataFrame | None,
                       spec: DatasetSpec = COMMISSION, prev_unique: bool = False) -> DataFrame:
    """G-07: align the batch to the stored preview (P-04), keep-last by key with
    the report position as order (W-02), classify (J-01)."""
    if stored_preview is not None:
        aligned = S.align_to_schema(S.harmonize_types(batch, stored_preview.schema), stored_preview.schema)
        batch = with_most_rows(aligned, most_rows(batch))
    return M.accumulate_and_classify(stored_preview, batch, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col, with_order=True,
                                     prev_unique=prev_unique)


def commission_official(preview: DataFrame, stored_official: DataFrame | None,
                        spec: DatasetSpec = COMMISSION, prev_unique: bool = False,
                        keep_absent: bool = False) -> DataFrame:
    """G-08: drop the stored totals row (F-07), give the preview the stored
    types (P-06/P-07) and columns (P-04), update changed rows in place and
    append unseen keys (J-03), then append a recomputed totals row (A-04).

    Rows carry ``seen_src/seen_ord`` — existing rows keep their place, new rows
    follow in report order (O-03); the totals row sorts last (``is_total``).
    A column the preview no longer carries becomes null, as the reference's
    re-alignment does (Q-06); ``keep_absent=True`` keeps the stored value instead.
    """
    data = _data_only(preview)
    absent: list[str] = []
    if stored_official is not None:
        labels = [c for c in (M.CHANGE,) if c in stored_official.columns]
        stored_data, _ = FL.split_totals(stored_official.drop(*labels), spec.footer_key)
        if TT.IS_TOTAL in stored_data.columns:
            stored_data = stored_data.drop(TT.IS_TOTAL)
        if keep_absent:
            absent = [c for c in stored_data.columns
                      if c not in data.columns and c not in spec.key and c not in M.STAMPS]
        target = T.StructType([f for f in stored_data.schema.fields if f.name not in M.STAMPS])
        data = with_known_rows(S.align_to_schema(S.harmonize_types(data, target), target), known_rows(data))
    else:
        stored_data = None
    merged = M.accumulate_and_classify(stored_data, data, spec.key, ord_col=spec.ord_col, seq_col=spec.seq_col, with_order=True,
                                       prev_unique=prev_unique, keep_from_prev=absent, batch_unique=True)
    return with_totals_and_order(merged)


def with_totals_and_order(merged: DataFrame) -> DataFrame:
    """A-04 over the merged rows; bookkeeping columns are left out of the sums.

    The totals branch filters on ``seen_src`` (derived from the previous-row
    aggregate, never null for a merged row).  That keeps the totals branch's
    plan below the shuffle identical to the rows branch, so Spark reuses the
    merge's exchange instead of running the merge a second time.
    """
    meta = [M.CHANGE, M.LAST_SRC, M.LAST_ORD, M.SEEN_SRC, M.SEEN_ORD, *M.STAMPS]
    data_cols = [c for c in merged.columns if c not in meta]
    basis = merged.where(F.col(M.SEEN_SRC).isNotNull()) if M.SEEN_SRC in merged.columns else merged
    tot = TT.totals_row(basis.select(*data_cols))
    types = dict(tot.dtypes)
    rows = merged.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in merged.columns]
                         ).withColumn(TT.IS_TOTAL, F.lit(False))
    return rows.unionByName(tot, allowMissingColumns=True)
