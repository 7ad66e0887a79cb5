"""Registered queries: one per operator of the inventory, over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Inputs come
from :mod:`snapmerge.plans.standins`; all consolidation steps named by a
query run through the library operators.  Bookkeeping columns
(``last_src``/``seen_ord`` …) are dropped unless the query is about order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DoubleType

from ..functions import calendar as CAL
from ..functions import periods as P
from ..functions import scalars as X
from ..operators import audit as AU
from ..operators import filters as FL
from ..operators import merge as M
from ..operators import order as O
from ..operators import routing as R
from ..operators import schema as S
from ..operators import totals as TT
from ..session import checkpoint_root
from ..sources import extract as EX
from ..sources.store import TableStore
from ..streaming import changes as SC
from ..streaming import stream as ST
from ..specs import COMMISSION, CONTRACTS, PORTFOLIO, STORE_ACTIVITY, TARGETS
from . import flows as G
from . import keyed as KT
from . import runner as RN
from . import standins as SI
from .standins import A_EMPTY, A_MID, A_TURN, A_TURN_BD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_COLS = [M.LAST_SRC, M.LAST_ORD, M.SEEN_SRC, M.SEEN_ORD]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Drop order bookkeeping columns."""
    return df.drop(*[c for c in ORDER_COLS if c in df.columns])


def _run_date_union(parts: dict[dt.date, DataFrame]) -> DataFrame:
    out = None
    for as_of, df in parts.items():
        df = df.withColumn("as_of", F.lit(as_of))
        out = df if out is None else out.unionByName(df)
    return out


# ================================================================== contracts: filters
@query
def filter_status(spark, sf):
    """F-01: paid proposals only (equality pushed to the scan)."""
    return FL.filter_equals(SI.contracts(spark, sf), "status", SI.PAID)


@query
def select_configured_columns(spark, sf):
    """P-01: configured keep-list (one configured column is absent and skipped)."""
    keep = ("proposal_id", "report_date", "cancel_reason", "status", "principal", "branch")
    return S.select_configured(SI.contracts(spark, sf), keep)


@query
def filter_current_month(spark, sf):
    """F-02: rows of the run month (range predicate)."""
    return SI.contracts(spark, sf).where(P.in_current_month("report_date", A_MID))


@query
def filter_month_turn_carryover(spark, sf):
    """F-03 at three run dates: mid-month, day 1 (carry-over) and day 1 of the next month."""
    c = SI.contracts(spark, sf)
    return _run_date_union({d: c.where(P.in_month_with_carryover("report_date", d))
                            for d in (A_MID, A_TURN, A_TURN_BD)})


@query
def filter_rolling_90d(spark, sf):
    """F-04: the 90 days up to the run (inclusive, no upper bound)."""
    return SI.contracts(spark, sf).where(P.within_rolling_days("report_date", A_MID))


@query
def source_last_n_days(spark, sf):
    """F-11: the "last 30 days" extract window."""
    return SI.contracts(spark, sf).where(P.in_last_n_days("report_date", A_MID, P.SOURCE_LAST_DAYS))


@query
def purge_stale_preview(spark, sf):
    """F-08: stored preview cut to the run month before merging."""
    return FL.purge_stale_preview(SI.contracts_stored(spark, sf, A_MID), "report_date", A_MID)


@query
def check_expected_period(spark, sf):
    """F-16: how much of the extract falls outside the run month."""
    return FL.check_expected_period(SI.contracts_extract(spark, sf, A_MID), "report_date", A_MID)


@query
def parse_date_dayfirst(spark, sf):
    """X-09: dates rendered as day-first or ISO text (and one junk form) parsed back."""
    c = SI.contracts(spark, sf)
    k = F.col("proposal_id")
    text = (F.when(k % 17 == 0, F.lit("n/a"))
            .when(k % 2 == 0, F.date_format("report_date", "dd/MM/yyyy"))
            .otherwise(F.date_format("report_date", "yyyy-MM-dd")))
    t = c.select("proposal_id", "report_date", text.alias("report_text"))
    return t.select("proposal_id", "report_text",
                    P.parse_date_dayfirst("report_text").alias("parsed_date"),
                    P.parse_date_dayfirst("report_text").eqNullSafe(F.col("report_date")).alias("round_trip"))


@query
def coerce_date_filter(spark, sf):
    """F-10: text dates parsed day-first; unparseable ones are excluded from the month filter."""
    c = SI.contracts(spark, sf)
    k = F.col("proposal_id")
    text = F.when(k % 11 == 0, F.lit("31/02/2001")).otherwise(F.date_format("report_date", "d/M/yyyy"))
    t = FL.with_parsed_date(c.select("proposal_id", text.alias("report_text")), "report_text", "parsed_date")
    return t.where(P.in_current_month("parsed_date", A_MID))


@query
def month_bounds(spark, sf):
    """X-10..X-13: month start, previous month end, carry-over start per run date."""
    d = SI.contracts(spark, sf).select(F.col("report_date").alias("run_date")).distinct()
    return d.select("run_date",
                    F.year("run_date").alias("run_year"), F.month("run_date").alias("run_month"),
                    F.dayofmonth("run_date").alias("run_day"),
                    P.month_start_col("run_date").alias("month_start"),
                    P.previous_month_end_col("run_date").alias("prev_month_end"),
                    P.carryover_start_col("run_date").alias("carryover_start"),
                    F.date_sub("run_date", P.ROLLING_WINDOW_DAYS).alias("rolling_start"))


@query
def scalar_strip(spark, sf):
    """X-01: whitespace/newline strip of text values."""
    c = SI.contracts(spark, sf)
    padded = F.concat(F.lit(" \n\t"), F.col("manager"), F.lit("\n  "))
    return c.select("proposal_id", X.strip_ws(padded).alias("manager_clean"),
                    F.trim(padded).alias("manager_sql_trim"))


@query
def float_tolerant_equality(spark, sf):
    """X-06: stored vs re-delivered amounts, raw and after 6-dp half-even rounding."""
    stored = SI.contracts_stored(spark, sf, A_MID).select("proposal_id", F.col("principal").alias("stored"))
    fresh = SI.contracts(spark, sf).select("proposal_id", F.col("principal").alias("fresh"))
    j = stored.join(fresh, "proposal_id")
    dt_ = stored.schema["stored"].dataType
    return j.select("proposal_id", (F.col("stored") == F.col("fresh")).alias("equal_raw"),
                    X.values_equal(F.col("stored"), F.col("fresh"), dt_).alias("equal_tolerant"))


@query
def null_safe_equality(spark, sf):
    """X-07: null-safe vs plain equality on columns with nulls."""
    a = SI.contracts(spark, sf)
    b = SI.contracts_stored(spark, sf, A_MID).select(
        "proposal_id", F.col("insurance").alias("ins_b"), F.col("branch").alias("branch_b"))
    j = a.join(b, "proposal_id")
    return j.select("proposal_id",
                    (F.col("insurance") == F.col("ins_b")).alias("insurance_eq"),
                    F.col("insurance").eqNullSafe(F.col("ins_b")).alias("insurance_eq_null_safe"),
                    (F.col("branch") == F.col("branch_b")).alias("branch_eq"),
                    F.col("branch").eqNullSafe(F.col("branch_b")).alias("branch_eq_null_safe"))


@query
def composite_key(spark, sf):
    """X-08: rows per composite key (dealer, branch) — null branch is one group."""
    c = SI.contracts(spark, sf)
    return (c.groupBy(F.struct("dealer_id", "branch").alias("k"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.col("k.dealer_id").alias("dealer_id"), F.col("k.branch").alias("branch"), "rows"))


# ================================================================== contracts: merge family
def _contracts_batch(spark, sf, as_of=A_MID):
    return G.contracts_batch(SI.contracts_extract(spark, sf, as_of), as_of)


@query
def union_by_name(spark, sf):
    """U-01: stored rows ∪ a batch that lost ``insurance`` and gained ``channel``."""
    stored = SI.contracts_stored(spark, sf, A_MID)
    batch = _contracts_batch(spark, sf).drop("insurance").withColumn("channel", F.lit("web"))
    return M.union_by_name(stored, batch)


@query
def accumulate(spark, sf):
    """U-02: stored table ∪ batch, keep-last by proposal — nothing removed."""
    return M.accumulate(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf), "proposal_id")


@query
def accumulate_empty_batch(spark, sf):
    """U-03: a run whose extract window holds no rows returns the stored table unchanged."""
    return M.accumulate(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf, A_EMPTY),
                        "proposal_id")


@query
def accumulate_and_classify(spark, sf):
    """U-04: accumulate + new/edited/unchanged label for every row."""
    return M.accumulate_and_classify(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf),
                                     "proposal_id")


@query
def classify_changes(spark, sf):
    """J-01: label each batch row against the stored table."""
    return M.classify_changes(_contracts_batch(spark, sf), SI.contracts_stored(spark, sf, A_MID), "proposal_id")


@query
def count_new_keys(spark, sf):
    """J-02: distinct batch keys absent from the stored table."""
    return M.count_new_keys(_contracts_batch(spark, sf), SI.contracts_stored(spark, sf, A_MID), "proposal_id")


@query
def split_new_edited(spark, sf):
    """J-04: the new and the edited rows of a run (unchanged rows left out)."""
    cl = M.classify_changes(_contracts_batch(spark, sf), SI.contracts_stored(spark, sf, A_MID), "proposal_id")
    parts = M.split_by_change(cl)
    return parts[M.NEW].unionByName(parts[M.EDITED])


@query
def upsert_in_place(spark, sf):
    """J-03: changed rows replaced where they are, unseen keys appended after them."""
    out = M.accumulate_and_classify(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf),
                                    "proposal_id", with_order=True)
    return out.drop(M.LAST_SRC, M.LAST_ORD)


@query
def change_summary(spark, sf):
    """A-10: new / edited / unchanged / total of one merge."""
    return M.change_summary(accumulate_and_classify(spark, sf))


@query
def audit_counts(spark, sf):
    """A-05/A-06: rows read from the extract, rows in the target after the run."""
    extract = SI.contracts_extract(spark, sf, A_MID)
    return AU.audit_counts(extract, contracts_quarter(spark, sf))


@query
def run_audit(spark, sf):
    """A-09: the audit row of the contracts run (plus one for an empty-extract run)."""
    ts = dt.datetime.combine(A_MID, dt.time(6, 0))
    a = AU.run_audit(CONTRACTS.dataset_id, ts, SI.contracts_extract(spark, sf, A_MID), contracts_quarter(spark, sf))
    empty_extract = SI.contracts_extract(spark, sf, A_EMPTY)
    empty_final = M.accumulate_and_classify(SI.contracts_stored(spark, sf, A_MID),
                                            G.contracts_batch(empty_extract, A_EMPTY), "proposal_id")
    b = AU.run_audit(CONTRACTS.dataset_id + "_empty", dt.datetime.combine(A_EMPTY, dt.time(6, 0)),
                     empty_extract, empty_final)
    return a.unionByName(b)


@query
def noop_detection(spark, sf):
    """S-11: the same batch merged twice — the second run has nothing new or edited."""
    batch = _contracts_batch(spark, sf)
    first = M.accumulate(SI.contracts_stored(spark, sf, A_MID), batch, "proposal_id")
    second = M.accumulate_and_classify(first, batch, "proposal_id")
    s = M.change_summary(second)
    return s.withColumn("is_noop", (F.col("new_rows") == 0) & (F.col("edited_rows") == 0))


@query
def first_run_seed(spark, sf):
    """S-09: no stored table yet — every row of the batch is new."""
    return M.accumulate_and_classify(None, _contracts_batch(spark, sf), "proposal_id")


@query
def align_to_existing_schema(spark, sf):
    """P-04: a drifted batch (lost ``insurance``, gained ``channel``) aligned to the stored schema."""
    stored = SI.contracts_stored(spark, sf, A_MID)
    batch = SI.contracts(spark, sf).drop("insurance").withColumn("channel", F.lit("web"))
    return S.align_to_schema(batch, stored.schema)


@query
def dedup_keep_last(spark, sf):
    """W-01: one commission line per contract — the highest line position (ties broken by content)."""
    return M.keep_last(SI.commission(spark, sf), "contract_code", ord_col="ord")


@query
def dedup_keep_last_composite(spark, sf):
    """W-02: one store-activity row per (store, vintage) over stored ∪ extract."""
    u = M.union_by_name(SI.store_activity_stored(spark, sf, A_MID).withColumn("arrival", F.lit(0)),
                        SI.store_activity(spark, sf).withColumn("arrival", F.lit(1)))
    return M.keep_last(u, ["store_id", "vintage"], ord_col="arrival").drop("arrival")


@query
def dedup_null_keys(spark, sf):
    """W-04: keep-last per branch; the null branch is one group."""
    return M.keep_last(SI.contracts(spark, sf), "branch", ord_col="proposal_id")


@query
def dedup_full_row(spark, sf):
    """W-03: whole-row de-duplication when no key is configured."""
    return M.dedup_full_row(SI.contracts(spark, sf).select("dealer_id", "manager", "status", "branch"))


@query
def preview_current_month(spark, sf):
    """U-05: month-scoped preview — both sides cut to the month, merged keep-last."""
    return plain(G.contracts_preview(SI.contracts_extract(spark, sf, A_MID),
                                     SI.contracts_stored(spark, sf, A_MID), A_MID))


@query
def accumulate_rolling_90d(spark, sf):
    """U-06: accumulate, then drop rows older than 90 days."""
    acc = M.accumulate(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf), "proposal_id")
    return acc.where(P.within_rolling_days("report_date", A_MID))


@query
def sort_by_date_stable(spark, sf):
    """O-01: rolling table ordered by date (nulls last), ties in arrival order — with positions."""
    acc = M.accumulate(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf), "proposal_id",
                       with_order=True).where(P.within_rolling_days("report_date", A_MID))
    order = O.stable_sort_keys(["report_date"], M.LAST_SRC, M.LAST_ORD) + [F.col("proposal_id").asc()]
    return plain(O.with_position(acc, order))


@query
def sort_append_order(spark, sf):
    """O-03: existing rows keep their place, new rows follow — positions of the permanent table."""
    acc = M.accumulate(SI.contracts_stored(spark, sf, A_MID), _contracts_batch(spark, sf), "proposal_id",
                       with_order=True)
    order = [F.col(M.SEEN_SRC).asc(), F.col(M.SEEN_ORD).asc(), F.col("proposal_id").asc()]
    return plain(O.with_position(acc, order))


@query
def route_by_run_year(spark, sf):
    """S-08: rolling-table rows with the run's year as their partition column."""
    return plain(contracts_quarter(spark, sf)).select("proposal_id", "report_date", "year")


@query
def contracts_preview(spark, sf):
    """G-01: the month preview of the contracts dataset, classified."""
    return plain(G.contracts_preview(SI.contracts_extract(spark, sf, A_MID),
                                     SI.contracts_stored(spark, sf, A_MID), A_MID))


@query
def contracts_quarter(spark, sf):
    """G-02: extract → paid → columns → month (+carry-over) → preview keep-last →
    merge into the rolling table → 90-day retention → classified, run-year routed."""
    extract = SI.contracts_extract(spark, sf, A_MID)
    stored = SI.contracts_stored(spark, sf, A_MID)
    preview = G.contracts_preview(extract, stored, A_MID)
    return plain(G.contracts_quarter(preview, stored, A_MID))


@query
def contracts_annual(spark, sf):
    """G-03: the preview merged into the permanent table (nothing removed)."""
    extract = SI.contracts_extract(spark, sf, A_MID)
    stored = SI.contracts_stored(spark, sf, A_MID)
    preview = G.contracts_preview(extract, stored, A_MID)
    return plain(G.contracts_annual(preview, stored, A_MID))


# ================================================================== store activity (G-04)
@query
def source_this_month(spark, sf):
    """F-12: vintage equals the run month."""
    return SI.store_activity(spark, sf).where(P.period_is_current("vintage", A_MID))


@query
def store_activity_merge(spark, sf):
    """G-04: extract → preview accumulate → official accumulate, classified."""
    stored = SI.store_activity_stored(spark, sf, A_MID)
    res = G.store_activity_flow(SI.store_activity(spark, sf), stored, stored, A_MID)
    return plain(res.targets["official"])


# ================================================================== targets (G-05)
@query
def row_year(spark, sf):
    """P-10 / X-02: year of each row from the first four characters of its period."""
    return R.with_row_year(SI.targets(spark, sf), "period")


@query
def period_yyyymm(spark, sf):
    """P-09: reference (year, month) and yyyymm of every run date."""
    d = SI.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    return d.select("run_date", F.year("run_date").alias("ref_year"), F.month("run_date").alias("ref_month"),
                    P.period_of("run_date").alias("period"))


@query
def source_short_window(spark, sf):
    """F-14: "this month", or "last 3 days" when the month-turn rule holds — at three run dates."""
    t = SI.targets(spark, sf)
    hol = set(SI.TEST_HOLIDAYS)
    return _run_date_union({d: FL.source_window_period(t, "period", d, hol) for d in (A_MID, A_TURN, A_TURN_BD)})


@query
def route_by_row_year(spark, sf):
    """S-07: accumulated targets with their routing year (partition column)."""
    acc = M.accumulate(SI.targets_stored(spark, sf, A_MID), SI.targets(spark, sf), TARGETS.key)
    return R.with_row_year(acc, "period")


@query
def years_present(spark, sf):
    """A-07 / O-04: distinct years of the targets table and the latest one."""
    return R.years_present(R.with_row_year(SI.targets(spark, sf), "period"))


@query
def targets_by_year(spark, sf):
    """G-05: preview accumulate, then every year present merged into its official table."""
    stored = SI.targets_stored(spark, sf, A_MID)
    res = G.targets_flow(SI.targets(spark, sf), stored, stored, A_MID)
    return plain(res.targets["official"])


@query
def yearly_counts_rollup(spark, sf):
    """A-08: new / edited / total per routed year plus the all-years line."""
    return R.yearly_counts(targets_by_year(spark, sf))


# ================================================================== portfolio (G-06)
@query
def filter_current_period(spark, sf):
    """F-05: integer period equals the run's yyyymm."""
    return SI.portfolio(spark, sf).where(P.period_is_current("period", A_MID))


@query
def source_this_year(spark, sf):
    """F-13: periods of the run year (yyyymm range)."""
    return SI.portfolio(spark, sf).where(P.period_in_this_year("period", A_MID))


@query
def sort_by_period_stable(spark, sf):
    """O-02: accumulated portfolio ordered by period, ties in arrival order — with positions."""
    acc = M.accumulate(SI.portfolio_stored(spark, sf, A_MID), SI.portfolio_extract(spark, sf, A_MID),
                       PORTFOLIO.key, with_order=True)
    order = O.stable_sort_keys(["period"], M.LAST_SRC, M.LAST_ORD) + [F.col("store_tax_id").asc(),
                                                                      F.col("branch").asc()]
    return plain(O.with_position(acc, order))


@query
def reorder_current_then_legacy(spark, sf):
    """P-05: accumulated portfolio with the extract's columns first, legacy ones last."""
    extract = SI.portfolio_extract(spark, sf, A_MID)
    acc = M.accumulate(SI.portfolio_stored(spark, sf, A_MID), extract, PORTFOLIO.key)
    return S.reorder_current_then_legacy(acc, extract.columns)


@query
def portfolio_by_year(spark, sf):
    """G-06: whole extract merged by year into the official tables, classified."""
    stored = SI.portfolio_stored(spark, sf, A_MID)
    res = G.portfolio_flow(SI.portfolio_extract(spark, sf, A_MID), stored, stored, A_MID)
    return plain(res.targets["official"])


@query
def portfolio_preview(spark, sf):
    """G-06 preview: current month only on both sides (F-05, F-08), keep-last, classified."""
    stored = SI.portfolio_stored(spark, sf, A_MID)
    res = G.portfolio_flow(SI.portfolio_extract(spark, sf, A_MID), stored, stored, A_MID)
    return plain(res.targets["preview"])


# ================================================================== commission (G-07, G-08)
def _commission_batch(spark, sf):
    return G.commission_batch(SI.commission_raw_headers(spark, sf, A_TURN))


def _whole_commission_batch(spark, sf):
    return G.commission_batch(SI.commission_raw_headers(spark, sf))


@query
def normalize_headers(spark, sf):
    """P-03: header whitespace/newlines stripped from the downloaded extract."""
    return S.normalize_headers(SI.commission_raw_headers(spark, sf))


@query
def drop_footer_rows(spark, sf):
    """F-06: the report's footer (null contract) removed from the extract."""
    return FL.drop_footer_rows(SI.commission_report(spark, sf), COMMISSION.footer_key)


@query
def split_totals_row(spark, sf):
    """F-07: stored official table split into data rows and its totals row."""
    data, totals = FL.split_totals(SI.commission_stored(spark, sf, A_TURN), COMMISSION.footer_key)
    return data.withColumn("part", F.lit("data")).unionByName(totals.withColumn("part", F.lit("totals")))


@query
def harmonize_types(spark, sf):
    """P-06/P-07: batch columns take the stored table's types (ids stored as text)."""
    stored = SI.commission_stored(spark, sf, A_TURN)
    return S.harmonize_types(_whole_commission_batch(spark, sf), stored.schema)


@query
def number_to_text_id(spark, sf):
    """P-07 / X-04: 14-digit numeric ids and amounts as text without ``.0`` or exponent."""
    c = SI.commission(spark, sf)
    as_double = (F.col("master_tax_id") * 1000000000000 + F.col("contract_code")).cast("double")
    amount_t = c.schema["gross_amount"].dataType
    return c.select("contract_code", "ord",
                    X.number_to_text(as_double, DoubleType()).alias("tax_id_text"),
                    X.number_to_text(F.col("gross_amount"), amount_t).alias("amount_text"))


@query
def nan_to_null(spark, sf):
    """P-08 / X-05: NaN values become SQL null."""
    c = SI.commission(spark, sf)
    raw = F.when(F.col("contract_code") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("rate_pct").cast("double"))
    t = c.select("contract_code", "ord", raw.alias("rate"))
    clean = X.nan_to_null(F.col("rate"), DoubleType())
    return t.select("contract_code", "ord", clean.alias("rate"), clean.isNull().alias("rate_is_null"))


@query
def totals_row(spark, sf):
    """A-01..A-03: totals of the extract's data rows — sum of money, mean of percents."""
    return TT.totals_row(_whole_commission_batch(spark, sf))


@query
def totals_row_refresh(spark, sf):
    """A-04: stored totals dropped, recomputed over the data rows, appended."""
    return TT.refresh_totals(SI.commission_stored(spark, sf, A_TURN), COMMISSION.footer_key)


def _commission_preview(spark, sf):
    return G.commission_preview(_commission_batch(spark, sf),
                                SI.commission_stored(spark, sf, A_TURN, with_totals=False))


@query
def commission_preview(spark, sf):
    """G-07: headers cleaned, footer dropped, aligned, keep-last by key in report order, classified."""
    return plain(_commission_preview(spark, sf))


@query
def commission_official(spark, sf):
    """G-08: in-place update + append into the official table, totals recomputed and appended."""
    off = G.commission_official(_commission_preview(spark, sf), SI.commission_stored(spark, sf, A_TURN))
    return plain(off)


@query
def schema_drift_report(spark, sf):
    """P-02: drifted extract vs the keep-list and vs the stored table, with value counts."""
    batch = (_whole_commission_batch(spark, sf).drop("rate_pct")
             .withColumn("net_amount", (F.col("gross_amount") * 0.9).cast("decimal(18,2)")))
    expected = ("contract_code", "period", "master_tax_id", "corban_tax_id", "gross_amount", "rate_pct")
    stored = SI.commission_stored(spark, sf, A_TURN)
    return S.schema_drift_report(spark, batch, COMMISSION.dataset_id, expected, stored.columns)


# ================================================================== calendar (J-05, D-06, D-07)
def _run_dates(spark, sf):
    return SI.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()


@query
def business_days(spark, sf):
    """J-05: Mon–Fri and not a holiday, for every order date."""
    return CAL.with_business_day(_run_dates(spark, sf), "run_date", SI.holiday_calendar(spark))


@query
def month_turn_rule(spark, sf):
    """D-06: short source window on day 1/2 after a non-business month end — per order date."""
    return CAL.with_month_turn_rule(_run_dates(spark, sf), "run_date", SI.holiday_calendar(spark))


@query
def month_turn_calendar(spark, sf):
    """D-07: the rule for every calendar day spanned by the orders."""
    days = CAL.run_dates_between(SI.table(spark, sf, "orders"), "o_orderdate")
    return CAL.with_month_turn_rule(days, "run_date", SI.holiday_calendar(spark))


# ================================================================== events
@query
def filter_display_type(spark, sf):
    """F-15: equality on the display type (pushed to the scan)."""
    return FL.filter_equals(SI.table(spark, sf, "events"), "event_type", "purchase")


# ================================================================== sources and streaming (S-01, S-02, R-01)
ORDERS_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")
CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query
def read_extract(spark, sf):
    """S-01: the orders file read through a declared schema, with its landing columns
    (file name and run epoch; the file-position column is checked in the tests)."""
    return EX.read_extract(spark, f"{sf.rstrip('/')}/orders.parquet", ORDERS_SCHEMA).drop(EX.ORD)


@query
def read_previous_or_empty(spark, sf):
    """S-02: an existing stored snapshot is read as is; a missing one is an empty frame."""
    base = sf.rstrip("/")
    present = EX.read_or_empty(spark, f"{base}/customer.parquet", CUSTOMER_SCHEMA)
    missing = EX.read_or_empty(spark, f"{base}/customer_preview_not_written_yet.parquet", CUSTOMER_SCHEMA)
    return present.unionByName(missing)


def _lineitem_as_commission(df):
    return df.select(F.col("l_orderkey").alias("contract_code"), P.period_of("l_shipdate").alias("period"),
                     F.col("l_suppkey").alias("master_tax_id"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("gross_amount"),
                     (F.col("l_tax") * 100).cast("decimal(9,4)").alias("rate_pct"),
                     F.col("l_linenumber").alias("ord"))


@query
def stream_accumulate(spark, sf):
    """R-01: an availableNow file stream over the lineitem file, each micro-batch
    accumulated keep-last by (contract, period) into a versioned table in the
    cluster's checkpoint folder; returns the accumulated table."""
    import uuid
    base = sf.rstrip("/")
    work = f"{checkpoint_root(spark)}/stream_accumulate/{uuid.uuid4().hex}"
    store = TableStore(spark, f"{work}/store")
    schema = spark.read.parquet(f"{base}/lineitem.parquet").schema
    q = ST.stream_accumulate(spark, f"{base}/lineitem[.]parquet", schema, store, "commission_stream",
                             list(COMMISSION.key), f"{work}/checkpoint", transform=_lineitem_as_commission,
                             ord_col="ord")
    q.awaitTermination()
    return store.read("commission_stream")


# ================================================================== landing folder (S-03, S-04, X-16)
def _epoch(d: dt.date) -> int:
    return int(dt.datetime.combine(d, dt.time(6, 0), tzinfo=dt.timezone.utc).timestamp())


def _write_landing(spark, sf) -> str:
    """Land three extracts from the driver tables as ``{dataset}_{epoch}.parquet``
    entries (Spark-written folders) in a fresh folder of the checkpoint root."""
    import uuid
    land = f"{checkpoint_root(spark)}/landing/{uuid.uuid4().hex}"
    entries = [("numero_contratos", _epoch(A_TURN), SI.contracts_extract(spark, sf, A_TURN)),
               ("numero_contratos", _epoch(A_MID), SI.contracts_extract(spark, sf, A_MID)),
               ("dias_sem_producao", _epoch(A_MID), SI.store_activity(spark, sf))]
    for dataset, epoch, df in entries:
        df.write.parquet(f"{land}/{dataset}_{epoch}.parquet")
    return land


def _landed_rows(spark, land: str, schema: str = "") -> DataFrame:
    """All landing entries in one read, with their landing columns; the rows carry the columns of ``schema``."""
    return EX.read_extract(spark, f"{land}/*.parquet", T.StructType.fromDDL(schema) if schema else T.StructType([]))


@query
def landing_run_id(spark, sf):
    """S-03 / X-16: every landing entry with its dataset, run epoch (from the name)
    and the rows read from it."""
    land = _write_landing(spark, sf)
    files = EX.landing_files(spark, land).select("file_name", "dataset", "epoch")
    rows = _landed_rows(spark, land).groupBy(F.col(EX.FILE).alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))
    return files.join(rows, "file_name").select("file_name", "dataset", "epoch", "rows")


@query
def latest_extract_per_dataset(spark, sf):
    """S-04: the newest landing entry per requested dataset (none for a dataset
    without an entry), with the rows read from it and their newest date."""
    land = _write_landing(spark, sf)
    latest = EX.latest_extract_per_dataset(EX.landing_files(spark, land),
                                           ["numero_contratos", "dias_sem_producao", "comissao_a_vista"])
    latest = latest.select("dataset", F.element_at(F.split("path", "/"), -1).alias("file_name"), "epoch")
    read = _landed_rows(spark, land, "report_date date, last_contract_date date")
    found = read.groupBy(F.col(EX.FILE).alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.coalesce("report_date", "last_contract_date")).alias("newest"))
    return latest.join(found, "file_name", "left").select("dataset", "file_name", "epoch", "rows", "newest")


# ================================================================== runs through ingest, runner and store
def _fresh_store(spark, name: str) -> TableStore:
    import uuid
    return TableStore(spark, f"{checkpoint_root(spark)}/{name}/{uuid.uuid4().hex}")


def _run(store: TableStore, spec, extract: DataFrame, as_of: dt.date, run_id: str) -> RN.RunReport:
    report = RN.run_dataset(store.spark, store, spec.dataset_id, extract, as_of, run_id)
    if report.note.startswith("failed"):
        raise RuntimeError(report.note)
    return report


@query
def rerun_same_run_id(spark, sf):
    """S-05 / S-11: a second run under a published run id, with a changed extract, leaves the table as it was."""
    store = _fresh_store(spark, "rerun_same_run_id")
    extract = SI.store_activity(spark, sf)
    _run(store, STORE_ACTIVITY, extract, A_MID, "r1")
    _run(store, STORE_ACTIVITY, extract.withColumn("financed_count", F.col("financed_count") + 1), A_MID, "r1")
    return store.read("store_activity_official").drop(*M.STAMPS)


@query
def stream_two_checkpoints(spark, sf):
    """R-01: two streams with checkpoints of their own feed one table; both inputs are kept."""
    base = sf.rstrip("/")
    store = _fresh_store(spark, "stream_two_checkpoints")
    schema = spark.read.parquet(f"{base}/lineitem.parquet").schema
    for k in (0, 1):
        ST.stream_accumulate(
            spark, f"{base}/lineitem[.]parquet", schema, store, "commission_stream", list(COMMISSION.key), f"{store.root}/checkpoint-{k}",
            transform=lambda df, k=k: _lineitem_as_commission(df).where(F.col("contract_code") % 2 == k), ord_col="ord").awaitTermination()
    return store.read("commission_stream")


@query
def ingest_real_headers(spark, sf):
    """P-01 / T-07: the whole contracts report under its own headers, run into an empty store."""
    extract = SI.contracts(spark, sf)
    store = _fresh_store(spark, "ingest_real_headers")
    _run(store, CONTRACTS, extract.toDF(*[CONTRACTS.display_names.get(c, c) for c in extract.columns]), A_MID, "r1")
    return store.read("contracts_quarter").drop("year", *M.STAMPS)


@query
def ingest_text_dates(spark, sf):
    """F-10 / X-09: report dates as day-first text; the rows whose date is no date go to quarantine."""
    text = F.when(F.col("proposal_id") % 20 == 0, F.lit("n/a")).otherwise(F.date_format("report_date", "d/M/yyyy"))
    store = _fresh_store(spark, "ingest_text_dates")
    _run(store, CONTRACTS, SI.contracts(spark, sf).withColumn("report_date", text), A_MID, "r1")
    stored = store.read("contracts_quarter").drop("year", *M.STAMPS)
    rejected = store.read_log("contracts_quarantine", RN.QUARANTINE_SCHEMA).select(
        F.get_json_object("row", "$.proposal_id").cast("long").alias("proposal_id"), F.lit("quarantine").alias("change_type"))
    return stored.unionByName(rejected, allowMissingColumns=True)


@query
def ingest_money_text(spark, sf):
    """F-10 / P-06: formatted amounts (``R$ 1.234,56``) over a stored table read as the amounts they are."""
    extract = SI.commission_raw_headers(spark, sf)
    store = _fresh_store(spark, "ingest_money_text")
    _run(store, COMMISSION, extract, A_TURN, "r1")
    shown = F.concat(F.lit("R$ "), F.translate(F.format_number("gross_amount", 2), ",.", ".,"))
    text = S.normalize_headers(extract).withColumn("gross_amount", (F.col("gross_amount") + 1).cast("decimal(18,2)")).withColumn("gross_amount", shown)
    _run(store, COMMISSION, text, A_TURN, "r2")
    return (store.read("commission_official").where("NOT is_total")
            .select("contract_code", "period", "master_tax_id", F.col("gross_amount").cast("decimal(18,2)").alias("gross_amount"), "change_type"))


@query
def quarantine_null_period(spark, sf):
    """Q-07: rows whose period is missing or no period stay out of the year routing and are counted with their reason."""
    period = (F.when(F.col("period") == 200001, F.lit(None)).when(F.col("period") == 200002, F.lit("bad"))
              .otherwise(F.col("period").cast("string")))
    store = _fresh_store(spark, "quarantine_null_period")
    _run(store, TARGETS, SI.targets(spark, sf).withColumn("period", period), A_MID, "r1")
    stored = store.read("targets_official").groupBy(F.col("year").cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    rejected = (store.read_log("targets_quarantine", RN.QUARANTINE_SCHEMA).select(F.explode("reasons").alias("part"))
                .groupBy("part").agg(F.count(F.lit(1)).alias("rows")))
    return stored.unionByName(rejected)


@query
def stored_table_order(spark, sf):
    """O-01 / O-02: the stored preview's files, in name order, hold its rows in date order."""
    store = _fresh_store(spark, "stored_table_order")
    _run(store, CONTRACTS, SI.contracts(spark, sf), A_MID, "r1")
    rows = store.read("contracts_preview").select("report_date", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    in_file = rows.withColumn("before", F.lag("report_date").over(Window.partitionBy("f").orderBy("i")))
    files = in_file.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("report_date")).alias("bad"),
                                     F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
    after = files.withColumn("prev", F.lag("hi").over(Window.orderBy("f")))  # a row per file
    return after.agg(F.sum("n").alias("rows"), F.sum("bad").alias("out_of_order_in_file"),
                     F.count_if(F.col("prev") > F.col("lo")).alias("out_of_order_between_files"))


# ================================================================== landing ledger and tables in key slices
def _touch(spark, path: str) -> None:
    """An export that broke off: a landing entry without a byte."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where).close()


def _job(spark, name: str, landed: list[list[tuple[int, DataFrame | None]]]) -> TableStore:
    """Store-activity runs of the scheduled job, after each group of entries (epoch, rows; None: an empty file) has landed."""
    import uuid

    from ..job import run_job
    land, store = f"{checkpoint_root(spark)}/{name}/{uuid.uuid4().hex}", _fresh_store(spark, name)
    for i, group in enumerate(landed):
        for epoch, rows in group:
            entry = f"{land}/{STORE_ACTIVITY.dataset_id}_{epoch}.parquet"
            _touch(spark, entry) if rows is None else rows.write.parquet(entry)
        run_job(spark, land, store.root, A_MID, [STORE_ACTIVITY.dataset_id], f"j{i}")
    return store


@query
def landing_empty_entry(spark, sf):
    """S-03 / G-10: an entry without a byte is a failed run with an audit row; the next entry is run."""
    store = _job(spark, "landing_empty_entry", [[(1_000_000_001, None), (1_000_000_002, SI.store_activity(spark, sf))]])
    return store.read_log(RN.HISTORY_TABLE).select("rows_read", "new_rows", "total_rows", "note")


@query
def landing_late_entry(spark, sf):
    """S-04: an entry that lands late, with an older epoch than one already run, is run."""
    rows = SI.store_activity(spark, sf)
    late = rows.withColumn("financed_count", F.col("financed_count") + 1)
    store = _job(spark, "landing_late_entry", [[(1_000_000_005, rows)], [(1_000_000_003, late)]])
    return store.read("store_activity_official").drop(EX.EPOCH, EX.ORD, *M.STAMPS)


def _keyed_contracts(spark, sf, name: str) -> KT.KeyedTable:
    return KT.seed(_fresh_store(spark, name), "contracts", SI.contracts_stored(spark, sf, A_MID), CONTRACTS.key, slices=64, buckets=2)


@query
def keyed_merge(spark, sf):
    """J-03 / U-04: stored contracts in key slices, merged with the month's batch; equal rows stay as stored."""
    t = _keyed_contracts(spark, sf, "keyed_merge")
    t.merge(_contracts_batch(spark, sf), "r1")
    return t.read().drop(*M.STAMPS)


@query
def keyed_bytes_written(spark, sf):
    """J-03: what runs over the whole stored table write: the first one, an edit of the oldest hundredth of the ids, the same again."""
    t = _keyed_contracts(spark, sf, "keyed_bytes_written")
    rows = t.read().drop(M.CHANGE, *M.STAMPS)
    top = rows.agg((F.min("proposal_id") + (F.max("proposal_id") - F.min("proposal_id")) / 100).alias("top")).first().top
    batch = rows.where(F.col("proposal_id") <= top).withColumn("principal", F.col("principal") + 1)
    whole = t.store.bytes_of(t.store.table_path("contracts"))
    batch = t.store.overwrite("batch", batch, "b") and t.store.read("batch")  # the batch must not read what it replaces
    runs = [("edit", t.merge(batch, "r1")), ("again", t.merge(batch, "r2"))]
    return spark.createDataFrame([(n, r.new_rows, r.edited_rows, r.total_rows, r.bytes_written * 10 < whole, r.bytes_written == 0) for n, r in runs],
                                 "run string, new_rows long, edited_rows long, total_rows long, under_a_tenth boolean, wrote_nothing boolean")


@query
def noop_writes_nothing(spark, sf):
    """S-11: a batch that was merged before writes no data file and publishes nothing."""
    t = _keyed_contracts(spark, sf, "noop_writes_nothing")
    t.merge(_contracts_batch(spark, sf), "r1")
    before = len(t.store.versions("contracts"))
    r = t.merge(_contracts_batch(spark, sf), "r2")
    return spark.createDataFrame([(r.new_rows, r.edited_rows, r.total_rows, len(t.store.versions("contracts")) - before, r.bytes_written, r.published)],
                                 "new_rows long, edited_rows long, total_rows long, folders_written long, bytes_written long, published boolean")


@query
def run_keyed_store(spark, sf):
    """G-04 in key slices: a first run and one with changed counts, through ingest, ledger and one commit."""
    rows = SI.store_activity(spark, sf)
    changed = rows.withColumn("financed_count", F.col("financed_count") + F.when(F.col("store_id") % 2 == 0, 1).otherwise(0))
    before = spark.conf.get(RN.KEYED_CONF, None)
    spark.conf.set(RN.KEYED_CONF, "true")
    try:
        store = _fresh_store(spark, "run_keyed_store")
        for i, extract in enumerate((rows, changed, changed)):
            _run(store, STORE_ACTIVITY, extract, A_MID, f"r{i}")
    finally:
        spark.conf.set(RN.KEYED_CONF, before) if before is not None else spark.conf.unset(RN.KEYED_CONF)
    return KT.KeyedTable(store, "store_activity_official", STORE_ACTIVITY.key).read().drop(*M.STAMPS, M.CHANGE)


@query
def stream_keyed(spark, sf):
    """R-01 in key slices: the file stream's micro-batch is merged into the slices its keys touch."""
    base, store = sf.rstrip("/"), _fresh_store(spark, "stream_keyed")
    ST.stream_accumulate(spark, f"{base}/lineitem[.]parquet", spark.read.parquet(f"{base}/lineitem.parquet").schema, store, "commission_stream",
                         list(COMMISSION.key), f"{store.root}/checkpoint", transform=_lineitem_as_commission, ord_col="ord", sliced=True).awaitTermination()
    return KT.KeyedTable(store, "commission_stream", COMMISSION.key).read().drop(*M.STAMPS)


@query
def totals_from_changes(spark, sf):
    """A-01..A-04: the totals row after a merge, from the commit's state and the changed rows only."""
    stored = SI.commission_stored(spark, sf, A_TURN, with_totals=False)
    t = KT.seed(_fresh_store(spark, "totals_from_changes"), "commission", stored, COMMISSION.key, ord_col="ord")
    batch = S.align_to_schema(S.harmonize_types(_commission_batch(spark, sf), stored.schema), stored.schema)
    t.merge(batch, "r1")
    return t.totals()


@query
def stream_changes(spark, sf):
    """R-01 with a state per key: the rows of the line item file that differ from a stored history that ends with 1995 (its last year's
    amounts were other ones): new and edited rows only, from the change log."""
    base, work = sf.rstrip("/"), _fresh_store(spark, "stream_changes").root
    file = spark.read.parquet(f"{base}/lineitem.parquet")
    history = M.keep_last(_lineitem_as_commission(file), list(COMMISSION.key), ord_col="ord").where(F.col("period") < 199601)
    history = history.withColumn("gross_amount", F.when(F.col("period") > 199500, F.col("gross_amount") + 1).otherwise(F.col("gross_amount")).cast("decimal(18,2)"))
    SC.change_stream(spark, f"{base}/lineitem[.]parquet", file.schema, list(COMMISSION.key), f"{work}/log", f"{work}/checkpoint",
                     transform=_lineitem_as_commission, ord_col="ord", initial=history).awaitTermination()
    return spark.read.parquet(f"{work}/log")


@query
def job_side_by_side(spark, sf):
    """G-10: the five datasets run at once from one landing folder; what each run counted, from the audit log."""
    import uuid

    from ..job import run_job
    land, store = f"{checkpoint_root(spark)}/job_side_by_side/{uuid.uuid4().hex}", _fresh_store(spark, "job_side_by_side")
    extracts = [(CONTRACTS, SI.contracts_extract(spark, sf, A_MID)), (STORE_ACTIVITY, SI.store_activity(spark, sf)), (TARGETS, SI.targets(spark, sf)),
                (PORTFOLIO, SI.portfolio_extract(spark, sf, A_MID)), (COMMISSION, SI.commission_extract(spark, sf, A_TURN))]
    for spec, rows in extracts:
        rows.write.parquet(f"{land}/{spec.dataset_id}_1000000001.parquet")
    run_job(spark, land, store.root, A_MID, [spec.dataset_id for spec, _ in extracts], "j1", at_once=len(extracts))
    return store.read_log(RN.HISTORY_TABLE).select("dataset", "rows_read", "new_rows", "total_rows", "note")
