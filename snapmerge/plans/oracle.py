"""DuckDB SQL for every registered query (the driver's correctness oracle).

The SQL is written independently of the Spark code: stand-ins as CTEs over
the pre-registered views, keep-last as ``row_number()``, classification as a
left join on ``IS NOT DISTINCT FROM``, float tolerance as ``round_even(x, 6)``.
Column names and types mirror the Spark output exactly.
"""

from __future__ import annotations

import datetime as dt

from .standins import A_EMPTY, A_MID, A_TURN, A_TURN_BD, PAID, TEST_HOLIDAYS, UNSEEN_DAYS

ORACLE: dict[str, str] = {}


def d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def ym(x: dt.date) -> int:
    return x.year * 100 + x.month


def month_start(x: dt.date) -> dt.date:
    return x.replace(day=1)


def next_month(x: dt.date) -> dt.date:
    return dt.date(x.year + (x.month == 12), x.month % 12 + 1, 1)


def carry_start(x: dt.date) -> dt.date:
    return month_start(x) - dt.timedelta(days=3) if x.day == 1 else month_start(x)


# ------------------------------------------------------------------ stand-ins
CONTRACT_COLS = ["proposal_id", "report_date", "dealer_id", "manager", "status", "contract_code",
                 "principal", "financed", "insurance", "branch"]
CONTRACT_FLOAT = {"principal", "financed", "insurance"}

CONTRACTS = """contracts as (
  select o_orderkey as proposal_id, cast(o_orderdate as date) as report_date,
         o_custkey as dealer_id, o_orderpriority as manager, case when o_orderstatus = 'F' then 'PROPOSTA PAGA' else o_orderstatus end as status,
         o_orderkey * 10 as contract_code, o_totalprice as principal, o_totalprice * 2 as financed,
         case when o_orderkey % 5 = 0 then null else o_totalprice / 4 end as insurance,
         case when o_orderkey % 13 = 0 then null else n_name end as branch
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def extract_cte(as_of: dt.date, name: str = "extract") -> str:
    return f"""{name} as (select * from contracts
  where report_date >= {d(as_of)} - 29 and report_date <= {d(as_of)})"""


def stored_cte(as_of: dt.date, name: str = "stored") -> str:
    cut = as_of - dt.timedelta(days=UNSEEN_DAYS)
    return f"""{name} as (
  select proposal_id, report_date, dealer_id, manager, status, contract_code,
         case when proposal_id % 7 = 0 then principal - 100
              when proposal_id % 3 = 0 then principal + 1e-8 else principal end as principal,
         financed, insurance, branch
  from contracts where status = '{PAID}' and report_date < {d(cut)})"""


def batch_cte(as_of: dt.date, src: str = "extract", name: str = "batch") -> str:
    cols = ", ".join(CONTRACT_COLS)
    return f"""{name} as (select {cols} from {src}
  where status = '{PAID}' and report_date >= {d(carry_start(as_of))} and report_date < {d(next_month(as_of))})"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ generic merge SQL
def keep_last_cte(name: str, src_sql: str, keys: list[str], order: str = "src desc, _o desc") -> str:
    k = ", ".join(keys)
    return f"""{name} as (select * exclude (rn) from (
  select *, row_number() over (partition by {k} order by {order}) as rn from ({src_sql})) where rn = 1)"""


def equal_expr(cols: list[str], floats: set[str], a: str = "l", b: str = "p") -> str:
    parts = []
    for c in cols:
        if c in floats:
            parts.append(f"round_even({a}.{c}, 6) is not distinct from round_even({b}.{c}, 6)")
        else:
            parts.append(f"{a}.{c} is not distinct from {b}.{c}")
    return " and ".join(parts) if parts else "true"


def merge_ctes(prev: str, batch: str, keys: list[str], cols: list[str], ord_col: str | None = None,
               prefix: str = "m", tiebreak: tuple[str, ...] = ()) -> list[str]:
    """CTEs ``{prefix}_last`` (keep-last rows + src/ord) and ``{prefix}_prev`` (last previous row).

    ``tiebreak``: value columns, in table order, that decide between rows with
    equal (src, ord) — larger wins, null smallest.
    """
    o = ord_col if ord_col else "0"
    order = "src desc, _o desc" + "".join(f", {c} desc nulls last" for c in tiebreak)
    u = (f"select *, 0 as src, {o} as _o from {prev} "
         f"union all by name select *, 1 as src, {o} as _o from {batch}")
    return [
        keep_last_cte(f"{prefix}_last", u, keys, order),
        keep_last_cte(f"{prefix}_prev", f"select *, 0 as src, {o} as _o, true as present from {prev}", keys, order),
    ]


def classified_select(keys: list[str], cols: list[str], floats: set[str], prefix: str = "m",
                      exclude_compare: tuple[str, ...] = (), extra: str = "") -> str:
    on = " and ".join(f"l.{k} is not distinct from p.{k}" for k in keys)
    cmp_cols = [c for c in cols if c not in keys and c not in exclude_compare]
    eq = equal_expr(cmp_cols, floats)
    sel = ", ".join(f"l.{c}" for c in cols)
    return (f"select {sel}, case when p.present is null then 'new' when {eq} then 'unchanged' "
            f"else 'edited' end as change_type{extra}\n"
            f"from {prefix}_last l left join {prefix}_prev p on {on}")


def reg(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ================================================================== contracts: filters
reg("filter_status", with_(CONTRACTS) + f"select * from contracts where status = '{PAID}'")
reg("select_configured_columns", with_(CONTRACTS) +
    "select proposal_id, report_date, status, principal, branch from contracts")
reg("filter_current_month", with_(CONTRACTS) +
    f"select * from contracts where report_date >= {d(month_start(A_MID))} and report_date < {d(next_month(A_MID))}")
reg("filter_month_turn_carryover", with_(CONTRACTS) + "\nunion all\n".join(
    f"select *, {d(x)} as as_of from contracts where report_date >= {d(carry_start(x))} "
    f"and report_date < {d(next_month(x))}" for x in (A_MID, A_TURN, A_TURN_BD)))
reg("filter_rolling_90d", with_(CONTRACTS) + f"select * from contracts where report_date >= {d(A_MID)} - 90")
reg("source_last_n_days", with_(CONTRACTS) +
    f"select * from contracts where report_date between {d(A_MID)} - 29 and {d(A_MID)}")
reg("purge_stale_preview", with_(CONTRACTS, stored_cte(A_MID)) +
    f"select * from stored where report_date >= {d(carry_start(A_MID))} and report_date < {d(next_month(A_MID))}")
reg("check_expected_period", with_(CONTRACTS, extract_cte(A_MID)) + f"""select count(*) as rows_read,
  count(*) filter (where not (report_date >= {d(month_start(A_MID))} and report_date < {d(next_month(A_MID))})
                   or report_date is null) as rows_outside_period,
  min(report_date) as min_date, max(report_date) as max_date from extract""")
reg("parse_date_dayfirst", with_(CONTRACTS) + """select proposal_id, report_text,
  coalesce(try_strptime(report_text, '%d/%m/%Y'), try_strptime(report_text, '%Y-%m-%d'))::date as parsed_date,
  coalesce(try_strptime(report_text, '%d/%m/%Y'), try_strptime(report_text, '%Y-%m-%d'))::date
    is not distinct from report_date as round_trip
from (select proposal_id, report_date,
        case when proposal_id % 17 = 0 then 'n/a'
             when proposal_id % 2 = 0 then strftime(report_date, '%d/%m/%Y')
             else strftime(report_date, '%Y-%m-%d') end as report_text from contracts)""")
reg("coerce_date_filter", with_(CONTRACTS) + f"""select * from (
  select proposal_id, report_text, try_strptime(report_text, '%d/%m/%Y')::date as parsed_date from (
    select proposal_id, case when proposal_id % 11 = 0 then '31/02/2001'
      else strftime(report_date, '%-d/%-m/%Y') end as report_text from contracts))
where parsed_date >= {d(month_start(A_MID))} and parsed_date < {d(next_month(A_MID))}""")
reg("month_bounds", with_(CONTRACTS) + """select run_date, year(run_date)::int as run_year,
  month(run_date)::int as run_month, day(run_date)::int as run_day,
  date_trunc('month', run_date)::date as month_start,
  (date_trunc('month', run_date)::date - 1) as prev_month_end,
  case when day(run_date) = 1 then date_trunc('month', run_date)::date - 3
       else date_trunc('month', run_date)::date end as carryover_start,
  run_date - 90 as rolling_start
from (select distinct report_date as run_date from contracts)""")
reg("scalar_strip", with_(CONTRACTS) + """select proposal_id,
  regexp_replace(' ' || chr(10) || chr(9) || manager || chr(10) || '  ', '^\\s+|\\s+$', '', 'g') as manager_clean,
  trim(' ' || chr(10) || chr(9) || manager || chr(10) || '  ') as manager_sql_trim from contracts""")
reg("float_tolerant_equality", with_(CONTRACTS, stored_cte(A_MID)) + """select s.proposal_id,
  s.principal = c.principal as equal_raw,
  round_even(s.principal, 6) is not distinct from round_even(c.principal, 6) as equal_tolerant
from stored s join contracts c on s.proposal_id = c.proposal_id""")
reg("null_safe_equality", with_(CONTRACTS, stored_cte(A_MID)) + """select c.proposal_id,
  c.insurance = s.insurance as insurance_eq, c.insurance is not distinct from s.insurance as insurance_eq_null_safe,
  c.branch = s.branch as branch_eq, c.branch is not distinct from s.branch as branch_eq_null_safe
from contracts c join stored s on c.proposal_id = s.proposal_id""")
reg("composite_key", with_(CONTRACTS) +
    "select dealer_id, branch, count(*) as rows from contracts group by dealer_id, branch")

# ================================================================== contracts: merge family
_MERGE_BASE = [CONTRACTS, extract_cte(A_MID), stored_cte(A_MID), batch_cte(A_MID)]
_K = ["proposal_id"]
_COLS = ", ".join(CONTRACT_COLS)


def _accumulate_sql(prev: str = "stored", batch: str = "batch", prefix: str = "m") -> list[str]:
    return merge_ctes(prev, batch, _K, CONTRACT_COLS, prefix=prefix)


reg("union_by_name", with_(*_MERGE_BASE) + f"""select {_COLS}, null::varchar as channel from stored
union all by name
select proposal_id, report_date, dealer_id, manager, status, contract_code, principal, financed,
       null::double as insurance, branch, 'web' as channel from batch""")
reg("accumulate", with_(*_MERGE_BASE, *_accumulate_sql()) + f"select {_COLS} from m_last")
reg("accumulate_empty_batch", with_(CONTRACTS, stored_cte(A_MID), extract_cte(A_EMPTY),
                                    batch_cte(A_EMPTY), *_accumulate_sql()) + f"select {_COLS} from m_last")
reg("accumulate_and_classify", with_(*_MERGE_BASE, *_accumulate_sql()) +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT))
reg("classify_changes", with_(*_MERGE_BASE, *_accumulate_sql()) +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT) + " where l.src = 1")
reg("count_new_keys", with_(*_MERGE_BASE) + """select count(*) as new_keys from (
  select distinct proposal_id from batch) b
where not exists (select 1 from stored s where s.proposal_id is not distinct from b.proposal_id)""")
reg("split_new_edited", with_(*_MERGE_BASE, *_accumulate_sql()) + "select * from (" +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT) + " where l.src = 1) where change_type in ('new', 'edited')")
reg("upsert_in_place", with_(*_MERGE_BASE, *_accumulate_sql()) +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT,
                      extra=", coalesce(p.src, l.src) as seen_src, cast(coalesce(p._o, l._o) as bigint) as seen_ord"))
reg("change_summary", with_(*_MERGE_BASE, *_accumulate_sql(), "c as (" +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT) + ")") + """select
  count(*) filter (where change_type = 'new') as new_rows,
  count(*) filter (where change_type = 'edited') as edited_rows,
  count(*) filter (where change_type = 'unchanged') as unchanged_rows, count(*) as total_rows from c""")


def _quarter_ctes(as_of: dt.date = A_MID) -> list[str]:
    """Preview (purged stored ∪ batch, keep-last) merged into the stored rolling table."""
    purged = (f"purged as (select * from stored where report_date >= {d(carry_start(as_of))} "
              f"and report_date < {d(next_month(as_of))})")
    return [purged, *merge_ctes("purged", "batch", _K, CONTRACT_COLS, prefix="pv"),
            "preview as (select " + _COLS + " from pv_last)",
            *merge_ctes("stored", "preview", _K, CONTRACT_COLS, prefix="q")]


_QUARTER = with_(*_MERGE_BASE, *_quarter_ctes()) + "select * from (" + classified_select(
    _K, CONTRACT_COLS, CONTRACT_FLOAT, prefix="q", extra=f", {A_MID.year} as year") + \
    f") where report_date >= {d(A_MID)} - 90"
reg("contracts_quarter", _QUARTER)
reg("route_by_run_year", f"select proposal_id, report_date, year from ({_QUARTER})")
reg("contracts_annual", with_(*_MERGE_BASE, *_quarter_ctes()) + classified_select(
    _K, CONTRACT_COLS, CONTRACT_FLOAT, prefix="q", extra=f", {A_MID.year} as year"))
reg("contracts_preview", with_(*_MERGE_BASE, *_quarter_ctes()) +
    classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT, prefix="pv"))
reg("preview_current_month", ORACLE["contracts_preview"])
reg("audit_counts", f"""select (select count(*) from ({with_(CONTRACTS, extract_cte(A_MID))} select * from extract)) as rows_read,
  count(*) filter (where change_type = 'new') as new_rows,
  count(*) filter (where change_type = 'edited') as edited_rows, count(*) as total_rows
from ({_QUARTER})""")


def _audit(dataset: str, ts: str, extract_sql: str, final_sql: str) -> str:
    return f"""select timestamp '{ts}' as run_ts, '{dataset}' as dataset, r.rows_read, f.new_rows, f.edited_rows,
  f.total_rows, case when r.rows_read = 0 then 'no data in period' else '' end as note,
  coalesce(r.rows_read, 0) = 0 as no_data
from (select count(*) as rows_read from ({extract_sql})) r,
     (select count(*) filter (where change_type = 'new') as new_rows,
             count(*) filter (where change_type = 'edited') as edited_rows, count(*) as total_rows
      from ({final_sql})) f"""


_EMPTY_FINAL = with_(CONTRACTS, stored_cte(A_MID), extract_cte(A_EMPTY), batch_cte(A_EMPTY),
                     *_accumulate_sql()) + classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT)
reg("run_audit", _audit("numero_contratos", f"{A_MID} 06:00:00",
                        with_(CONTRACTS, extract_cte(A_MID)) + "select * from extract", _QUARTER)
    + "\nunion all\n" +
    _audit("numero_contratos_empty", f"{A_EMPTY} 06:00:00",
           with_(CONTRACTS, extract_cte(A_EMPTY)) + "select * from extract", _EMPTY_FINAL))
reg("noop_detection", with_(*_MERGE_BASE, *_accumulate_sql(), f"first_run as (select {_COLS} from m_last)",
                            *merge_ctes("first_run", "batch", _K, CONTRACT_COLS, prefix="n2"),
                            "c as (" + classified_select(_K, CONTRACT_COLS, CONTRACT_FLOAT, prefix="n2") + ")") +
    """select count(*) filter (where change_type = 'new') as new_rows,
  count(*) filter (where change_type = 'edited') as edited_rows,
  count(*) filter (where change_type = 'unchanged') as unchanged_rows, count(*) as total_rows,
  count(*) filter (where change_type = 'new') = 0 and count(*) filter (where change_type = 'edited') = 0 as is_noop
from c""")
reg("first_run_seed", with_(*_MERGE_BASE) + f"select {_COLS}, 'new' as change_type from batch")
reg("align_to_existing_schema", with_(CONTRACTS) + """select proposal_id, report_date, dealer_id, manager, status,
  contract_code, principal, financed, null::double as insurance, branch from contracts""")
reg("dedup_null_keys", with_(CONTRACTS) + """select * exclude (rn) from (
  select *, row_number() over (partition by branch order by proposal_id desc) as rn from contracts) where rn = 1""")
reg("dedup_full_row", with_(CONTRACTS) + "select distinct dealer_id, manager, status, branch from contracts")
reg("accumulate_rolling_90d", with_(*_MERGE_BASE, *_accumulate_sql()) +
    f"select {_COLS} from m_last where report_date >= {d(A_MID)} - 90")
reg("sort_by_date_stable", with_(*_MERGE_BASE, *_accumulate_sql()) + f"""select {_COLS},
  row_number() over (order by report_date asc nulls last, src, _o, proposal_id) as row_number
from m_last where report_date >= {d(A_MID)} - 90""")
reg("sort_append_order", with_(*_MERGE_BASE, *_accumulate_sql()) + f"""select {", ".join("l." + c for c in CONTRACT_COLS)},
  row_number() over (order by coalesce(p.src, l.src), coalesce(p._o, l._o), l.proposal_id) as row_number
from m_last l left join m_prev p on l.proposal_id is not distinct from p.proposal_id""")


# ================================================================== other stand-ins
def period_sql(col: str) -> str:
    return f"cast(year({col}) * 100 + month({col}) as integer)"


STORE_ACTIVITY = f"""store_activity as (
  select o_custkey as store_id, c_name as store_name, {period_sql('o_orderdate')} as vintage,
         max(cast(o_orderdate as date)) as last_contract_date,
         cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as financed_value,
         count(*) as financed_count
  from orders join customer on o_custkey = c_custkey group by all)"""
STORE_STORED = f"""sa_stored as (
  select store_id, store_name, vintage, last_contract_date, financed_value,
         case when store_id % 7 = 0 then financed_count + 1 else financed_count end as financed_count
  from store_activity where vintage < {ym(A_MID)})"""
SA_COLS = ["store_id", "store_name", "vintage", "last_contract_date", "financed_value", "financed_count"]
SA_KEYS = ["store_id", "vintage"]

TARGETS = f"""targets as (
  select {period_sql('o_orderdate')} as period, n_name as branch,
         cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as production,
         cast(count(*) * 250000 as decimal(28,2)) as target
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all)"""
TARGETS_STORED = f"""t_stored as (
  select period, branch,
         case when period % 7 = 0 then cast(production - 100 as decimal(28,2)) else production end as production,
         target
  from targets where period < {ym(A_MID)})"""
T_COLS = ["period", "branch", "production", "target"]
T_KEYS = ["period", "branch"]
T_DEC = {"production", "target"}

PORTFOLIO = f"""portfolio as (
  select distinct c_custkey as store_tax_id, n_name as branch, {period_sql('o_orderdate')} as period,
         c_mktsegment as segment, c_acctbal as balance
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""
PORTFOLIO_EXTRACT = f"""p_extract as (
  select period, store_tax_id, branch, balance, segment from portfolio
  where period between {A_MID.year * 100 + 1} and {A_MID.year * 100 + 12})"""
PORTFOLIO_STORED = f"""p_stored as (
  select store_tax_id, branch, period, segment,
         case when store_tax_id % 7 = 0 then balance + 1 else balance end as balance,
         case when store_tax_id % 2 = 0 then 'Y' else 'N' end as legacy_flag
  from portfolio where period < {ym(A_MID)})"""
P_KEYS = ["store_tax_id", "branch", "period"]
P_COLS = ["store_tax_id", "branch", "period", "segment", "balance", "legacy_flag"]

COMMISSION = f"""commission as (
  select l_orderkey as contract_code, {period_sql('l_shipdate')} as period, l_suppkey as master_tax_id,
         cast(l_extendedprice as decimal(18,2)) as gross_amount, cast(l_tax * 100 as decimal(9,4)) as rate_pct,
         l_linenumber as ord
  from lineitem)"""
# A_TURN is day 1 after a Saturday month end: the source window is the last 3 days (June and July).
COMMISSION_EXTRACT = f"""cx as (
  select * from commission where period between {ym(A_TURN - dt.timedelta(days=2))} and {ym(A_TURN)}
  union all
  select null, null, null, cast(sum(gross_amount) as decimal(18,2)), null, null from commission
  where period between {ym(A_TURN - dt.timedelta(days=2))} and {ym(A_TURN)})"""
COMMISSION_REPORT = """cx as (
  select * from commission
  union all
  select null, null, null, cast(sum(gross_amount) as decimal(18,2)), null, null from commission)"""
COMMISSION_STORED = f"""cs_data as (
  select contract_code, cast(period as varchar) as period, cast(master_tax_id as varchar) as master_tax_id,
         case when contract_code % 7 = 0 then cast(gross_amount - 100 as decimal(18,2)) else gross_amount end
           as gross_amount, rate_pct, ord
  from commission where period < {ym(A_TURN)}),
cs as (select * from cs_data
  union all select null, null, null, cast(sum(gross_amount) as decimal(18,2)), null, null from cs_data)"""
C_COLS = ["contract_code", "period", "master_tax_id", "gross_amount", "rate_pct", "ord"]
C_KEYS = ["contract_code", "period"]
C_DEC = {"gross_amount", "rate_pct"}
C_BATCH = """cb as (select contract_code, cast(period as varchar) as period,
  cast(master_tax_id as varchar) as master_tax_id, gross_amount, rate_pct, ord
  from cx where contract_code is not null)"""

HOLIDAYS = "(" + ", ".join(d(x) for x in TEST_HOLIDAYS) + ")"


def business_sql(col: str) -> str:
    return f"(isodow({col}) - 1 < 5 and {col} not in {HOLIDAYS})"


# ================================================================== store activity
reg("source_this_month", with_(STORE_ACTIVITY) + f"select * from store_activity where vintage = {ym(A_MID)}")
reg("dedup_keep_last_composite", with_(STORE_ACTIVITY, STORE_STORED) + f"""select * exclude (rn, arrival) from (
  select *, row_number() over (partition by store_id, vintage order by arrival desc) as rn from (
    select *, 0 as arrival from sa_stored union all by name select *, 1 as arrival from store_activity))
where rn = 1""")
reg("store_activity_merge", with_(STORE_ACTIVITY, STORE_STORED,
                                  *merge_ctes("sa_stored", "store_activity", SA_KEYS, SA_COLS, prefix="pv"),
                                  "preview as (select " + ", ".join(SA_COLS) + " from pv_last)",
                                  *merge_ctes("sa_stored", "preview", SA_KEYS, SA_COLS, prefix="o")) +
    classified_select(SA_KEYS, SA_COLS, {"financed_value"}, prefix="o"))

# ================================================================== targets
reg("row_year", with_(TARGETS) + "select *, cast(substr(cast(period as varchar), 1, 4) as integer) as year from targets")
reg("period_yyyymm", """select run_date, year(run_date)::int as ref_year, month(run_date)::int as ref_month,
  cast(year(run_date) * 100 + month(run_date) as integer) as period
from (select distinct cast(o_orderdate as date) as run_date from orders)""")
reg("source_short_window", with_(TARGETS) + f"""select *, {d(A_MID)} as as_of from targets where period = {ym(A_MID)}
union all select *, {d(A_TURN)} as as_of from targets where period between {ym(A_TURN - dt.timedelta(days=2))} and {ym(A_TURN)}
union all select *, {d(A_TURN_BD)} as as_of from targets where period = {ym(A_TURN_BD)}""")
reg("route_by_row_year", with_(TARGETS, TARGETS_STORED, *merge_ctes("t_stored", "targets", T_KEYS, T_COLS)) +
    "select " + ", ".join(T_COLS) + ", cast(substr(cast(period as varchar), 1, 4) as integer) as year from m_last")
reg("years_present", with_(TARGETS) + """select year, year = max(year) over () as is_latest from (
  select distinct cast(substr(cast(period as varchar), 1, 4) as integer) as year from targets) where year is not null""")
_T_YEAR = "cast(substr(cast(period as varchar), 1, 4) as integer)"
_TARGETS_BY_YEAR = with_(
    TARGETS, TARGETS_STORED,
    *merge_ctes("t_stored", "targets", T_KEYS, T_COLS, prefix="pv"),
    f"rows_y as (select {', '.join(T_COLS)}, {_T_YEAR} as year from pv_last)",
    f"prev_y as (select *, {_T_YEAR} as year from t_stored where {_T_YEAR} in (select year from rows_y))",
    *merge_ctes("prev_y", "rows_y", T_KEYS, T_COLS + ["year"], prefix="o"),
) + classified_select(T_KEYS, T_COLS + ["year"], T_DEC, prefix="o")
reg("targets_by_year", _TARGETS_BY_YEAR)
reg("yearly_counts_rollup", f"""select year, count(*) filter (where change_type = 'new') as new_rows,
  count(*) filter (where change_type = 'edited') as edited_rows, count(*) as total_rows,
  grouping(year) = 1 as is_all_years
from ({_TARGETS_BY_YEAR}) group by rollup (year)""")

# ================================================================== portfolio
reg("filter_current_period", with_(PORTFOLIO) + f"select * from portfolio where period = {ym(A_MID)}")
reg("source_this_year", with_(PORTFOLIO) +
    f"select * from portfolio where period between {A_MID.year * 100 + 1} and {A_MID.year * 100 + 12}")
reg("sort_by_period_stable", with_(PORTFOLIO, PORTFOLIO_EXTRACT, PORTFOLIO_STORED,
                                   *merge_ctes("p_stored", "p_extract", P_KEYS, P_COLS)) +
    "select " + ", ".join(P_COLS) + """, row_number() over (order by period asc nulls last, src, _o,
  store_tax_id, branch) as row_number from m_last""")
reg("reorder_current_then_legacy", with_(PORTFOLIO, PORTFOLIO_EXTRACT, PORTFOLIO_STORED,
                                         *merge_ctes("p_stored", "p_extract", P_KEYS, P_COLS)) +
    "select " + ", ".join(P_COLS) + " from m_last")
_PY = "cast(substr(cast(period as varchar), 1, 4) as integer)"
reg("portfolio_by_year", with_(
    PORTFOLIO, PORTFOLIO_EXTRACT, PORTFOLIO_STORED,
    f"rows_y as (select *, {_PY} as year from p_extract)",
    f"prev_y as (select *, {_PY} as year from p_stored where {_PY} in (select year from rows_y))",
    *merge_ctes("prev_y", "rows_y", P_KEYS, P_COLS + ["year"], prefix="o"),
) + classified_select(P_KEYS, P_COLS + ["year"], {"balance"}, prefix="o"))
reg("portfolio_preview", with_(
    PORTFOLIO, PORTFOLIO_EXTRACT, PORTFOLIO_STORED,
    f"cur as (select * from p_extract where period = {ym(A_MID)})",
    f"pp as (select * from p_stored where period = {ym(A_MID)})",
    *merge_ctes("pp", "cur", P_KEYS, P_COLS, prefix="o"),
) + classified_select(P_KEYS, P_COLS, {"balance"}, prefix="o"))

# ================================================================== commission
reg("normalize_headers", with_(COMMISSION, COMMISSION_REPORT) + "select * from cx")
reg("drop_footer_rows", with_(COMMISSION, COMMISSION_REPORT) + "select * from cx where contract_code is not null")
reg("split_totals_row", with_(COMMISSION, COMMISSION_STORED) +
    "select *, case when contract_code is null then 'totals' else 'data' end as part from cs")
reg("harmonize_types", with_(COMMISSION, COMMISSION_REPORT, C_BATCH) + "select * from cb")
reg("dedup_keep_last", with_(COMMISSION) + """select * exclude (rn) from (
  select *, row_number() over (partition by contract_code order by ord desc, period desc nulls last,
    master_tax_id desc nulls last, gross_amount desc nulls last, rate_pct desc nulls last) as rn
  from commission) where rn = 1""")
reg("number_to_text_id", with_(COMMISSION) + """select contract_code, ord,
  cast(cast(cast(master_tax_id * 1000000000000 + contract_code as double) as decimal(38,0)) as varchar) as tax_id_text,
  case when gross_amount = floor(gross_amount) then cast(cast(floor(gross_amount) as decimal(38,0)) as varchar)
       else trim(cast(gross_amount as varchar)) end as amount_text
from commission""")
reg("nan_to_null", with_(COMMISSION) + """select contract_code, ord,
  case when isnan(r) then null else r end as rate, isnan(r) as rate_is_null from (
  select contract_code, ord, case when contract_code % 9 = 0 then 'nan'::double
         else cast(rate_pct as double) end as r from commission)""")
reg("totals_row", with_(COMMISSION, COMMISSION_REPORT, C_BATCH.replace(
    "cast(period as varchar) as period,\n  cast(master_tax_id as varchar) as master_tax_id", "period, master_tax_id")) +
    """select null::bigint as contract_code, null::integer as period, null::bigint as master_tax_id,
  coalesce(cast(sum(gross_amount) as decimal(28,2)), 0) as gross_amount,
  cast(sum(rate_pct) as double) / count(rate_pct) as rate_pct, null::integer as ord, true as is_total from cb""")
reg("totals_row_refresh", with_(COMMISSION, COMMISSION_STORED, "sd as (select * from cs where contract_code is not null)") +
    """select contract_code, period, master_tax_id, cast(gross_amount as decimal(28,2)) as gross_amount,
  cast(rate_pct as double) as rate_pct, ord, false as is_total from sd
union all
select null, null, null, coalesce(cast(sum(gross_amount) as decimal(28,2)), 0),
  cast(sum(rate_pct) as double) / count(rate_pct), null, true from sd""")
C_TIE = ("master_tax_id", "gross_amount", "rate_pct")
_C_PREVIEW = [COMMISSION, COMMISSION_EXTRACT, COMMISSION_STORED, C_BATCH,
              *merge_ctes("cs_data", "cb", C_KEYS, C_COLS, ord_col="ord", prefix="pv", tiebreak=C_TIE)]
reg("commission_preview", with_(*_C_PREVIEW) +
    classified_select(C_KEYS, C_COLS, C_DEC, prefix="pv", exclude_compare=("ord",)))
reg("commission_official", with_(
    *_C_PREVIEW, "preview as (select " + ", ".join(C_COLS) + " from pv_last)",
    "sd as (select * from cs where contract_code is not null)",
    *merge_ctes("sd", "preview", C_KEYS, C_COLS, ord_col="ord", prefix="o", tiebreak=C_TIE),
    "cl as (" + classified_select(C_KEYS, C_COLS, C_DEC, prefix="o", exclude_compare=("ord",)) + ")") +
    """select contract_code, period, master_tax_id, cast(gross_amount as decimal(28,2)) as gross_amount,
  cast(rate_pct as double) as rate_pct, ord, change_type, false as is_total from cl
union all
select null, null, null, coalesce(cast(sum(gross_amount) as decimal(28,2)), 0),
  cast(sum(rate_pct) as double) / count(rate_pct), null, null, true from cl""")
reg("schema_drift_report", with_(COMMISSION, COMMISSION_REPORT) + """select * from (values
  ('comissao_a_vista', 'corban_tax_id', 'missing_in_extract', 0::bigint),
  ('comissao_a_vista', 'rate_pct', 'missing_in_extract', 0::bigint),
  ('comissao_a_vista', 'rate_pct', 'missing_vs_table', 0::bigint),
  ('comissao_a_vista', 'ord', 'missing_vs_table', 0::bigint)) t(dataset, column_name, issue, non_null_values)
where false
union all select 'comissao_a_vista', 'corban_tax_id', 'missing_in_extract', 0
union all select 'comissao_a_vista', 'rate_pct', 'missing_in_extract', 0
union all select 'comissao_a_vista', 'rate_pct', 'missing_vs_table', 0
union all select 'comissao_a_vista', 'net_amount', 'extra_vs_table',
  (select count(gross_amount) from cx where contract_code is not null)""")

# ================================================================== calendar and events
_RUN_DATES = "(select distinct cast(o_orderdate as date) as run_date from orders)"
reg("business_days", f"select run_date, {business_sql('run_date')} as is_business_day from {_RUN_DATES}")


def _turn_sql(days: str) -> str:
    return f"""select run_date, pme as prev_month_end, pme_b as prev_month_end_is_business_day,
  day(run_date) in (1, 2) and not pme_b as use_short_window from (
  select run_date, pme, {business_sql('pme')} as pme_b from (
    select run_date, date_trunc('month', run_date)::date - 1 as pme from {days}))"""


reg("month_turn_rule", _turn_sql(_RUN_DATES))
reg("month_turn_calendar", _turn_sql("""(select cast(unnest(generate_series(lo::timestamp, hi::timestamp,
  interval 1 day)) as date) as run_date from (select min(cast(o_orderdate as date)) as lo,
  max(cast(o_orderdate as date)) as hi from orders))"""))
reg("filter_display_type", "select * from events where event_type = 'purchase'")

# ================================================================== sources and streaming
reg("read_extract", "select *, 'orders.parquet' as extract_file, null::bigint as extract_epoch from orders")
reg("read_previous_or_empty", "select * from customer")
reg("stream_accumulate", f"""select * exclude (rn), 'new' as change_type from (
  select *, row_number() over (partition by contract_code, period order by ord desc,
    master_tax_id desc nulls last, gross_amount desc nulls last, rate_pct desc nulls last) as rn from (
    select l_orderkey as contract_code, {period_sql('l_shipdate')} as period, l_suppkey as master_tax_id,
           cast(l_extendedprice as decimal(18,2)) as gross_amount, cast(l_tax * 100 as decimal(9,4)) as rate_pct,
           l_linenumber as ord from lineitem)) where rn = 1""")

# ================================================================== landing folder
def _epoch(x: dt.date) -> int:
    return int(dt.datetime.combine(x, dt.time(6, 0), tzinfo=dt.timezone.utc).timestamp())


_E_TURN, _E_MID = _epoch(A_TURN), _epoch(A_MID)
reg("landing_run_id", with_(CONTRACTS, extract_cte(A_TURN, "x_turn"), extract_cte(A_MID, "x_mid"),
                            STORE_ACTIVITY) + f"""
select 'numero_contratos_{_E_TURN}.parquet' as file_name, 'numero_contratos' as dataset,
       {_E_TURN}::bigint as epoch, (select count(*) from x_turn) as rows
union all
select 'numero_contratos_{_E_MID}.parquet', 'numero_contratos', {_E_MID}::bigint, (select count(*) from x_mid)
union all
select 'dias_sem_producao_{_E_MID}.parquet', 'dias_sem_producao', {_E_MID}::bigint,
       (select count(*) from store_activity)""")
reg("latest_extract_per_dataset", with_(CONTRACTS, extract_cte(A_MID, "x_mid"), STORE_ACTIVITY) + f"""
select 'numero_contratos' as dataset, 'numero_contratos_{_E_MID}.parquet' as file_name, {_E_MID}::bigint as epoch,
       (select count(*) from x_mid) as rows, (select max(report_date) from x_mid) as newest
union all
select 'dias_sem_producao', 'dias_sem_producao_{_E_MID}.parquet', {_E_MID}::bigint,
       (select count(*) from store_activity), (select max(last_contract_date) from store_activity)
union all
select 'comissao_a_vista', null, null, null, null""")

# ================================================================== runs through ingest, runner and store
reg("rerun_same_run_id", with_(STORE_ACTIVITY) + "select " + ", ".join(SA_COLS) + ", 'new' as change_type from store_activity")
_LINES = f"""select *, row_number() over (partition by contract_code, period order by ord desc,
    master_tax_id desc nulls last, gross_amount desc nulls last, rate_pct desc nulls last) as rn from (
    select l_orderkey as contract_code, {period_sql('l_shipdate')} as period, l_suppkey as master_tax_id,
           cast(l_extendedprice as decimal(18,2)) as gross_amount, cast(l_tax * 100 as decimal(9,4)) as rate_pct,
           l_linenumber as ord from lineitem)"""
reg("stream_two_checkpoints", f"""select * exclude (rn),
  case when contract_code % 2 = 0 then 'unchanged' else 'new' end as change_type from ({_LINES}) where rn = 1""")
_RUN_COLS = ", ".join(CONTRACT_COLS)
reg("ingest_real_headers", with_(CONTRACTS, batch_cte(A_MID, "contracts")) + f"select {_RUN_COLS}, 'new' as change_type from batch")
reg("ingest_text_dates", with_(CONTRACTS, batch_cte(A_MID, "contracts")) +
    f"select {_RUN_COLS}, 'new' as change_type from batch where proposal_id % 20 <> 0 union all by name "
    "select proposal_id, 'quarantine' as change_type from contracts where proposal_id % 20 = 0")
reg("ingest_money_text", f"""select contract_code, period, master_tax_id, cast(gross_amount + 1 as decimal(18,2)) as gross_amount,
  'edited' as change_type from ({_LINES}) where rn = 1""")
reg("quarantine_null_period", with_(TARGETS) + """select cast(period // 100 as varchar) as part, count(*) as rows
from targets where period not in (200001, 200002) group by all
union all select 'period: missing', count(*) from targets where period = 200001 having count(*) > 0
union all select 'period: unreadable', count(*) from targets where period = 200002 having count(*) > 0""")
reg("stored_table_order", with_(CONTRACTS, batch_cte(A_MID, "contracts")) +
    "select count(*) as rows, 0::bigint as out_of_order_in_file, 0::bigint as out_of_order_between_files from batch")


# ================================================================== landing ledger and tables in key slices
reg("landing_empty_entry", with_(STORE_ACTIVITY) + """select null::bigint as rows_read, null::bigint as new_rows, null::bigint as total_rows,
  'failed: landing entry dias_sem_producao_1000000001.parquet is empty' as note
union all select count(*), count(*), count(*), '' from store_activity""")
reg("landing_late_entry", with_(STORE_ACTIVITY) + "select " + ", ".join(c if c != "financed_count" else "financed_count + 1 as financed_count" for c in SA_COLS) +
    ", 'edited' as change_type from store_activity")
_KEYED = with_(*_MERGE_BASE, *_accumulate_sql(), "c as (" + classified_select(
    _K, CONTRACT_COLS, CONTRACT_FLOAT, extra="".join(f", p.{c} as p_{c}" for c in CONTRACT_COLS)) + ")")
reg("keyed_merge", _KEYED + "select " + ", ".join(
    f"case when change_type = 'unchanged' then p_{c} else {c} end as {c}" for c in CONTRACT_COLS) + ", change_type from c")
reg("noop_writes_nothing", _KEYED + """select 0::bigint as new_rows, 0::bigint as edited_rows, count(*) as total_rows,
  0::bigint as folders_written, 0::bigint as bytes_written, false as published from c""")
reg("keyed_bytes_written", with_(CONTRACTS, stored_cte(A_MID), """ids as (
  select count(*) as n, min(proposal_id) + (max(proposal_id) - min(proposal_id)) / 100 as top from stored)""") + """
select 'edit' as run, 0::bigint as new_rows, (select count(*) from stored where proposal_id <= (select top from ids)) as edited_rows,
  n as total_rows, true as under_a_tenth, false as wrote_nothing from ids
union all select 'again', 0, 0, n, true, true from ids""")
reg("totals_from_changes", with_(*_C_PREVIEW) + """select null::bigint as contract_code, null::varchar as period, null::varchar as master_tax_id,
  coalesce(cast(sum(gross_amount) as decimal(28,2)), 0) as gross_amount,
  cast(sum(rate_pct) as double) / count(rate_pct) as rate_pct, null::integer as ord, true as is_total from pv_last""")
reg("run_keyed_store", with_(STORE_ACTIVITY) + "select " + ", ".join(
    c if c != "financed_count" else "financed_count + (store_id % 2 = 0)::int as financed_count" for c in SA_COLS) + " from store_activity")
reg("stream_keyed", ORACLE["stream_accumulate"])
reg("stream_changes", f"""select * exclude (rn), case when period < 199601 then 'edited' else 'new' end as change_type,
  cast(case when period < 199601 then 2 else 1 end as bigint) as change_no from ({_LINES}) where rn = 1 and period > 199500""")
_SOLE = "count(*) as rows_read, count(*) as new_rows, count(*) as total_rows, '' as note"
reg("job_side_by_side", with_(CONTRACTS, extract_cte(A_MID), batch_cte(A_MID), STORE_ACTIVITY, TARGETS, PORTFOLIO, PORTFOLIO_EXTRACT, COMMISSION, COMMISSION_EXTRACT,
                              "cm as (select count(*) as n, count(distinct (contract_code, period)) as k from cx where contract_code is not null)",
                              "bt as (select count(*) as n from batch)") + f"""select 'Store activity' as dataset, {_SOLE} from store_activity
union all select 'Targets', {_SOLE} from targets
union all select 'Portfolio', {_SOLE} from p_extract
union all select 'Contracts', count(*), (select n from bt), (select n from bt), '' from extract
union all select 'Commission', n, k, k, '1 footer rows dropped' from cm""")
