"""Stand-in report extracts and stored snapshots built from the driver tables.

These functions only *shape* rows of ``/root/testdata/sf*/`` into the schemas
the five datasets have (column mapping, the report's own grouping, a footer
row, stored-as-text columns, and value edits that make a stored snapshot
differ from the next extract).  They do none of the consolidation work: every
filter by period, de-duplication, merge and classification is done by the
library in :mod:`snapmerge.plans.queries`.

Stored snapshots hold the *whole history* before the run (no id subsets), so
the work of every query grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions.calendar import holidays_from_dates
from ..operators.filters import source_window_period

# Fixed run dates of the stand-ins.
A_MID = dt.date(2001, 7, 15)     # ordinary mid-month run
A_TURN = dt.date(2001, 7, 1)     # day 1; 2001-06-30 is a Saturday → carry-over and short window
A_TURN_BD = dt.date(2001, 8, 1)  # day 1; 2001-07-31 is a Tuesday → carry-over, no short window
A_EMPTY = dt.date(2002, 3, 15)   # after the last order date: the extract is empty
# Status value that plays "paid proposal".
PAID = "PROPOSTA PAGA"   # the status a paid proposal has in the report (order status F here)
# Days before the run that the stored snapshot has not seen yet.
UNSEEN_DAYS = 2
# Holiday rows used by the tests (national scope).
TEST_HOLIDAYS = [dt.date(2001, 5, 1), dt.date(2001, 9, 7), dt.date(2001, 10, 12),
                 dt.date(2001, 11, 2), dt.date(2001, 11, 15), dt.date(2001, 12, 25)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def holiday_calendar(spark: SparkSession) -> DataFrame:
    return holidays_from_dates(spark, TEST_HOLIDAYS)


# ------------------------------------------------------------------ contracts
def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every proposal ever issued (orders ⋈ customer ⋈ nation)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("o_orderkey")
    return j.select(
        key.alias("proposal_id"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        F.col("o_custkey").alias("dealer_id"),
        F.col("o_orderpriority").alias("manager"),
        F.when(F.col("o_orderstatus") == "F", PAID).otherwise(F.col("o_orderstatus")).alias("status"),
        (key * 10).alias("contract_code"),
        F.col("o_totalprice").alias("principal"),
        (F.col("o_totalprice") * 2).alias("financed"),
        F.when(key % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") / 4).alias("insurance"),
        F.when(key % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("branch"),
    )


def contracts_extract(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """The daily "last 30 days" report as of ``as_of`` (F-11, applied by the library)."""
    return contracts(spark, sf_dir).where(P.in_last_n_days("report_date", as_of, P.SOURCE_LAST_DAYS))


def contracts_stored(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """The stored table before the run: every paid contract older than the last
    ``UNSEEN_DAYS`` days, with some values that the new extract will change
    (``principal - 100``) or only re-state with float noise (``+ 1e-8``)."""
    cut = as_of - dt.timedelta(days=UNSEEN_DAYS)
    base = contracts(spark, sf_dir).where((F.col("status") == PAID) & (F.col("report_date") < F.lit(cut)))
    k = F.col("proposal_id")
    principal = (F.when(k % 7 == 0, F.col("principal") - 100)
                 .when(k % 3 == 0, F.col("principal") + 1e-8)
                 .otherwise(F.col("principal")))
    return base.withColumn("principal", principal)


# ------------------------------------------------------------------ store activity
def store_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly store-activity report: one row per store and vintage month."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey)
    vintage = P.period_of("o_orderdate")
    return (j.groupBy(F.col("o_custkey").alias("store_id"), F.col("c_name").alias("store_name"),
                      vintage.alias("vintage"))
            .agg(F.max(F.col("o_orderdate").cast("date")).alias("last_contract_date"),
                 F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("financed_value"),
                 F.count(F.lit(1)).alias("financed_count")))


def store_activity_stored(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """Stored store-activity table: vintages before the run month, some counts differing."""
    s = store_activity(spark, sf_dir).where(F.col("vintage") < F.lit(P.yyyymm(as_of)))
    return s.withColumn("financed_count",
                        F.when(F.col("store_id") % 7 == 0, F.col("financed_count") + 1)
                        .otherwise(F.col("financed_count")))


# ------------------------------------------------------------------ targets
def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly targets report: one row per period and branch."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return (j.groupBy(P.period_of("o_orderdate").alias("period"), F.col("n_name").alias("branch"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("production"),
                 (F.count(F.lit(1)) * 250000).cast("decimal(28,2)").alias("target")))


def targets_stored(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """Stored targets: periods before the run month; some productions differ."""
    t = targets(spark, sf_dir).where(F.col("period") < F.lit(P.yyyymm(as_of)))
    return t.withColumn("production",
                        F.when(F.col("period") % 7 == 0, (F.col("production") - 100).cast("decimal(28,2)"))
                        .otherwise(F.col("production")))


# ------------------------------------------------------------------ portfolio
def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partner-portfolio report: one row per store, branch and month."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("c_custkey").alias("store_tax_id"), F.col("n_name").alias("branch"),
                    P.period_of("o_orderdate").alias("period"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")).distinct()


def portfolio_extract(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """The "reference = this year" report (F-13 by the library), columns in a new order."""
    p = portfolio(spark, sf_dir).where(P.period_in_this_year("period", as_of))
    return p.select("period", "store_tax_id", "branch", "balance", "segment")


def portfolio_stored(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """Stored portfolio: months before the run, a legacy column, some balances differing."""
    p = portfolio(spark, sf_dir).where(F.col("period") < F.lit(P.yyyymm(as_of)))
    return (p.withColumn("balance", F.when(F.col("store_tax_id") % 7 == 0, F.col("balance") + 1)
                         .otherwise(F.col("balance")))
            .withColumn("legacy_flag", F.when(F.col("store_tax_id") % 2 == 0, F.lit("Y")).otherwise(F.lit("N"))))


# ------------------------------------------------------------------ commission
def commission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commission lines; ``ord`` is the line's position inside its contract in the report.

    Positions may repeat inside a contract; keep-last then breaks the tie on
    the row content (deterministically).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("contract_code"),
        P.period_of("l_shipdate").alias("period"),
        F.col("l_suppkey").alias("master_tax_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("gross_amount"),
        (F.col("l_tax") * 100).cast("decimal(9,4)").alias("rate_pct"),
        F.col("l_linenumber").alias("ord"),
    )


def commission_extract(spark: SparkSession, sf_dir: str, as_of: dt.date) -> DataFrame:
    """The commission report as downloaded: the source window of ``as_of`` (F-14 by the
    library) and the report's footer row."""
    return _with_footer(source_window_period(commission(spark, sf_dir), "period", as_of, set(TEST_HOLIDAYS)))


def commission_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commission report over all periods, with its footer row."""
    return _with_footer(commission(spark, sf_dir))


def _with_footer(rows: DataFrame) -> DataFrame:
    """A report's rows and its footer (null contract, summed amount)."""
    footer = rows.agg(F.sum("gross_amount").cast("decimal(18,2)").alias("gross_amount"))
    footer = footer.select(F.lit(None).cast("long").alias("contract_code"), F.lit(None).cast("int").alias("period"),
                           F.lit(None).cast("long").alias("master_tax_id"), "gross_amount",
                           F.lit(None).cast("decimal(9,4)").alias("rate_pct"), F.lit(None).cast("int").alias("ord"))
    return rows.unionByName(footer)


def commission_stored(spark: SparkSession, sf_dir: str, as_of: dt.date, with_totals: bool = True) -> DataFrame:
    """The official commission table before the run: all months before the run
    month, period and tax id stored as text, some amounts differing, and (for
    the official table) the sheet's old totals row (null key)."""
    c = commission(spark, sf_dir).where(F.col("period") < F.lit(P.yyyymm(as_of)))
    data = c.select(
        "contract_code",
        F.col("period").cast("string").alias("period"),
        F.col("master_tax_id").cast("string").alias("master_tax_id"),
        F.when(F.col("contract_code") % 7 == 0, (F.col("gross_amount") - 100).cast("decimal(18,2)"))
        .otherwise(F.col("gross_amount")).alias("gross_amount"),
        "rate_pct", "ord")
    if not with_totals:
        return data
    stale_total = data.agg(F.sum("gross_amount").cast("decimal(18,2)").alias("gross_amount")).select(
        F.lit(None).cast("long").alias("contract_code"), F.lit(None).cast("string").alias("period"),
        F.lit(None).cast("string").alias("master_tax_id"), "gross_amount",
        F.lit(None).cast("decimal(9,4)").alias("rate_pct"), F.lit(None).cast("int").alias("ord"))
    return data.unionByName(stale_total)


def commission_raw_headers(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> DataFrame:
    """The commission extract with the header whitespace the real report carries (all periods without ``as_of``)."""
    e = commission_report(spark, sf_dir) if as_of is None else commission_extract(spark, sf_dir, as_of)
    return e.toDF(*["\n    " + c + "\n    " if c == "gross_amount" else (" " + c if c == "rate_pct" else c)
                    for c in e.columns])
