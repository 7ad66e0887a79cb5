"""Totals, footers, schema operators and scalar helpers on hand-written frames."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmerge.functions import scalars as X
from snapmerge.operators import filters as FL
from snapmerge.operators import schema as S
from snapmerge.operators import totals as TT

SCHEMA = "code long, `R$ amount` decimal(18,2), `% rate` double, name string"


def test_footer_anywhere_and_two_footers(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"), 0.5, "a"), (None, Decimal("9.00"), None, None),
                                (2, Decimal("2.50"), 1.5, "b"), (None, Decimal("9.00"), None, None)], SCHEMA)
    data, totals = FL.split_totals(df, "code")
    assert data.count() == 2 and totals.count() == 2
    f = FL.footer_count(df, "code").first()
    assert f.footer_rows == 2 and f.has_footer
    refreshed = TT.refresh_totals(df, "code")
    tot = refreshed.where(TT.IS_TOTAL).collect()
    assert len(tot) == 1                                            # every old totals row dropped (Q-09)
    assert tot[0]["R$ amount"] == Decimal("3.50") and tot[0]["% rate"] == 1.0 and tot[0]["name"] is None


def test_totals_of_empty_data_sum_zero_mean_null(spark):
    empty = spark.createDataFrame([], SCHEMA)
    t = TT.totals_row(empty).first()
    assert t["R$ amount"] == Decimal("0.00") and t["% rate"] is None and t["code"] is None   # T-03


def test_totals_choose_columns_by_name(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0)], "id long, gross_amount double, rate_pct double")
    t = TT.totals_row(df).first()
    assert t.gross_amount == 2.0 and t.rate_pct == 4.0 and t.id is None


def test_number_to_text_never_scientific(spark):
    df = spark.createDataFrame([(41163512345678.0, 202608.0, Decimal("12.50"), None)],
                               "a double, b double, c decimal(18,2), d double")
    r = df.select(X.number_to_text("a", T.DoubleType()).alias("a"), X.number_to_text("b", T.DoubleType()).alias("b"),
                  X.number_to_text("c", T.DecimalType(18, 2)).alias("c"),
                  X.number_to_text("d", T.DoubleType()).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("41163512345678", "202608", "12.50", None)      # T-04


def test_strip_removes_newlines_not_only_spaces(spark):
    r = spark.createDataFrame([("\n  R$ x \t\n",)], "s string").select(
        X.strip_ws("s").alias("a"), F.trim("s").alias("b")).first()
    assert r.a == "R$ x" and r.b != "R$ x"                                          # T-06


def test_nan_becomes_null(spark):
    r = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").select(
        X.nan_to_null("x", T.DoubleType()).alias("x")).collect()
    assert r[0].x is None and r[1].x == 1.0                                         # T-12


def test_normalize_align_reorder_harmonize(spark):
    raw = spark.createDataFrame([(1, 2.0, 3)], ["\n  Cd Contrato\n ", " R$ x", "extra"])
    clean = S.normalize_headers(raw)
    assert clean.columns == ["Cd Contrato", "R$ x", "extra"]
    target = T.StructType([T.StructField("R$ x", T.DoubleType()), T.StructField("Cd Contrato", T.StringType()),
                           T.StructField("missing", T.LongType())])
    aligned = S.align_to_schema(clean, target)
    assert aligned.columns == ["R$ x", "Cd Contrato", "missing"]
    assert aligned.first()["Cd Contrato"] == "1" and aligned.first()["missing"] is None
    reordered = S.reorder_current_then_legacy(clean, ["extra", "Cd Contrato"])
    assert reordered.columns == ["extra", "Cd Contrato", "R$ x"]
    ids = spark.createDataFrame([(41163512345678.0, 200106)], "tax double, period int")
    stored = T.StructType([T.StructField("tax", T.StringType()), T.StructField("period", T.StringType())])
    h = S.harmonize_types(ids, stored).first()
    assert (h.tax, h.period) == ("41163512345678", "200106")


def test_schema_drift_report_counts_values(spark):
    batch = spark.createDataFrame([(1, None), (2, "x")], "a long, new_col string")
    rep = {(r.column_name, r.issue): r.non_null_values for r in
           S.schema_drift_report(spark, batch, "ds", ["a", "b"], existing=["a", "old"]).collect()}
    assert rep == {("b", "missing_in_extract"): 0, ("old", "missing_vs_table"): 0,
                   ("new_col", "extra_vs_table"): 1}


def test_select_configured_tolerates_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert S.select_configured(df, ["b", "zzz", "a"]).columns == ["b", "a"]
    assert S.missing_columns(["b", "zzz"], df) == ["zzz"]


def test_tolerant_equality_is_null_safe(spark):
    r = spark.createDataFrame([(None, None, 1.0000001, 1.0)], "a double, b double, c double, d double").select(
        X.values_equal(F.col("a"), F.col("b"), T.DoubleType()).alias("nn"),
        X.values_equal(F.col("c"), F.col("d"), T.DoubleType()).alias("close")).first()
    assert r.nn is True and r.close is True


def test_broadcast_bound_measures_string_bytes(spark):
    from snapmerge.operators import sizing as S
    short = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert S.proven_rows(short) == 100
    assert S.measured_bytes(short, 100) == 100 * 8 * 4 + sum(len(str(i)) for i in range(100))
    long_keys = spark.range(20).select(F.concat(F.repeat(F.lit("k"), 4 * 1024 * 1024), F.col("id")).alias("k"))
    assert S.bounded_count(long_keys, S.broadcast_row_limit(long_keys)) == 20   # the estimate alone would pass
    assert S.proven_rows(long_keys) is None                                      # the measurement does not
    assert S.proven_rows(spark.range(3).select(F.array("id").alias("a"))) is None


def test_totals_skip_nan(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, float("nan"), float("nan")), (3, 3.0, 2.0)], "k int, gross_amount double, rate_pct double")
    t = TT.totals_row(df).first()
    assert t["gross_amount"] == 5.0 and t["rate_pct"] == 1.5


def test_yearly_counts_keep_rows_without_a_year_apart(spark):
    from snapmerge.operators import routing as R
    df = spark.createDataFrame([(2001, "new"), (2001, "edited"), (None, "new"), (2002, "unchanged")], "y int, change_type string")
    got = {(r.year, r.is_all_years): (r.new_rows, r.edited_rows, r.total_rows) for r in R.yearly_counts(df, "y").collect()}
    assert got == {(2001, False): (1, 1, 2), (2002, False): (0, 0, 1), (None, False): (1, 0, 1), (None, True): (2, 1, 4)}
