"""Merge semantics against a brute-force model on random small frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snapmerge.operators import merge as M

SCHEMA = "k int, v double, o int"

rows_st = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)),
              st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.0 + 1e-9, 2.5, -3.25])),
              st.integers(0, 3)),
    max_size=10)


def _rank(src, row):
    _, v, o = row
    return (src, o, v is not None, v if v is not None else 0.0)


def model(prev, batch):
    """keep-last per key: batch beats previous, then higher ``o``, then larger value."""
    out = {}
    for key in {r[0] for r in prev} | {r[0] for r in batch}:
        p = [r for r in prev if r[0] == key]
        b = [r for r in batch if r[0] == key]
        p_last = max(p, key=lambda r: _rank(0, r)) if p else None
        last = max(b, key=lambda r: _rank(1, r)) if b else p_last
        if p_last is None:
            change = "new"
        else:
            a, c = last[1], p_last[1]
            same = (a is None and c is None) or (a is not None and c is not None and round(a, 6) == round(c, 6))
            change = "unchanged" if same else "edited"
        out[key] = (last[1], last[2], change)
    return out


def observed(df):
    return {r.k: (r.v, r.o, r[M.CHANGE]) for r in df.collect()}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prev=rows_st, batch=rows_st)
def test_accumulate_and_classify_matches_model(spark, prev, batch):
    p = spark.createDataFrame(prev, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    got = M.accumulate_and_classify(p, b, "k", ord_col="o", compare_exclude=["o"])
    assert observed(got) == model(prev, batch)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prev=rows_st, batch=rows_st)
def test_touched_only_plan_matches_model(spark, prev, batch):
    # the touched-only plan requires a previous table with one row per key
    unique_prev = list({r[0]: r for r in prev}.values())
    p = spark.createDataFrame(unique_prev, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    got = M.accumulate_and_classify(p, b, "k", ord_col="o", prev_unique=True, strategy="touched")
    assert observed(got) == model(unique_prev, batch)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prev=rows_st, batch=rows_st)
def test_lookup_plan_matches_model(spark, prev, batch):
    # the lookup plan also requires a previous table with one row per key
    unique_prev = list({r[0]: r for r in prev}.values())
    p = spark.createDataFrame(unique_prev, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    got = M.accumulate_and_classify(p, b, "k", ord_col="o", prev_unique=True, strategy="lookup")
    assert observed(got) == model(unique_prev, batch)
