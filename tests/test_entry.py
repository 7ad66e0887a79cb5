"""Driver contract: entry smoke, registry, and the oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from snapmerge.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_runs_and_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "change_type" in df.columns and "year" in df.columns


def test_every_query_has_oracle_sql():
    from snapmerge.plans.oracle import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert len(QUERIES) >= 70


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        try:
            import pandas as pd
            if pd.isna(v):
                return None
        except (TypeError, ValueError):
            pass
        return str(v.item() if hasattr(v, "item") else v)
    return sorted((tuple(norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_oracle_matches_on_sf0001(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL).toPandas()
    ddf = duck.sql(E.oracle_sql()[key]).to_arrow_table().to_pandas(date_as_object=True)
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)


def test_smoke_dir_exists():
    assert os.path.isdir(SF_SMALL)
