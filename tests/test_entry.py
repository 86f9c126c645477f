"""The driver contract and a small-scale oracle run (DuckDB on the same Parquet files)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from helpers import SF001

ROWS_ONLY = {
    "garch_forecast", "walk_forward_forest", "walk_forward_gbt", "select_on_validation", "select_on_validation_v2",
    "benchmark_split", "benchmark_split_log",
}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "ticker", "close", "ret", "vol_5", "vol_10", "vol_30", "target_vol_fwd"]
    assert df.count() == 5334 - 35 * 10


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)
    optional = {q for q in qs if q == "pipeline" or q.startswith("op") and "_" in q and q[2 : q.index("_")].isdigit()}
    assert set(qs) - set(os_) - optional == ROWS_ONLY


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["lineitem", "orders", "events", "supplier", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


FAST = [
    "features_clean", "features_v2", "features_v3_panel", "cutoffs", "fold_profile", "walk_forward_linear",
    "dashboard_mae", "score_requests", "garch_grid", "prices_long",
]


@pytest.mark.parametrize("name", FAST)
def test_oracle_small(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in sdf.collect())
    res = duck.sql(E.oracle_sql()[name]).to_arrow_table().to_pylist()
    assert sorted(res[0].keys()) == cols if res else True
    drows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in res)
    assert srows == drows
