"""Every registered query against its DuckDB oracle (sf0.001), like the
driver's correctness gate; queries without an oracle must return rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 10 and df.columns == ["period", "avg_power"]


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows, f"{name} returned no rows"
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert _rows(df.columns, rows) == _rows(cols, expected)


def test_limits_only_where_top_k_is_the_feature():
    """No oracle (and so no registered answer) is cut by a row cap, except the
    top-k reports whose limit is the question itself."""
    top_k = {"peak_periods", "layout_1d_peak_periods", "ranked_peaks", "monthly_per_key",
             "monthly_per_key_orders", "layout_1w_monthly"}
    for name, sql in oracle_sql().items():
        if " limit " in f" {sql.lower()} ":
            assert name in top_k, name
