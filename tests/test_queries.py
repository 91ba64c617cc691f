"""Every registered query with oracle SQL returns the oracle's rows
(DuckDB on the same parquet tables), at sf0.001; the entry point runs."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SLOW_NO_ORACLE = {"greedy_selection", "prefix_selection", "tune_depth", "forest_accuracy",
                  "forest_predict", "forest_reference"}
# text operators that SQL can't express; their tests lie with them
TEXT = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["feature", "score"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_model_work():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) <= SLOW_NO_ORACLE | TEXT


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert got == _rows(ocols, res.fetchall())
