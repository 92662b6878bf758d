"""Named queries against their DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cinelens.plans import catalog

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or type(v).__name__ == "NAType" or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "orders", "lineitem", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    sp = entry.queries()[name](spark, SF).toPandas()
    db = con.execute(entry.oracle_sql()[name]).df()
    assert _rows(sp) == _rows(db)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["userId", "rank", "movieId", "title", "genres", "similarity", "source"]
    assert df.count() > 0


def test_every_query_has_a_callable():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert not math.isnan(len(qs))


@pytest.mark.parametrize("name", ["r2_recommend", "e5_eval_lists", "f7_svd_gram", "a4_last_rating", "v8_report"])
def test_no_cartesian_or_nested_loop_plans(spark, name):
    """Scale guard: the final (post-AQE) plan of each query has no
    cartesian product and no broadcast nested-loop join."""
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_report import plan_text, summarize

    df = entry.queries()[name](spark, SF)
    df.collect()
    counts = summarize(plan_text(df))["counts"]
    assert "CartesianProduct" not in counts and "BroadcastNestedLoopJoin" not in counts, counts
