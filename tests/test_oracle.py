"""Registered queries vs their DuckDB oracle text: all at sf0.001 and a subset (all with
TESSERA_FULL_ORACLE=1) at sf0.01, plus a rows-only smoke run of the entry point."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from scripts.check_oracle import TABLES, rows_of

FAST = [
    "position_stats", "covariance", "decompose", "variance_explained", "log_ratio", "empirical_cdf", "box_stats",
    "alternating_means", "topk_classes", "roc_curve", "threshold_errors", "kmeans_step", "nearest_centroid",
    "minibatch_assign", "pair_distance", "partition_columns",
]


@pytest.fixture(scope="module")
def con():
    """One DuckDB connection for each table folder."""
    out = {}
    for folder in (SF_SMALL, SF_ORACLE):
        out[folder] = c = duckdb.connect()
        for t in TABLES:
            p = f"{folder}/{t}.parquet"
            if os.path.exists(p):
                c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return out


def cases():
    sql = E.oracle_sql()
    full = os.environ.get("TESSERA_FULL_ORACLE") == "1"
    return [(n, SF_SMALL) for n in sorted(sql)] + [(n, SF_ORACLE) for n in sorted(sql) if full or n in FAST]


@pytest.mark.parametrize(("name", "folder"), cases())
def test_query_matches_oracle(spark, con, name, folder):
    df = E.queries()[name](spark, folder)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con[folder].execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    idx = [dcols.index(c) for c in cols]
    assert rows_of(cols, srows) == rows_of(cols, [tuple(r[i] for i in idx) for r in drows])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "res_mean" in df.columns


def test_every_query_has_a_callable_and_oracle_names_are_known():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100
