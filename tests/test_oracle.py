"""Every registered query against its oracle SQL (DuckDB) on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_temperature_c" in df.columns


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows, scols = df.collect(), df.columns
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 1


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="test data not present")
@pytest.mark.parametrize("name", ["anomaly_detection", "city_temperature_rankings"])
def test_skew_paths_match_oracle(spark, name):
    """Force the salted shuffle join and a multi-bucket rank; results must not change."""
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for t in ("events", "nation", "region"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    conf = {"stratus.broadcast.maxRows": "0", "stratus.join.rowsPerTask": "50",
            "stratus.rank.valuesPerBucket": "4"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES[name](spark, sf)
        srows, scols = df.collect(), df.columns
    finally:
        for k in conf:
            spark.conf.unset(k)
    cur = c.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert rows_of(scols, srows) == rows_of(dcols, cur.fetchall())
