"""Every registered query against its DuckDB oracle on sf0.001 (rows, columns, values)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from eventlake.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracles import TABLES, digest

NAMES = sorted(QUERIES)  # other parts test their queries themselves


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["did", "event_type", "count"]
    assert len(df.collect()) == 10
