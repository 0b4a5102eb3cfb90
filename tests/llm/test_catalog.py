import os
import re

import duckdb
import pytest

from eventlake.llm import catalog
from tests.conftest import SF_SMALL
from tools.check_oracles import digest


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES] == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_runs_and_matches_its_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows or name == "op3_decontaminate"
    if "conv_id" not in df.columns and "item_id" not in df.columns:
        assert sorted(r.doc_id for r in rows) == sorted(
            r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())
    if name in catalog.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "conversations", "labels", "benchmark"):
            if os.path.exists(p := f"{SF_SMALL}/{t}.parquet"):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        res = con.execute(catalog.ORACLES[name])
        cols, want = [d[0] for d in res.description], res.fetchall()
        assert sorted(cols) == sorted(df.columns) and len(want) == len(rows)
        assert digest(df.columns, rows) == digest(cols, want)
