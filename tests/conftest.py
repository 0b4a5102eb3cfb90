import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import checkpoint_root, get_spark
    s = get_spark("local[*]", app="eventlake-tests", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # the shared folder if configured, else a local one (tests only)
    yield s


@pytest.fixture()
def run_lines(spark):
    """Classify, infer and flatten raw lines; returns (rows, schema, reasons)."""
    from pyspark.sql import functions as F
    from eventlake.plans.ingest import flatten_events, prepare

    def run(lines):
        data = [(x.encode("utf-8") if isinstance(x, str) else bytes(x),) for x in lines]
        raw = spark.createDataFrame(data, "value binary")
        c, schema, counts = prepare(raw)
        flat = flatten_events(c.filter(F.col("reason").isNull()), schema)
        rows = [r.asDict(recursive=True) for r in flat.collect()]
        reasons = [r["reason"] for r in c.select("reason").collect()]
        return rows, flat.schema, reasons

    return run
