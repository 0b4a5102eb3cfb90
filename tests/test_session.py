"""Scratch folder resolution when the session names no ``spark.checkpoint.dir``."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from eventlake.session import checkpoint_root, get_spark, scratch_path
spark = get_spark("local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
a, b = checkpoint_root(spark), checkpoint_root(spark)
assert a == b, (a, b)
assert scratch_path(spark, "x").startswith(a + "/eventlake/x-")
assert spark.range(5).checkpoint().count() == 5
print("OK")
"""


def test_checkpoint_root_falls_back_when_unset():
    conf_dir = tempfile.mkdtemp(prefix="eventlake-noconf-")  # no spark-defaults.conf in it
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("OK")


def test_own_files_are_written_without_checksum_files(spark, tmp_path):
    """Each would cost two more processes that set its mode, see PLAIN_FILES."""
    from eventlake.llm.common import written
    from eventlake.sinks.lake import write_lake
    rows = spark.range(20).selectExpr("id", "'2024' AS year", "CAST(id % 3 AS STRING) AS month")
    write_lake(rows, str(tmp_path / "lake"), "year={year}/month={month}", max_rows=2)
    scratch = written(rows, "plain-files")
    folder = scratch.inputFiles()[0].removeprefix("file:").replace("///", "/").rpartition("/")[0]
    for place in (str(tmp_path / "lake"), folder):
        names = [f for _, _, files in os.walk(place) for f in files]
        data = [f for f in names if f.endswith(".parquet") and not f.startswith(".")]
        assert data and not [f for f in names if f.endswith(".parquet.crc")]
    assert scratch.count() == spark.read.parquet(str(tmp_path / "lake")).count() == 20
