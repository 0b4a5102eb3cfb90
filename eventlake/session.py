"""Session helpers: builder defaults, scoped conf changes and a shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# The one session setting every eventlake plan relies on: of duplicate JSON keys the last
# wins (as a JSON-lines reader in Python does). Spark reads it when a plan is run, so it has
# to stay set. Times need no setting: all conversions are zone-free.
REQUIRED_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# For writes to file: paths (other stores do not read these). Without its native library Hadoop
# starts four processes per file there, to set the modes of the file and of the checksum beside it:
# 30 ms each, and until such a process runs its own program it counts with all of Spark's memory.
# The raw file system writes files alone, with the modes that the process's umask gives.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def get_spark(master: str | None = None, app: str = "eventlake", **conf) -> SparkSession:
    """Build (or reuse) a session with sane defaults for this engine.

    On a cluster ``master`` stays None and the launcher decides; locally it is
    ``local[*]``. AQE stays on so shuffle partitions coalesce and skewed join
    partitions split at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.maxMetadataStringLength": "2000",  # plans name whole paths
        **REQUIRED_CONF,
    }
    defaults.update(conf)
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure_session(spark)
    return spark


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to a session someone else built."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextlib.contextmanager
def conf_scope(spark: SparkSession, **settings):
    """Temporarily set SQL confs (keys with dots passed as a dict via **{...})."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage. Only
    when it is unset (local runs, tests) a fresh local folder is made and
    registered, so that ``DataFrame.checkpoint()`` and our written tables agree.
    ``spark.checkpoint.dir`` is a core setting that a running session refuses
    to change, so the fallback goes through ``SparkContext.setCheckpointDir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            # A machine-local folder is invisible to other executors: refuse.
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                               "(HDFS / object store) that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared checkpoint root (not created)."""
    return f"{checkpoint_root(spark)}/eventlake/{name}-{uuid.uuid4().hex[:12]}"
