"""JSON-lines source — one event per line, raw bytes kept for the guards.

Each line is stripped of Unicode whitespace (``(?U)\\s``; Spark's ``trim``
strips spaces only) and blank lines are skipped. Lines that are not valid
UTF-8 are passed through untouched: stripping would re-encode them, and G1
must see the original bytes. JSON validity is *not* decided here — G3 does
it, so a bad line is quarantined with a reason instead of silently lost
(``drop_invalid=True`` gives the reader's drop-and-warn behaviour).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.jsonvalue import strict_parts, strict_value

log = logging.getLogger(__name__)

DROPPED = "eventlake_dropped"
_STRIP = r"(?U)^\s+|\s+$"
_WS = r"(?U)\s"


def strip_blank(lines: DataFrame, value: str = "value") -> DataFrame:
    """Strip Unicode whitespace from each line and drop blank lines -> ``value BINARY``."""
    return _shape(lines.select(F.col(value).cast("string").alias("value")))


def _shape(lines: DataFrame) -> DataFrame:
    """Drop blank lines (tested on the raw line), then strip the rest.

    Testing blankness on the raw line, not on the stripped one, keeps the
    strip out of the pushed-down filter: it runs once per line.
    """
    line = F.col("value")
    ok = F.call_function("is_valid_utf8", line)
    blank = ok & line.rlike(r"(?U)^\s*$")
    # The strip can only change a line that starts or ends with whitespace; testing
    # those two characters first keeps the regex off the (typical) clean line.
    padded = F.substring(line, 1, 1).rlike(_WS) | F.substring(line, -1, 1).rlike(_WS)
    stripped = F.when(ok & padded, F.regexp_replace(line, _STRIP, "")).otherwise(line)
    return lines.filter(~blank).select(stripped.cast("binary").alias("value"))


def read_jsonl(spark: SparkSession, path, streaming: bool = False, drop_invalid: bool = False,
               max_files_per_trigger: int | None = None, clean_source: str | None = None,
               archive_dir: str | None = None, max_file_age: str | None = None,
               dropped: Observation | None = None) -> DataFrame:
    """Lines of JSON-lines file(s) at ``path`` as ``value BINARY``.

    ``drop_invalid`` leaves out lines that are not one JSON value in UTF-8. They are counted in
    the job that reads the lines: by ``dropped`` (see ``warn_dropped``), in a stream under
    ``DROPPED`` among each batch's observed metrics.

    ``streaming=True`` returns a file-source stream (new files are picked up
    per trigger, offsets kept in the query checkpoint). The file source lists
    its folder on every trigger, so a landing zone that only grows slows every
    batch: ``clean_source`` (``"archive"`` with ``archive_dir``, or ``"delete"``)
    moves committed files away and ``max_file_age`` bounds what is listed.
    """
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
        if clean_source:
            r = r.option("cleanSource", clean_source)
            if archive_dir:
                r = r.option("sourceArchiveDir", archive_dir)
        if max_file_age:
            r = r.option("maxFileAge", max_file_age)
        lines = r.load(path)
    else:
        lines = spark.read.text(path)
    out = _shape(lines)
    if drop_invalid:
        text = F.col("value").cast("string")
        utf8 = F.call_function("is_valid_utf8", text)
        arr, obj_ok = strict_parts(text)
        # a generator, so that each wrapper is parsed once (as in ``guards.classify``)
        parts = out.select("value", F.inline(F.array(F.struct(F.when(utf8, arr).alias("__arr"), F.when(utf8, obj_ok).alias("__ok")))))
        marked = parts.select("value", F.coalesce(strict_value(F.col("__arr"), F.col("__ok")).isNotNull(), F.lit(False)).alias("__valid"))
        out = marked.observe(dropped if dropped is not None else DROPPED, F.count_if(~F.col("__valid")).alias("dropped")) \
            .filter("__valid").select("value")
    return out


def warn_dropped(dropped: Observation, path) -> int:
    """After the job that read the lines: how many were dropped, with a warning if any were."""
    n = int(dropped.get["dropped"])
    if n:
        log.warning("%s: %d lines are not JSON and were dropped", path, n)
    return n
