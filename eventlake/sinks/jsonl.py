"""K4: JSON-lines sink of raw messages (one per line, bytes as they arrived)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, value: str = "value", mode: str = "overwrite",
                compression: str | None = None) -> None:
    w = df.select(F.col(value).cast("string").alias("value")).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
