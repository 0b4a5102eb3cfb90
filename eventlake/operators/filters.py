"""Filters and limits."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.timecols import DEFAULT_TEMPLATE, format_field

# Fixed value: the reference's default wanted-collections list.
DEFAULT_WANTED = ("app.bsky.feed.post,app.bsky.feed.like,app.bsky.feed.repost,"
                  "app.bsky.graph.follow,app.bsky.graph.block")


def parse_wanted(spec: str | None) -> list[str]:
    """Comma list, each item trimmed, empty items ignored."""
    if not spec:
        return []
    return [c.strip() for c in spec.split(",") if c.strip()]


def wanted_collections(df: DataFrame, spec: str | None = DEFAULT_WANTED,
                       col: str = "commit_collection") -> DataFrame:
    """keep events whose collection is wanted; events without one always pass.

    An empty spec lets everything through. The list is a literal IN-set, so the
    predicate stays in generated code and pushes to a Parquet scan.
    """
    wanted = parse_wanted(spec)
    if not wanted:
        return df
    if col not in df.columns:
        return df
    c = F.col(f"`{col}`")
    return df.filter(c.isNull() | c.isin(wanted))


def lake_slice(df: DataFrame, year=None, month=None, day=None, hour=None, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """conditions on the string partition columns of ``template`` -> ``PartitionFilters``.

    A segment whose fields are all given is an equality on its whole text. One that has other
    fields too is matched around the given ones; a field that no segment holds cannot be
    sliced by and raises.

    On a lake opened at its root Spark still lists every folder before pruning;
    ``sources.lake.open_lake_slice`` also narrows the listing to the folder prefix.
    """
    given = {n: format_field(n, v) for n, v in (("year", year), ("month", month), ("day", day), ("hour", hour)) if v is not None}
    cond, used = F.lit(True), set()
    for segment in template.strip("/").split("/"):
        name, form = segment.split("=", 1)
        fields = re.findall(r"\{(\w+)\}", form)
        if not given.keys() & set(fields):
            continue
        used |= given.keys() & set(fields)
        if given.keys() >= set(fields):
            cond = cond & (F.col(f"`{name}`") == F.lit(form.format(**given)))
        else:
            parts = re.split(r"\{(\w+)\}", form)
            pattern = "".join(("\\d+" if p not in given else given[p]) if i % 2 else f"\\Q{p}\\E" if p else "" for i, p in enumerate(parts))
            cond = cond & F.col(f"`{name}`").rlike(f"^{pattern}$")
    if missing := given.keys() - used:
        raise ValueError(f"the template {template!r} has no field for {sorted(missing)}")
    return df.filter(cond)


def capture(df: DataFrame, n: int = 10, order=("time_us", "did")) -> DataFrame:
    """the first ``n`` events in a stated order (top-k, not a full sort)."""
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in order]).limit(int(n))
