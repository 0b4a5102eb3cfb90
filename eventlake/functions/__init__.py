"""Column-level building blocks (all built-in Spark expressions, no Python UDFs)."""

from eventlake.functions.jsonvalue import (
    strict_parse, variant_kind, is_object, path_of,
)
from eventlake.functions.timecols import (
    floor_ms, epoch_ms_to_ts, ts_to_epoch_us, partition_columns,
    lag_seconds, DEFAULT_TEMPLATE,
)

__all__ = [
    "strict_parse", "variant_kind", "is_object", "path_of",
    "floor_ms", "epoch_ms_to_ts", "ts_to_epoch_us", "partition_columns",
    "lag_seconds", "DEFAULT_TEMPLATE",
]
