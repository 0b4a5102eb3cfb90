"""DataFrame operators: guards, filters, flatten, derived columns, schema, reports."""

from eventlake.operators.guards import (
    classify, guard_size, guard_utf8, guard_time_us, guard_object,
    MAX_MESSAGE_BYTES, REASONS,
)
from eventlake.operators.filters import wanted_collections, lake_slice, capture, DEFAULT_WANTED
from eventlake.operators.flatten import flatten, flatten_columns, flattened_schema
from eventlake.operators.derive import (
    with_event_ms, with_epoch_timestamps, with_partitions, with_lag, project_event,
    DEFAULT_PATHS, DECLARED_COLUMNS,
)
from eventlake.operators.schema import (
    normalize, conform, merge_schemas, evolve_frame,
)
from eventlake.operators.paths import collect_pairs, path_kinds, schema_of_pairs, shapes_of, with_shape
from eventlake.operators.reports import (
    top_accounts, event_counters, reason_counts, histogram, current_lag, lake_inventory,
)

__all__ = [
    "classify", "guard_size", "guard_utf8", "guard_time_us",
    "guard_object", "MAX_MESSAGE_BYTES", "REASONS", "wanted_collections", "lake_slice", "capture",
    "DEFAULT_WANTED", "flatten", "flatten_columns", "flattened_schema", "with_event_ms",
    "with_epoch_timestamps", "with_partitions", "with_lag", "project_event", "DEFAULT_PATHS",
    "DECLARED_COLUMNS", "collect_pairs", "path_kinds", "schema_of_pairs", "shapes_of", "with_shape", "normalize", "conform", "merge_schemas",
    "evolve_frame", "top_accounts", "event_counters", "reason_counts",
    "histogram", "current_lag", "lake_inventory",
]
