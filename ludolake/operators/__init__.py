from .arrays import assemble_name_arrays, explode_bridge, lookup_name_arrays, valid_bridge
from .latest import latest_by_key, upsert_latest
from .order import (
    exact_percentile,
    global_index,
    page,
    page_numbers,
    percentile_buckets,
    top_n,
    value_counts,
)
from .pivot import pivot_metrics

__all__ = [
    "assemble_name_arrays",
    "exact_percentile",
    "explode_bridge",
    "global_index",
    "latest_by_key",
    "lookup_name_arrays",
    "page",
    "page_numbers",
    "percentile_buckets",
    "pivot_metrics",
    "top_n",
    "upsert_latest",
    "valid_bridge",
    "value_counts",
]
