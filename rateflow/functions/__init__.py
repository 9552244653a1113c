"""Column-level functions (all built-in Spark expressions)."""

from rateflow.functions.arrays import forward_fill_array
from rateflow.functions.numeric import abs_pct_change_expr, fixed, stddev_to_fixed, usd_conversion
from rateflow.functions.sql import register_sql_functions
from rateflow.functions.strings import (
    NULL_MARKERS,
    base_name,
    null_if_marker,
    route_frequency,
    series_from_partition_dir,
    series_from_path,
    strip_prefix,
)

__all__ = [
    "NULL_MARKERS",
    "abs_pct_change_expr",
    "base_name",
    "fixed",
    "forward_fill_array",
    "null_if_marker",
    "register_sql_functions",
    "route_frequency",
    "series_from_partition_dir",
    "series_from_path",
    "stddev_to_fixed",
    "strip_prefix",
    "usd_conversion",
]
