"""Series operators: fills, scans, metrics, harmonization and serving reads."""

from rateflow.operators.blocks import plain_scan, prefix_scan, scan
from rateflow.operators.fill import (
    date_spine,
    forward_fill,
    forward_fill_nonzero,
    gap_fill,
    gap_fill_spine,
    series_span,
    spine_left_join,
)
from rateflow.operators.harmonize import (
    add_conversions,
    combined_currency,
    harmonize,
    harmonize_outer_join,
    harmonize_pivot,
    union_daily_monthly,
    weekly_observations,
)
from rateflow.operators.metrics import (
    abs_pct_change,
    expanding_stddev,
    lag_value,
    metrics_skeleton,
    series_metrics,
    volatility,
    wide_metrics,
)
from rateflow.operators.serve import latest, serve_latest, serve_metric_group, sort_series

__all__ = [
    "abs_pct_change", "add_conversions", "combined_currency", "date_spine", "expanding_stddev",
    "forward_fill", "forward_fill_nonzero", "gap_fill", "gap_fill_spine", "harmonize",
    "harmonize_outer_join", "harmonize_pivot", "lag_value", "latest", "metrics_skeleton",
    "plain_scan", "prefix_scan", "scan", "serve_latest", "serve_metric_group", "series_metrics",
    "series_span", "sort_series", "spine_left_join", "union_daily_monthly", "volatility", "weekly_observations",
    "wide_metrics",
]
