"""rateflow: rate time series on Spark DataFrames.

Gap fill and forward fill per series, harmonized wide tables with reciprocal conversion,
percent change and expanding volatility, batch and streaming refresh, serving reads.
"""

from rateflow.functions import forward_fill_array, usd_conversion
from rateflow.operators import (
    abs_pct_change,
    combined_currency,
    gap_fill,
    harmonize,
    series_metrics,
    volatility,
    wide_metrics,
)

__version__ = "0.1.0"

__all__ = [
    "abs_pct_change",
    "combined_currency",
    "forward_fill_array",
    "gap_fill",
    "harmonize",
    "series_metrics",
    "usd_conversion",
    "volatility",
    "wide_metrics",
]
