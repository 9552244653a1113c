"""Serving reads of the metrics tables: newest k rows, one metric group, oldest first.

``orderBy(desc).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps its own top
k and only k rows per task reach the final merge, so nothing but k rows leaves the
executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metric group names and the column prefixes that make them up.
GROUPS = ("rates", "changes", "volatility")
CHANGE_PREFIX = "rate_change_percent_"
VOL_PREFIX = "volatility_"


def sort_series(df: DataFrame, cols: Sequence[str] | str = ("date",)) -> DataFrame:
    """Ascending sort: only at the serving edge, never before an aggregate or write."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.orderBy(*cols)


def latest(df: DataFrame, date: str, k: int = 20, ascending: bool = False) -> DataFrame:
    """``ORDER BY date DESC LIMIT k``; with ``ascending=True`` the k rows are then re-sorted
    oldest first (for plotting)."""
    top = df.orderBy(F.col(date).desc()).limit(k)
    return top.orderBy(F.col(date).asc()) if ascending else top


def metric_columns(df: DataFrame, date: str, group: str, rates: Sequence[str]) -> list[str]:
    """Columns of one metric group, derived from the rate columns of the table."""
    if group not in GROUPS:
        raise ValueError(f"group must be one of {GROUPS}")
    if group == "rates":
        return list(rates)
    prefix = CHANGE_PREFIX if group == "changes" else VOL_PREFIX
    return [prefix + c.lower() for c in rates]


def serve_metric_group(df: DataFrame, date: str, group: str, rates: Sequence[str]) -> DataFrame:
    """``SELECT date, <columns of the group>``."""
    return df.select(date, *metric_columns(df, date, group, rates))


def serve_latest(df: DataFrame, date: str, rates: Sequence[str], k: int = 20, group: str = "rates",
                 ascending: bool = True) -> DataFrame:
    """Newest k rows of one metric group, oldest first: what a dashboard plots."""
    return latest(serve_metric_group(df, date, group, rates), date, k, ascending)
