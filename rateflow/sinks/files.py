"""File sinks for landed series: CSV with a header per frequency/series folder, JSON payloads.

Files are written by the executors in parallel (one file per task and folder); the layout
``<root>/freq=DAILY/series_id=DP1/part-*.csv`` is what ``rateflow.sources.files`` reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_series_csv(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("freq", "series_id"),
    header: bool = True,
    null_value: str = ".",
    quote_all: bool = False,
    mode: str = "overwrite",
) -> str:
    """CSV with a header, no index column, one folder per partition value."""
    w = df.write.mode(mode).option("header", header).option("nullValue", null_value)
    if quote_all:
        w = w.option("quoteAll", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_series_json(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("series_id",),
    date: str = "date",
    value: str = "value",
    missing: str = ".",
    mode: str = "overwrite",
) -> str:
    """JSON payloads ``{"observations": [{"date": "...", "value": "..."}, ...]}``, one per
    series and month (a bounded array), values as text with ``.`` for missing, in
    folders ``<key>=<id>``."""
    keys = list(keys)
    obs = F.struct(
        F.date_format(F.col(date), "yyyy-MM-dd").alias("date"),
        F.coalesce(F.col(value).cast("string"), F.lit(missing)).alias("value"),
    )
    payload = df.groupBy(*keys, F.trunc(F.col(date), "MM").alias("_rf_month")).agg(
        F.array_sort(F.collect_list(obs)).alias("observations"),
        F.count(F.lit(1)).alias("count"),
    )
    payload.drop("_rf_month").write.mode(mode).partitionBy(*keys).json(path)
    return path
