"""Date grids and forward fills over keyed series (long layout).

``gap_fill`` is the workhorse: every series gets one row per day of its own
``[min(date), max(date)]`` span; a day without an observation takes the last value
before it. It never builds a separate spine to join against: each observation is
expanded with ``explode(sequence(date, next_date - 1))``, where ``next_date`` (a ``lead``)
and the carried value come from one window per series, so no cross join or per-series
collection happens. ``block_days`` switches to the blocked scan
(``rateflow.operators.blocks``), which spreads one long series over many tasks.

``date_spine`` + ``spine_left_join`` + ``forward_fill`` are the literal, step-by-step form
(spine, left join, LAST_VALUE IGNORE NULLS), kept as operators of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.operators.blocks import scan


def _keys(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def series_span(df: DataFrame, keys=("series_id",), date: str = "date") -> DataFrame:
    """Per series: first and last date, ``DATEDIFF`` in days and the number of grid days."""
    keys = _keys(keys)
    return (
        df.groupBy(*keys)
        .agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))
        .withColumn("day_diff", F.date_diff(F.col("max_date"), F.col("min_date")).cast("bigint"))
        .withColumn("n_days", F.col("day_diff") + 1)
    )


def date_spine(df: DataFrame, keys=("series_id",), date: str = "date", step_days: int = 1) -> DataFrame:
    """One row per series and grid day from the series' own min to max date.

    The span is a per-series aggregate (partial aggregation, nothing returns to the
    driver); the grid is generated by ``explode(sequence(...))`` on the executors.
    """
    keys = _keys(keys)
    span = df.groupBy(*keys).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    step = F.expr(f"INTERVAL {int(step_days)} DAYS")
    return span.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias(date))


def spine_left_join(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value") -> DataFrame:
    """``spine LEFT JOIN observations USING (keys, date)``: grid days without data get NULL."""
    keys = _keys(keys)
    spine = date_spine(df, keys, date)
    return spine.join(df.select(*keys, date, value), on=keys + [date], how="left")


def forward_fill(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                 out: str | None = None, block_days: int | None = None) -> DataFrame:
    """``COALESCE(v, LAST_VALUE(v IGNORE NULLS) OVER (ROWS UNBOUNDED PRECEDING))`` per series.

    NULL is missing; 0 is a value and is carried. Leading NULLs stay NULL.
    """
    keys = _keys(keys)
    out = out or value
    s = scan(df, keys, date, [value], block_days=block_days, ffill=True)
    return s.withColumn(out, F.col(f"{value}__ffill")).drop(f"{value}__ffill")


def forward_fill_nonzero(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                         out: str | None = None, block_days: int | None = None,
                         tiebreak: str | None = None) -> DataFrame:
    """Forward fill where both NULL *and 0* are missing (the array UDF's rule), as double.

    Leading missing values become NULL; every other missing value takes the last valid one.
    ``tiebreak`` orders rows that share a date (e.g. the frequency of a UNION ALL).
    """
    keys = _keys(keys)
    out = out or value
    tmp = "_rf_valid"
    valid = F.when(F.col(value).isNotNull() & (F.col(value) != 0), F.col(value).cast("double"))
    order = [date] if tiebreak is None else [date, tiebreak]
    s = scan(df.withColumn(tmp, valid), keys, order, [tmp], block_days=block_days, ffill=True)
    return s.withColumn(out, F.col(f"{tmp}__ffill")).drop(tmp, f"{tmp}__ffill")


def gap_fill(
    df: DataFrame,
    keys=("series_id",),
    date: str = "date",
    value: str = "value",
    missing: str = "zero",
    block_days: int | None = None,
) -> DataFrame:
    """Complete daily grid per series with forward fill.

    ``missing='zero'`` (parity with the reference's load step): NULL observations become 0
    first; 0 is then a value and is carried. ``missing='null'``: NULL observations are gaps
    and take the last non-NULL value. Output: ``keys, date, value`` with
    ``max - min + 1`` rows per series.
    """
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    keys = _keys(keys)
    v = F.col(value)
    if missing == "zero":
        v = F.coalesce(v, F.lit(0).cast(df.schema[value].dataType))
    obs = df.select(*keys, F.col(date), v.alias(value))
    s = scan(obs, keys, date, [value], block_days=block_days, ffill=True, next_order=True)
    end = F.when(F.col("__next").isNull(), F.col(date)).otherwise(
        F.greatest(F.col(date), F.date_sub(F.col("__next"), 1))
    )
    return s.select(
        *keys,
        F.explode(F.sequence(F.col(date), end, F.expr("INTERVAL 1 DAYS"))).alias(date),
        F.col(f"{value}__ffill").alias(value),
    )


def gap_fill_spine(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                   missing: str = "zero") -> DataFrame:
    """The literal form of ``gap_fill``: spine, left join, forward fill. Same result."""
    keys = _keys(keys)
    v = F.col(value)
    if missing == "zero":
        v = F.coalesce(v, F.lit(0).cast(df.schema[value].dataType))
    obs = df.select(*keys, F.col(date), v.alias(value))
    joined = spine_left_join(obs, keys, date, value)
    return forward_fill(joined, keys, date, value)
