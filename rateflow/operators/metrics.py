"""Rate metrics: LAG, absolute percent change, expanding volatility.

Both the long layout (``keys`` = series columns) and the wide harmonized layout
(``keys=[]``, one column per series) go through one scan, so LAG and the expanding
deviation share a single window node and a single shuffle. Per-series windows are bounded
by the calendar; the wide table has one row per date. ``block_days`` switches either to the
blocked prefix scan, which splits a series (or the date axis) over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateflow.functions.numeric import abs_pct_change_expr, stddev_to_fixed
from rateflow.operators.blocks import scan
from rateflow.operators.fill import _keys


def lag_value(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
              out: str = "prev_value", block_days: int | None = None) -> DataFrame:
    """``LAG(value, 1) OVER (PARTITION BY keys ORDER BY date)``; NULL on the first row."""
    s = scan(df, _keys(keys), date, [value], block_days=block_days, prev=True)
    return s.withColumnRenamed(f"{value}__prev", out)


def expanding_stddev(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                     out: str = "stddev_value", block_days: int | None = None) -> DataFrame:
    """``STDDEV_SAMP(value) OVER (PARTITION BY keys ORDER BY date)`` (expanding, double)."""
    s = scan(df, _keys(keys), date, [value], block_days=block_days, moments=True)
    return s.withColumnRenamed(f"{value}__sd", out)


def abs_pct_change(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                   out: str = "rate_change_percent", precision: int = 10, scale: int = 4,
                   block_days: int | None = None) -> DataFrame:
    """Absolute percent change to the previous row; 0 on the first row and after NULL/0."""
    s = scan(df, _keys(keys), date, [value], block_days=block_days, prev=True)
    return s.withColumn(out, abs_pct_change_expr(value, f"{value}__prev", precision, scale)).drop(
        f"{value}__prev"
    )


def volatility(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
               out: str = "volatility", precision: int = 10, scale: int = 4,
               block_days: int | None = None) -> DataFrame:
    """Expanding sample deviation of the level, NULL -> 0, fixed point."""
    s = scan(df, _keys(keys), date, [value], block_days=block_days, moments=True)
    return s.withColumn(out, stddev_to_fixed(f"{value}__sd", precision, scale)).drop(f"{value}__sd")


def series_metrics(df: DataFrame, keys=("series_id",), date: str = "date", value: str = "value",
                   precision: int = 10, scale: int = 4, block_days: int | None = None) -> DataFrame:
    """Change and volatility per series in one pass (long layout)."""
    s = scan(df, _keys(keys), date, [value], block_days=block_days, prev=True, moments=True)
    return s.select(
        *df.columns,
        abs_pct_change_expr(value, f"{value}__prev", precision, scale).alias("rate_change_percent"),
        stddev_to_fixed(f"{value}__sd", precision, scale).alias("volatility"),
    )


def _by_column(wide: DataFrame, date: str, cols: list[str]) -> DataFrame:
    """``plain_scan`` of a wide table with one window per column instead of one for all.

    Values keep their types: the long layout has a value column per type among ``cols``."""
    types = dict(wide.dtypes)
    kinds = sorted({types[c] for c in cols})
    values = [f"_rf_v{i}" for i in range(len(kinds))]

    def row(at: int, c: str) -> Column:
        own = [F.col(f"`{c}`") if types[c] == k else F.lit(None).cast(k) for k in kinds]
        return F.struct(F.lit(at).alias("_rf_at"), *[x.alias(v) for x, v in zip(own, values)])

    long = wide.select(F.col(date), F.inline(F.array(*[row(i, c) for i, c in enumerate(cols)])))
    one = F.coalesce(*[F.col(v).cast("double") for v in values])
    # the double of whichever type the row has, for the deviation
    s = scan(long.withColumn("_rf_d", one), ["_rf_at"], date, values, prev=True)
    w = Window.partitionBy("_rf_at").orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("_rf_sd", F.stddev_samp("_rf_d").over(w))
    out: list[Column] = []
    for i, c in enumerate(cols):
        v = values[kinds.index(types[c])]
        for x, name in ((v, c), (f"{v}__prev", f"{c}__prev"), ("_rf_sd", f"{c}__sd")):
            out.append(F.max(F.when(F.col("_rf_at") == i, F.col(x))).alias(name))
    return s.groupBy(date).agg(*out)


def wide_metrics(
    wide: DataFrame,
    date: str,
    cols: Sequence[str],
    precision: int = 10,
    scale: int = 4,
    block_days: int | None = None,
    change_prefix: str = "rate_change_percent_",
    vol_prefix: str = "volatility_",
) -> DataFrame:
    """Metrics table over a wide table: date, the rate columns, then one change and one
    volatility column per rate (named ``<prefix><column in lower case>``).

    Windows run over the union of dates in the wide table, so a series is NULL outside its
    own span: its change there is 0 and its volatility keeps the last value.

    A wide table has one row per calendar date. By default its columns are laid out as rows,
    the windows run per column (a task holds one column, never the whole table), and one
    aggregate by date puts them side by side again: two shuffles, no join. ``block_days``
    switches to the blocked scan for very long date grids.
    """
    cols = list(cols)
    if not cols:
        return wide.select(date)
    if block_days is None:
        s = _by_column(wide, date, cols)
    else:
        s = scan(wide.select(date, *cols), [], date, cols, block_days=block_days, prev=True,
                        moments=True)
    return s.select(
        date,
        *cols,
        *[abs_pct_change_expr(c, f"{c}__prev", precision, scale).alias(change_prefix + c.lower()) for c in cols],
        *[stddev_to_fixed(f"{c}__sd", precision, scale).alias(vol_prefix + c.lower()) for c in cols],
    )


def metrics_skeleton(wide: DataFrame, date: str, cols: Sequence[str], precision: int = 10, scale: int = 4,
                     change_prefix: str = "rate_change_percent_", vol_prefix: str = "volatility_") -> DataFrame:
    """The metrics table before the update: rates plus typed NULL metric columns."""
    dec = f"decimal({precision},{scale})"
    cols = list(cols)
    return wide.select(
        date,
        *cols,
        *[F.lit(None).cast(dec).alias(change_prefix + c.lower()) for c in cols],
        *[F.lit(None).cast(dec).alias(vol_prefix + c.lower()) for c in cols],
    )
