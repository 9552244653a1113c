"""Running window state per series: ``plain_scan`` and the blocked ``prefix_scan``.

``plain_scan`` is one ``Window.partitionBy(series).orderBy(date)``: a whole series goes to
one task, which is bounded when rows are unique per (series, day). ``prefix_scan`` cuts
every series into date blocks so that a very long series spreads over many tasks:

1. one shuffle on ``(keys, block)`` (an explicit repartition); inside each block the running
   state comes from ordinary window functions (lag, last-ignore-nulls, count/avg/var_pop,
   lead);
2. a summary per block (last values, count, mean, M2) comes from plain aggregates over the
   same exchange, so it is not shuffled again; the summaries (one row per block, tiny) are
   folded into an *exclusive* prefix per series with a second window;
3. the prefix is joined back on ``(keys, block)``. The big side is already partitioned on
   those keys, so only the small prefix side moves (or AQE broadcasts it when its
   measured size is small).

Moments are merged with the pairwise update of Chan, Golub and LeVeque, so the expanding
standard deviation equals the single-window one up to rounding in the last bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLK = "_rf_blk"
_EPOCH = "1970-01-01"


def block_of(date: Column | str, block_days: int) -> Column:
    """Block number of a date: whole ``block_days`` periods since 1970-01-01."""
    d = F.col(date) if isinstance(date, str) else date
    return F.floor(F.datediff(d, F.lit(_EPOCH).cast("date")) / F.lit(block_days)).cast("int")


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    cols: Sequence[str],
    *,
    block_days: int = 366,
    prev: bool = False,
    ffill: bool = False,
    moments: bool = False,
    next_order: bool = False,
) -> DataFrame:
    """Add running columns per value column ``c`` (in the order of ``cols``):

    - ``prev``: ``<c>__prev`` = value on the preceding row of the series (LAG 1, NULLs kept);
    - ``ffill``: ``<c>__ffill`` = last non-NULL value up to this row;
    - ``moments``: ``<c>__sd`` = sample standard deviation of the non-NULL values so far
      (NULL below two values);
    - ``next_order``: ``__next`` = the ``order`` value of the following row of the series.

    ``order`` is a DATE column, or a list whose first element is the DATE column and the
    rest break ties; rows are assumed unique per ``(keys, order)``.
    """
    keys = list(keys)
    order_cols = [order] if isinstance(order, str) else list(order)
    order = order_cols[0]
    part = keys + [BLK]
    wb = Window.partitionBy(*part).orderBy(*order_cols)
    wrun = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.struct(*[F.col(c) for c in order_cols])

    # One shuffle on (keys, block). Both the window below and the block aggregate find
    # their input already partitioned, so the exchange is written once and read twice.
    d = df.withColumn(BLK, block_of(order, block_days)).repartition(*part)

    # --- 1. in-block running state ------------------------------------------------------
    inner: list[Column] = []
    if prev:
        inner.append(F.row_number().over(wb).alias("_rf_rn"))
    if next_order:
        inner.append(F.lead(F.col(order)).over(wb).alias("_rf_lead"))
    for i, c in enumerate(cols):
        x = F.col(c)
        if prev:
            inner.append(F.lag(x).over(wb).alias(f"_rf{i}_p"))
        if ffill:
            inner.append(F.last(x, ignorenulls=True).over(wrun).alias(f"_rf{i}_f"))
        if moments:
            xd = x.cast("double")
            inner.append(F.count(xd).over(wrun).alias(f"_rf{i}_n"))
            inner.append(F.avg(xd).over(wrun).alias(f"_rf{i}_m"))
            inner.append((F.var_pop(xd).over(wrun) * F.count(xd).over(wrun)).alias(f"_rf{i}_q"))
    scanned = d.select("*", *inner)

    # --- 2. one row per block from plain aggregates -> exclusive prefix over blocks ------
    aggs: list[Column] = []
    if next_order:
        aggs.append(F.min(F.col(order)).alias("_rf_first"))
    for i, c in enumerate(cols):
        x = F.col(c)
        if prev:
            aggs.append(F.max_by(x, pos).alias(f"_rf{i}_last"))
        if ffill:
            aggs.append(F.max_by(x, F.when(x.isNotNull(), pos)).alias(f"_rf{i}_bf"))
        if moments:
            xd = x.cast("double")
            aggs += [
                F.count(xd).alias(f"_rf{i}_bn"),
                F.coalesce(F.avg(xd), F.lit(0.0)).alias(f"_rf{i}_bm"),
                F.coalesce(F.var_pop(xd) * F.count(xd), F.lit(0.0)).alias(f"_rf{i}_bq"),
            ]
    blocks = d.groupBy(*part).agg(*aggs)

    wp = Window.partitionBy(*keys).orderBy(BLK) if keys else Window.orderBy(BLK)
    wex = wp.rowsBetween(Window.unboundedPreceding, -1)
    wall = wp.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry: list[Column] = [F.col(k) for k in part]
    if next_order:
        carry.append(F.lead("_rf_first").over(wp).alias("_rf_cnext"))
    for i, _ in enumerate(cols):
        if prev:
            carry.append(F.lag(f"_rf{i}_last").over(wp).alias(f"_rf{i}_cp"))
        if ffill:
            carry.append(F.last(f"_rf{i}_bf", ignorenulls=True).over(wex).alias(f"_rf{i}_cf"))
        if moments:
            n, m, q = F.col(f"_rf{i}_bn"), F.col(f"_rf{i}_bm"), F.col(f"_rf{i}_bq")
            # shift by a representative mean of the series to keep the sums well conditioned
            k = F.first(F.when(n > 0, m), ignorenulls=True).over(wall)
            carry += [
                F.coalesce(F.sum(n).over(wex), F.lit(0)).alias(f"_rf{i}_cn"),
                F.coalesce(F.sum(n * (m - k)).over(wex), F.lit(0.0)).alias(f"_rf{i}_cs1"),
                F.coalesce(F.sum(q + n * (m - k) * (m - k)).over(wex), F.lit(0.0)).alias(f"_rf{i}_cs2"),
                F.coalesce(k, F.lit(0.0)).alias(f"_rf{i}_ck"),
            ]
    prefix = blocks.select(*carry)

    # --- 3. join the carried state back (big side keeps its partitioning) ----------------
    j = scanned.join(prefix, on=part, how="left")
    out: list[Column] = []
    if next_order:
        out.append(F.coalesce(F.col("_rf_lead"), F.col("_rf_cnext")).alias("__next"))
    for i, c in enumerate(cols):
        if prev:
            out.append(F.when(F.col("_rf_rn") == 1, F.col(f"_rf{i}_cp")).otherwise(F.col(f"_rf{i}_p"))
                       .alias(f"{c}__prev"))
        if ffill:
            out.append(F.coalesce(F.col(f"_rf{i}_f"), F.col(f"_rf{i}_cf")).alias(f"{c}__ffill"))
        if moments:
            n = F.col(f"_rf{i}_n").cast("double")
            m = F.col(f"_rf{i}_m")
            q = F.coalesce(F.col(f"_rf{i}_q"), F.lit(0.0))
            n0 = F.col(f"_rf{i}_cn").cast("double")
            s1 = F.col(f"_rf{i}_cs1")
            s2 = F.col(f"_rf{i}_cs2")
            k = F.col(f"_rf{i}_ck")
            mean0 = k + s1 / F.nullif(n0, F.lit(0.0))
            m20 = s2 - s1 * s1 / F.nullif(n0, F.lit(0.0))
            total = n0 + n
            m2 = (
                F.when(n0 == 0, q)
                .when(n == 0, m20)
                .otherwise(m20 + q + (m - mean0) * (m - mean0) * n0 * n / total)
            )
            sd = F.when(total >= 2, F.sqrt(F.greatest(m2, F.lit(0.0)) / (total - 1)))
            out.append(sd.alias(f"{c}__sd"))
    return j.select(*[F.col(c) for c in df.columns], *out)


def plain_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    cols: Sequence[str],
    *,
    prev: bool = False,
    ffill: bool = False,
    moments: bool = False,
    next_order: bool = False,
) -> DataFrame:
    """Same output as ``prefix_scan`` with one unblocked window per series.

    For inputs whose window partitions are bounded by construction, e.g. a wide table with
    one row per calendar date: one shuffle, no block summary and no join.
    """
    keys = list(keys)
    order_cols = [order] if isinstance(order, str) else list(order)
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(*order_cols)
    wrun = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out: list[Column] = []
    if next_order:
        out.append(F.lead(F.col(order_cols[0])).over(w).alias("__next"))
    for c in cols:
        x = F.col(c)
        if prev:
            out.append(F.lag(x).over(w).alias(f"{c}__prev"))
        if ffill:
            out.append(F.last(x, ignorenulls=True).over(wrun).alias(f"{c}__ffill"))
        if moments:
            out.append(F.stddev_samp(x.cast("double")).over(wrun).alias(f"{c}__sd"))
    return df.select("*", *out)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    cols: Sequence[str],
    *,
    block_days: int | None = None,
    **what: bool,
) -> DataFrame:
    """``plain_scan`` when ``block_days`` is None, else ``prefix_scan`` with that block size.

    With unique ``(keys, date)`` a series window holds at most one row per day of its span
    (about 36,500 rows a century), whatever the raw volume, so the plain per-series window
    is bounded and is the default. Blocks split a series over several tasks: for a few
    very long series, or inputs not yet reduced to one row per day.
    """
    if block_days is None:
        return plain_scan(df, keys, order, cols, **what)
    return prefix_scan(df, keys, order, cols, block_days=block_days, **what)
