"""Rate-like observation series derived from the driver's TPC-H-style tables.

The driver has no exchange-rate files, so the series are re-aimed at ``orders``:

- a series is an order priority (``DP1`` .. ``DP5`` daily, ``MP1`` .. ``MP5`` monthly), or a
  priority within the customer's nation (``DP1_N07`` ...) for many, sparser series;
- the value of a series-day is the mean order price in thousands, rounded half-up to four
  places, as ``DECIMAL(18,4)``;
- a series-day whose orders are all still pending (status ``P``) has no settled price: its
  value is NULL, the role of the ``.`` marker in the raw files.

The mean is computed in whole cents with integer division, so it is exact at any scale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The five order priorities in their natural order, by first character.
PRIORITY_CODES = ("1", "2", "3", "4", "5")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def priority_ids(freq: str = "DAILY") -> list[str]:
    """Series ids of the priority series of one frequency (``DP1`` .. or ``MP1`` ..)."""
    prefix = "D" if freq == "DAILY" else "M"
    return [f"{prefix}P{c}" for c in PRIORITY_CODES]


def _half_up_mean_thousands(cents_sum, n):
    """round_half_up(cents_sum / 100 / 1000 / n, 4) with integer arithmetic."""
    q = F.expr(f"(2 * {cents_sum} + 10 * {n}) div (20 * {n})")
    return (q.cast("decimal(22,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")


def daily_parts(spark: SparkSession, sf_dir: str, key: str = "priority",
                start: str | None = None, end: str | None = None) -> DataFrame:
    """Per series code (``P1`` or ``P1_N07``) and day: price in cents, order count and
    settled-order count. Everything else is rolled up from these additive parts, so
    ``orders`` is scanned once for every frequency.

    ``key='nation_priority'`` joins ``customer``, which Spark broadcasts only while its
    measured size is under the broadcast threshold; beyond it the join is sort-merge.
    ``start <= order date < end`` (``yyyy-MM-dd``) is applied to the raw timestamp column, so
    it reaches the Parquet scan as a pushed filter (row groups outside are skipped).
    """
    orders = table(spark, sf_dir, "orders")
    if start:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        orders = orders.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    code = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1))
    if key == "nation_priority":
        cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
        code = F.concat(code, F.lit("_N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    elif key != "priority":
        raise ValueError("key must be 'priority' or 'nation_priority'")
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(100)).cast("bigint")
    return orders.groupBy(code.alias("code"), F.to_date("o_orderdate").alias("date")).agg(
        F.sum(cents).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(F.col("o_orderstatus") != "P", 1)).alias("_settled"),
    )


def _finish(parts: DataFrame, freq: str) -> DataFrame:
    if freq == "MONTHLY":
        parts = parts.groupBy("code", F.trunc("date", "MM").alias("date")).agg(
            F.sum("_cents").alias("_cents"), F.sum("_n").alias("_n"), F.sum("_settled").alias("_settled"))
    prefix = "D" if freq == "DAILY" else "M"
    return parts.select(
        F.concat(F.lit(prefix), F.col("code")).alias("series_id"),
        F.lit(freq).alias("freq"),
        "date",
        F.when(F.col("_settled") > 0, _half_up_mean_thousands("_cents", "_n")).alias("value"),
    )


def order_observations(spark: SparkSession, sf_dir: str, freq: str = "DAILY", key: str = "priority",
                       start: str | None = None, end: str | None = None) -> DataFrame:
    """Long observations ``(series_id, freq, date, value)`` from ``orders``: daily, or monthly
    rolled up from the daily parts (the monthly mean is total cents over total orders).

    ``key='priority'``: five series per frequency. ``key='nation_priority'``: one series per
    customer nation and priority. See ``daily_parts`` for the join and the date bounds.
    """
    if freq not in ("DAILY", "MONTHLY"):
        raise ValueError("freq must be DAILY or MONTHLY")
    return _finish(daily_parts(spark, sf_dir, key, start, end), freq)


def all_observations(spark: SparkSession, sf_dir: str, key: str = "priority") -> DataFrame:
    """Daily and monthly observations in one long table; both come from one set of daily
    parts, so ``orders`` is scanned and shuffled once (the second branch reuses the exchange)."""
    parts = daily_parts(spark, sf_dir, key)
    return _finish(parts, "DAILY").unionByName(_finish(parts, "MONTHLY"))
