"""Long observations -> one wide table per frequency (one column per series).

The default is a single ``groupBy(date)`` with one conditional aggregate per series id
(partial aggregation on the map side, one shuffle on date). The chain of full outer joins is kept as the literal form; it
gives the same rows when ``(series, date)`` is unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.numeric import usd_conversion
from rateflow.operators.fill import gap_fill


def harmonize_pivot(df: DataFrame, ids: Sequence[str], series: str = "series_id", date: str = "date",
                    value: str = "value", out_date: str = "date") -> DataFrame:
    """Wide table with ``out_date`` and one column per id.

    Written as one conditional aggregate per id (``max(CASE WHEN series = id THEN value)``)
    grouped by date: a single partial/final aggregation with one shuffle on date. The id
    list is always given, so no job runs to discover it. ``(series, date)`` is unique, so
    ``max`` picks the one value (``groupBy().pivot()`` gives the same table with a second,
    two-phase aggregation).
    """
    s = F.col(series)
    # a date that only other series have makes no row
    listed = df.filter(s.isin([*ids]))
    return listed.groupBy(F.col(date).alias(out_date)).agg(
        *[F.max(F.when(s == F.lit(i), F.col(value))).alias(i) for i in ids]
    )


def harmonize_outer_join(df: DataFrame, ids: Sequence[str], series: str = "series_id", date: str = "date",
                         value: str = "value", out_date: str = "date", materialize: bool = False) -> DataFrame:
    """``s1 FULL OUTER JOIN s2 USING (date) FULL OUTER JOIN s3 ...`` (key coalesced).

    Each per-series filter is pushed down into its own branch, so the input plan runs once per
    series. ``materialize=True`` first writes the long input with a reliable ``checkpoint()``
    (to the shared ``spark.checkpoint.dir``, lineage cut), so the branches read that instead.
    """
    if materialize:
        from rateflow.session import checkpoint_root

        checkpoint_root(df.sparkSession)  # ensures a checkpoint folder is set
        df = df.select(series, date, value).checkpoint(eager=True)
    frames = [
        df.filter(F.col(series) == sid).select(F.col(date).alias(out_date), F.col(value).alias(sid))
        for sid in ids
    ]
    return reduce(lambda a, b: a.join(b, on=out_date, how="full"), frames)


def add_conversions(wide: DataFrame, convert: Sequence[str], suffix: str = "_CONVERTED",
                    precision: int = 35, scale: int = 4) -> DataFrame:
    """Append ``<col>_CONVERTED = usd_conversion(<col>)`` for the USD-quoted columns."""
    return wide.select("*", *[usd_conversion(c, precision, scale).alias(c + suffix) for c in convert])


def harmonize(
    df: DataFrame,
    ids: Sequence[str],
    convert: Sequence[str] = (),
    fill: bool = False,
    missing: str = "zero",
    series: str = "series_id",
    date: str = "date",
    value: str = "value",
    out_date: str = "date",
    block_days: int | None = None,
) -> DataFrame:
    """Harmonized wide table. ``fill=True`` gap-fills every series in its own span first
    (daily); otherwise the observations are taken as they are (monthly). ``missing='zero'``
    turns NULL observations into 0 at load (parity); ``'null'`` keeps them NULL."""
    obs = df.select(series, date, value)
    if fill:
        obs = gap_fill(obs, [series], date, value, missing=missing, block_days=block_days)
    elif missing == "zero":
        obs = obs.withColumn(value, F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)))
    wide = harmonize_pivot(obs, ids, series, date, value, out_date)
    return add_conversions(wide, convert)


def weekly_observations(df: DataFrame, series: str = "series_id", date: str = "date",
                        value: str = "value") -> DataFrame:
    """One row per series and week (weeks start on Monday): the value of the week's last
    observation, NULL kept. Partial aggregation per (series, week), one shuffle."""
    return df.groupBy(F.col(series), F.date_trunc("week", F.col(date)).cast("date").alias(date)).agg(
        F.max_by(F.col(value), F.col(date)).alias(value))


def union_daily_monthly(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name; duplicates across frequencies are kept."""
    return daily.unionByName(monthly, allowMissingColumns=True)


def combined_currency(
    obs: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    series: str = "series_id",
    date: str = "date",
    value: str = "value",
    freq: str = "freq",
    block_days: int | None = None,
) -> DataFrame:
    """One table over all frequencies, one column per currency.

    For every output column, the UNION ALL of its series (e.g. one daily and one monthly)
    is forward-filled in date order with NULL *and 0* missing (rows sharing a date are taken
    in frequency order), keeping each value's date. The columns are then put side by side
    on ``(date, freq)``: a date observed at two frequencies stays two rows, and no join
    multiplies rows. Output: ``date`` (text), ``freq``, one double column per currency.

    ``mapping``: output column -> the series ids that feed it.
    """
    from rateflow.operators.fill import forward_fill_nonzero

    tag = {sid: name for name, sids in mapping.items() for sid in sids}
    pairs = [F.lit(x) for kv in tag.items() for x in kv]
    labelled = obs.select(
        F.element_at(F.create_map(*pairs), F.col(series)).alias("_rf_out"),
        F.col(freq),
        F.col(date),
        F.col(value),
    ).filter(F.col("_rf_out").isNotNull())
    filled = forward_fill_nonzero(labelled, ["_rf_out"], date, value, out="_rf_ff",
                                  block_days=block_days, tiebreak=freq)
    out = F.col("_rf_out")
    return filled.groupBy(F.col(date).cast("string").alias("date"), F.col(freq)).agg(
        *[F.max(F.when(out == F.lit(name), F.col("_rf_ff"))).alias(name) for name in mapping]
    )
