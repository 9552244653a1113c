"""Incremental metrics refresh from a change stream, with carried state.

A store (``rateflow.sinks.versions`` at ``metrics_path``) holds three tables, all by hash bucket of the series:

- ``raw``: the observations of each batch (folders below ``raw_path``);
- ``state``: a row per series: last date and value, number, mean and sum of squared deviations (M2) of its
  filled values;
- ``metrics``: the metric rows of each batch. A later batch's row of a day counts.

A batch extends its series from their state: the grid goes on from the last date and value, and the moments are
merged with those of the new days (Chan, Golub and LeVeque), so what is read follows the batch and not the history. Only
series with late or restated days (not after their last date) are computed anew from their raw rows. Raw rows, state and
metrics of a batch become one version; a replayed batch that is already in it does nothing. Buckets of more than
``FOLDERS`` folders are merged into one, the newest row of a day staying.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.functions.numeric import abs_pct_change_expr, stddev_to_fixed
from rateflow.operators.fill import gap_fill
from rateflow.sinks.versions import Part, Version, publish, read_parts, read_version, version, write_parts
from rateflow.streaming.consume import BatchFn, consume

#: Folders of a bucket before they are merged.
FOLDERS = 8
METRICS = ("series_id", "date", "value", "rate_change_percent", "volatility")
_MOMENTS = ("n", "mean", "m2")


def series_bucket(series: str = "series_id", buckets: int = 16) -> Column:
    """Stable hash bucket of a series id: the parts of the raw, state and metrics tables."""
    return F.pmod(F.xxhash64(F.col(series)), F.lit(buckets)).cast("int")


def _bucket(part: Part) -> int:
    return int(part.part.split("-")[0])


def _merged(before: tuple[Column, Column, Column], more: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Number, mean and M2 of two groups together."""
    n0, mean0, m20 = (F.coalesce(c, F.lit(0.0)) for c in before)
    n, mean, m2 = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in more)
    total = n0 + n
    share = n / F.when(total > 0, total)
    apart = mean - mean0
    return total, F.coalesce(mean0 + apart * share, F.lit(0.0)), F.coalesce(m20 + m2 + apart * apart * n0 * share, F.lit(0.0))


def _measured(filled: DataFrame, series: DataFrame) -> DataFrame:
    """The metrics of filled rows that go on from ``series``' state (nulls for a new series); the row at its
    last date only starts the window."""
    rows = filled.join(series.select("series_id", "last_date", *_MOMENTS), "series_id")
    new = F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))
    w = Window.partitionBy("series_id").orderBy("date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.when(new, F.col("value").cast("double"))
    rows = rows.select(
        "series_id", "date", "value", new.alias("_new"), *_MOMENTS, F.lag("value").over(w).alias("_prev"),
        F.count(x).over(run).alias("_n"), F.avg(x).over(run).alias("_mean"), (F.var_pop(x).over(run) * F.count(x).over(run)).alias("_m2"))
    total, _, m2 = _merged(tuple(F.col(c) for c in _MOMENTS), tuple(F.col(f"_{c}") for c in _MOMENTS))
    rows = rows.withColumn("_sd", F.when(total >= 2, F.sqrt(F.greatest(m2, F.lit(0.0)) / (total - 1)))).filter("_new")
    return rows.select(
        "series_id", "date", "value", abs_pct_change_expr("value", "_prev", 10, 4).alias("rate_change_percent"),
        stddev_to_fixed("_sd", 10, 4).alias("volatility"))


def _newest(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per series and day: that of the newest batch."""
    kept = F.struct(*[F.col(c) for c in columns if c not in ("series_id", "date")], F.col("bucket"), F.col("batch"))
    rows = rows.groupBy("series_id", "date").agg(F.max_by(kept, "batch").alias("_kept"))
    return rows.select("series_id", "date", "_kept.*").select(*columns, "bucket", "batch")


def _state(metrics: DataFrame, series: DataFrame) -> DataFrame:
    """Every series' state after its new metric rows."""
    x = F.col("value").cast("double")
    last = metrics.groupBy("series_id").agg(
        F.max("date").alias("_date"), F.max_by("value", "date").alias("_value"), F.count(x).alias("_n"), F.avg(x).alias("_mean"),
        (F.var_pop(x) * F.count(x)).alias("_m2"))
    n, mean, m2 = _merged(tuple(F.col(c) for c in _MOMENTS), tuple(F.col(f"_{c}") for c in _MOMENTS))
    return last.join(series.select("series_id", "bucket", *_MOMENTS), "series_id").select(
        "series_id", "bucket", F.col("_date").alias("last_date"), F.col("_value").alias("last_value"), n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def refresh_batch(spark: SparkSession, raw_path: str, metrics_path: str, missing: str = "zero",
                  block_days: int | None = None, buckets: int = 16, writer: str = "") -> BatchFn:
    """Batch function for ``consume``: store the batch, then extend the metrics of its series, or compute them anew where
    it brings days that are not after the last one. ``writer`` tells streams (their batch numbers) apart.
    Within a batch the greater value of a day wins, and a later batch wins over an earlier one."""

    def run(batch: DataFrame, batch_id: int) -> None:
        last = version(spark, metrics_path)
        done = [int(p.part.split("-")[1]) for p in last.of("batches") if p.part.split("-")[0] == writer]
        if done and batch_id <= max(done):
            return  # replayed: it is in the version
        number = 1 + max((int(p.part.split("-")[1]) for p in last.of("raw")), default=-1)
        parts = [f"concat(bucket, '-', {number})", "cast(bucket AS string)"]
        rows = batch.groupBy("series_id", "date").agg(F.max("value").alias("value"))
        rows = rows.withColumns({"bucket": series_bucket("series_id", buckets), "batch": F.lit(number)})
        raw = [p for p in write_parts(rows, raw_path, "raw", parts[0], counted=False) if p.folder]
        marker = Part("batches", f"{writer}-{batch_id}", "", 0, None, None, "{}")
        others = [p for p in last.parts if not (p.name == "batches" and p.part.split("-")[0] == writer)]
        if not raw:
            publish(spark, metrics_path, [*others, marker], after=last)
            return
        touched = [str(_bucket(p)) for p in raw]
        obs = read_parts(spark, raw)
        kind = obs.schema["value"].dataType.simpleString()
        known = last.of("state", touched)
        state = read_parts(spark, known) if known else spark.createDataFrame(
            [], f"series_id string, bucket int, last_date date, last_value {kind}, n double, mean double, m2 double")

        # a row for each series of the batch, with its state; that of a series to compute anew is set to nothing
        first = obs.groupBy("series_id", "bucket").agg(F.min("date").alias("first_date")).join(state.drop("bucket"), "series_id", "left")
        anew = F.coalesce(F.col("first_date") <= F.col("last_date"), F.lit(False))
        series = first.withColumn("anew", anew).withColumns({c: F.when(~F.col("anew"), F.col(c)) for c in ("last_date", "last_value", *_MOMENTS)})
        series = series.persist()  # from written parts: a lost block is computed again
        again = [str(r.bucket) for r in series.filter("anew").select("bucket").distinct().collect()]  # at most ``buckets`` numbers

        going = series.filter("NOT anew")
        starts = going.filter("last_date IS NOT NULL").select("series_id", F.col("last_date").alias("date"), F.col("last_value").cast(kind).alias("value"))
        later = obs.join(going, "series_id", "left_semi") if again else obs
        grid = gap_fill(later.select("series_id", "date", "value").union(starts),
                        ["series_id"], "date", "value", missing=missing, block_days=block_days)
        if again:
            history = read_parts(spark, [*(p for p in last.of("raw") if str(_bucket(p)) in again), *(p for p in raw if str(_bucket(p)) in again)])
            history = _newest(history.join(series.filter("anew"), "series_id", "left_semi"), ("series_id", "date", "value"))
            grid = grid.union(gap_fill(history.select("series_id", "date", "value"), ["series_id"], "date", "value", missing=missing, block_days=block_days))
        metrics = _measured(grid, series).withColumns({"bucket": series_bucket("series_id", buckets), "batch": F.lit(number)})
        new = write_parts(metrics, metrics_path, "metrics", parts[0], counted=False)
        fresh = _state(read_parts(spark, new), series)
        stays = state.join(series, "series_id", "left_anti")
        states = write_parts(fresh.unionByName(stays), metrics_path, "state", parts[1], counted=False)
        keys = {p.part for p in states}
        publish(spark, metrics_path, [*(p for p in others if p.name != "state" or p.part not in keys), *raw, *new, *states, marker], after=last)
        series.unpersist()
        compact(spark, raw_path, metrics_path)

    return run


def compact(spark: SparkSession, raw_path: str, metrics_path: str, most: int | None = None) -> Version:
    """Merge the folders of each bucket that has more than ``most`` (``FOLDERS``) of them, as one new version: one
    folder, with the newest row of each series and day."""
    most = FOLDERS if most is None else most
    last = version(spark, metrics_path)
    stay, new = list(last.parts), []
    for name, root in (("raw", raw_path), ("metrics", metrics_path)):
        of: dict[int, list[Part]] = {}
        for p in last.of(name):
            of.setdefault(_bucket(p), []).append(p)
        many = [p for ps in of.values() if len(ps) > most for p in ps]
        if many:
            columns = METRICS if name == "metrics" else ("series_id", "date", "value")
            top = max(int(p.part.split("-")[1]) for p in last.of(name))
            new += write_parts(_newest(read_parts(spark, many), columns), root, name, f"concat(bucket, '-', {top})", counted=False)
            stay = [p for p in stay if p not in many]
    if not new:
        return last
    return Version(publish(spark, metrics_path, [*stay, *new], after=last), [*stay, *new])


def stream_refresh(spark: SparkSession, source: str, schema: StructType, checkpoint: str, raw_path: str,
                   metrics_path: str, missing: str = "zero") -> None:
    """One run: consume new files of ``source`` and refresh the metrics of touched series."""
    writer = f"{zlib.crc32(checkpoint.encode()):08x}"
    consume(spark, source, schema, checkpoint, refresh_batch(spark, raw_path, metrics_path, missing, writer=writer))


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """The metrics of all series and days: the newest batch's row of each."""
    return _newest(read_version(spark, metrics_path, "metrics"), METRICS).select(*METRICS)
