"""Change streams: initial rows, append-only, empty runs, incremental refresh."""

import datetime as dt

from pyspark.sql import functions as F

from rateflow.streaming.consume import append_to, consume, land
from rateflow.streaming.refresh import read_metrics, stream_refresh

SCHEMA = "series_id string, date date, value decimal(18,4)"


def batch(spark, start, n, sid="A"):
    rows = [(sid, dt.date(2020, 1, 1) + dt.timedelta(days=start + i), None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("value", F.lit(1).cast("decimal(18,4)"))


def test_initial_rows_then_only_new(spark, tmp):
    src, sink, ckpt = f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ckpt"
    schema = batch(spark, 0, 1).schema
    land(batch(spark, 0, 5), src)
    consume(spark, src, schema, ckpt, append_to(sink, run=0))
    land(batch(spark, 5, 3), src)
    consume(spark, src, schema, ckpt, append_to(sink, run=1))
    consume(spark, src, schema, ckpt, append_to(sink, run=2))
    runs = {r.run: r["count"] for r in spark.read.parquet(sink).groupBy("run").count().collect()}
    assert runs == {0: 5, 1: 3}


def test_append_only_skips_existing(spark, tmp):
    src, sink, ckpt = f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ckpt"
    schema = batch(spark, 0, 1).schema
    land(batch(spark, 0, 5), src)
    consume(spark, src, schema, ckpt, append_to(sink, run=0), initial_rows=False)
    land(batch(spark, 5, 2), src)
    consume(spark, src, schema, ckpt, append_to(sink, run=1), initial_rows=False)
    assert spark.read.parquet(sink).count() == 2


def test_incremental_refresh_handles_late_rows(spark, tmp):
    src, ckpt, raw, met = (f"{tmp}/{x}" for x in ("src", "ckpt", "raw", "met"))
    schema = batch(spark, 0, 1).schema
    land(batch(spark, 0, 3).union(batch(spark, 10, 1)), src)
    stream_refresh(spark, src, schema, ckpt, raw, met, missing="null")
    assert read_metrics(spark, met).count() == 11
    land(batch(spark, 20, 1, sid="B"), src)  # only B is touched
    stream_refresh(spark, src, schema, ckpt, raw, met, missing="null")
    m = read_metrics(spark, met)
    assert {r.series_id: r["count"] for r in m.groupBy("series_id").count().collect()} == {"A": 11, "B": 1}


def test_late_row_in_old_history_equals_batch(spark, tmp):
    from decimal import Decimal

    from rateflow.operators.fill import gap_fill
    from rateflow.operators.metrics import series_metrics

    src, ckpt, raw, met = (f"{tmp}/{x}" for x in ("src", "ckpt", "raw", "met"))
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), Decimal(v)) for i, v in
            [(0, "1.0000"), (3, "2.0000"), (9, "5.0000")]]
    first = spark.createDataFrame(rows, SCHEMA)
    land(first, src)
    stream_refresh(spark, src, first.schema, ckpt, raw, met, missing="null")
    late = spark.createDataFrame([("A", dt.date(2020, 1, 6), Decimal("9.0000"))], SCHEMA)  # between old rows
    land(late, src)
    stream_refresh(spark, src, first.schema, ckpt, raw, met, missing="null")
    got = sorted(tuple(r) for r in read_metrics(spark, met).collect())
    want = sorted(tuple(r) for r in series_metrics(gap_fill(first.union(late), missing="null")).collect())
    assert got == want and len(got) == 10


def test_stream_without_initial_rows_may_start_on_an_empty_source(spark, tmp):
    from rateflow.streaming.consume import append_to, consume, land

    source, target, ckpt = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt"
    rows = spark.createDataFrame([(1,), (2,)], "x long")
    land(rows.limit(0), source)
    consume(spark, source, rows.schema, ckpt, append_to(target, 0), initial_rows=False)
    for run, x in ((1, [(1,)]), (2, [(2,)])):
        land(spark.createDataFrame(x, "x long"), source)
        consume(spark, source, rows.schema, ckpt, append_to(target, run), initial_rows=False)
    assert sorted(r.x for r in spark.read.parquet(target).collect()) == [1, 2]


def test_a_later_batch_restates_a_day(spark, tmp):
    from rateflow.streaming.refresh import read_metrics, stream_refresh
    from rateflow.streaming.consume import land

    schema = spark.createDataFrame([], "series_id string, date date, value decimal(18,4)").schema
    for day, value in (("2020-01-01", "2"), ("2020-01-01", "4"), ("2020-01-03", "5")):
        land(spark.sql(f"SELECT 'S' AS series_id, DATE'{day}' AS date, CAST({value} AS DECIMAL(18,4)) AS value"), f"{tmp}/in")
        stream_refresh(spark, f"{tmp}/in", schema, f"{tmp}/ckpt", f"{tmp}/raw", f"{tmp}/metrics")
    got = [(str(r.date), float(r.value)) for r in read_metrics(spark, f"{tmp}/metrics").orderBy("date").collect()]
    assert got == [("2020-01-01", 4.0), ("2020-01-02", 4.0), ("2020-01-03", 5.0)]
