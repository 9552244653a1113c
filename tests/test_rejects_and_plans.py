"""Unreadable rows, the refresh from files, serving by path, and the plan of wide metrics."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rateflow.__main__ import main
from rateflow.operators.blocks import plain_scan
from rateflow.operators.metrics import wide_metrics
from rateflow.plans.refresh import refresh_from_files, table_names
from rateflow.sources.files import read_series_csv, rejected_rows


def _land(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_bad_number_is_reported_not_zero(spark, tmp_path):
    path = _land(tmp_path, DAAA="date,value\n2024-01-01,1.5\n2024-01-02,7x.1\n2024-01-03,.\n,2.0\n")
    bad = sorted((r.series_id, r.date or "", r.value) for r in rejected_rows(spark, path).collect())
    assert bad == [("DAAA", "", "2.0"), ("DAAA", "2024-01-02", "7x.1")]
    good = sorted((r.date.day, r.value) for r in read_series_csv(spark, path, unreadable="drop").collect())
    assert good == [(1, 1.5), (3, None)]
    assert read_series_csv(spark, path).count() == 4


def test_refresh_then_serve_by_path(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = _land(tmp_path / "in", DAAA="date,value\n2024-01-01,0.00671\n2024-01-02,0.00674\n2024-01-03,oops\n",
                 DBBB="VALUE,DATE\n2,2024-01-01\n4,2024-01-02\n")
    root = str(tmp_path / "tables")
    status = refresh_from_files(spark, path, env="rateflow_t_rejects", root=root)
    assert "Rejected rows: 1." in status
    assert spark.table(table_names("rateflow_t_rejects")["rejects"]).count() == 1
    served = main(["serve", "--root", root, "--freq", "daily", "--group", "changes"]).collect()
    assert [r.rate_change_percent_dbbb for r in served] == [Decimal("0.0000"), Decimal("100.0000")]
    assert served[1].rate_change_percent_daaa == Decimal("0.4471")


def test_wide_metrics_without_single_partition(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(i), Decimal(i % 7), None if i % 5 == 0 else i * 0.5) for i in range(40)]
    wide = spark.createDataFrame(rows, "d date, A decimal(18,4), B double").unionByName(
        spark.createDataFrame([(day + dt.timedelta(50), None, None)], "d date, A decimal(18,4), B double"))
    got = wide_metrics(wide, "d", ["A", "B"])
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    one = plain_scan(wide, [], "d", ["A", "B"], prev=True, moments=True)
    both = got.join(one.select("d", "A__sd", "B__sd", F.col("A").alias("a"), F.col("B").alias("b")), "d").collect()
    assert len(both) == 41
    for r in both:
        assert (r.A, r.B) == (r.a, r.b)
        assert abs(float(r.volatility_a) - (r.A__sd or 0)) < 1e-4
        assert abs(float(r.volatility_b) - (r.B__sd or 0)) < 1e-4
    assert wide_metrics(wide, "d", []).columns == ["d"]
