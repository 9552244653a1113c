"""Files of any header, each file loaded once, and refreshes that readers see whole."""

import os

import pytest
from pyspark.sql import functions as F

import rateflow.plans.load as L
from rateflow.__main__ import main
from rateflow.plans.load import load_new_files, loaded_files, loaded_rows, rejected_of
from rateflow.plans.refresh import refresh_from_files, table_names
from rateflow.sinks.versions import read_version, version
from rateflow.sources.files import layouts, read_series_csv, rejected_rows


def land(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    return folder


def values(df):
    return {(r.series_id, str(r.date)): r.value for r in df.collect()}


def test_columns_anywhere_and_files_without_them(spark, tmp):
    wide = ",".join([f"c{i}" for i in range(40)] + ["Value", "x", "DATE"])
    row = ",".join(["7"] * 40 + ["1.5", '"a,b"', "2024-01-02"])
    path = land(f"{tmp}/in 1", A=f"{wide}\n{row}\n", B="date,value\n2024-01-01,2\ndate,value\n2024-01-03,.\n", C="date,amount\n2024-01-01,3\n", D="value,date\n4,2024-01-04\n",
                E="\n\n date , value \n2024-01-05,5\n")
    assert values(read_series_csv(spark, path)) == {("A", "2024-01-02"): 1.5, ("B", "2024-01-01"): 2.0, ("B", "2024-01-03"): None, ("D", "2024-01-04"): 4.0, ("E", "2024-01-05"): 5.0}
    (bad,) = rejected_rows(spark, path).collect()
    assert (bad.series_id, bad.date, bad.value, bad.reject) == ("C", None, None, "no date and value columns") and bad.file_path.endswith("C.csv")
    only = land(f"{tmp}/only", C="date,amount\n2024-01-01,3\n")
    assert read_series_csv(spark, only).collect() == [] and rejected_rows(spark, only).count() == 1
    assert read_series_csv(spark, only, infer=True).collect() == []


def test_one_scan_a_layout_and_no_join(spark, tmp):
    path = land(f"{tmp}/in", A="date,value\n2024-01-01,1\n", B="date,value\n2024-01-01,2\n")
    plan = read_series_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Join" not in plan and "Exchange" not in plan
    land(path, C="value,date\n1,2024-01-01\n")
    plan = read_series_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Join" not in plan and "Exchange" not in plan
    assert {(k.date, k.value, len(v)) for k, v in layouts(spark, path).items()} == {(0, 1, 2), (1, 0, 1)}


def test_headers_of_split_files(spark, tmp):
    """Files of several splits, of which only the beginnings are read, and small ones that share a task."""
    rows = "".join(f"{i}.5,2024-01-{i % 28 + 1:02d}\n" for i in range(4000))
    path = land(f"{tmp}/in", **{f"BIG{i}": "value,date\n" + rows for i in range(3)}, **{f"S{i}": "date,value\n2024-01-01,1\n" for i in range(20)}, ODD="a,b\n" + rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, ("16384", "1024"), strict=True):
            spark.conf.set(k, v)
        found = {k: len(v) for k, v in layouts(spark, path).items()}
        assert found == {(1, 0, 2): 3, (0, 1, 2): 20, (None, None, 2): 1}
        assert read_series_csv(spark, path).count() == 12020
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_inferred_types_over_header_orders(spark, tmp):
    path = land(f"{tmp}/in", A="date,value\n2024-01-03,9.5\n", B="VALUE,DATE\n7,2024-01-04\n")
    df = read_series_csv(spark, path, infer=True)
    assert dict(df.dtypes) == {"series_id": "string", "date": "date", "value": "double"}
    assert values(df) == {("A", "2024-01-03"): 9.5, ("B", "2024-01-04"): 7.0}


def test_a_file_is_loaded_once(spark, tmp):
    path, root = land(f"{tmp}/in", A="date,value\n2024-01-01,1\n2024-01-02,oops\n", B="value,date\n2,2024-01-01\n"), f"{tmp}/store"
    first = load_new_files(spark, path, root)
    assert (first.files, first.rows, first.rejects) == (2, 2, 1)
    again = load_new_files(spark, path, root)
    assert again.files == 0 and version(spark, root).number == 1
    land(path, C="date,value\n2024-01-05,5\n")
    assert load_new_files(spark, path, root)[:3] == (1, 1, 0)
    rows = loaded_rows(spark, version(spark, root).parts)
    assert {(r.series_id, r.load) for r in rows.collect()} == {("A", 1), ("B", 1), ("C", 2)}
    # a changed file replaces its rows; a file that is gone keeps them
    land(path, A="date,value\n2024-01-01,10\n2024-01-02,20\n2024-01-03,30\n")
    os.remove(f"{path}/B.csv")
    assert load_new_files(spark, path, root)[:3] == (1, 3, 0)
    parts = version(spark, root).parts
    assert {(r.series_id, r.date.day, r.value, r.load) for r in loaded_rows(spark, parts).collect()} == {
        ("A", 1, 10.0, 3), ("A", 2, 20.0, 3), ("A", 3, 30.0, 3), ("B", 1, 2.0, 1), ("C", 5, 5.0, 2)}
    assert rejected_of(spark, parts).collect() == []
    assert sorted((r.file_path[-5:], r.load) for r in loaded_files(spark, parts).collect()) == [("A.csv", 3), ("B.csv", 1), ("C.csv", 2)]
    assert load_new_files(spark, path, root).files == 0
    assert load_new_files(spark, path, root, force=True).files == 2
    assert loaded_rows(spark, version(spark, root).parts).count() == 5


def test_a_broken_load_is_repeated_whole(spark, tmp, monkeypatch):
    path, root = land(f"{tmp}/in", A="date,value\n2024-01-01,1\n"), f"{tmp}/store"
    load_new_files(spark, path, root)
    land(path, A="date,value\n2024-01-01,7\n", B="date,value\n2024-01-02,2\n")

    def broken(*args, **kw):
        raise RuntimeError("broken before the version is published")

    monkeypatch.setattr(L, "publish", broken)
    with pytest.raises(RuntimeError):
        load_new_files(spark, path, root)
    monkeypatch.undo()
    assert values(loaded_rows(spark, version(spark, root).parts)) == {("A", "2024-01-01"): 1.0}
    assert load_new_files(spark, path, root)[:2] == (2, 2)
    assert values(loaded_rows(spark, version(spark, root).parts)) == {("A", "2024-01-01"): 7.0, ("B", "2024-01-02"): 2.0}


def test_refresh_loads_new_files_only_and_publishes_at_once(spark, tmp, monkeypatch):
    import rateflow.plans.refresh as R

    path, root = land(f"{tmp}/in", DAAA="date,value\n2023-12-31,1\n2024-01-01,2\n", MBBB="date,value\n2024-01-01,oops\n2024-02-01,3\n"), f"{tmp}/tables"
    assert "Rejected rows: 1." in refresh_from_files(spark, path, env="rf_once", root=root)
    names = table_names("rf_once")
    old = {t: spark.table(names[t]).count() for t in ("raw", "rejects", "DAILY_metrics", "MONTHLY_metrics")}
    assert old == {"raw": 3, "rejects": 1, "DAILY_metrics": 2, "MONTHLY_metrics": 1}
    land(path, DCCC="value,date\n4,2024-01-03\n")

    # a job that breaks after the harmonized tables: readers of the store see the old set
    def broken(*args, **kw):
        raise RuntimeError("broken between two tables")

    monkeypatch.setattr(R, "wide_metrics", broken)
    with pytest.raises(RuntimeError):
        refresh_from_files(spark, path, env="rf_once", root=root)
    monkeypatch.undo()
    assert version(spark, root).number == 1 and "DCCC" not in read_version(spark, root, "daily_harmonized").columns
    assert spark.table(names["DAILY_metrics"]).count() == 2
    refresh_from_files(spark, path, env="rf_once", root=root)
    assert version(spark, root).number == 2 and read_version(spark, root, "daily_metrics").count() == 3
    loads = {r.load for r in loaded_files(spark, version(spark, root).parts).collect()}
    assert loads == {1, 2}
    assert [r.DCCC for r in spark.table(names["DAILY_metrics"]).orderBy("DDATE").collect()] == [None, None, 4.0]
    served = main(["serve", "--root", root, "--freq", "daily", "-k", "1"])
    assert [r.DCCC for r in served.collect()] == [4.0]
    files = {f.split("_part=")[1][:4] for f in served.inputFiles()}
    assert files == {"2024"}  # the year 2023 is not read


def test_column_named_like_the_header(spark, tmp):
    path = land(f"{tmp}/in", A="date,value\n2024-01-01,value\n")
    assert rejected_rows(spark, path).select("date", "value").collect() == [("2024-01-01", "value")]
    assert read_series_csv(spark, path).filter(F.col("value").isNull()).count() == 1
