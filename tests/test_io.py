"""Sources, sinks and the update-join."""

import datetime as dt
import json
import os
from decimal import Decimal

from rateflow.sinks.tables import append_table, create_table_as, declared_schema_table, null_to_zero, update_from
from rateflow.sources.files import filter_date_range, list_source_files, read_series_csv, read_series_json


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_markers_padding_blank_lines_quotes_header_case(spark, tmp):
    write(f"{tmp}/daily/DINR.csv", 'date,value\n2020-01-01,.\n\n 2020-01-02 , 71.34 \n"2020-01-03","71.76"\n'
                                      "2020-01-06,NULL\n2020-01-07,null\n2020-01-08,\n2020-01-09,abc\n")
    write(f"{tmp}/monthly/meur.csv", "DATE,VALUE\n2020-01-01,1.1\n")
    df = read_series_csv(spark, tmp)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [
        ("DINR", dt.date(2020, 1, 1), None), ("DINR", dt.date(2020, 1, 2), 71.34),
        ("DINR", dt.date(2020, 1, 3), 71.76), ("DINR", dt.date(2020, 1, 6), None),
        ("DINR", dt.date(2020, 1, 7), None), ("DINR", dt.date(2020, 1, 8), None),
        ("DINR", dt.date(2020, 1, 9), None), ("MEUR", dt.date(2020, 1, 1), 1.1)]


def test_csv_infer_schema(spark, tmp):
    write(f"{tmp}/MINR.csv", "date,value\n2020-01-01,71.279\n2020-02-01,71.5295\n")
    df = read_series_csv(spark, tmp, infer=True)
    assert dict(df.dtypes) == {"series_id": "string", "date": "date", "value": "double"}


def test_list_source_files(spark, tmp):
    write(f"{tmp}/A.csv", "date,value\n2020-01-01,1\n")
    write(f"{tmp}/B.csv", "date,value\n2020-01-01,2\n2020-01-02,3\n")
    files = list_source_files(spark, tmp).collect()
    assert sorted(r.file_name for r in files) == ["A.csv", "B.csv"]
    assert all(r.file_size > 0 for r in files)


def test_json_payloads(spark, tmp):
    docs = [
        {"realtime_start": "x", "observations": [{"date": "2020-01-01", "value": ".", "extra": 1},
                                                 {"date": "2020-01-02", "value": "71.34"}]},
        {"observations": []},
    ]
    write(f"{tmp}/series_id=DINR/part-0.json", "\n".join(json.dumps(x) for x in docs) + "\n")
    df = read_series_json(spark, tmp)
    assert sorted(tuple(r) for r in df.collect()) == [("DINR", dt.date(2020, 1, 1), None),
                                                      ("DINR", dt.date(2020, 1, 2), 71.34)]
    assert read_series_json(spark, tmp, start="2020-01-02").count() == 1
    assert filter_date_range(df, "date", "2019-01-01", "2020-01-01").count() == 1


def test_update_from_keeps_unmatched_rows(spark):
    target = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, Decimal("9.0000"), "c")],
                                   "k int, m decimal(10,4), t string")
    upd = spark.createDataFrame([(1, Decimal("1.5000")), (3, None)], "k int, m decimal(10,4)")
    out = sorted(tuple(r) for r in update_from(target, upd, "k", ["m"]).collect())
    assert out == [(1, Decimal("1.5000"), "a"), (2, None, "b"), (3, None, "c")]


def test_tables_roundtrip(spark, tmp):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), None)], "series_id string, date date, value double")
    t = create_table_as(null_to_zero(df, "value"), "rf_test_obs", f"{tmp}/t1")
    assert t.first().value == 0.0
    append_table(df, "rf_test_obs")
    assert spark.table("rf_test_obs").count() == 2
    declared = declared_schema_table(spark, "rf_test_decl", "DATE date, VALUE double", f"{tmp}/t2")
    assert declared.dtypes == [("DATE", "date"), ("VALUE", "double")]


def test_assert_unique(spark):
    import pytest

    from rateflow.sinks.tables import assert_unique

    ok = spark.createDataFrame([("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 1, 2))], "series_id string, date date")
    assert_unique(ok)
    with pytest.raises(ValueError):
        assert_unique(ok.union(ok.limit(1)))


def test_each_file_is_matched_by_its_own_header(spark, tmp):
    write(f"{tmp}/A.csv", "date,value\n2020-01-01,1.5\n")
    write(f"{tmp}/B.csv", "VALUE,extra,Date\n2.25,x,2020-01-02\n.,y,2020-01-03\n")
    write(f"{tmp}/C.csv", "date,value\n")
    rows = {(r.series_id, str(r.date)): r.value for r in read_series_csv(spark, tmp).collect()}
    assert rows == {("A", "2020-01-01"): 1.5, ("B", "2020-01-02"): 2.25, ("B", "2020-01-03"): None}
    assert {r.file_name for r in list_source_files(spark, tmp).collect()} == {"A.csv", "B.csv", "C.csv"}
