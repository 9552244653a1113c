"""Published versions: whole sets, replaced parts, updates by key, newest rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rateflow.sinks.versions import (
    latest_parts,
    publish,
    read_parts,
    read_version,
    replace_parts,
    update_parts,
    version,
    write_parts,
)

MONTH = "date_format(date, 'yyyy-MM')"


def days(spark, n, value=1, start=dt.date(2024, 1, 1)):
    rows = [(start + dt.timedelta(i), value) for i in range(n)]
    return spark.createDataFrame(rows, "date date, value int")


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_reader_sees_all_tables_old_or_new(spark, tmp):
    assert version(spark, tmp).number == 0
    first = write_parts(days(spark, 3), tmp, "a") + write_parts(days(spark, 4), tmp, "b")
    assert publish(spark, tmp, first) == 1
    # a job that breaks between two tables
    with pytest.raises(RuntimeError):
        new = write_parts(days(spark, 30), tmp, "a")
        raise RuntimeError(f"broken after {len(new)} tables")
    assert (read_version(spark, tmp, "a").count(), read_version(spark, tmp, "b").count()) == (3, 4)
    held = read_version(spark, tmp, "a")
    assert publish(spark, tmp, write_parts(days(spark, 5), tmp, "a") + write_parts(days(spark, 6), tmp, "b")) == 2
    assert (read_version(spark, tmp, "a").count(), read_version(spark, tmp, "b").count()) == (5, 6)
    assert held.count() == 3 and read_version(spark, tmp, "b", 1).count() == 4
    with pytest.raises(ValueError):
        read_version(spark, tmp, "c")


def test_old_versions_are_dropped(spark, tmp):
    for n in range(1, 6):
        publish(spark, tmp, write_parts(days(spark, n), tmp, "a"), keep=2)
    assert read_version(spark, tmp, "a").count() == 5 and read_version(spark, tmp, "a", 4).count() == 4
    with pytest.raises(ValueError):
        version(spark, tmp, 3)
    assert len(files(f"{tmp}/data")) == len(files(f"{tmp}/data/a")) and sum(os.path.isdir(f"{tmp}/data/a/{x}/_part=all") for x in os.listdir(f"{tmp}/data/a")) == 2


def test_an_update_writes_only_the_months_it_hits(spark, tmp):
    publish(spark, tmp, write_parts(days(spark, 100), tmp, "a", MONTH, "date") + write_parts(days(spark, 2), tmp, "b"))
    before = files(f"{tmp}/data")
    updates = spark.createDataFrame([(dt.date(2024, 2, 5), 7), (dt.date(2024, 2, 29), None), (dt.date(2030, 1, 1), 9), (None, 3), (None, 4)], "date date, value int")
    assert update_parts(spark, tmp, "a", updates, ["date"], ["value"], MONTH, "date") == 2
    after = files(f"{tmp}/data")
    assert {f: after[f] for f in before} == before  # untouched
    assert {f.split("_part=")[1].split("/")[0] for f in set(after) - set(before)} == {"2024-02"}
    got = {r.date: r.value for r in read_version(spark, tmp, "a").collect()}
    assert len(got) == 100 and got.pop(dt.date(2024, 2, 5)) == 7 and got.pop(dt.date(2024, 2, 29)) is None and set(got.values()) == {1}
    assert [p.n_rows for p in version(spark, tmp).of("a", ["2024-01", "2024-02"])] == [31, 29]
    assert read_version(spark, tmp, "b").count() == 2
    with pytest.raises(ValueError, match="duplicate"):
        update_parts(spark, tmp, "a", updates.union(updates.limit(1)), ["date"], ["value"], MONTH)
    assert version(spark, tmp).number == 2
    assert update_parts(spark, tmp, "a", updates.filter("date > '2029-01-01'"), ["date"], ["value"], MONTH) == 2


def test_a_repeated_update_key_fails(spark):
    from rateflow.sinks.tables import update_from

    target = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    twice = spark.createDataFrame([(1, 5), (1, 6), (9, 7), (9, 8), (None, 1), (None, 2)], "k int, v int")
    with pytest.raises(Exception, match="two updates of one key"):
        update_from(target, twice, "k", ["v"]).collect()
    assert sorted(update_from(target, twice.filter("k > 1"), "k", ["v"]).collect()) == [(1, 1), (2, 2)]


def test_newest_rows_from_the_newest_parts(spark, tmp):
    publish(spark, tmp, write_parts(days(spark, 900), tmp, "a", MONTH, "date"))
    parts = version(spark, tmp).of("a")
    few = latest_parts(parts, 40)
    assert [p.part for p in few] == ["2026-06", "2026-05"] and len(parts) == 30
    top = read_parts(spark, few).orderBy(F.desc("date")).limit(40)
    assert sorted(top.collect()) == sorted(read_version(spark, tmp, "a").orderBy(F.desc("date")).limit(40).collect())
    # more history, as many files
    replace_parts(spark, tmp, write_parts(days(spark, 2000, start=dt.date(2000, 1, 1)), tmp, "a", MONTH, "date"))
    assert len(latest_parts(version(spark, tmp).of("a"), 40)) == 2
    assert len(latest_parts(parts, 10**6)) == 30
    # overlapping ranges are all read until k rows lie above the rest
    wide = [parts[0]._replace(low="2020-01-01", high="2026-06-30", n_rows=100), parts[1]._replace(low="2026-01-01", high="2026-02-01", n_rows=50),
            parts[2]._replace(low="2019-01-01", high="2019-02-01", n_rows=10)]
    assert latest_parts(wide, 60) == wide[:2]


def test_empty_tables_and_null_dates(spark, tmp):
    publish(spark, tmp, write_parts(days(spark, 0), tmp, "a", MONTH, "date") + write_parts(
        spark.createDataFrame([(None, 1), (dt.date(2024, 1, 1), 2)], "date date, value int"), tmp, "b", MONTH, "date"))
    assert read_version(spark, tmp, "a").collect() == [] and read_version(spark, tmp, "a").columns == ["date", "value"]
    parts = version(spark, tmp).of("b")
    assert {p.part for p in parts} == {"2024-01", "none"}
    assert [p.part for p in latest_parts(parts, 1)] == ["2024-01"] and len(latest_parts(parts, 2)) == 2
    assert latest_parts(version(spark, tmp).of("a"), 5)
