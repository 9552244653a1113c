"""Change rows of rewritten tables, and the streamed refresh with carried state."""

import datetime as dt
import random
import shutil
from decimal import Decimal

import pytest

import rateflow.streaming.refresh as S
from rateflow.operators.fill import gap_fill
from rateflow.operators.metrics import series_metrics
from rateflow.plans.catalog import DAILY_CONVERT, DAILY_IDS, DAILY_RATES
from rateflow.plans.refresh import Frequency, refresh_metrics
from rateflow.sinks.versions import publish, replace_parts, version, write_parts
from rateflow.streaming.changes import consume_changes, table_changes
from rateflow.streaming.refresh import read_metrics, refresh_batch

OBS = "series_id string, date date, value decimal(18,4)"


def got(df, *columns):
    return sorted((tuple(r[c] for c in (*columns, "_change")) for r in df.collect()), key=str)


def test_inserts_updates_and_deletes(spark, tmp):
    a = spark.createDataFrame([(1, 1, "a"), (2, None, "b"), (3, 3, None), (None, 4, "n")], "k int, v int, w string")
    b = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (4, 4, "d"), (None, None, "n")], "k int, v int, w string")
    publish(spark, tmp, write_parts(a, tmp, "t"))
    publish(spark, tmp, write_parts(b, tmp, "t"))
    changes = table_changes(spark, tmp, "t", ["k"], 1)
    assert {r._version for r in changes.collect()} == {2}
    rows = {(r.k, r.v, r.w, r._change) for r in changes.collect()}
    assert rows == {(2, None, "b", "update_before"), (2, 5, "b", "update_after"), (3, 3, None, "delete"), (4, 4, "d", "insert"),
                    (None, 4, "n", "update_before"), (None, None, "n", "update_after")}
    assert table_changes(spark, tmp, "t", ["k"], 0).filter("_change = 'insert'").count() == 4
    assert table_changes(spark, tmp, "t", ["k"], 2).collect() == []
    # another column, and an emptied table
    publish(spark, tmp, write_parts(b.selectExpr("k", "v", "w", "k + 1 AS more").filter("k = 2"), tmp, "t"))
    assert got(table_changes(spark, tmp, "t", ["k"], 2).filter("k = 2"), "more") == [(3, "update_after"), (None, "update_before")]
    publish(spark, tmp, write_parts(b.limit(0), tmp, "t"))
    assert got(table_changes(spark, tmp, "t", ["k"], 3), "k") == [(2, "delete")]


def test_parts_that_stay_are_not_read(spark, tmp):
    df = spark.createDataFrame([(p, i) for p in "abc" for i in range(5)], "p string, i int")
    publish(spark, tmp, write_parts(df, tmp, "t", "p"))
    replace_parts(spark, tmp, write_parts(df.filter("p = 'b' AND i > 0"), tmp, "t", "p"))
    changes = table_changes(spark, tmp, "t", ["p", "i"], 1)
    assert got(changes, "p", "i") == [("b", 0, "delete")]
    assert {f.split("_part=")[1][0] for f in changes.inputFiles()} == {"b"}


def test_consumer_sees_each_version_once(spark, tmp):
    seen = []

    def note(df, number):
        seen.append((number, got(df, "k")))

    def table(*ks):
        return write_parts(spark.createDataFrame([(k,) for k in ks], "k int"), f"{tmp}/s", "t")

    def run(initial_rows=True, at="c"):
        return consume_changes(spark, f"{tmp}/s", "t", ["k"], f"{tmp}/{at}", note, initial_rows)

    assert run() == 0 and seen == []
    publish(spark, f"{tmp}/s", table(1, 2))
    run(), run(), run(False, "d")
    publish(spark, f"{tmp}/s", table(2, 3))

    def broken(df, number):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        consume_changes(spark, f"{tmp}/s", "t", ["k"], f"{tmp}/c", broken)
    run(), run(), run(False, "d")
    assert seen == [(1, [(1, "insert"), (2, "insert")]), (2, [(1, "delete"), (3, "insert")]), (2, [(1, "delete"), (3, "insert")])]
    for n in range(3):
        publish(spark, f"{tmp}/s", table(n))
    with pytest.raises(ValueError, match="not kept"):
        run()


def test_only_the_restated_day_comes_out(spark, tmp):
    rows = [(i, "DAILY", dt.date(2024, 1, 1) + dt.timedelta(d), Decimal(d + 2)) for i in DAILY_IDS for d in range(40)]
    freq = Frequency("DAILY", "DDATE", DAILY_IDS, DAILY_CONVERT, DAILY_RATES, fill=True)
    schema = "series_id string, freq string, date date, value decimal(18,4)"
    refresh_metrics(spark, spark.createDataFrame(rows, schema), [freq], env="rf_changes", root=tmp)
    day = dt.date(2024, 1, 20)
    rows = [(i, f, d, v + 1 if (i, d) == (DAILY_IDS[0], day) else v) for i, f, d, v in rows]
    refresh_metrics(spark, spark.createDataFrame(rows, schema), [freq], env="rf_changes", root=tmp)
    changes = table_changes(spark, tmp, "daily_harmonized", ["DDATE"], 1).select("DDATE", "_change", DAILY_IDS[0], DAILY_IDS[1]).collect()
    assert sorted((r[0], r[1], r[2]) for r in changes) == [(day, "update_after", Decimal(22)), (day, "update_before", Decimal(21))]
    assert {r[3] for r in changes} == {Decimal(21)}


def expected(spark, batches, missing):
    """Newest batch wins per day, then gap fill and metrics over everything."""
    best = {}
    for b in batches:
        own = {}
        for s, d, v in b:
            own[s, d] = max((x for x in (own.get((s, d)), v) if x is not None), default=None)
        best |= own
    df = spark.createDataFrame([(s, d, v) for (s, d), v in best.items()], OBS)
    return sorted((tuple(r) for r in series_metrics(gap_fill(df, missing=missing)).collect()), key=str)


@pytest.mark.parametrize("missing", ["null", "zero"])
def test_carried_state_equals_batch(spark, tmp, monkeypatch, missing):
    monkeypatch.setattr(S, "FOLDERS", 2)
    rng, day, batches = random.Random(3), dt.date(2020, 1, 1), []
    run = refresh_batch(spark, f"{tmp}/raw", f"{tmp}/m", missing, buckets=3)
    for i in range(7):
        rows = [(f"S{k}", day + dt.timedelta(rng.randrange(i * 6 - (4 if rng.random() < 0.2 else 0), i * 6 + 6)),
                 None if rng.random() < 0.15 else Decimal(rng.randrange(9000)) / 100) for k in range(8) for _ in range(rng.randrange(4))]
        batches.append(rows)
        run(spark.createDataFrame(rows, OBS), i)
        if i in (2, 6):
            run(spark.createDataFrame(rows, OBS), i)  # replayed
            assert sorted((tuple(r) for r in read_metrics(spark, f"{tmp}/m").collect()), key=str) == expected(spark, batches, missing)
    last = version(spark, f"{tmp}/m")
    for table in ("raw", "metrics", "state"):
        assert len(last.of(table)) <= 3 * 3


def test_history_is_not_read_for_later_days(spark, tmp):
    day = dt.date(2020, 1, 1)
    run = refresh_batch(spark, f"{tmp}/raw", f"{tmp}/m", "null", buckets=2)
    batches = [[(s, day + dt.timedelta(10 * i + j), Decimal(10 * i + j + len(s))) for s in ("A", "BB", "CCC") for j in range(5)] for i in range(3)]
    run(spark.createDataFrame(batches[0], OBS), 0)
    shutil.move(f"{tmp}/raw", f"{tmp}/away")  # no raw row of the first batch can be read
    shutil.move(f"{tmp}/m/data/metrics", f"{tmp}/metrics-away")
    run(spark.createDataFrame(batches[1], OBS), 1)
    shutil.copytree(f"{tmp}/away", f"{tmp}/raw", dirs_exist_ok=True)
    shutil.copytree(f"{tmp}/metrics-away", f"{tmp}/m/data/metrics", dirs_exist_ok=True)
    run(spark.createDataFrame(batches[2][:5], OBS), 2)
    assert sorted((tuple(r) for r in read_metrics(spark, f"{tmp}/m").collect()), key=str) == expected(spark, [*batches[:2], batches[2][:5]], "null")
