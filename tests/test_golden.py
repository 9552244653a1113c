"""Golden rows: the first days of the sample rate files, end to end through CSV ingestion,
gap fill, harmonization, conversion and metrics (values as listed in FIXTURES.md §3)."""

import os
from decimal import Decimal

import pytest

from rateflow.operators.harmonize import harmonize
from rateflow.operators.metrics import wide_metrics
from rateflow.sources.files import read_series_csv

# The first rows of the sample files (date, value; "." = missing).
DAILY = {
    "DINR": [("2020-01-01", "."), ("2020-01-02", "71.34"), ("2020-01-03", "71.76"), ("2020-01-06", "71.86")],
    "DEUR": [("2020-01-01", "."), ("2020-01-02", "1.1166"), ("2020-01-03", "1.1173"), ("2020-01-06", "1.1187")],
    "DGBP": [("2020-01-01", "."), ("2020-01-02", "1.3128"), ("2020-01-03", "1.3091"), ("2020-01-06", "1.3163")],
}
MONTHLY = {
    "MINR": [("2020-01-01", "71.2790"), ("2020-02-01", "71.5295"), ("2020-03-01", "74.5482")],
    "MEUR": [("2020-01-01", "1.1098"), ("2020-02-01", "1.0911"), ("2020-03-01", "1.1046")],
    "MGBP": [("2020-01-01", "1.3076"), ("2020-02-01", "1.2953"), ("2020-03-01", "1.2369")],
}

# date, INR, EU converted, UK converted, change x3, volatility x3
GOLDEN_ZERO = [
    ("2020-01-01", 0.0, "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000"),
    ("2020-01-02", 71.34, "0.8956", "0.7617", "0.0000", "0.0000", "0.0000", "50.4450", "0.6333", "0.5386"),
    ("2020-01-03", 71.76, "0.8950", "0.7639", "0.5887", "0.0670", "0.2888", "41.3099", "0.5169", "0.4404"),
    ("2020-01-04", 71.76, "0.8950", "0.7639", "0.0000", "0.0000", "0.0000", "35.8105", "0.4476", "0.3816"),
]
GOLDEN_NULL = [
    ("2020-01-01", None, None, None, "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000"),
    ("2020-01-02", 71.34, "0.8956", "0.7617", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000"),
    ("2020-01-03", 71.76, "0.8950", "0.7639", "0.5887", "0.0670", "0.2888", "0.2970", "0.0004", "0.0016"),
    ("2020-01-04", 71.76, "0.8950", "0.7639", "0.0000", "0.0000", "0.0000", "0.2425", "0.0003", "0.0013"),
]
GOLDEN_MONTHLY = [
    ("2020-01-01", 71.279, "0.9011", "0.7648", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000", "0.0000"),
    ("2020-02-01", 71.5295, "0.9165", "0.7720", "0.3514", "1.7090", "0.9414", "0.1771", "0.0109", "0.0051"),
    ("2020-03-01", 74.5482, "0.9053", "0.8085", "4.2202", "1.2220", "4.7280", "1.8195", "0.0080", "0.0234"),
]


def land(tmp, series):
    for sid, rows in series.items():
        with open(os.path.join(tmp, f"{sid}.csv"), "w") as fh:
            fh.write("date,value\n" + "".join(f"{d},{v}\n" for d, v in rows))
    return tmp


def as_tuples(rows):
    out = []
    for r in rows:
        vals = list(r)
        out.append((vals[0].isoformat(), vals[1]) + tuple(None if v is None else str(v) for v in vals[2:]))
    return out


def expected(golden):
    return [(g[0], g[1]) + tuple(None if v is None else str(Decimal(v)) for v in g[2:]) for g in golden]


@pytest.mark.parametrize("missing,golden", [("zero", GOLDEN_ZERO), ("null", GOLDEN_NULL)])
def test_daily_golden(spark, tmp, missing, golden):
    obs = read_series_csv(spark, land(tmp, DAILY))
    wide = harmonize(obs, ["DINR", "DEUR", "DGBP"], ["DEUR", "DGBP"], fill=True, missing=missing, out_date="DDATE")
    m = wide_metrics(wide, "DDATE", ["DINR", "DEUR_CONVERTED", "DGBP_CONVERTED"]).orderBy("DDATE").collect()
    assert len(m) == 6  # 2020-01-01 .. 2020-01-06, weekend filled
    assert as_tuples(m[:4]) == expected(golden)


def test_monthly_golden(spark, tmp):
    obs = read_series_csv(spark, land(tmp, MONTHLY))
    wide = harmonize(obs, ["MINR", "MEUR", "MGBP"], ["MEUR", "MGBP"], fill=False, out_date="MDATE")
    m = wide_metrics(wide, "MDATE", ["MINR", "MEUR_CONVERTED", "MGBP_CONVERTED"]).orderBy("MDATE").collect()
    assert as_tuples(m) == expected(GOLDEN_MONTHLY)


def test_refresh_from_files_end_to_end(spark, tmp):
    from rateflow.plans.refresh import refresh_from_files, table_names

    land(tmp, DAILY)
    land(tmp, MONTHLY)
    status = refresh_from_files(spark, tmp, env="rf_golden", convert=["DEUR", "DGBP", "MEUR", "MGBP"],
                                root=f"{tmp}-tables")
    assert "up to date" in status
    names = table_names("rf_golden")
    daily = spark.table(names["DAILY_metrics"]).orderBy("DDATE").select(
        "DDATE", "DINR", "DEUR_CONVERTED", "DGBP_CONVERTED",
        "rate_change_percent_dinr", "rate_change_percent_deur_converted", "rate_change_percent_dgbp_converted",
        "volatility_dinr", "volatility_deur_converted", "volatility_dgbp_converted").collect()
    got = [(r[0].isoformat(), float(r[1])) + tuple(str(v) for v in r[2:]) for r in daily[:4]]
    assert got == expected(GOLDEN_ZERO)
    monthly = spark.table(names["MONTHLY_metrics"]).orderBy("MDATE").select(
        "MDATE", "MINR", "MEUR_CONVERTED", "MGBP_CONVERTED",
        "rate_change_percent_minr", "rate_change_percent_meur_converted", "rate_change_percent_mgbp_converted",
        "volatility_minr", "volatility_meur_converted", "volatility_mgbp_converted").collect()
    assert [(r[0].isoformat(), float(r[1])) + tuple(str(v) for v in r[2:]) for r in monthly] == \
        expected(GOLDEN_MONTHLY)


def test_weekly_tables_from_daily(spark, tmp):
    from rateflow.plans.refresh import refresh_from_files, table_names

    land(tmp, DAILY)
    refresh_from_files(spark, tmp, env="rf_weekly", convert=["DEUR", "DGBP"], root=f"{tmp}-tables", weekly=True)
    rows = spark.table(table_names("rf_weekly")["WEEKLY_harmonized"]).orderBy("WDATE").collect()
    # week of Mon 2019-12-30 ends with the 2020-01-03 value; week of 2020-01-06 has one day
    assert [(r.WDATE.isoformat(), float(r.DINR)) for r in rows] == [("2019-12-30", 71.76), ("2020-01-06", 71.86)]
    m = spark.table(table_names("rf_weekly")["WEEKLY_metrics"]).orderBy("WDATE").collect()
    assert str(m[1].rate_change_percent_dinr) == "0.1394"


def test_refresh_with_null_policy(spark, tmp):
    from rateflow.plans.refresh import refresh_from_files, table_names

    land(tmp, DAILY)
    refresh_from_files(spark, tmp, env="rf_nullpol", convert=["DEUR", "DGBP"], root=f"{tmp}-tables", missing="null")
    rows = spark.table(table_names("rf_nullpol")["DAILY_metrics"]).orderBy("DDATE").select(
        "DDATE", "DINR", "DEUR_CONVERTED", "DGBP_CONVERTED",
        "rate_change_percent_dinr", "rate_change_percent_deur_converted", "rate_change_percent_dgbp_converted",
        "volatility_dinr", "volatility_deur_converted", "volatility_dgbp_converted").collect()
    got = [(r[0].isoformat(), None if r[1] is None else float(r[1])) + tuple(None if v is None else str(v)
                                                                            for v in r[2:]) for r in rows[:4]]
    assert got == expected(GOLDEN_NULL)
