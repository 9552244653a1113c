"""Scalar functions: conversion, percent change, array fill, string keys."""

from decimal import Decimal

from pyspark.sql import functions as F

from rateflow.functions import (
    abs_pct_change_expr,
    base_name,
    forward_fill_array,
    null_if_marker,
    register_sql_functions,
    route_frequency,
    series_from_path,
    strip_prefix,
    usd_conversion,
)

# The conversion cases of the reference unit tests (input, expected).
CONVERSION_CASES = [(0, "0.0000"), (1, "1.0000"), (2, "0.5000"), (4, "0.2500"), (0.5, "2.0000"), (None, None)]


def test_usd_conversion_table(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x, _ in CONVERSION_CASES], "x double")
    got = [r.y for r in df.select(usd_conversion("x").alias("y")).collect()]
    want = [Decimal(v) if v is not None else None for _, v in CONVERSION_CASES]
    assert got == want
    assert df.select(usd_conversion("x").alias("y")).schema["y"].dataType.simpleString() == "decimal(35,4)"


def test_usd_conversion_sql_function(spark):
    register_sql_functions(spark)
    rows = spark.sql(
        "SELECT usd_conversion(x) AS y FROM VALUES (2.0), (0.0), (CAST(NULL AS DOUBLE)), (3.0) t(x)"
    ).collect()
    assert [r.y for r in rows] == [Decimal("0.5000"), Decimal("0.0000"), None, Decimal("0.3333")]


def test_usd_conversion_rounds_argument_first(spark):
    # the argument is taken at 4 places, then inverted and rounded half up
    df = spark.createDataFrame([(1.11664,), (32.0,)], "x double")
    assert [r.y for r in df.select(usd_conversion("x").alias("y")).collect()] == [
        Decimal("0.8956"), Decimal("0.0313")]


def test_abs_pct_change_cases(spark):
    df = spark.createDataFrame(
        [(110.0, 100.0), (90.0, 100.0), (5.0, 0.0), (5.0, None), (None, 4.0), (1.0001, 1.0)],
        "x double, p double")
    got = [r.c for r in df.select(abs_pct_change_expr("x", "p").alias("c")).collect()]
    assert got == [Decimal("10.0000"), Decimal("10.0000"), Decimal("0.0000"), Decimal("0.0000"),
                   Decimal("0.0000"), Decimal("0.0100")]


def test_forward_fill_array_fixtures(spark):
    df = spark.createDataFrame(
        [([None, 1.0, 0.0, None, 2.0],), ([],), ([0.0, None],)], "a array<double>")
    got = [r.f for r in df.select(forward_fill_array("a").alias("f")).collect()]
    assert got == [[None, 1.0, 1.0, 1.0, 2.0], [], [None, None]]


def test_forward_fill_array_seed(spark):
    df = spark.createDataFrame([([0.0, None, 3.0],)], "a array<double>")
    got = df.select(forward_fill_array("a", F.lit(7.0)).alias("f")).first().f
    assert got == [7.0, 7.0, 3.0]


def test_string_keys(spark):
    df = spark.createDataFrame([("stage/daily/dinr.csv", "RAW_DINR", "DEUR"),
                                ("MGBP.csv", "RAW_MGBP", "MGBP")], "p string, t string, s string")
    r = df.select(series_from_path("p").alias("a"), base_name("p").alias("b"), strip_prefix("t").alias("c"),
                  route_frequency("s").alias("d")).collect()
    assert [tuple(x) for x in r] == [("DINR", "dinr.csv", "DINR", "DAILY"),
                                     ("MGBP", "MGBP.csv", "MGBP", "MONTHLY")]


def test_null_markers(spark):
    df = spark.createDataFrame([(" . ",), ("NULL",), ("null",), ("",), (None,), (" 1.5 ",)], "v string")
    assert [r.v for r in df.select(null_if_marker("v").alias("v")).collect()] == [None] * 5 + ["1.5"]


def test_change_keeps_the_inputs_precision(spark):
    from pyspark.sql import functions as F

    from rateflow.functions.numeric import abs_pct_change_expr

    for kind in ("double", "decimal(18,8)"):
        df = spark.range(1).select(F.lit("0.00674").cast(kind).alias("x"), F.lit("0.00671").cast(kind).alias("p"))
        assert str(df.select(abs_pct_change_expr("x", "p").alias("c")).collect()[0].c) == "0.4471"
