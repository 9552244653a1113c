"""Every operator of the blueprint as a query over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame built from the whole
``orders`` (and ``customer``) table; file, table and stream queries first land data that
Spark derives from those tables in the shared checkpoint folder, then read it back with
the operator under test. ``rateflow.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

from rateflow.functions.arrays import forward_fill_array
from rateflow.functions.numeric import round_double, usd_conversion
from rateflow.functions.sql import register_harmonized_combined, register_sql_functions
from rateflow.functions.strings import base_name, route_frequency, series_from_partition_dir, series_from_path, strip_prefix
from rateflow.operators.fill import (
    date_spine,
    forward_fill,
    forward_fill_nonzero,
    gap_fill,
    series_span,
    spine_left_join,
)
from rateflow.operators.harmonize import (
    combined_currency,
    harmonize,
    harmonize_outer_join,
    harmonize_pivot,
    union_daily_monthly,
    weekly_observations,
)
from rateflow.operators.metrics import (
    abs_pct_change,
    expanding_stddev,
    lag_value,
    metrics_skeleton,
    series_metrics,
    volatility,
    wide_metrics,
)
from rateflow.operators.serve import latest, serve_latest, serve_metric_group, sort_series
from rateflow.plans import catalog as C
from rateflow.plans.load import load_new_files, loaded_rows
from rateflow.plans.refresh import Frequency, metric_columns, refresh_metrics, serve_published, table_names
from rateflow.session import shared_dir
from rateflow.sinks.files import write_series_csv, write_series_json
from rateflow.sinks.tables import (
    append_table,
    create_table_as,
    declared_schema_table,
    guard_tables,
    null_to_zero,
    update_from,
)
from rateflow.sinks.versions import publish, read_version, update_parts, version, write_parts
from rateflow.sources.files import (
    create_table_from_files,
    list_source_files,
    read_series_csv,
    read_series_json,
    rejected_rows,
    with_frequency,
)
from rateflow.sources.tables import all_observations, order_observations
from rateflow.streaming.changes import table_changes
from rateflow.streaming.consume import append_to, consume, count_then_append, land
from rateflow.streaming.refresh import read_metrics, stream_refresh

Query = Callable[[SparkSession, str], DataFrame]

DAILY = Frequency("DAILY", "DDATE", C.DAILY_IDS, C.DAILY_CONVERT, C.DAILY_RATES, fill=True)
MONTHLY = Frequency("MONTHLY", "MDATE", C.MONTHLY_IDS, C.MONTHLY_CONVERT, C.MONTHLY_RATES, fill=False)


# --- shared inputs ---------------------------------------------------------------------

def _daily(spark, sf):
    return order_observations(spark, sf, "DAILY", "priority")


def _monthly(spark, sf):
    return order_observations(spark, sf, "MONTHLY", "priority")


def _sparse(spark, sf):
    """Many sparse daily series (nation x priority): the long-layout workload."""
    return order_observations(spark, sf, "DAILY", "nation_priority").select("series_id", "date", "value")


def _filled(spark, sf, missing="zero"):
    return gap_fill(_sparse(spark, sf), ["series_id"], "date", "value", missing=missing)


def _harmonized(spark, sf, f: Frequency):
    obs = _daily(spark, sf) if f is DAILY else _monthly(spark, sf)
    return harmonize(obs, f.ids, f.convert, fill=f.fill, missing="zero", out_date=f.date_col)


def _metrics(spark, sf, f: Frequency):
    wide = _harmonized(spark, sf, f)
    return wide_metrics(wide, f.date_col, f.rates)


def _landed_csv(spark, sf, **kw) -> str:
    """All observations landed as CSV under ``freq=/series_id=`` folders."""
    path = shared_dir(spark, "landing-csv")
    obs = all_observations(spark, sf)
    spread = obs.repartition("freq", "series_id", F.year("date"))
    write_series_csv(spread.select("freq", "series_id", "date", "value"), path, **kw)
    return path


# --- sources ---------------------------------------------------------------------------

def scan_csv_nullif(spark, sf):
    """Four different null markers and padded fields in the files -> NULL / trimmed."""
    path = shared_dir(spark, "landing-markers")
    obs = all_observations(spark, sf)
    marker = F.element_at(F.array(*[F.lit(m) for m in ("." , "NULL", "null", "")]),
                          (F.dayofmonth("date") % 4 + 1).cast("int"))
    text = F.when(F.col("value").isNull(), marker).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
    obs.repartition("freq", "series_id", F.year("date")).select(
        "freq", "series_id", "date", text.alias("value")
    ).write.option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).partitionBy("freq", "series_id").csv(path)
    return read_series_csv(spark, path, series_from="dir")


def scan_csv_quoted(spark, sf):
    path = _landed_csv(spark, sf, quote_all=True)
    return read_series_csv(spark, path, series_from="dir")


def scan_csv_infer(spark, sf):
    """Schema inferred from the files (empty field = NULL, so value infers as double)."""
    path = _landed_csv(spark, sf, null_value="")
    return read_series_csv(spark, path, infer=True, series_from="dir")


def _landed_unreadable(spark, sf) -> str:
    """The observations as CSV, with text that is no number where the value is missing."""
    path = shared_dir(spark, "landing-unreadable")
    obs = all_observations(spark, sf)
    text = F.coalesce(F.col("value").cast("string"), F.concat(F.lit("n/a "), F.col("date").cast("string")))
    write_series_csv(obs.select("freq", "series_id", "date", text.alias("value")), path)
    return path


def rejected_rows_q(spark, sf):
    found = rejected_rows(spark, _landed_unreadable(spark, sf), series_from="dir")
    return found.select("series_id", F.col("date").cast("date").alias("date"), "value")


def load_without_rejects(spark, sf):
    return read_series_csv(spark, _landed_unreadable(spark, sf), series_from="dir", unreadable="drop")


def mixed_headers(spark, sf):
    """``date,value`` and ``VALUE,DATE`` files side by side in each folder, values of seven
    decimals: each file by its own header, nothing rounded."""
    path = shared_dir(spark, "landing-mixed")
    obs = all_observations(spark, sf).withColumn("value", F.col("value").cast("double") + F.lit(0.0000125))
    even = F.dayofmonth("date") % 2 == 0
    for part, names in ((obs.filter(even), ("date", "value")), (obs.filter(~even), ("VALUE", "DATE"))):
        out = part.select("freq", "series_id", *[F.col(n.lower()).alias(n) for n in names])
        out.write.mode("append").option("header", True).option("nullValue", ".").partitionBy("freq", "series_id").csv(path)
    return read_series_csv(spark, path, series_from="dir")


def wide_headers(spark, sf):
    """Files of 40 columns, the observation in two of the last: a header of any width is read."""
    path = shared_dir(spark, "landing-wide")
    filler = [F.lit(i).alias(f"c{i}") for i in range(35)]
    all_observations(spark, sf).select("freq", "series_id", *filler, F.col("value").alias("VALUE"), F.lit("x").alias("note"), F.col("date").alias("Date"), F.lit(0).alias("z")) \
        .write.option("header", True).option("nullValue", ".").partitionBy("freq", "series_id").csv(path)
    return read_series_csv(spark, path, series_from="dir")


def infer_mixed_headers(spark, sf):
    """Inferred types over files of two header orders: each file's columns by its own names."""
    path = shared_dir(spark, "landing-infer")
    obs = all_observations(spark, sf)
    even = F.dayofmonth("date") % 2 == 0
    for part, names in ((obs.filter(even), ("date", "value")), (obs.filter(~even), ("VALUE", "DATE"))):
        out = part.select("freq", "series_id", *[F.col(n.lower()).alias(n) for n in names])
        out.write.mode("append").option("header", True).option("nullValue", "").partitionBy("freq", "series_id").csv(path)
    return read_series_csv(spark, path, infer=True, series_from="dir")


def load_history(spark, sf):
    """Two arrivals of files in one folder, loaded by four runs: the second and the fourth find nothing new."""
    path, root = shared_dir(spark, "landing-history"), shared_dir(spark, "store-history")
    for arrival in _arrivals(spark, sf):
        write_series_csv(arrival, path, partition_by=("series_id",), mode="append")
        for _ in range(2):
            load_new_files(spark, path, root, series_from="dir")
    return loaded_rows(spark, version(spark, root).parts)


def inferred_schema_table(spark, sf):
    return create_table_from_files(spark, "rateflow_inferred_observations", _landed_csv(spark, sf, null_value=""),
                                   shared_dir(spark, "table-inferred"))


def list_source_files_q(spark, sf):
    path = _landed_csv(spark, sf)
    files = list_source_files(spark, path)
    return files.groupBy(series_from_partition_dir("file_path").alias("series_id")).agg(
        F.bool_and(F.col("file_size") > 0).alias("all_filled"))


def series_from_path_q(spark, sf):
    """The series of ``<folder>/<series>.csv`` names, one per observation."""
    file = F.concat(F.lit("stage/"), F.initcap("freq"), F.lit("/"), F.lower("series_id"), F.lit(".csv"))
    named = all_observations(spark, sf).select(file.alias("file_path"))
    return named.groupBy(series_from_path("file_path").alias("series_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def route_frequency_q(spark, sf):
    path = _landed_csv(spark, sf)
    df = read_series_csv(spark, path, series_from="dir")
    return df.groupBy("series_id", route_frequency("series_id").alias("freq")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def load_all_series(spark, sf):
    """One recursive read of every file of every frequency into the long table."""
    path = _landed_csv(spark, sf)
    return with_frequency(read_series_csv(spark, path, series_from="dir"))


def copy_by_name(spark, sf):
    """Headers in another order and case (``VALUE,DATE``) still map by name."""
    path = shared_dir(spark, "landing-upper")
    obs = all_observations(spark, sf)
    obs.repartition("freq", "series_id", F.year("date")).select(
        "freq", "series_id", F.col("value").alias("VALUE"), F.col("date").alias("DATE")
    ).write.option("header", True).option("nullValue", ".").partitionBy("freq", "series_id").csv(path)
    return read_series_csv(spark, path, series_from="dir")


def scan_table(spark, sf):
    name = "rateflow_scan_observations"
    create_table_as(_daily(spark, sf), name, shared_dir(spark, "table-scan"))
    return spark.table(name)


def scan_json_observations(spark, sf):
    path = shared_dir(spark, "landing-json")
    write_series_json(all_observations(spark, sf), path)
    return read_series_json(spark, path)


def filter_date_range_q(spark, sf):
    path = shared_dir(spark, "landing-json-range")
    write_series_json(all_observations(spark, sf), path)
    return read_series_json(spark, path, start=C.RANGE_START)


def literal_rows(spark, sf):
    """Inline literal rows (``TO_DATE``, decimals, aliases) joined to the observed series."""
    meta = spark.sql(
        """
        SELECT * FROM VALUES
          ('1', 'URGENT',        TO_DATE('1995-01-01'), CAST(1.0000 AS DECIMAL(10,4))),
          ('2', 'HIGH',          TO_DATE('1995-01-01'), CAST(1.0000 AS DECIMAL(10,4))),
          ('3', 'MEDIUM',        TO_DATE('1995-01-01'), CAST(0.5000 AS DECIMAL(10,4))),
          ('4', 'NOT SPECIFIED', TO_DATE('1995-01-01'), CAST(0.2500 AS DECIMAL(10,4))),
          ('5', 'LOW',           TO_DATE('1995-01-01'), CAST(0.2500 AS DECIMAL(10,4)))
          AS meta(code, label, since, weight)
        """
    )
    obs = all_observations(spark, sf)
    per = obs.groupBy(F.substring("series_id", 3, 1).alias("code"), "freq").agg(
        F.count(F.lit(1)).alias("n_obs"), F.min("date").alias("first_date"))
    return per.join(meta, "code").select(
        "code", "label", "freq", "n_obs", "weight",
        F.date_diff("first_date", "since").cast("bigint").alias("days_since"))


def date_spine_q(spark, sf):
    return date_spine(_sparse(spark, sf), ["series_id"], "date")


def date_add_seq(spark, sf):
    """``DATEADD(DAY, SEQ, min_date)`` over a generated sequence per series."""
    span = series_span(_sparse(spark, sf))
    return span.select(
        "series_id", F.explode(F.sequence(F.lit(0), F.col("day_diff"))).alias("seq"), "min_date"
    ).select("series_id", "seq", F.date_add("min_date", F.col("seq").cast("int")).alias("date"))


# --- sinks -----------------------------------------------------------------------------

def ctas_harmonized(spark, sf):
    name = "rateflow_harmonized_daily_tbl"
    return create_table_as(_harmonized(spark, sf, DAILY), name, shared_dir(spark, "table-ctas"))


def view_roundtrip(spark, sf):
    _harmonized(spark, sf, MONTHLY).createOrReplaceTempView("harmonized_monthly_v")
    return spark.table("harmonized_monthly_v")


def append_table_q(spark, sf):
    name = "rateflow_append_observations"
    create_table_as(_daily(spark, sf), name, shared_dir(spark, "table-append"))
    return append_table(_monthly(spark, sf), name)


def sink_csv_roundtrip(spark, sf):
    """CSV sink with header per ``freq=/series_id=`` folder, read back by partition discovery."""
    path = _landed_csv(spark, sf)
    back = spark.read.option("header", True).option("nullValue", ".").schema(
        "date DATE, value DOUBLE, freq STRING, series_id STRING").csv(path)
    return back.select("series_id", "freq", "date", "value")


def declared_schema_table_q(spark, sf):
    name = "rateflow_declared_observations"
    schema = "series_id STRING, date DATE, value DECIMAL(18,4)"
    declared_schema_table(spark, name, schema, shared_dir(spark, "table-declared"))
    return append_table(_daily(spark, sf), name)


def null_to_zero_q(spark, sf):
    return null_to_zero(all_observations(spark, sf), "value")


def update_from_join(spark, sf):
    wide = _harmonized(spark, sf, DAILY).select("DDATE", *C.DAILY_RATES)
    skeleton = metrics_skeleton(wide, "DDATE", C.DAILY_RATES)
    tmp = wide_metrics(wide, "DDATE", C.DAILY_RATES)
    return update_from(skeleton, tmp, "DDATE", metric_columns(C.DAILY_RATES))


def update_parts_q(spark, sf):
    """An update by key of a table in monthly parts: only the months it hits are written."""
    root = shared_dir(spark, "store-update")
    publish(spark, root, write_parts(_daily(spark, sf), root, "daily", BY_MONTH, "date"))
    update_parts(spark, root, "daily", _restated(_daily(spark, sf)).filter(RESTATED), ["series_id", "date"], ["value"], BY_MONTH, "date")
    return read_version(spark, root, "daily")


def serve_published_q(spark, sf):
    """The newest rows of a metric group, from the newest yearly parts of the published table."""
    root = shared_dir(spark, "store-serve")
    refresh_metrics(spark, all_observations(spark, sf), [DAILY, MONTHLY], env="rateflow_serve", root=root)
    return serve_published(spark, root, "daily_metrics", "DDATE", C.DAILY_RATES, k=20, group="volatility")


def _refresh(spark, sf, env):
    raw = all_observations(spark, sf)
    refresh_metrics(spark, raw, [DAILY, MONTHLY], env=env)
    return table_names(env)


def refresh_metrics_q(spark, sf):
    names = _refresh(spark, sf, "rateflow_dev")
    return spark.table(names["DAILY_metrics"])


def guard_tables_q(spark, sf):
    names = _refresh(spark, sf, "rateflow_guard")
    guard_tables(spark, [names["DAILY_harmonized"], names["MONTHLY_harmonized"]])
    return spark.table(names["MONTHLY_harmonized"])


def env_layers(spark, sf):
    """Row counts of every table the daily and monthly refresh wrote, per layer."""
    names = _refresh(spark, sf, "rateflow_prod")
    written = ["raw"] + [f"{f}_{kind}" for kind in ("harmonized", "metrics") for f in ("DAILY", "MONTHLY")]
    parts = [
        spark.table(t).groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t.split(".")[0]).alias("layer"), F.lit(t.split(".")[1]).alias("table_name"), "n_rows")
        for t in (names[k] for k in written)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- projections, joins, aggregates ------------------------------------------------------

def project_rename(spark, sf):
    return _daily(spark, sf).select(F.col("date").alias("DDATE"), F.col("series_id").alias("SERIES"),
                                    F.col("value").alias("RATE"))


def metrics_skeleton_q(spark, sf):
    wide = _harmonized(spark, sf, DAILY).select("DDATE", *C.DAILY_RATES)
    return metrics_skeleton(wide, "DDATE", C.DAILY_RATES)


def serve_metric_group_q(spark, sf):
    return serve_metric_group(_metrics(spark, sf, DAILY), "DDATE", "volatility", C.DAILY_RATES)


def spine_left_join_q(spark, sf):
    return spine_left_join(_sparse(spark, sf), ["series_id"], "date", "value")


def _filled_priority(spark, sf):
    return gap_fill(_daily(spark, sf).select("series_id", "date", "value"), ["series_id"], "date", "value",
                    missing="null")


def harmonize_outer_join_q(spark, sf):
    return harmonize_outer_join(_filled_priority(spark, sf), C.DAILY_IDS, out_date="DDATE", materialize=True)


def harmonize_pivot_q(spark, sf):
    return harmonize_pivot(_filled_priority(spark, sf), C.DAILY_IDS, out_date="DDATE")


def combined_currency_q(spark, sf):
    return combined_currency(all_observations(spark, sf), C.COMBINED)


def combined_currency_table(spark, sf):
    """The combined table through a declared schema (date and currencies) and an insert; rows
    of both frequencies keep their order of columns, not their frequency."""
    name = "rateflow_combined_currency"
    schema = "date STRING, " + ", ".join(f"{c} DOUBLE" for c in C.COMBINED)
    declared_schema_table(spark, name, schema, shared_dir(spark, "table-combined"))
    return append_table(combined_currency_q(spark, sf).drop("freq"), name)


def harmonized_combined(spark, sf):
    """The harmonized tables of both frequencies through one table function, called by name."""
    _harmonized(spark, sf, DAILY).createOrReplaceTempView("rateflow_daily_h")
    _harmonized(spark, sf, MONTHLY).createOrReplaceTempView("rateflow_monthly_h")
    register_harmonized_combined(
        spark, {"DAILY": ("rateflow_daily_h", "DDATE", C.DAILY_IDS), "MONTHLY": ("rateflow_monthly_h", "MDATE", C.MONTHLY_IDS)}, list(C.COMBINED))
    return spark.sql(f"SELECT * FROM harmonized_combined(DATE'{C.RANGE_START}')")


def harmonize_listed(spark, sf):
    """Two of the series, in a table that has others with dates of their own."""
    return harmonize_pivot(_sparse(spark, sf), C.LISTED, out_date="DDATE")


def series_span_q(spark, sf):
    return series_span(_sparse(spark, sf))


def row_count(spark, sf):
    return all_observations(spark, sf).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))


def global_agg(spark, sf):
    obs = all_observations(spark, sf)
    return obs.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("value").alias("n_values"),
        F.sum("value").cast("decimal(38,4)").alias("sum_value"),
    )


def _month_blocks(spark, sf):
    """Per series and month: dates and values in date order (NULLs kept; bounded arrays)."""
    obs = _daily(spark, sf)
    return obs.groupBy("series_id", F.trunc("date", "MM").alias("month")).agg(
        F.array_sort(F.collect_list(F.struct("date", "value"))).alias("_rows"))


def series_array_agg(spark, sf):
    b = _month_blocks(spark, sf)
    return b.select("series_id", "month", F.transform("_rows", lambda r: r["value"].cast("double")).alias("vals"))


def rows_to_objects(spark, sf):
    """Rows as JSON objects per series and month; NULL fields are left out of an object."""
    obs = _daily(spark, sf)
    return obs.groupBy("series_id", F.trunc("date", "MM").alias("month")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("*")))).alias("objects"))


def _array_filled(spark, sf):
    """Month arrays filled with the array fold, seeded by the last valid value of the
    series' earlier months (a per-series window over month rows)."""
    from pyspark.sql import Window

    b = _month_blocks(spark, sf).withColumn("vals", F.transform("_rows", lambda r: r["value"]))
    valid_last = F.try_element_at(F.filter("vals", lambda x: x.isNotNull() & (x != 0)), F.lit(-1))
    w = Window.partitionBy("series_id").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_last_valid", valid_last.cast("double"))
    b = b.withColumn("_seed", F.last("_last_valid", ignorenulls=True).over(w))
    return b.withColumn("filled", forward_fill_array("vals", F.col("_seed")))


def forward_fill_array_q(spark, sf):
    return _array_filled(spark, sf).select("series_id", "month", "filled")


def forward_fill_array_sql(spark, sf):
    """The array fill called by name from SQL, on each month's values alone."""
    register_sql_functions(spark)
    series_array_agg(spark, sf).createOrReplaceTempView("rateflow_month_values")
    return spark.sql("SELECT series_id, month, forward_fill_array(vals) AS filled FROM rateflow_month_values")


def explode_filled(spark, sf):
    b = _array_filled(spark, sf)
    z = b.select("series_id", F.explode(F.arrays_zip(F.transform("_rows", lambda r: r["date"]).alias("d"),
                                                      F.col("filled").alias("v"))).alias("z"))
    return z.select("series_id", F.col("z.d").alias("date"), F.col("z.v").alias("value"))


def forward_fill_nonzero_q(spark, sf):
    return forward_fill_nonzero(_daily(spark, sf).select("series_id", "date", "value"))


# --- windows and metrics ---------------------------------------------------------------------

def forward_fill_window(spark, sf):
    return forward_fill(_sparse(spark, sf), ["series_id"], "date", "value")


def lag_value_q(spark, sf):
    return lag_value(_filled(spark, sf))


def expanding_stddev_q(spark, sf):
    s = expanding_stddev(_filled(spark, sf))
    return s.withColumn("stddev_value", round_double("stddev_value", 4).cast("decimal(18,4)"))


def abs_pct_change_q(spark, sf):
    return abs_pct_change(_filled(spark, sf))


def volatility_q(spark, sf):
    return volatility(_filled(spark, sf))


def gap_fill_q(spark, sf):
    return _filled(spark, sf, "zero")


def gap_fill_null(spark, sf):
    return _filled(spark, sf, "null")


def series_metrics_q(spark, sf):
    return series_metrics(_filled(spark, sf, "null"))


# The same operators on the blocked prefix scan (a series split over yearly blocks).
BLOCK_DAYS = 366


def gap_fill_blocked(spark, sf):
    return gap_fill(_sparse(spark, sf), ["series_id"], "date", "value", missing="zero", block_days=BLOCK_DAYS)


def series_metrics_blocked(spark, sf):
    filled = gap_fill(_sparse(spark, sf), ["series_id"], "date", "value", missing="null", block_days=BLOCK_DAYS)
    return series_metrics(filled, block_days=BLOCK_DAYS)


def daily_metrics_blocked(spark, sf):
    obs = _daily(spark, sf)
    wide = harmonize(obs, DAILY.ids, DAILY.convert, fill=True, missing="zero", out_date="DDATE",
                     block_days=BLOCK_DAYS)
    return wide_metrics(wide, "DDATE", DAILY.rates, block_days=BLOCK_DAYS)


def usd_conversion_q(spark, sf):
    obs = null_to_zero(_daily(spark, sf), "value")
    return obs.select("series_id", "date", "value", usd_conversion("value").alias("value_converted"))


def usd_conversion_sql_udf(spark, sf):
    register_sql_functions(spark)
    null_to_zero(_daily(spark, sf), "value").createOrReplaceTempView("rateflow_daily_obs")
    return spark.sql(
        "SELECT series_id, date, value, usd_conversion(value) AS value_converted FROM rateflow_daily_obs")


def string_keys(spark, sf):
    ids = all_observations(spark, sf).select("series_id", "freq").distinct()
    raw_name = F.concat(F.lit("RAW_"), F.col("series_id"))
    stage_path = F.concat(F.lit("stage/"), F.lower("freq"), F.lit("/"), F.lower("series_id"), F.lit(".csv"))
    return ids.select(
        "series_id",
        raw_name.alias("raw_table"),
        strip_prefix(raw_name).alias("stripped"),
        F.split_part(F.concat(F.lit("RAW_"), F.col("freq")), F.lit("_"), F.lit(2)).alias("layer_part"),
        base_name(stage_path).alias("file_name"),
        series_from_path(stage_path).alias("from_file"),
    )


def harmonize_daily(spark, sf):
    return _harmonized(spark, sf, DAILY)


def harmonize_monthly(spark, sf):
    return _harmonized(spark, sf, MONTHLY)


def daily_metrics(spark, sf):
    return _metrics(spark, sf, DAILY)


def monthly_metrics(spark, sf):
    return _metrics(spark, sf, MONTHLY)


def weekly_metrics(spark, sf):
    """Weekly series (week starting Monday), harmonized and measured like the monthly ones."""
    obs = order_observations(spark, sf, "DAILY", "priority").select("series_id", "date", "value")
    weekly = weekly_observations(obs)
    weekly = weekly.withColumn("series_id", F.concat(F.lit("W"), F.substring("series_id", 2, 2)))
    ids = [f"WP{c}" for c in "12345"]
    wide = harmonize(weekly, ids, ["WP2", "WP3"], fill=False, missing="zero", out_date="WDATE")
    return wide_metrics(wide, "WDATE", C.rate_columns(ids, ["WP2", "WP3"]))


# --- sorts, top-k, unions ----------------------------------------------------------------------

def sort_series_q(spark, sf):
    return sort_series(_filled(spark, sf), ["series_id", "date"])


def latest_20(spark, sf):
    return latest(_metrics(spark, sf, DAILY), "DDATE", 20)


def latest_5(spark, sf):
    return latest(_metrics(spark, sf, MONTHLY), "MDATE", 5)


def latest_20_ascending(spark, sf):
    return latest(_metrics(spark, sf, DAILY), "DDATE", 20, ascending=True)


def serve_latest_q(spark, sf):
    return serve_latest(_metrics(spark, sf, MONTHLY), "MDATE", C.MONTHLY_RATES, k=20, group="changes")


def union_daily_monthly_q(spark, sf):
    return union_daily_monthly(_daily(spark, sf), _monthly(spark, sf))


# --- streams --------------------------------------------------------------------------------------

_OBS_SCHEMA = StructType([
    StructField("series_id", StringType()),
    StructField("date", DateType()),
    StructField("value", DecimalType(18, 4)),
])


def _arrivals(spark, sf, key="priority"):
    """The observations in two arrivals, split at the cutoff date. The bound is applied to
    the raw order date, so each arrival reads only its own Parquet row groups."""
    cols = ["series_id", "date", "value"]
    first = order_observations(spark, sf, "DAILY", key, end=C.ARRIVAL_CUTOFF).select(*cols)
    second = order_observations(spark, sf, "DAILY", key, start=C.ARRIVAL_CUTOFF).select(*cols)
    return first, second


def stream_empty_start(spark, sf):
    """A stream without initial rows that is created before the first file lands: every row of
    both arrivals comes through."""
    src, sink, ckpt = (shared_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    first, second = _arrivals(spark, sf)
    land(first.limit(0), src)
    for i, arrival in enumerate((first.limit(0), first, second)):
        if i:
            land(arrival, src)
        consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=i), initial_rows=False)
    return spark.read.schema("series_id STRING, date DATE, value DECIMAL(18,4), run INT, batch INT") \
        .parquet(sink).select("series_id", "date", "value")


def stream_restated(spark, sf):
    """The second arrival restates every first day of a month with twice its value and brings the
    days of 1994 late; the newest value of a day counts."""
    src, ckpt, raw, metrics = (shared_dir(spark, n) for n in ("stream-src", "stream-ckpt", "stream-raw",
                                                              "stream-metrics"))
    obs = _daily(spark, sf).select("series_id", "date", "value")
    restated = F.dayofmonth("date") == 1
    late = F.year("date") == 1994
    land(obs.filter(~late), src)
    stream_refresh(spark, src, _OBS_SCHEMA, ckpt, raw, metrics, missing="null")
    twice = F.when(restated, (F.col("value") * 2).cast("decimal(18,4)")).otherwise(F.col("value"))
    land(obs.filter(restated | late).withColumn("value", twice), src)
    stream_refresh(spark, src, _OBS_SCHEMA, ckpt, raw, metrics, missing="null")
    return read_metrics(spark, metrics)


#: Days whose values the second version restates, and monthly parts.
RESTATED = "year(date) = 1995 AND day(date) = 1"
BY_MONTH = "date_format(date, 'yyyy-MM')"


def _restated(obs):
    return obs.withColumn("value", F.expr(f"CASE WHEN {RESTATED} THEN CAST(value * 2 AS DECIMAL(18,4)) ELSE value END"))


def table_changes_q(spark, sf):
    """The harmonized daily table, published twice: with restated days only the rows that differ come out."""
    root = shared_dir(spark, "store-changes")
    for obs in (_daily(spark, sf), _restated(_daily(spark, sf))):
        wide = harmonize(obs, DAILY.ids, DAILY.convert, fill=True, missing="zero", out_date="DDATE")
        publish(spark, root, write_parts(wide, root, "daily_harmonized", "date_format(DDATE, 'yyyy')", "DDATE"))
    return table_changes(spark, root, "daily_harmonized", ["DDATE"], since=1)


def stream_initial_rows(spark, sf):
    src, sink, ckpt = (shared_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    first, second = _arrivals(spark, sf)
    land(first, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=0), initial_rows=True)
    land(second, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=1), initial_rows=True)
    consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=2), initial_rows=True)  # nothing new
    return spark.read.parquet(sink).select("run", "series_id", "date", "value")


def stream_append_only(spark, sf):
    src, sink, ckpt = (shared_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    first, second = _arrivals(spark, sf)
    land(first, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=0), initial_rows=False)
    land(second, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, append_to(sink, run=1), initial_rows=False)
    return spark.read.schema("series_id STRING, date DATE, value DECIMAL(18,4), run INT, batch INT") \
        .parquet(sink).select("series_id", "date", "value")


def stream_pending_count(spark, sf):
    src, sink, status, ckpt = (shared_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-status",
                                                               "stream-ckpt"))
    first, second = _arrivals(spark, sf)
    land(first, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, count_then_append(sink, status, 0))
    land(second, src)
    consume(spark, src, _OBS_SCHEMA, ckpt, count_then_append(sink, status, 1))
    consume(spark, src, _OBS_SCHEMA, ckpt, count_then_append(sink, status, 2))  # no batch, no row
    st = spark.read.parquet(status)
    return st.groupBy("run").agg(F.sum("pending_rows").alias("pending_rows"))


def stream_consume(spark, sf):
    """Consume the observation stream into the raw table and refresh the metrics of the
    touched series after every batch; late rows land in old partitions correctly."""
    src, ckpt, raw, metrics = (shared_dir(spark, n) for n in ("stream-src", "stream-ckpt", "stream-raw",
                                                              "stream-metrics"))
    first, second = _arrivals(spark, sf, "nation_priority")
    land(first, src)
    stream_refresh(spark, src, _OBS_SCHEMA, ckpt, raw, metrics, missing="null")
    land(second, src)
    stream_refresh(spark, src, _OBS_SCHEMA, ckpt, raw, metrics, missing="null")
    return read_metrics(spark, metrics)


def stream_harmonized_initial_rows(spark, sf):
    """Change stream on the harmonized daily table, with its existing rows first: the table is
    written as Parquet, a new checkpoint emits every row once, a second run emits nothing."""
    tbl, sink, ckpt = (shared_dir(spark, n) for n in ("harm-tbl", "harm-sink", "harm-ckpt"))
    wide = _harmonized(spark, sf, DAILY)
    wide.write.mode("overwrite").parquet(tbl)
    schema = spark.read.parquet(tbl).schema
    consume(spark, tbl, schema, ckpt, append_to(sink, run=0), initial_rows=True)
    consume(spark, tbl, schema, ckpt, append_to(sink, run=1), initial_rows=True)  # nothing new
    return spark.read.parquet(sink).drop("run", "batch")


def stream_harmonized_monthly(spark, sf):
    """The same change stream on the harmonized monthly table."""
    tbl, sink, ckpt = (shared_dir(spark, n) for n in ("harm-tbl", "harm-sink", "harm-ckpt"))
    _harmonized(spark, sf, MONTHLY).write.mode("overwrite").parquet(tbl)
    schema = spark.read.parquet(tbl).schema
    for i in range(2):  # nothing new the second time
        consume(spark, tbl, schema, ckpt, append_to(sink, run=i), initial_rows=True)
    return spark.read.parquet(sink).drop("run", "batch")


_EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                  "props STRING")


def stream_driver_table(spark, sf):
    """A driver table consumed as an append-only change stream, straight from its folder
    (``pathGlobFilter`` picks the one file, the schema is given), then rolled up into daily
    observations per event type."""
    sink, ckpt = shared_dir(spark, "events-sink"), shared_dir(spark, "events-ckpt")
    stream = spark.readStream.schema(_EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf)
    from rateflow.streaming.consume import run_available

    run_available(stream.select("event_id", "event_type", "ts", "value"), ckpt, append_to(sink, run=0))
    run_available(stream.select("event_id", "event_type", "ts", "value"), ckpt, append_to(sink, run=1))
    ev = spark.read.parquet(sink)
    return ev.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_sum"),
        F.countDistinct("run").alias("n_runs"),
    )


QUERIES: dict[str, Query] = {
    # sources
    "scan_csv_nullif": scan_csv_nullif,
    "scan_csv_quoted": scan_csv_quoted,
    "scan_csv_infer": scan_csv_infer,
    "inferred_schema_table": inferred_schema_table,
    "wide_headers": wide_headers,
    "infer_mixed_headers": infer_mixed_headers,
    "load_history": load_history,
    "mixed_headers": mixed_headers,
    "rejected_rows": rejected_rows_q,
    "load_without_rejects": load_without_rejects,
    "list_source_files": list_source_files_q,
    "series_from_path": series_from_path_q,
    "route_frequency": route_frequency_q,
    "load_all_series": load_all_series,
    "copy_by_name": copy_by_name,
    "scan_table": scan_table,
    "scan_json_observations": scan_json_observations,
    "filter_date_range": filter_date_range_q,
    "literal_rows": literal_rows,
    "date_spine": date_spine_q,
    # sinks / tables
    "ctas_harmonized": ctas_harmonized,
    "view_roundtrip": view_roundtrip,
    "append_table": append_table_q,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "declared_schema_table": declared_schema_table_q,
    "null_to_zero": null_to_zero_q,
    "update_from_join": update_from_join,
    "update_parts": update_parts_q,
    "serve_published": serve_published_q,
    "guard_tables": guard_tables_q,
    "env_layers": env_layers,
    # projections
    "project_rename": project_rename,
    "metrics_skeleton": metrics_skeleton_q,
    "serve_metric_group": serve_metric_group_q,
    # joins
    "spine_left_join": spine_left_join_q,
    "harmonize_outer_join": harmonize_outer_join_q,
    "harmonize_pivot": harmonize_pivot_q,
    "harmonize_listed": harmonize_listed,
    "combined_currency": combined_currency_q,
    "combined_currency_table": combined_currency_table,
    "harmonized_combined": harmonized_combined,
    # aggregates
    "series_span": series_span_q,
    "row_count": row_count,
    "series_array_agg": series_array_agg,
    "rows_to_objects": rows_to_objects,
    "global_agg": global_agg,
    # windows
    "lag_value": lag_value_q,
    "expanding_stddev": expanding_stddev_q,
    "forward_fill_window": forward_fill_window,
    # sorts / top-k / unions
    "sort_series": sort_series_q,
    "latest_20": latest_20,
    "latest_5": latest_5,
    "latest_20_ascending": latest_20_ascending,
    "union_daily_monthly": union_daily_monthly_q,
    # scalars
    "string_keys": string_keys,
    "date_add_seq": date_add_seq,
    "explode_filled": explode_filled,
    # composites
    "usd_conversion": usd_conversion_q,
    "abs_pct_change": abs_pct_change_q,
    "volatility": volatility_q,
    "gap_fill": gap_fill_q,
    "gap_fill_null": gap_fill_null,
    "series_metrics": series_metrics_q,
    "gap_fill_blocked": gap_fill_blocked,
    "series_metrics_blocked": series_metrics_blocked,
    "daily_metrics_blocked": daily_metrics_blocked,
    "harmonize_daily": harmonize_daily,
    "harmonize_monthly": harmonize_monthly,
    "daily_metrics": daily_metrics,
    "monthly_metrics": monthly_metrics,
    "weekly_metrics": weekly_metrics,
    "refresh_metrics": refresh_metrics_q,
    "serve_latest": serve_latest_q,
    # streams
    "stream_append_only": stream_append_only,
    "stream_empty_start": stream_empty_start,
    "stream_restated": stream_restated,
    "stream_harmonized_monthly": stream_harmonized_monthly,
    "stream_initial_rows": stream_initial_rows,
    "stream_harmonized_initial_rows": stream_harmonized_initial_rows,
    "table_changes": table_changes_q,
    "stream_pending_count": stream_pending_count,
    "stream_consume": stream_consume,
    "stream_driver_table": stream_driver_table,
    # UDF surface
    "usd_conversion_sql_udf": usd_conversion_sql_udf,
    "forward_fill_nonzero": forward_fill_nonzero_q,
    "forward_fill_array": forward_fill_array_q,
    "forward_fill_array_sql": forward_fill_array_sql,
}
