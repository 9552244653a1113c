"""DuckDB SQL equivalents of ``rateflow.plans.queries`` (the correctness oracle).

DuckDB divides decimals in double precision, so every rounded quotient here (mean price,
reciprocal, percent change) is written as an exact half-up integer division; Spark computes
the same values in exact decimal arithmetic.
"""

from __future__ import annotations

from rateflow.plans import catalog as C

# --- building blocks -------------------------------------------------------------------------


def obs_sql(freq: str = "DAILY", key: str = "priority") -> str:
    daily = freq == "DAILY"
    day = "CAST(o.o_orderdate AS DATE)" if daily else "CAST(date_trunc('month', o.o_orderdate) AS DATE)"
    sid = f"'{'D' if daily else 'M'}P' || substr(o.o_orderpriority, 1, 1)"
    join = ""
    if key == "nation_priority":
        sid += " || '_N' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')"
        join = "JOIN customer c ON o.o_custkey = c.c_custkey"
    return f"""SELECT series_id, '{freq}' AS freq, date,
  CASE WHEN settled > 0 THEN CAST(CAST((2 * cents + 10 * n) // (20 * n) AS DECIMAL(22,0)) * 0.0001 AS DECIMAL(18,4)) END AS value
FROM (SELECT {sid} AS series_id, {day} AS date,
        sum(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS cents,
        count(*) AS n,
        count(CASE WHEN o.o_orderstatus <> 'P' THEN 1 END) AS settled
      FROM orders o {join} GROUP BY 1, 2) t"""


def all_obs_sql(key: str = "priority") -> str:
    return f"({obs_sql('DAILY', key)}) UNION ALL ({obs_sql('MONTHLY', key)})"


def with_(*ctes: tuple[str, str], select: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{select}"


def zero(v: str = "value", dec: str = "DECIMAL(18,4)") -> str:
    return f"COALESCE({v}, CAST(0 AS {dec}))"


def gap_fill_ctes(src: str, missing: str = "zero", prefix: str = "g") -> list[tuple[str, str]]:
    """CTEs ``<prefix>_o``, ``<prefix>_sp``, ``<prefix>`` (series_id, date, value) from CTE ``src``."""
    v = zero() if missing == "zero" else "value"
    return [
        (f"{prefix}_o", f"SELECT series_id, date, {v} AS value FROM {src}"),
        (
            f"{prefix}_sp",
            f"""SELECT series_id, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT series_id, min(date) AS lo, max(date) AS hi FROM {prefix}_o GROUP BY series_id) s""",
        ),
        (
            prefix,
            f"""SELECT sp.series_id, sp.date,
  COALESCE(o.value, last_value(o.value IGNORE NULLS) OVER (PARTITION BY sp.series_id ORDER BY sp.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS value
FROM {prefix}_sp sp LEFT JOIN {prefix}_o o ON sp.series_id = o.series_id AND sp.date = o.date""",
        ),
    ]


def _scaled(x: str) -> str:
    return f"CAST({x} * 10000 AS HUGEINT)"


def pct(x: str, p: str, precision: int = 10) -> str:
    """Half-up ``abs((x - p) / p * 100)`` at 4 places; 0 when ``p`` is NULL or 0 or ``x`` NULL."""
    X, P = _scaled(x), _scaled(p)
    q = f"(2 * abs({X} - {P}) * 1000000 + abs({P})) // (2 * abs({P}))"
    return (f"CASE WHEN {p} IS NULL OR {p} = 0 OR {x} IS NULL THEN CAST(0 AS DECIMAL({precision},4)) "
            f"ELSE CAST(CAST({q} AS DECIMAL(18,0)) * 0.0001 AS DECIMAL({precision},4)) END")


def conv(x: str) -> str:
    """Half-up reciprocal at 4 places as DECIMAL(35,4); 0 -> 0, NULL -> NULL."""
    m = _scaled(x)
    q = f"(200000000 + abs({m})) // (2 * abs({m}))"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN CAST(0 AS DECIMAL(35,4)) "
            f"ELSE CAST(sign({m}) * CAST({q} AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(35,4)) END")


def vol(sd: str, precision: int = 10) -> str:
    return f"CAST(round(CAST(COALESCE({sd}, 0) AS DECIMAL(38,11)), 4) AS DECIMAL({precision},4))"


def sd_over(x: str, part: str = "", order: str = "date") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"stddev_samp(CAST({x} AS DOUBLE)) OVER ({p}ORDER BY {order})"


def lag_over(x: str, part: str = "", order: str = "date") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"LAG({x}) OVER ({p}ORDER BY {order})"


def ffill_nonzero(x: str, part: str, order: str) -> str:
    return (f"last_value(CASE WHEN {x} IS NOT NULL AND {x} <> 0 THEN CAST({x} AS DOUBLE) END IGNORE NULLS) "
            f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def pivot_select(src: str, ids: list[str], date_alias: str, val: str = "value") -> str:
    cols = ", ".join(f"max(CASE WHEN series_id = '{i}' THEN {val} END) AS {i}" for i in ids)
    return f"SELECT date AS {date_alias}, {cols} FROM {src} GROUP BY date"


# --- harmonized / metrics (wide) -------------------------------------------------------------------


def harmonized_ctes(freq: str, obs: str | None = None, prefix: str = "h") -> list[tuple[str, str]]:
    daily = freq == "DAILY"
    ids = C.DAILY_IDS if daily else C.MONTHLY_IDS
    convert = C.DAILY_CONVERT if daily else C.MONTHLY_CONVERT
    dcol = "DDATE" if daily else "MDATE"
    h = prefix
    ctes = [(f"{h}_obs", obs or obs_sql(freq))]
    if daily:
        ctes += gap_fill_ctes(f"{h}_obs", "zero", f"{h}_f")
    else:
        ctes += [(f"{h}_f", f"SELECT series_id, date, {zero()} AS value FROM {h}_obs")]
    ctes.append((f"{h}_wide", pivot_select(f"{h}_f", ids, dcol)))
    conv_cols = ", ".join(f"{conv(c)} AS {c}_CONVERTED" for c in convert)
    ctes.append((f"{h}_conv", f"SELECT *, {conv_cols} FROM {h}_wide"))
    return ctes


def harmonized_sql(freq: str) -> str:
    return with_(*harmonized_ctes(freq), select="SELECT * FROM h_conv")


def wide_metrics_select(src: str, dcol: str, rates: list[str]) -> str:
    inner = ", ".join(
        [dcol, *rates]
        + [f"{lag_over(c, order=dcol)} AS prev_{c}" for c in rates]
        + [f"{sd_over(c, order=dcol)} AS sd_{c}" for c in rates]
    )
    outer = ", ".join(
        [dcol, *rates]
        + [f"{pct(c, 'prev_' + c)} AS rate_change_percent_{c.lower()}" for c in rates]
        + [f"{vol('sd_' + c)} AS volatility_{c.lower()}" for c in rates]
    )
    return f"SELECT {outer} FROM (SELECT {inner} FROM {src}) m"


def metrics_ctes(freq: str) -> list[tuple[str, str]]:
    daily = freq == "DAILY"
    dcol = "DDATE" if daily else "MDATE"
    rates = C.DAILY_RATES if daily else C.MONTHLY_RATES
    return harmonized_ctes(freq) + [("mt", wide_metrics_select("h_conv", dcol, rates))]


def metrics_sql(freq: str, tail: str = "") -> str:
    return with_(*metrics_ctes(freq), select=f"SELECT * FROM mt {tail}")


# --- long layout ----------------------------------------------------------------------------------

SPARSE = obs_sql("DAILY", "nation_priority")


def filled_sql(missing: str = "zero", select: str = "SELECT * FROM g") -> str:
    return with_(("s", SPARSE), *gap_fill_ctes("s", missing), select=select)


def long_metrics_select(src: str) -> str:
    return (f"SELECT series_id, date, value, {pct('value', 'prev')} AS rate_change_percent, "
            f"{vol('sd')} AS volatility FROM (SELECT *, {lag_over('value', 'series_id')} AS prev, "
            f"{sd_over('value', 'series_id')} AS sd FROM {src}) m")


def _layer_counts() -> str:
    d = with_(*harmonized_ctes("DAILY"), select="SELECT count(*) FROM h_conv")
    m = with_(*harmonized_ctes("MONTHLY"), select="SELECT count(*) FROM h_conv")
    rows = [
        ("rateflow_prod_raw", "observations", f"(SELECT count(*) FROM ({all_obs_sql()}) a)"),
        ("rateflow_prod_harmonized", "harmonized_daily_tbl", f"({d})"),
        ("rateflow_prod_harmonized", "harmonized_monthly_tbl", f"({m})"),
        ("rateflow_prod_analytics", "daily_data_metrics", f"({d})"),
        ("rateflow_prod_analytics", "monthly_data_metrics", f"({m})"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS layer, '{b}' AS table_name, CAST({c} AS BIGINT) AS n_rows" for a, b, c in rows
    )


def changes_sql() -> str:
    """Rows of the harmonized daily table that a second version with restated days changes."""
    columns = C.DAILY_IDS + [f"{c}_CONVERTED" for c in C.DAILY_CONVERT]
    restated = f"SELECT series_id, freq, date, {RESTATED_VALUE} AS value FROM ({obs_sql('DAILY')}) o"

    def rows(kind: str, of: str) -> str:
        return f"SELECT {of}.DDATE, " + ", ".join(f"{of}.{c}" for c in columns) + f", '{kind}' AS _change, 2 AS _version FROM met"

    met = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in columns)
    return with_(
        *harmonized_ctes("DAILY"), *harmonized_ctes("DAILY", restated, "r"),
        ("met", f"SELECT a, b FROM h_conv a JOIN r_conv b ON a.DDATE = b.DDATE WHERE NOT ({met})"),
        select=f"{rows('update_before', 'a')} UNION ALL {rows('update_after', 'b')}")


#: The value of the second version: twice the first days' of the months of 1995.
RESTATED_VALUE = "CASE WHEN year(date) = 1995 AND day(date) = 1 THEN CAST(value * 2 AS DECIMAL(18,4)) ELSE value END"


def oracle_sql() -> dict[str, str]:
    daily = f"({obs_sql('DAILY')})"
    monthly = f"({obs_sql('MONTHLY')})"
    allo = f"({all_obs_sql()})"
    as_double = f"SELECT series_id, date, CAST(value AS DOUBLE) AS value FROM {allo} a"
    daily_rates = ", ".join(C.DAILY_RATES)
    metric_nulls = ", ".join(
        [f"CAST(NULL AS DECIMAL(10,4)) AS rate_change_percent_{c.lower()}" for c in C.DAILY_RATES]
        + [f"CAST(NULL AS DECIMAL(10,4)) AS volatility_{c.lower()}" for c in C.DAILY_RATES]
    )
    filled_priority = with_(("s", obs_sql("DAILY")), *gap_fill_ctes("s", "null"),
                            select=pivot_select("g", C.DAILY_IDS, "DDATE"))
    combined = with_(
        ("u", f"SELECT 'P' || substr(series_id, 3, 1) AS out, freq, date, value FROM {allo} a"),
        ("ff", f"SELECT out, freq, date, {ffill_nonzero('value', 'out', 'date, freq')} AS v FROM u"),
        select="SELECT CAST(date AS VARCHAR) AS date, freq, "
        + ", ".join(f"max(CASE WHEN out = '{k}' THEN v END) AS {k}" for k in C.COMBINED)
        + " FROM ff GROUP BY 1, 2",
    )
    nonzero_daily = (f"SELECT series_id, date, {ffill_nonzero('value', 'series_id', 'date')} AS value "
                     f"FROM {daily} d")
    weekly_ids = [f"WP{c}" for c in "12345"]
    weekly = with_(
        ("w", f"SELECT 'W' || substr(series_id, 2, 2) AS series_id, CAST(date_trunc('week', date) AS DATE) AS date, "
              f"arg_max({zero()}, date) AS value FROM {daily} d GROUP BY 1, 2"),
        ("h_f", f"SELECT series_id, date, {zero()} AS value FROM w"),
        ("h_wide", pivot_select("h_f", weekly_ids, "WDATE")),
        ("h_conv", "SELECT *, " + ", ".join(f"{conv(c)} AS {c}_CONVERTED" for c in ("WP2", "WP3")) + " FROM h_wide"),
        select=wide_metrics_select("h_conv", "WDATE", C.rate_columns(weekly_ids, ["WP2", "WP3"])),
    )
    month_rows = (f"SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, date, value "
                  f"FROM {daily} d")
    cut = f"DATE '{C.ARRIVAL_CUTOFF}'"
    return {
        # sources
        "scan_csv_nullif": as_double,
        "scan_csv_quoted": as_double,
        "scan_csv_infer": as_double,
        "inferred_schema_table": as_double,
        "wide_headers": as_double,
        "infer_mixed_headers": as_double,
        "load_history": f"SELECT series_id, date, CAST(value AS DOUBLE) AS value, CASE WHEN date < {cut} THEN 1 ELSE 2 END AS load FROM {daily} d",
        "rejected_rows": f"SELECT series_id, date, 'n/a ' || CAST(date AS VARCHAR) AS value FROM {allo} a WHERE value IS NULL",
        "load_without_rejects": f"{as_double} WHERE value IS NOT NULL",
        "mixed_headers": f"SELECT series_id, date, CAST(value AS DOUBLE) + 0.0000125 AS value FROM {allo} a",
        "list_source_files": f"SELECT series_id, true AS all_filled FROM {allo} a GROUP BY 1",
        "series_from_path": f"SELECT series_id, count(*) AS n_rows FROM {allo} a GROUP BY 1",
        "route_frequency": f"SELECT series_id, CASE WHEN starts_with(series_id, 'D') THEN 'DAILY' ELSE 'MONTHLY' END "
                           f"AS freq, count(*) AS n_rows FROM {allo} a GROUP BY 1, 2",
        "load_all_series": f"SELECT series_id, date, CAST(value AS DOUBLE) AS value, freq FROM {allo} a",
        "copy_by_name": as_double,
        "scan_table": f"SELECT * FROM {daily} d",
        "scan_json_observations": as_double,
        "filter_date_range": f"{as_double} WHERE date >= DATE '{C.RANGE_START}' AND date <= current_date",
        "literal_rows": f"""SELECT p.code, m.label, p.freq, p.n_obs, m.weight,
  CAST(date_diff('day', m.since, p.first_date) AS BIGINT) AS days_since
FROM (SELECT substr(series_id, 3, 1) AS code, freq, count(*) AS n_obs, min(date) AS first_date
      FROM {allo} a GROUP BY 1, 2) p
JOIN (VALUES ('1', 'URGENT', DATE '1995-01-01', CAST(1.0000 AS DECIMAL(10,4))),
             ('2', 'HIGH', DATE '1995-01-01', CAST(1.0000 AS DECIMAL(10,4))),
             ('3', 'MEDIUM', DATE '1995-01-01', CAST(0.5000 AS DECIMAL(10,4))),
             ('4', 'NOT SPECIFIED', DATE '1995-01-01', CAST(0.2500 AS DECIMAL(10,4))),
             ('5', 'LOW', DATE '1995-01-01', CAST(0.2500 AS DECIMAL(10,4)))) m(code, label, since, weight)
  ON p.code = m.code""",
        "date_spine": filled_sql("zero", "SELECT series_id, date FROM g_sp"),
        # sinks / tables
        "ctas_harmonized": harmonized_sql("DAILY"),
        "view_roundtrip": harmonized_sql("MONTHLY"),
        "append_table": f"SELECT * FROM {daily} d UNION ALL SELECT * FROM {monthly} m",
        "sink_csv_roundtrip": f"SELECT series_id, freq, date, CAST(value AS DOUBLE) AS value FROM {allo} a",
        "declared_schema_table": f"SELECT series_id, date, value FROM {daily} d",
        "null_to_zero": f"SELECT series_id, freq, date, {zero()} AS value FROM {allo} a",
        "update_from_join": metrics_sql("DAILY"),
        "update_parts": f"SELECT series_id, freq, date, {RESTATED_VALUE} AS value FROM {daily} d",
        "serve_published": metrics_sql("DAILY").replace(
            "SELECT * FROM mt", "SELECT DDATE, " + ", ".join(f"volatility_{c.lower()}" for c in C.DAILY_RATES) + " FROM mt ORDER BY DDATE DESC LIMIT 20"),
        "harmonized_combined": " UNION ALL ".join(
            f"SELECT {d} AS date, '{f}' AS freq, " + ", ".join(f"{i} AS {c}" for i, c in zip(ids, C.COMBINED)) + f" FROM ({harmonized_sql(f)}) h WHERE {d} >= DATE '{C.RANGE_START}'"
            for f, d, ids in (("DAILY", "DDATE", C.DAILY_IDS), ("MONTHLY", "MDATE", C.MONTHLY_IDS))),
        "table_changes": changes_sql(),
        "guard_tables": harmonized_sql("MONTHLY"),
        "env_layers": _layer_counts(),
        # projections
        "project_rename": f"SELECT date AS DDATE, series_id AS SERIES, value AS RATE FROM {daily} d",
        "metrics_skeleton": with_(*harmonized_ctes("DAILY"), select=f"SELECT DDATE, {daily_rates}, {metric_nulls} FROM h_conv"),
        "serve_metric_group": metrics_sql("DAILY").replace(
            "SELECT * FROM mt", "SELECT DDATE, " + ", ".join(f"volatility_{c.lower()}" for c in C.DAILY_RATES) + " FROM mt"),
        # joins
        "spine_left_join": filled_sql("null", "SELECT sp.series_id, sp.date, o.value FROM g_sp sp "
                                              "LEFT JOIN g_o o ON sp.series_id = o.series_id AND sp.date = o.date"),
        "harmonize_outer_join": filled_priority,
        "harmonize_pivot": filled_priority,
        "harmonize_listed": pivot_select(f"({SPARSE}) s", C.LISTED, "DDATE").replace(
            " GROUP BY date", " WHERE series_id IN (" + ", ".join(f"'{i}'" for i in C.LISTED) + ") GROUP BY date"),
        "combined_currency": combined,
        "combined_currency_table": f"SELECT date, {', '.join(C.COMBINED)} FROM ({combined}) c",
        # aggregates
        "series_span": f"""SELECT series_id, min(date) AS min_date, max(date) AS max_date,
  CAST(date_diff('day', min(date), max(date)) AS BIGINT) AS day_diff,
  CAST(date_diff('day', min(date), max(date)) + 1 AS BIGINT) AS n_days
FROM ({SPARSE}) s GROUP BY series_id""",
        "row_count": f"SELECT count(*) AS n_rows FROM {allo} a",
        "series_array_agg": f"SELECT series_id, month, list(CAST(value AS DOUBLE) ORDER BY date) AS vals FROM ({month_rows}) r GROUP BY 1, 2",
        "rows_to_objects": f"""SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month,
  '[' || string_agg('{{"series_id":"' || series_id || '","freq":"' || freq || '","date":"' || CAST(date AS VARCHAR) || '"'
        || CASE WHEN value IS NULL THEN '' ELSE ',"value":' || CAST(value AS VARCHAR) END || '}}', ',' ORDER BY date) || ']'
  AS objects
FROM {daily} d GROUP BY 1, 2""",
        "global_agg": f"""SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows,
  count(value) AS n_values, CAST(sum(value) AS DECIMAL(38,4)) AS sum_value FROM {allo} a""",
        # windows
        "lag_value": filled_sql("zero", f"SELECT series_id, date, value, {lag_over('value', 'series_id')} AS prev_value FROM g"),
        "expanding_stddev": filled_sql("zero", f"SELECT series_id, date, value, CAST(round(CAST({sd_over('value', 'series_id')} AS DECIMAL(38,11)), 4) "
                                               f"AS DECIMAL(18,4)) AS stddev_value FROM g"),
        "forward_fill_window": f"""SELECT series_id, date, COALESCE(value, last_value(value IGNORE NULLS) OVER
  (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS value FROM ({SPARSE}) s""",
        # sorts / top-k / unions
        "sort_series": filled_sql("zero"),
        "latest_20": metrics_sql("DAILY", "ORDER BY DDATE DESC LIMIT 20"),
        "latest_5": metrics_sql("MONTHLY", "ORDER BY MDATE DESC LIMIT 5"),
        "latest_20_ascending": metrics_sql("DAILY", "ORDER BY DDATE DESC LIMIT 20"),
        "serve_latest": metrics_sql("MONTHLY").replace(
            "SELECT * FROM mt", "SELECT MDATE, " + ", ".join(f"rate_change_percent_{c.lower()}" for c in C.MONTHLY_RATES)
            + " FROM mt ORDER BY MDATE DESC LIMIT 20"),
        "union_daily_monthly": f"SELECT * FROM {daily} d UNION ALL SELECT * FROM {monthly} m",
        # scalars
        "string_keys": f"""SELECT series_id, 'RAW_' || series_id AS raw_table,
  regexp_replace('RAW_' || series_id, '^RAW_', '') AS stripped,
  split_part('RAW_' || freq, '_', 2) AS layer_part,
  lower(series_id) || '.csv' AS file_name,
  upper(split_part(lower(series_id) || '.csv', '.', 1)) AS from_file
FROM (SELECT DISTINCT series_id, freq FROM {allo} a) k""",
        "date_add_seq": f"""SELECT series_id, CAST(seq AS BIGINT) AS seq, CAST(lo + CAST(seq AS INTEGER) AS DATE) AS date
FROM (SELECT series_id, lo, unnest(generate_series(0, date_diff('day', lo, hi))) AS seq
      FROM (SELECT series_id, min(date) AS lo, max(date) AS hi FROM ({SPARSE}) s GROUP BY 1) t) u""",
        "explode_filled": nonzero_daily,
        # composites
        "usd_conversion": f"SELECT series_id, date, {zero()} AS value, {conv(zero())} AS value_converted FROM {daily} d",
        "abs_pct_change": filled_sql("zero", f"SELECT series_id, date, value, {pct('value', 'prev')} AS rate_change_percent "
                                             f"FROM (SELECT *, {lag_over('value', 'series_id')} AS prev FROM g) m"),
        "volatility": filled_sql("zero", f"SELECT series_id, date, value, {vol('sd')} AS volatility "
                                         f"FROM (SELECT *, {sd_over('value', 'series_id')} AS sd FROM g) m"),
        "gap_fill": filled_sql("zero"),
        "gap_fill_null": filled_sql("null"),
        "series_metrics": filled_sql("null", long_metrics_select("g")),
        "gap_fill_blocked": filled_sql("zero"),
        "series_metrics_blocked": filled_sql("null", long_metrics_select("g")),
        "daily_metrics_blocked": metrics_sql("DAILY"),
        "harmonize_daily": harmonized_sql("DAILY"),
        "harmonize_monthly": harmonized_sql("MONTHLY"),
        "daily_metrics": metrics_sql("DAILY"),
        "monthly_metrics": metrics_sql("MONTHLY"),
        "weekly_metrics": weekly,
        "refresh_metrics": metrics_sql("DAILY"),
        # streams
        "stream_append_only": f"SELECT series_id, date, value FROM {daily} d WHERE date >= {cut}",
        "stream_empty_start": f"SELECT series_id, date, value FROM {daily} d",
        "stream_restated": with_(
            ("s", f"SELECT series_id, date, CAST(CASE WHEN day(date) = 1 THEN value * 2 ELSE value END AS DECIMAL(18,4)) "
                  f"AS value FROM {daily} d"),
            *gap_fill_ctes("s", "null"), select=long_metrics_select("g")),
        "stream_harmonized_monthly": harmonized_sql("MONTHLY"),
        "stream_initial_rows": f"SELECT CASE WHEN date < {cut} THEN 0 ELSE 1 END AS run, series_id, date, value FROM {daily} d",
        "stream_pending_count": f"SELECT CASE WHEN date < {cut} THEN 0 ELSE 1 END AS run, count(*) AS pending_rows "
                                f"FROM {daily} d GROUP BY 1",
        "stream_consume": filled_sql("null", long_metrics_select("g")),
        "stream_harmonized_initial_rows": harmonized_sql("DAILY"),
        "stream_driver_table": """SELECT event_type AS series_id, CAST(ts AS DATE) AS date, count(*) AS n_events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_sum, CAST(1 AS BIGINT) AS n_runs
FROM events GROUP BY 1, 2""",
        # UDF surface
        "usd_conversion_sql_udf": f"SELECT series_id, date, {zero()} AS value, {conv(zero())} AS value_converted FROM {daily} d",
        "forward_fill_nonzero": nonzero_daily,
        "forward_fill_array_sql": f"SELECT series_id, month, list(v ORDER BY date) AS filled FROM (SELECT series_id, month, date, "
                                  f"{ffill_nonzero('value', 'series_id, month', 'date')} AS v FROM ({month_rows}) r) x GROUP BY 1, 2",
        "forward_fill_array": f"SELECT series_id, month, list(v ORDER BY date) AS filled FROM (SELECT series_id, month, date, "
                              f"{ffill_nonzero('value', 'series_id', 'date')} AS v FROM ({month_rows}) r) x GROUP BY 1, 2",
    }


# Keys whose result has no exact SQL form here: they are checked on row counts only.
ROWS_ONLY: tuple[str, ...] = ()

