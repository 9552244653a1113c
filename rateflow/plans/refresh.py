"""The batch refresh job: raw -> harmonized -> analytics, in environment-named layers.

``refresh_metrics`` is the one callable job: it loads the raw long table (NULL -> 0 at
load), writes the harmonized daily and monthly tables and the metrics tables in one pass each, publishes
all of them as one version, guards that they exist, and returns a status string. ``refresh_from_files`` is the same from
landed files, of which only those not loaded before are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rateflow.operators.harmonize import harmonize, weekly_observations
from rateflow.operators.metrics import wide_metrics
from rateflow.operators.serve import CHANGE_PREFIX, VOL_PREFIX, serve_latest
from rateflow.session import shared_dir
from rateflow.sinks.tables import (
    assert_unique,
    ensure_layers,
    guard_tables,
    null_to_zero,
)
from rateflow.sinks.versions import Part, Version, latest_parts, publish, read_parts, version, write_parts


@dataclass(frozen=True)
class Frequency:
    name: str  # DAILY / MONTHLY
    date_col: str  # DDATE / MDATE
    ids: list[str]
    convert: list[str]
    rates: list[str]
    fill: bool


def table_names(env: str) -> dict[str, str]:
    raw, harm, ana = (f"{env}_{x}".lower() for x in ("raw", "harmonized", "analytics"))
    # The names of the harmonized and analytics tables.
    return {
        "raw": f"{raw}.observations",
        "rejects": f"{raw}.rejected_observations",
        "DAILY_harmonized": f"{harm}.harmonized_daily_tbl",
        "MONTHLY_harmonized": f"{harm}.harmonized_monthly_tbl",
        "DAILY_metrics": f"{ana}.daily_data_metrics",
        "MONTHLY_metrics": f"{ana}.monthly_data_metrics",
        "WEEKLY_harmonized": f"{harm}.harmonized_weekly_tbl",
        "WEEKLY_metrics": f"{ana}.weekly_data_metrics",
    }


def metric_columns(rates: list[str]) -> list[str]:
    return [f"rate_change_percent_{c.lower()}" for c in rates] + [f"volatility_{c.lower()}" for c in rates]


def build_harmonized(raw: DataFrame, f: Frequency, missing: str = "zero") -> DataFrame:
    """Harmonized wide table of one frequency. Weekly series are the daily ones taken at the last
    observation of each week."""
    if f.name == "WEEKLY":
        obs = weekly_observations(raw.filter(raw.freq == "DAILY").select("series_id", "date", "value"))
    else:
        obs = raw.filter(raw.freq == f.name)
    return harmonize(obs, f.ids, f.convert, fill=f.fill, missing=missing, out_date=f.date_col)


_FREQ = "CASE WHEN startswith(series_id, 'D') THEN 'DAILY' ELSE 'MONTHLY' END"
#: Parts of the harmonized and metrics tables: a year each, so the newest rows are in the last few files.
BY_YEAR = "date_format({date}, 'yyyy')"


def _as_views(spark: SparkSession, names: dict[str, str], selects: dict[str, str]) -> None:
    """Catalog names of published tables: views over their folders."""
    for key, select in selects.items():
        name = names[key]
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # written in place by an earlier release
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def _select_of(parts: list[Part], columns: str = "*") -> str:
    """SQL that reads parts of one table; of an empty one, its schema."""
    schema = StructType.fromJson(json.loads(parts[0].schema))
    folders = [p.folder for p in parts if p.folder]
    names = ", ".join(f"`{f.name}`" for f in schema)
    if not folders:
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        return f"SELECT {columns} FROM (SELECT {nothing}) WHERE false"
    runs: dict[str, list[str]] = {}
    for p in parts:
        runs.setdefault(p.folder.rsplit("/", 1)[0], []).append(f"'{p.part}'")
    each = [f"SELECT {names} FROM parquet.`{base}` WHERE CAST(_part AS STRING) IN ({', '.join(keys)})" for base, keys in runs.items()]
    return f"SELECT {columns} FROM ({' UNION ALL '.join(each)})"


def _publish_metrics(spark: SparkSession, raw_parts: list[Part], other: list[Part], freqs: list[Frequency], env: str, root: str,
                     read_raw: Callable[[Frequency], DataFrame], selects: dict[str, str], missing: str, last: Version) -> None:
    """Write the harmonized and metrics tables of ``read_raw``'s rows, then publish them and ``raw_parts`` at once."""
    new = list(raw_parts)
    harmonized: dict[str, list[Part]] = {}
    for f in freqs:
        wide = build_harmonized(read_raw(f), f, missing=missing)
        harmonized[f.name] = write_parts(wide, root, f"{f.name.lower()}_harmonized", BY_YEAR.format(date=f.date_col), counted=False)
        selects[f"{f.name}_harmonized"] = _select_of(harmonized[f.name])
        new += harmonized[f.name]
    for f in freqs:
        wide = read_parts(spark, harmonized[f.name])
        metrics = wide_metrics(wide.select(f.date_col, *f.rates), f.date_col, f.rates)
        parts = write_parts(metrics, root, f"{f.name.lower()}_metrics", BY_YEAR.format(date=f.date_col), f.date_col)
        selects[f"{f.name}_metrics"] = _select_of(parts)
        new += parts
    replaced = {p.name for p in new}
    publish(spark, root, [p for p in other if p.name not in replaced] + new, after=last)
    names = table_names(env)
    _as_views(spark, names, selects)
    guard_tables(spark, [names[f"{f.name}_harmonized"] for f in freqs])


def refresh_metrics(
    spark: SparkSession,
    raw: DataFrame,
    freqs: list[Frequency],
    env: str = "dev",
    root: str | None = None,
    check_unique: bool = True,
    missing: str = "zero",
) -> str:
    """Run the whole refresh; ``raw`` is the long table ``(series_id, freq, date, value)``.

    All tables become one new version of the store at ``root``: readers of the store (``serve``) see the
    old set or the new one. The catalog's names are views that are moved on one after another afterwards."""
    root = root or shared_dir(spark, f"{env}-tables")
    ensure_layers(spark, env, root=root)
    # parity: missing values become 0 at load; ``missing='null'`` keeps them as gaps to fill
    loaded = null_to_zero(raw, "value") if missing == "zero" else raw
    last = version(spark, root)
    parts = write_parts(loaded, root, "raw", "freq", counted=False)
    if check_unique:
        assert_unique(read_parts(spark, parts), ["series_id"], "date")

    def of(f: Frequency) -> DataFrame:
        name = "DAILY" if f.name == "WEEKLY" else f.name
        return read_parts(spark, [p for p in parts if p.part == name] or [parts[0]._replace(folder="")])

    _publish_metrics(spark, parts, last.parts, freqs, env, root, of, {"raw": _select_of(parts)}, missing, last)
    return "Metric tables are up to date."


def frequencies_for(ids_by_freq: dict[str, list[str]], convert: list[str] = (),
                    weekly: bool = False) -> list[Frequency]:
    """Frequency descriptions for the given series ids; daily series are gap-filled.
    ``weekly=True`` adds a weekly table built from the daily series."""
    if weekly and ids_by_freq.get("DAILY"):
        ids_by_freq = {**ids_by_freq, "WEEKLY": list(ids_by_freq["DAILY"])}
    out = []
    for name, date_col, fill in (("DAILY", "DDATE", True), ("MONTHLY", "MDATE", False), ("WEEKLY", "WDATE", False)):
        ids = sorted(ids_by_freq.get(name, []))
        if not ids:
            continue
        conv = [i for i in ids if i in set(convert)]
        rates = [f"{i}_CONVERTED" if i in conv else i for i in ids]
        out.append(Frequency(name, date_col, ids, conv, rates, fill))
    return out


def refresh_from_files(
    spark: SparkSession,
    path: str,
    env: str = "dev",
    convert: list[str] = (),
    ids_by_freq: dict[str, list[str]] | None = None,
    root: str | None = None,
    weekly: bool = False,
    missing: str = "zero",
) -> str:
    """The whole daily job from landed ``<SERIES>.csv`` files (``date,value`` with null
    markers): load the files that the store at ``root`` has not loaded yet (each is read once), route each series to its
    frequency by its id, and publish rows and metrics as one version. The wide tables need the series ids as column
    names; when ``ids_by_freq`` is not given they come from the ledger (a row per file, no
    contents). Rows that cannot be read are never loaded as 0: they go to the raw layer's
    ``rejected_observations`` table, and the status says how many they are."""
    from rateflow.functions.strings import route_frequency, series_from_path
    from rateflow.plans.load import loaded_files, loaded_rows, rejected_of, stage_new_files
    from rateflow.sources.files import with_frequency

    root = root or shared_dir(spark, f"{env}-tables")
    ensure_layers(spark, env, root=root)
    staged = stage_new_files(spark, path, root)
    if ids_by_freq is None:
        ids_by_freq = {}
        ids = loaded_files(spark, staged.parts).select(series_from_path("file_path").alias("series_id")).distinct()
        for r in ids.select(route_frequency("series_id").alias("freq"), "series_id").orderBy("freq", "series_id").collect():
            ids_by_freq.setdefault(r.freq, []).append(r.series_id)
    freqs = frequencies_for(ids_by_freq, list(convert), weekly=weekly)
    raw = with_frequency(loaded_rows(spark, staged.parts))  # at the files' own precision
    raw = null_to_zero(raw, "value") if missing == "zero" else raw
    assert_unique(raw, ["series_id"], "date")
    rows = [p for p in staged.parts if p.name == "observations"]
    ok, bad = ([p for p in rows if p.part.endswith(end)] or [rows[0]._replace(folder="")] for end in ("-ok", "-bad"))
    value = "coalesce(value, 0D) AS value" if missing == "zero" else "value"
    selects = {
        "raw": _select_of(ok, f"series_id, date, {value}, {_FREQ} AS freq"),
        "rejects": _select_of(bad, "series_id, date_text AS date, value_text AS value, file_path, reject")}
    own = [p for p in staged.parts if p.name.startswith("observations")]
    _publish_metrics(spark, own, staged.parts, freqs, env, root, lambda f: raw, selects, missing, staged.last)
    rejects = rejected_of(spark, staged.parts).count()
    return f"Metric tables are up to date. Rejected rows: {rejects}." if rejects else "Metric tables are up to date."


def serve_published(spark: SparkSession, root: str, table: str, date: str, rates: list[str] | None = None, k: int = 20,
                    group: str = "rates", ascending: bool = True) -> DataFrame:
    """Newest k rows of one metric group of a published metrics table. The manifest tells the dates and rows of its
    yearly parts, and only the newest parts that hold k rows are read, however long the history is."""
    parts = latest_parts(version(spark, root).of(table), k)
    df = read_parts(spark, parts)
    if rates is None:
        rates = [c for c in df.columns if c != date and not c.startswith((CHANGE_PREFIX, VOL_PREFIX))]
    return serve_latest(df, date, rates, k, group, ascending)
