"""Loading with a history: no file is loaded twice.

A store (``rateflow.sinks.versions``) holds the loaded rows and, beside them, a ledger: the path, length and
modification time of every file that was loaded, and the number of its load. A run lists the source
(no contents), leaves out what the ledger has, reads the rest once, and publishes rows and ledger as one
version. So a run that breaks has loaded nothing and is repeated whole; a file that has changed is loaded
again in place of its old rows; a file that is gone keeps its rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.sinks.versions import KEEP, Part, Version, publish, read_parts, version, write_parts
from rateflow.sources.files import as_path, read_series_text

#: Part of a table of loaded rows: its load, and whether the rows can be read.
_PART = "concat(load, CASE WHEN reject IS NULL THEN '-ok' ELSE '-bad' END)"


class Loaded(NamedTuple):
    """What a run loaded, the version before it, and all parts after it (published or yet to be)."""

    files: int
    rows: int
    rejects: int
    last: Version
    parts: list[Part]


def _ledger(name: str) -> str:
    return f"{name}_files"


def listed_files(spark: SparkSession, source: str) -> DataFrame:
    """``file_path``, ``length`` and ``modified`` of every file below ``source``; no contents are read."""
    at = F.col("_metadata")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select(at["file_path"].alias("file_path"), at["file_size"].alias("length"), at["file_modification_time"].alias("modified"))


def stage_new_files(spark: SparkSession, source: str, root: str, name: str = "observations", series_from: str | None = "file",
                    force: bool = False, **options) -> Loaded:
    """Write the rows and ledger of all files below ``source`` that were not loaded as they are now (of all, with
    ``force``), without publishing them. ``options`` are those of ``read_series_text``."""
    last = version(spark, root)
    listed, known = listed_files(spark, source), last.of(_ledger(name))
    fresh = listed
    if known and not force:
        fresh = listed.join(read_parts(spark, known), ["file_path", "length", "modified"], "left_anti")
    files = [r.file_path for r in fresh.select("file_path").collect()]  # a path per file to read
    if not files:
        return Loaded(0, 0, 0, last, last.parts)
    load = 1 + max((int(p.part) for p in known), default=0)
    rows = read_series_text(spark, [as_path(f) for f in files], series_from=series_from, **options)
    bad = F.col("reject").isNotNull()
    loaded = rows.select(
        *([] if series_from is None else ["series_id"]), F.expr("try_cast(date AS DATE)").alias("date"), F.expr("try_cast(value AS DOUBLE)").alias("value"),
        F.when(bad, F.col("date")).alias("date_text"), F.when(bad, F.col("value")).alias("value_text"), "file_path", "reject", F.lit(load).alias("load"))
    new = write_parts(loaded, root, name, _PART, "date")
    parts = [p for p in last.parts]
    if known:
        # files loaded before in another state: their rows and entries go, and only those loads are written anew
        paths = spark.createDataFrame([(f,) for f in files], "file_path string")
        hit = [str(r.load) for r in read_parts(spark, known).join(paths, "file_path", "left_semi").select("load").distinct().collect()]
        if hit:
            of = {name: {f"{n}-{k}" for n in hit for k in ("ok", "bad")}, _ledger(name): set(hit)}
            for table, part in ((name, _PART), (_ledger(name), "load")):
                old = last.of(table, of[table])
                left = read_parts(spark, old).join(paths, "file_path", "left_anti")
                parts = [p for p in parts if p not in old] + [p for p in write_parts(left, root, table, part, "date" if table == name else None) if p.folder]
    entries = fresh.join(spark.createDataFrame([(f,) for f in files], "file_path string"), "file_path").withColumn("load", F.lit(load))
    parts += [p for p in new if p.folder] + write_parts(entries, root, _ledger(name), "load")
    n = {k: sum(p.n_rows for p in new if p.part == f"{load}-{k}") for k in ("ok", "bad")}
    return Loaded(len(files), n["ok"], n["bad"], last, parts)


def load_new_files(spark: SparkSession, source: str, root: str, name: str = "observations", keep: int = KEEP, **options) -> Loaded:
    """Load the files below ``source`` that were not loaded as they are now, as one new version; without any,
    nothing is written."""
    staged = stage_new_files(spark, source, root, name, **options)
    if staged.files:
        publish(spark, root, staged.parts, keep, after=staged.last)
    return staged


def _rows(spark: SparkSession, parts: list[Part], name: str, kind: str) -> DataFrame:
    found = [p for p in parts if p.name == name]
    some = [p for p in found if p.part.endswith(f"-{kind}")]
    if not found:
        raise ValueError(f"nothing is loaded as {name}")
    return read_parts(spark, some) if some else read_parts(spark, [found[0]._replace(folder="")])


def loaded_rows(spark: SparkSession, parts: list[Part], name: str = "observations") -> DataFrame:
    """The series, ``date``, ``value`` and ``load`` of all readable rows of ``parts`` (of a version or a staged load)."""
    rows = _rows(spark, parts, name, "ok")
    return rows.select(*[c for c in rows.columns if c in ("series_id", "date", "value", "load")])


def rejected_of(spark: SparkSession, parts: list[Part], name: str = "observations") -> DataFrame:
    """The rows (as text) and files that could not be read: see ``rejected_rows``."""
    rows = _rows(spark, parts, name, "bad")
    keep = [c for c in rows.columns if c == "series_id"]
    return rows.select(*keep, F.col("date_text").alias("date"), F.col("value_text").alias("value"), "file_path", "reject")


def loaded_files(spark: SparkSession, parts: list[Part], name: str = "observations") -> DataFrame:
    """The ledger: ``file_path``, ``length``, ``modified`` and ``load``."""
    return read_parts(spark, [p for p in parts if p.name == _ledger(name)])
