"""Published versions of a set of tables.

A store is a folder. The rows of its tables lie in part folders that are written once and never
changed. A version is a manifest: one row per part of every table, with its folder, its number of rows and the
range of its dates. It is written by one task, after all of its parts, and appears by the rename of one
file. A reader takes the newest manifest, so it sees the old set of all tables or the new one, never a
mixture; a run that breaks leaves the old version as it was.

Replacing some parts of a table writes those parts only: the next manifest names the other parts'
folders again. The last ``keep`` versions can be read; older manifests are dropped, and then the
folders that no kept version names. One writer at a time; manifests grow with the parts (months, buckets,
loads), not with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.session import list_folders, remove_path
from rateflow.sinks.tables import assert_unique, update_from

#: Versions that stay readable.
KEEP = 3
_WHOLE = "all"
_MANIFEST = "name string, part string, folder string, n_rows long, low string, high string, schema string"


class Part(NamedTuple):
    """A part of a table: ``low`` and ``high`` are the least and greatest date (None if not asked for)."""

    name: str
    part: str
    folder: str
    n_rows: int
    low: str | None
    high: str | None
    schema: str


class Version(NamedTuple):
    number: int
    parts: list[Part]

    def of(self, name: str, parts: Iterable[str] | None = None) -> list[Part]:
        wanted = None if parts is None else set(parts)
        return [p for p in self.parts if p.name == name and (wanted is None or p.part in wanted)]


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or a numbered one that is kept; number 0 without parts before the first."""
    try:
        rows = spark.read.schema(f"{_MANIFEST}, v int").parquet(f"{root.rstrip('/')}/versions").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    newest = max((r.v for r in rows), default=0)
    at = newest if number is None else number
    found = [Part(*r[:-1]) for r in rows if r.v == at]
    if at and not found:
        raise ValueError(f"version {at} is not kept below {root}")
    return Version(at, [p for p in found if p.name])


def write_parts(df: DataFrame, root: str, name: str, part: str | None = None, date: str | None = None,
                counted: bool = True) -> list[Part]:
    """Write ``df`` as new parts of table ``name``, one per value of the SQL expression ``part`` (plain text:
    letters, digits, ``-`` and ``_``), or one in all. Nothing is published yet. ``counted=False`` leaves out the rows and
    dates of each part (n_rows -1), which take a read of the key and date columns."""
    spark = df.sparkSession
    base = f"{root.rstrip('/')}/data/{name}/{uuid.uuid4().hex[:16]}"
    key = F.lit(_WHOLE) if part is None else F.coalesce(F.expr(part).cast("string"), F.lit("none"))
    keyed = df.withColumn("_part", key)
    if part is not None:
        # few files a part, and a large part split over several tasks
        keyed = keyed.hint("rebalance", "_part")
    # tasks may put their files in place themselves: no one reads the folder before a manifest names it
    keyed.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("_part").parquet(base)
    schema = df.schema.json()
    if not counted:
        parts = [f.removeprefix("_part=") for f in list_folders(spark, base) if f.startswith("_part=")]
        return [Part(name, p, f"{base}/_part={p}", -1, None, None, schema) for p in parts] or [Part(name, _WHOLE, "", 0, None, None, schema)]
    back = spark.read.schema(StructType([*df.schema.fields]).add("_part", "string")).parquet(base)
    range_ = [f(date).cast("string") if date else F.lit(None).cast("string") for f in (F.min, F.max)]
    stats = back.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), range_[0].alias("low"), range_[1].alias("high")).collect()
    return [Part(name, r["_part"], f"{base}/_part={r['_part']}", r.n, r.low, r.high, schema) for r in stats] or [
        # an empty table: its schema
        Part(name, _WHOLE, "", 0, None, None, schema)]


def publish(spark: SparkSession, root: str, parts: Iterable[Part], keep: int = KEEP, after: Version | None = None) -> int:
    """Make ``parts`` (of all tables) the next version, and drop what no kept version names."""
    root = root.rstrip("/")
    last = after or version(spark, root)
    number = last.number + 1
    rows = sorted(set(parts)) or [Part("", "", "", 0, None, None, "")]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{root}/versions/v={number}")
    drop_old(spark, root, number - keep)
    return number


def drop_old(spark: SparkSession, root: str, upto: int) -> None:
    """Drop the versions up to ``upto``: first their manifests, then the folders only they named."""
    if upto < 1:
        return
    rows = spark.read.schema(f"{_MANIFEST}, v int").parquet(f"{root}/versions").select("folder", "v").distinct().collect()
    kept = {r.folder for r in rows if r.v > upto}
    for v in sorted({r.v for r in rows if r.v <= upto}):
        remove_path(spark, f"{root}/versions/v={v}")
    for folder in sorted({r.folder for r in rows if r.v <= upto} - kept - {""}):
        remove_path(spark, folder)


def read_parts(spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
    """The rows of some parts of one table; only their folders are listed and read."""
    if not parts:
        raise ValueError("no parts: the table is not in this version")
    schema = StructType.fromJson(json.loads(parts[0].schema))
    folders = [p.folder for p in parts if p.folder]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """Table ``name`` in the newest (or a numbered) version."""
    return read_parts(spark, version(spark, root, number).of(name))


def replace_parts(spark: SparkSession, root: str, new: Sequence[Part], drop: Callable[[Part], bool] = lambda p: False,
                  keep: int = KEEP) -> int:
    """Publish the newest version with ``new`` parts in place of those of the same table and key, and without
    those that ``drop`` holds for."""
    last = version(spark, root)
    keys = {(p.name, p.part) for p in new}
    return publish(spark, root, [p for p in last.parts if (p.name, p.part) not in keys and not drop(p)] + [*new], keep, after=last)


def update_parts(spark: SparkSession, root: str, name: str, updates: DataFrame, on: Sequence[str], columns: Sequence[str],
                 part: str, date: str | None = None, keep: int = KEEP) -> int:
    """``UPDATE name SET c = u.c ... FROM updates u WHERE keys are equal``, as a new version in which only
    the parts that ``updates`` hit are written. ``part`` is the table's part expression, over columns of ``on``.
    An update key that occurs twice is an error; null keys match nothing. Returns the version's number (the old one, if no part is hit)."""
    known = updates.dropna(subset=list(on))
    assert_unique(known, list(on[:-1]), on[-1])
    last = version(spark, root)
    # at most a row for each part of the table
    hit = [r[0] for r in known.select(F.expr(part).cast("string")).distinct().collect()]
    parts = last.of(name, hit)
    if not parts:
        return last.number
    written = write_parts(update_from(read_parts(spark, parts), known, on, columns), root, name, part, date)
    keys = {p.part for p in parts}
    return publish(spark, root, [p for p in last.parts if p.name != name or p.part not in keys] + written, keep, after=last)


def latest_parts(parts: Sequence[Part], k: int) -> list[Part]:
    """The newest parts (by their dates' ranges) that are sure to hold the newest ``k`` rows: any part left
    out ends before the least date of ``k`` rows or more of the others."""
    out: list[Part] = []
    dated = sorted((p for p in parts if p.n_rows and p.high), key=lambda p: (p.high, p.low), reverse=True)
    for p in dated:
        if sum(q.n_rows for q in out if q.low > p.high) >= k:
            break
        out.append(p)
    undated = [p for p in parts if p.n_rows and not p.high]  # null dates only: last in descending order
    return (out if sum(p.n_rows for p in out) >= k else out + undated) or list(parts[:1])
