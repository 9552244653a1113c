"""Landed observation files -> the long table ``(series_id, freq, date, value)``.

One wildcard/recursive read covers every series of every frequency (no per-file loop): the
headers are read first, the files are grouped by their layout, and each layout is one scan. The series id
comes from the path through the hidden ``_metadata`` column, and the frequency from the id.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from rateflow.functions.strings import (
    NULL_MARKERS,
    null_if_marker,
    route_frequency,
    series_from_partition_dir,
    series_from_path,
)


def _series_col(mode: str | None) -> Column | None:
    path = F.col("_metadata.file_path")
    if mode == "file":
        return series_from_path(path)
    if mode == "dir":
        return series_from_partition_dir(path)
    return None


def _first_lines(spark: SparkSession, path: str | Sequence[str], recursive: bool) -> DataFrame:
    """``file_path`` and ``line``: the first line with text of each file. Of a split that fills a task only the first
    batch of lines is read, so the beginnings of large files are read and their rest is not."""
    conf = spark._jsparkSession.sessionState().conf()
    # no other split follows one of so many bytes in its task
    alone = conf.filesMaxPartitionBytes() - conf.filesOpenCostInBytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            out = {}
            for file, text, start in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                if start == 0 and file not in seen and text.strip():
                    seen.add(file)
                    out[file] = text
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([*out]), pa.array([*out.values()])], names=["file_path", "line"])
            if batch.num_rows and batch.column(3)[-1].as_py() >= alone and (out or batch.column(2)[-1].as_py()):
                return

    lines = spark.read.option("recursiveFileLookup", recursive).text(path)
    at = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_block_length")]
    return lines.select(at[0], "value", *at[1:]).mapInArrow(first, "file_path string, line string")


class Layout(NamedTuple):
    """Where ``date`` and ``value`` stand in a file's header of ``width`` columns (None: not there)."""

    date: int | None
    value: int | None
    width: int

    @property
    def usable(self) -> bool:
        return self.date is not None and self.value is not None


def layouts(spark: SparkSession, path: str | Sequence[str], recursive: bool = True, quote: str = '"', sep: str = ",") -> dict[Layout, list[str]]:
    """The files below ``path`` by the layout of their own header lines (a short line per file, and no
    more of its contents, reaches the driver). Names are matched without regard to case."""
    out: dict[Layout, list[str]] = {}
    for r in _first_lines(spark, path, recursive).collect():
        cells = [c.strip().lower() for c in next(csv.reader([r.line], delimiter=sep, quotechar=quote or None, skipinitialspace=True))]
        at = [cells.index(n) if n in cells else None for n in ("date", "value")]
        out.setdefault(Layout(*at, len(cells)), []).append(r.file_path)
    return out


def as_path(uri: str) -> str:
    """A file's listed address as a path to read: not encoded, and its own ``*``, ``[`` ... no patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def _in_layout(reader: DataFrameReader, layout: Layout, files: Sequence[str], infer: bool = False) -> DataFrame:
    """``date`` and ``value`` of files of one layout, with ``_metadata``: one scan that parses these two columns."""
    paths = [as_path(f) for f in files]
    if infer:
        raw = reader.option("inferSchema", True).csv(paths)
        names = raw.columns
    else:
        names = [f"_c{i}" for i in range(layout.width)]
        raw = reader.schema(", ".join(f"{n} string" for n in names)).csv(paths)
    return raw.select(F.col(f"`{names[layout.date]}`").alias("date"), F.col(f"`{names[layout.value]}`").alias("value"), F.col("_metadata").alias("_metadata"))


#: Why a row's texts are no observation: that takes a date, and a marker or a number.
REJECT = "CASE WHEN try_cast(date AS DATE) IS NULL OR (value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL) THEN 'row' END"
#: Splits of at least this many bytes are a task of their own.
LARGE = 64 << 20


def _csv_reader(spark: SparkSession, recursive: bool = True, quote: str = '"', sep: str = ",") -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", sep)
        .option("quote", quote)
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("recursiveFileLookup", recursive)
    )


def read_series_text(spark: SparkSession, path: str | Sequence[str], null_markers: Sequence[str] = NULL_MARKERS,
                     series_from: str | None = "file", **options) -> DataFrame:
    """The files' rows as they stand, each file by its own header: the series (if it is asked for),
    ``date`` and ``value`` as text (NULL for a marker), ``file_path``, and ``reject``: why the row cannot be an
    observation (NULL if it can). A file without the two columns gives one row, with no date and no value.

    Files are grouped by the layout of their headers, and each distinct layout is one scan over its own
    files; nothing is joined."""
    keep = [] if series_from is None else ["series_id"]
    groups = layouts(spark, path, **options)
    text = [f"{c} string" for c in [*keep, "date", "value", "file_path", "reject"]]
    parts = []
    for layout, files in groups.items():
        if not layout.usable:
            continue
        raw, sid = _in_layout(_csv_reader(spark, **options), layout, files), _series_col(series_from)
        rows = raw.select(
            *([] if sid is None else [sid.alias("series_id")]),
            null_if_marker("date", null_markers).alias("date"),
            null_if_marker("value", null_markers).alias("value"),
            F.col("_metadata.file_path").alias("file_path"),
        )
        # a header line that is repeated inside a file is no row
        rows = rows.filter(~F.coalesce((F.lower("date") == "date") & (F.lower("value") == "value"), F.lit(False)))
        parts.append(rows.withColumn("reject", F.expr(REJECT)))
    odd = [f for layout, files in groups.items() if not layout.usable for f in files]
    if odd or not parts:
        files = spark.createDataFrame([(f,) for f in odd], "file_path string")
        sid = {None: None, "file": series_from_path, "dir": series_from_partition_dir}[series_from]
        none = F.lit(None).cast("string")
        parts.append(files.select(*([] if sid is None else [sid(F.col("file_path")).alias("series_id")]), none.alias("date"), none.alias("value"),
                                  "file_path", F.lit("no date and value columns").alias("reject")))
    return reduce(DataFrame.unionByName, parts).select(*[t.split()[0] for t in text])


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c == "series_id"], F.expr("try_cast(date AS DATE)").alias("date"),
                       F.expr("try_cast(value AS DOUBLE)").alias("value"))


def read_series_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    null_markers: Sequence[str] = NULL_MARKERS,
    infer: bool = False,
    series_from: str | None = "file",
    recursive: bool = True,
    quote: str = '"',
    sep: str = ",",
    unreadable: str = "null",
) -> DataFrame:
    """Read ``date,value`` CSV files with a header of any width and order.

    Trims fields, skips blank lines, reads UTF-8, accepts optionally quoted fields, matches each file by
    its own header without regard to case, turns any of ``null_markers`` into NULL and converts with
    ``try_cast``. Rows with text that is neither a marker nor readable, or without a date, are
    kept with NULL there (``unreadable='null'``) or left out (``'drop'``); ``rejected_rows``
    lists them, and the files without the two columns. ``infer=True`` keeps Spark's inferred types instead, the
    wider type where files of different headers differ (markers other than the empty field then make ``value`` text).
    ``series_from``: ``'file'`` (base name), ``'dir'`` (``series_id=`` folder) or ``None``.
    """
    if unreadable not in ("null", "drop"):
        raise ValueError("unreadable must be 'null' or 'drop'")
    options = {"recursive": recursive, "quote": quote, "sep": sep}
    if infer:
        sid = _series_col(series_from)
        named = [] if sid is None else [sid.alias("series_id")]
        parts = [_in_layout(_csv_reader(spark, **options), layout, files, infer=True).select(*named, "date", "value")
                 for layout, files in layouts(spark, path, **options).items() if layout.usable]
        if parts:
            return reduce(DataFrame.unionByName, parts)
    rows = read_series_text(spark, path, null_markers, series_from, **options)
    # a file without the columns has no rows
    rows = rows.filter("reject IS NULL" if unreadable == "drop" else "reject IS NULL OR reject = 'row'")
    return _typed(rows)


def rejected_rows(spark: SparkSession, path: str | Sequence[str], null_markers: Sequence[str] = NULL_MARKERS,
                  series_from: str | None = "file", **options) -> DataFrame:
    """What ``read_series_csv`` cannot read, as text: rows with a date or a value that
    is neither a marker nor readable, those without a date, and a row without either for each file whose header lacks a
    column. Columns: the series (if it is asked for), ``date``, ``value``, the ``file_path`` and the reason (``reject``)."""
    return read_series_text(spark, path, null_markers, series_from, **options).filter("reject IS NOT NULL")


def create_table_from_files(spark: SparkSession, name: str, files: str | Sequence[str], path: str,
                            series_from: str | None = "dir") -> DataFrame:
    """A table at ``path`` with the schema inferred from the files, and their rows in it."""
    from rateflow.sinks.tables import append_table, declared_schema_table

    df = read_series_csv(spark, files, infer=True, series_from=series_from)
    declared_schema_table(spark, name, df.schema, path)
    return append_table(df, name)


def with_frequency(df: DataFrame, series: str = "series_id") -> DataFrame:
    """Add ``freq`` routed from the series id (``D...`` daily, else monthly)."""
    return df.withColumn("freq", route_frequency(series))


# The JSON payload layout of an observations response.
OBSERVATIONS_SCHEMA = StructType(
    [
        StructField(
            "observations",
            ArrayType(StructType([StructField("date", StringType()), StructField("value", StringType())])),
        )
    ]
)


def read_series_json(
    spark: SparkSession,
    path: str | Sequence[str],
    start: str | None = None,
    end: str | None = None,
    multi_line: bool = False,
    null_markers: Sequence[str] = NULL_MARKERS,
    series_from: str | None = "dir",
) -> DataFrame:
    """Observation payloads -> ``(series_id, date, value)``; extra fields are ignored and an
    empty ``observations`` list gives no rows. ``start``/``end`` bound the dates
    (``end`` defaults to today)."""
    raw = (
        spark.read.schema(OBSERVATIONS_SCHEMA)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    sid = _series_col(series_from)
    keep = ["series_id"] if sid is not None else []
    # take the path first, so the scan reads only ``_metadata.file_path``
    paths = raw.select(*([sid.alias("series_id")] if sid is not None else []), "observations")
    flat = paths.select(*keep, F.inline("observations"))
    out = flat.select(
        *keep,
        F.expr("try_cast(trim(date) AS DATE)").alias("date"),
        null_if_marker("value", null_markers).alias("_rf_v"),
    ).select(*keep, "date", F.expr("try_cast(_rf_v AS DOUBLE)").alias("value"))
    return filter_date_range(out, "date", start, end) if (start or end) else out


def filter_date_range(df: DataFrame, date: str = "date", start: str | None = None, end: str | None = None) -> DataFrame:
    """Keep ``start <= date <= end``; ``end`` defaults to ``current_date()``. Pushed into the
    Parquet scan when ``df`` reads Parquet."""
    d = F.col(date)
    cond = d <= (F.to_date(F.lit(end)) if end else F.current_date())
    if start:
        cond = cond & (d >= F.to_date(F.lit(start)))
    return df.filter(cond)


def list_source_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``LIST @stage``: one row per file below ``path`` (path, name, size), also those with
    a header only. Only the listing is read, no file's contents. Spark's readers leave out
    files of no bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size"))
