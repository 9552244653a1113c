"""String helpers for series keys, file paths, frequency routing and null markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value markers of the raw CSV files, in this order.
NULL_MARKERS = (".", "NULL", "null", "")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def base_name(path: Column | str) -> Column:
    """Last path segment (``a/b/C.csv`` -> ``C.csv``)."""
    return F.element_at(F.split(_c(path), "/"), -1)


def series_from_path(path: Column | str) -> Column:
    """Series id from a file path: the base name up to its first dot, upper-cased."""
    return F.upper(F.split_part(base_name(path), F.lit("."), F.lit(1)))


def series_from_partition_dir(path: Column | str, name: str = "series_id") -> Column:
    """Series id from a hive-style folder ``.../series_id=XYZ/part-...``, upper-cased."""
    return F.upper(F.regexp_extract(_c(path), f"{name}=([^/]+)", 1))


def strip_prefix(col: Column | str, prefix: str = "RAW_") -> Column:
    """Remove a leading prefix such as ``RAW_`` from a table name."""
    return F.regexp_replace(_c(col), "^" + prefix, "")


def route_frequency(series_id: Column | str, daily_prefix: str = "D") -> Column:
    """Daily series ids start with ``D``; everything else is monthly."""
    return F.when(_c(series_id).startswith(daily_prefix), F.lit("DAILY")).otherwise(F.lit("MONTHLY"))


def null_if_marker(text: Column | str, markers=NULL_MARKERS) -> Column:
    """Trim a text field and turn any of the null markers into NULL."""
    t = F.trim(_c(text))
    return F.when(t.isin(*markers) | t.isNull(), F.lit(None).cast("string")).otherwise(t)
