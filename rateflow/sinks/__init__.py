"""Sinks: tables, files and the update-join."""

from rateflow.sinks.tables import (
    append_table,
    assert_unique,
    create_table_as,
    declared_schema_table,
    ensure_layers,
    guard_tables,
    null_to_zero,
    update_from,
)
from rateflow.sinks.files import write_series_csv, write_series_json

__all__ = [
    "append_table",
    "assert_unique",
    "create_table_as",
    "declared_schema_table",
    "ensure_layers",
    "guard_tables",
    "null_to_zero",
    "update_from",
    "write_series_csv",
    "write_series_json",
]
