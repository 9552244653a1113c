"""Sources: landed CSV/JSON observation files and series derived from the driver tables."""

from rateflow.sources.files import (
    filter_date_range,
    list_source_files,
    read_series_csv,
    read_series_json,
    with_frequency,
)
from rateflow.sources.tables import all_observations, order_observations

__all__ = [
    "all_observations", "filter_date_range", "list_source_files", "order_observations",
    "read_series_csv", "read_series_json", "with_frequency",
]
