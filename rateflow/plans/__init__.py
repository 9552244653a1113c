"""Jobs and the query registry: the refresh job, registered queries and their SQL oracle."""

from rateflow.plans.refresh import Frequency, frequencies_for, refresh_from_files, refresh_metrics, table_names

__all__ = ["Frequency", "frequencies_for", "refresh_from_files", "refresh_metrics", "table_names"]
