"""Change streams over landed tables and the incremental metrics refresh."""

from rateflow.streaming.changes import consume_changes, table_changes
from rateflow.streaming.consume import append_to, change_stream, consume, count_then_append, land, run_available
from rateflow.streaming.refresh import compact, read_metrics, refresh_batch, series_bucket, stream_refresh

__all__ = [
    "append_to", "change_stream", "compact", "consume", "consume_changes", "count_then_append", "land", "read_metrics",
    "refresh_batch", "run_available", "series_bucket", "stream_refresh", "table_changes",
]
