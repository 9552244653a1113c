"""Change streams over landed tables with Structured Streaming.

A table's change stream is a file-source stream over its folder plus a checkpoint: the
checkpoint remembers which files were consumed, so each run sees only new files.

- ``initial_rows=True``: a new checkpoint over existing files emits them first.
- ``initial_rows=False`` (append-only, no initial rows): the existing files, if any, are drained
  once through a batch function that does nothing; a marker beside the checkpoint then says
  that the stream is created, and the real consumer starts from there.

Every run uses ``trigger(availableNow=True)``: it processes what is there and stops, so a
daily scheduler (or a test) can call it like a batch job. Sinks write each micro-batch to
its own folder with overwrite, so a retried batch replaces its own output instead of
appending twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BatchFn = Callable[[DataFrame, int], None]


def land(df: DataFrame, path: str, spread: list[str] | None = None) -> None:
    """Append a batch of rows as new Parquet files (an arrival)."""
    w = df.repartition(*spread) if spread else df
    w.write.mode("append").parquet(path)


def change_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Streaming DataFrame of the rows in files added under ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, fn: BatchFn) -> None:
    """Process everything available now through ``fn(batch_df, batch_id)``, then stop."""
    q = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(fn)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the stream without initial rows has been created, by its marker."""
    try:
        spark.read.schema("id long").parquet(f"{checkpoint}-started").limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def consume(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    fn: BatchFn,
    initial_rows: bool = True,
) -> None:
    """One run of a consumer of ``source``'s change stream."""
    if not initial_rows and not _started(spark, checkpoint):
        run_available(change_stream(spark, source, schema), checkpoint, lambda df, i: None)
        # only now: a drain that broke off is drained again, and an empty source, which makes no
        # batch and so no offset, is not drained a second time
        spark.range(1).write.mode("overwrite").parquet(f"{checkpoint}-started")
    run_available(change_stream(spark, source, schema), checkpoint, fn)


def append_to(target: str, run: int | None = None) -> BatchFn:
    """Batch function: write the batch below ``target/run=<run>/batch=<id>`` (idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sub = f"{target}/run={run}/batch={batch_id}" if run is not None else f"{target}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(sub)

    return write


def count_then_append(target: str, status: str, run: int) -> BatchFn:
    """Batch function: record the pending-row count of the batch, then consume it.

    Runs with no new files produce no batch at all, hence no status row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/run={run}/batch={batch_id}")
        (
            batch.groupBy()
            .agg(F.count(F.lit(1)).alias("pending_rows"))
            .write.mode("overwrite")
            .parquet(f"{status}/run={run}/batch={batch_id}")
        )

    return write
