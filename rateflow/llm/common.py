"""Helpers shared by the operators: tables, lineage cuts and document identity."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.session import remove_path, shared_dir

#: Folders written in each open ``scratch`` block.
_OPEN: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` in this block are deleted when it ends, but for those with ``keep=True``, which
    pass to the block around it. What leaves the block must be read from a kept table alone."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.pop()
        for path in made:
            remove_path(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and read it back, so
    that a lost executor costs a reread, not a recomputation of all that came before."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    around = _OPEN[:-1] if keep else _OPEN
    if around:
        around[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches' rows, some at a time and without copies, so that a worker holds the Python objects
    made of a few rows, not of a whole batch."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a document: 64 bits of its id and text. Rows that repeat both are one
    document; rows that repeat the id with another text are told apart."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def safe_names(df: DataFrame, keep: list[str]) -> DataFrame:
    """Only the columns an operator works on, so that extra columns never clash with its own."""
    return df.select(*[F.col(c) for c in keep])
