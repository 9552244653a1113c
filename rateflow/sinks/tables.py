"""Catalog tables: create-as-select, append, declared schema, update-join, guards, layers.

Tables are written as Parquet with an explicit location (a shared folder on a cluster),
so the metastore only records where they are. Tables that are replaced in place can be seen half
written; ``rateflow.sinks.versions`` publishes whole sets of tables at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The three layers of the pipeline.
LAYERS = ("raw", "harmonized", "analytics")


def ensure_layers(spark: SparkSession, env: str = "dev", layers: Sequence[str] = LAYERS,
                  root: str | None = None) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS <env>_<layer>`` for every layer; returns the names.

    With ``root`` the databases live below that (shared) folder instead of the session's
    warehouse directory."""
    names = [f"{env}_{layer}".lower() for layer in layers]
    for name in names:
        loc = f" LOCATION '{root.rstrip('/')}/{name}.db'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return names


def create_table_as(df: DataFrame, name: str, path: str | None = None,
                    partition_by: Sequence[str] = ()) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS SELECT ...``; returns ``spark.table(name)``."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """``INSERT INTO name SELECT ...`` matching columns by name."""
    spark = df.sparkSession
    target_cols = spark.table(name).columns
    df.select(*target_cols).write.mode("append").insertInto(name)
    return spark.table(name)


def declared_schema_table(spark: SparkSession, name: str, schema: StructType | str, path: str) -> DataFrame:
    """``CREATE OR REPLACE TABLE name (<schema>)`` as an empty Parquet table at ``path``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def null_to_zero(df: DataFrame, cols: Sequence[str] | str = ("value",)) -> DataFrame:
    """``UPDATE t SET c = 0 WHERE c IS NULL`` as a projection (Parquet has no UPDATE)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    types = dict(df.dtypes)
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(0).cast(types[c])).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def update_from(target: DataFrame, updates: DataFrame, on: Sequence[str] | str,
                columns: Sequence[str]) -> DataFrame:
    """``UPDATE target SET c = u.c ... FROM updates u WHERE target.key = u.key``.

    Matched rows take the new values; unmatched target rows keep theirs. Written as a left join with one row per key of
    ``updates``, so each target row appears once; a target row whose key occurs twice in
    ``updates`` fails the query.
    """
    on = [on] if isinstance(on, str) else list(on)
    cols = list(columns)
    new = F.struct(*[F.col(c).alias(c) for c in cols])
    u = updates.groupBy(*on).agg(F.count(F.lit(1)).alias("_rf_n"), F.first(new).alias("_rf_new"))
    twice = F.raise_error(F.concat(F.lit("two updates of one key: "), F.to_json(F.struct(*on))))
    j = target.join(u, on=on, how="left")
    return j.select(
        *[
            F.when(F.col("_rf_n") > 1, twice).when(F.col("_rf_n") == 1, F.col(f"_rf_new.`{c}`")).otherwise(F.col(c)).alias(c)
            if c in cols else F.col(c)
            for c in target.columns
        ]
    )


def assert_unique(df: DataFrame, keys: Sequence[str] = ("series_id",), date: str = "date") -> None:
    """Fail when a ``(keys, date)`` pair occurs twice: joins would multiply such rows and
    window order would be unstable. One aggregate job; only a single offending key (at
    most) reaches the driver."""
    dup = (
        df.groupBy(*keys, date)
        .agg(F.count(F.lit(1)).alias("_rf_n"))
        .filter(F.col("_rf_n") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        raise ValueError(f"duplicate observation for {tuple(dup[0])[:-1]}")


def guard_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Fail when a source table is missing."""
    for name in names:
        if not spark.catalog.tableExists(name):
            raise RuntimeError(f"Table {name} does not exist.")
