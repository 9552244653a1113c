"""Change rows between two published versions of a table.

A table that is written anew by every refresh (``rateflow.sinks.versions``) has a change stream all the same:
the rows of two versions are compared by key, and only rows that differ come out. Parts that both versions
name are the same rows and are not read. The rest meets in one full outer join on the keys; values
are compared by a 64-bit hash first and column by column where the hashes agree, so no change is lost.

``_change`` is ``insert``, ``update_before`` and ``update_after`` (both rows of a changed key) or ``delete``;
``_version`` is the version that made it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.sinks.versions import Part, read_parts, version


def _rows(spark: SparkSession, parts: Sequence[Part], like: Sequence[Part]) -> DataFrame:
    return read_parts(spark, parts or [like[0]._replace(folder="")])


def table_changes(spark: SparkSession, root: str, name: str, keys: Sequence[str], since: int, until: int | None = None) -> DataFrame:
    """The change rows of table ``name`` from version ``since`` (0: before the first, so all rows are
    inserts) to ``until`` (the newest). ``keys`` identify a row (null keys are equal). A column that only one of the versions
    has is NULL in the other."""
    new = version(spark, root, until)
    before = version(spark, root, since).of(name) if since else []
    after = new.of(name)
    same = {p.folder for p in before} & {p.folder for p in after}
    old_rows = _rows(spark, [p for p in before if p.folder not in same], before or after)
    new_rows = _rows(spark, [p for p in after if p.folder not in same], after)
    types = {f.name: f.dataType for f in [*old_rows.schema.fields, *new_rows.schema.fields]}
    values = [c for c in types if c not in keys]

    def side(rows: DataFrame) -> DataFrame:
        rows = rows.select(*[(F.col(f"`{c}`") if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        own = F.struct(*[F.col(f"`{c}`") for c in values]) if values else F.struct(F.lit(1).alias("_one"))
        return rows.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), own.alias("_own"), F.xxhash64(*values, F.lit(0)).alias("_hash"))

    a, b = side(old_rows).alias("a"), side(new_rows).alias("b")
    # the keys one by one: a struct of them does not match where one is null
    on = [F.col(f"a._key.`{k}`").eqNullSafe(F.col(f"b._key.`{k}`")) for k in keys]
    met = a.join(b, on, "full")
    here, there = F.col("a._hash").isNotNull(), F.col("b._hash").isNotNull()
    differ = (F.col("a._hash") != F.col("b._hash")) | ~F.col("a._own").eqNullSafe(F.col("b._own"))

    def row(kind: str, of: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(f"{of}._key").alias("key"), F.col(f"{of}._own").alias("own"))

    rows = F.when(~here, F.array(row("insert", "b"))).when(~there, F.array(row("delete", "a"))).when(
        differ, F.array(row("update_before", "a"), row("update_after", "b")))
    return met.select(F.explode(rows).alias("_row")).select(
        *[F.col(f"_row.key.`{k}`").alias(k) for k in keys], *[F.col(f"_row.own.`{c}`").alias(c) for c in values],
        F.col("_row.kind").alias("_change"), F.lit(new.number).cast("int").alias("_version"))


def consume_changes(spark: SparkSession, root: str, name: str, keys: Sequence[str], checkpoint: str,
                    fn: Callable[[DataFrame, int], None], initial_rows: bool = True) -> int:
    """One run of a consumer of ``name``'s changes: ``fn(changes, version)`` gets all since the version it saw last, if
    there is a newer one, and that version is then noted below ``checkpoint``. A run that breaks is repeated with
    the same changes if nothing newer came; ``fn`` should replace its output by version. The first run gets the table's rows as
    inserts, or with ``initial_rows=False`` only notes the version. Returns the version. A consumer that
    is further behind than the kept versions gets an error."""
    try:
        seen = spark.read.schema("version int").parquet(f"{checkpoint}/versions").agg(F.max("version")).collect()[0][0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        seen = None
    newest = version(spark, root).number
    if newest and newest != seen:
        if seen is not None or initial_rows:
            fn(table_changes(spark, root, name, keys, seen or 0, newest), newest)
        spark.createDataFrame([(newest,)], "version int").coalesce(1).write.mode("append").parquet(f"{checkpoint}/versions")
    return newest
