"""SQL-callable functions, registered by name for SQL users.

``CREATE TEMPORARY FUNCTION ... RETURN`` defines a SQL function that Catalyst inlines into
the plan, so calling it by name costs the same as writing the expression out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession, precision: int = 35, scale: int = 4) -> list[str]:
    """Register ``usd_conversion(rate)`` and ``forward_fill_array(values)`` as session SQL
    functions; returns the names.

    ``forward_fill_array`` gives each element the last one up to it that is neither NULL nor 0
    (NULL before the first), in time in proportion to the array's length."""
    dec = f"DECIMAL({precision},{scale})"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION usd_conversion(exchange_rate {dec})
        RETURNS {dec}
        RETURN CASE WHEN exchange_rate = 0 THEN CAST(0 AS {dec})
                    ELSE CAST(1 / exchange_rate AS {dec}) END
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION forward_fill_array(vals ARRAY<DOUBLE>)
        RETURNS ARRAY<DOUBLE>
        RETURN CASE WHEN vals IS NOT NULL THEN transform(
            array(filter(transform(vals, (x, i) -> CASE WHEN x <> 0 THEN struct(i AS at, x AS value) END), m -> m IS NOT NULL)),
            valid -> concat(
                array_repeat(CAST(NULL AS DOUBLE), coalesce(get(valid, 0).at, size(vals))),
                flatten(transform(valid, (v, j) -> array_repeat(v.value, coalesce(get(valid, j + 1).at, size(vals)) - v.at)))))[0] END
        """
    )
    return ["usd_conversion", "forward_fill_array"]


def register_harmonized_combined(spark: SparkSession, tables: Mapping[str, tuple[str, str, Sequence[str]]], columns: Sequence[str]) -> str:
    """Register the table function ``harmonized_combined(since DATE)`` over harmonized tables: the rows of every
    frequency from ``since`` on (all, for NULL) as ``date``, ``freq`` and ``columns``.

    ``tables``: frequency -> (table or view, its date column, the series columns that feed ``columns`` in their order). It is
    inlined into the plan, so a filter on its columns reaches the tables."""
    schema = {c: spark.table(name).schema[c].dataType.simpleString() for name, _, cols in tables.values() for c in cols}
    first = next(iter(tables.values()))[2]
    returns = ", ".join(["date DATE", "freq STRING", *[f"`{c}` {schema[s]}" for c, s in zip(columns, first, strict=True)]])
    union = " UNION ALL ".join(
        f"SELECT `{date}` AS date, '{freq}' AS freq, " + ", ".join(f"`{s}`" for s in cols) + f" FROM {name} WHERE since IS NULL OR `{date}` >= since"
        for freq, (name, date, cols) in tables.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION harmonized_combined(since DATE) RETURNS TABLE ({returns}) RETURN {union}")
    return "harmonized_combined"
