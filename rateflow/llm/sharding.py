"""Shards by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions only.

A stable integer key seeds a 64-bit linear congruential generator; the key "jumps" from
shard to shard until it passes the last one. There is no ring table: the shard follows from
the key and the shard count alone, and one more shard takes only the keys that jump into it.

Defined cases: an integer key is used as it is, any other type by its ``xxhash64``, and a
null key is 0; equal keys share a shard; null text has no bytes; an empty table gives an
empty result; extra columns are kept as they are unless they bear an output's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rateflow.llm.common import written

# Fixed value: the published generator's multiplier, in 32-bit and 16-bit parts.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW1, _LOW0 = _LOW >> 16, _LOW & 0xFFFF
_MASK = 0xFFFFFFFF


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """``key * MULTIPLIER + 1`` modulo 2**64 in 32-bit halves; no product leaves 63 bits."""
    middle = low * _long(_LOW1)
    bottom = low * _long(_LOW0) + F.shiftleft(middle.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
    carry = F.shiftright(bottom, 32) + F.shiftright(middle, 16)
    cross = high * _long(_LOW0) + F.shiftleft((high * _long(_LOW1)).bitwiseAND(_long(0xFFFF)), 16)
    return (carry + low * _long(_HIGH) + cross).bitwiseAND(_long(_MASK)), bottom.bitwiseAND(_long(_MASK))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard (0 to ``shards`` - 1) of a long ``key``.

    A jump moves at least one shard on, so ``shards`` steps always reach the end; steps
    after the end change nothing."""
    key = F.coalesce(key, _long(0))
    high, low = _step(F.shiftrightunsigned(key, 32), key.bitwiseAND(_long(_MASK)))
    start = F.struct(high.alias("high"), low.alias("low"), _long(0).alias("shard"))

    def jump(state: Column, _: Column) -> Column:
        draw = F.shiftright(state["high"], 1) + _long(1)
        to = ((state["shard"] + _long(1)) * (F.lit(float(1 << 31)) / draw)).cast("long")
        high, low = _step(state["high"], state["low"])
        moved = F.struct(high.alias("high"), low.alias("low"), to.alias("shard"))
        return F.when(to < _long(shards), moved).otherwise(state)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda state: state["shard"].cast("int"))


def jump_shards(df: DataFrame, key: str, shards: int, rows_per_block: int = 100_000) -> DataFrame:
    """``df`` with ``shard``, ``grown_shard`` (with one more shard) and ``slot``, a gapless
    number from 0 within the shard.

    Slots need no shard in one task: rows are numbered within blocks of about ``rows_per_block``
    rows, after the rows of the shard's earlier blocks, which come from counts alone. A row's
    block is a hash of its place in the table, written first so that the place holds, so rows
    that are equal in all columns are spread as well."""
    as_long = F.col(key).cast("long") if isinstance(df.schema[key].dataType, IntegralType) else F.when(
        F.col(key).isNotNull(), F.xxhash64(F.col(key)))
    df = written(df.withColumn("_place", F.monotonically_increasing_id()), "placed")
    # the block count follows the table, so a block's rows stay bounded at every size
    blocks = max(1, -(-df.count() // (shards * rows_per_block)))
    placed = df.withColumns({
        "shard": jump_shard(as_long, shards),
        "grown_shard": jump_shard(as_long, shards + 1),
        "_block": F.pmod(F.xxhash64("_place"), F.lit(blocks)),
    })
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "_block", F.coalesce(F.sum("_rows").over(earlier), _long(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_block").orderBy(key, "_place")
    numbered = placed.withColumn("_row", F.row_number().over(inside).cast("long"))
    return (
        numbered.join(before, ["shard", "_block"])
        .withColumn("slot", F.col("_before") + F.col("_row") - 1)
        .drop("_block", "_before", "_row", "_place")
    )
