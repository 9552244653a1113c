"""Temperature mixing of sources, in DataFrame functions only.

A source's weight is its share of the tokens to the power ``exponent``, normalised. The
exponent (0: all sources alike, 1: as they are) is bisected to the least at which no source is
repeated more than ``repetition`` times, or to the greatest whose weights keep at least
``entropy`` of the greatest entropy possible. The budget is the least at which every document
is drawn at least once, so that nothing is lost.

Weights become token quotas. A source's quota is some whole passes over its documents, each
in an order of its own (by checksum), and a last pass up to the quota's end. The
draws are cut into blocks, and each block takes the same share of every source's quota: any
run of whole blocks is mixed to the weights, to within a document per source. The order in
a block is a permutation by checksum.

A source's running token count needs no task to hold a source: checksum ranges of about
``rows_per_range`` rows are summed first, and running counts go on from the earlier ranges'.

Defined cases: a document has its words and one token for its end, so that null and empty
texts count 1; a null source and the empty one are the same source; rows that repeat an id are
drawn alike, once each a pass; an empty table gives an empty result. Sources and their token
counts reach the driver: a row per source, not per document.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm.common import written

_WORD = r"[^\x20\x09-\x0D]+"


def bisect_exponent(shares: list[float], repetition: float | None = 2.0, entropy: float | None = None) -> float:
    """The exponent between 0 and 1 at which the limit is just met."""
    low, high = min(shares), max(shares)

    def flat_enough(e: float) -> bool:
        powers = [s**e for s in shares]
        total = sum(powers)
        return -sum(p / total * math.log(p / total) for p in powers) >= entropy * math.log(len(shares)) - 1e-12

    def within(e: float) -> bool:
        return (high / low) ** (1 - e) <= repetition

    below, above = 0.0, 1.0
    if entropy is not None:  # flatter below, so the greatest that is flat enough
        if len(shares) < 2 or flat_enough(above):
            return above
        for _ in range(60):
            middle = (below + above) / 2
            below, above = (middle, above) if flat_enough(middle) else (below, middle)
        return below
    if within(below):
        return below
    for _ in range(60):
        middle = (below + above) / 2
        below, above = (below, middle) if within(middle) else (middle, above)
    return above


def quotas(tokens: dict[str, int], repetition: float | None = 2.0, entropy: float | None = None) -> dict[str, int]:
    """Tokens to draw from each source; no source less than it has."""
    total = sum(tokens.values())
    shares = {s: t / total for s, t in tokens.items()}
    e = bisect_exponent(list(shares.values()), repetition, entropy)
    # weight over share, against the source for which it is least
    least = min(s ** (e - 1) for s in shares.values())
    return {s: max(t, round(t * (shares[s] ** (e - 1) / least))) for s, t in tokens.items()}


def mix(docs: DataFrame, repetition: float | None = 2.0, entropy: float | None = None, id_col: str = "doc_id",
        block_tokens: int = 1 << 20, rows_per_range: int = 4096) -> DataFrame:
    """A row per drawn document: ``id_col``, ``source``, ``n_tokens``, ``epoch`` (pass, from 0),
    ``block`` and ``slot`` (place in the block, from 0)."""
    counted = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)) + 1).cast("long").alias("n_tokens"), F.xxhash64("text").alias("_text"))
    # rows that are alike are counted, then told apart by a number: none of them share a place in the
    # permutation, whatever the id. Two steps, so that no array holds all copies of a row
    alike = counted.groupBy("_id", "source", "n_tokens", "_text").agg(F.count(F.lit(1)).alias("_copies"))
    counted = written(
        alike.withColumn("_from", F.explode(F.expr("sequence(0, _copies - 1, 4096)")))
        .withColumn("_copy", F.explode(F.expr("sequence(_from, least(_from + 4096, _copies) - 1)"))).drop("_copies", "_from"), "counted")
    have = {r.source: (r.tokens, r.rows) for r in counted.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).collect()}
    quota = quotas({s: t for s, (t, _) in have.items()}, repetition, entropy) if have else {}
    rows = [F.struct(F.lit(s).alias("source"), F.lit(have[s][0]).cast("long").alias("tokens"), F.lit(quota[s]).cast("long").alias("quota")) for s in sorted(have)]
    listed = F.array(*rows) if rows else F.array().cast("array<struct<source:string,tokens:bigint,quota:bigint>>")
    target = docs.sparkSession.range(1).select(F.inline(listed))
    blocks = max(1, -(-sum(quota.values()) // block_tokens))
    ranges = max(1, -(-sum(n for _, n in have.values()) // rows_per_range))

    # a row per source, each a label and two numbers
    drawn = (
        counted.join(target, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.expr("cast((quota - 1) div tokens as int)"))))
        .withColumn("_sum", F.md5(F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("")), "_text", "_copy", "epoch").cast("binary")))
        .withColumn("_range", F.expr(f"cast(conv(substr(_sum, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296"))
    )
    inside = Window.partitionBy("source", "epoch", "_range").orderBy("_sum", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source", "epoch").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = drawn.groupBy("source", "epoch", "_range").agg(F.sum("n_tokens").alias("_tokens")).select(
        "source", "epoch", "_range", F.coalesce(F.sum("_tokens").over(earlier), zero).alias("_before"))
    placed = (
        drawn.withColumn("_own", F.coalesce(F.sum("n_tokens").over(inside), zero))
        .join(before, ["source", "epoch", "_range"])
        .withColumn("_at", F.col("epoch") * F.col("tokens") + F.col("_before") + F.col("_own"))
        .filter((F.col("epoch") == 0) | (F.col("_at") + F.col("n_tokens") <= F.col("quota")))
        .withColumn("block", F.expr(f"cast(cast(_at as decimal(20,0)) * {blocks} div quota as bigint)"))
    )
    order = Window.partitionBy("block").orderBy(F.reverse("_sum"), "source", "epoch", "n_tokens")
    return placed.select(
        F.col("_id").alias(id_col), "source", "n_tokens", "epoch", "block",
        (F.row_number().over(order) - 1).cast("long").alias("slot"))
