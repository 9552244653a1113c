"""The training-data pipeline over ``documents``: five stages, each on all that its
predecessor kept. A stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's docs. All but the last return the columns of docs.

The stages need no column but ``doc_id``, ``text``, ``lang`` and ``source``; other columns ride
along. Empty tables, null ids and texts, and repeated rows pass through every stage as their
operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import scratch, written
from rateflow.llm.language_id import UNKNOWN, identify
from rateflow.llm.mixing import mix
from rateflow.llm.near_dedup import near_duplicates
from rateflow.llm.packing import pack
from rateflow.llm.queries import END_ID, SEQUENCE, VOCABULARY
from rateflow.llm.suffix_dedup import cut_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; texts without letters, or less like every language
    than like the mean of all, go."""
    return identify(docs).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the one with the least doc_id (the first of
    its rows, if some repeat it). Null ids come last; an id, null or not, says nothing about which
    rows are alike."""
    # a row's number tells rows that repeat an id apart
    numbered = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("first")
    with scratch(spark):  # signatures and texts of the search go once its rows are known
        groups = near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "group_id")
        stay = numbered.select("_row", "doc_id").join(groups, "_row").groupBy("group_id").agg(first)
        stay = written(stay.select(F.col("first._row").alias("_row")), "stay", keep=True)
    return numbered.join(stay, "_row", "left_semi").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings are cut out of the texts; documents left without a word go.
    Bytes of a character that was cut in two go with it."""
    # the other columns ride along, so the texts are shuffled once for their cuts
    cut = cut_repeats(docs, 100)
    # a cut inside a character leaves bytes that are no text: they are replaced, then dropped
    mended = F.coalesce(F.expr("try_validate_utf8(cast(kept as string))"), F.translate(F.expr("make_valid_utf8(cast(kept as string))"), "�", ""))
    cut = cut.withColumn("_text", F.when(F.size("spans") > 0, mended).otherwise(F.col("_row.text"))).filter(F.col("_text").rlike(r"\S"))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, repeated to the sources' weights, at most twice."""
    # a row's number tells rows that repeat an id apart
    numbered = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    drawn = mix(numbered, repetition=2.0, id_col="_row").select("_row", "block", "slot")
    return numbered.join(drawn, "_row").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids: a row per piece, with the ids."""
    return pack(docs, public_tokenizers.path(VOCABULARY), END_ID, SEQUENCE)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Random projections, minhashes and a tokenizer have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
