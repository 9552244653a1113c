"""One query per operator: each applies it to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import table, written
from rateflow.llm.conversation_repair import COUNTS, line_hashes, repair
from rateflow.llm.hard_negatives import hard_negatives
from rateflow.llm.language_id import held_out, identify
from rateflow.llm.licences import scan
from rateflow.llm.mixing import mix
from rateflow.llm.near_dedup import near_duplicates
from rateflow.llm.neighbours import nearest
from rateflow.llm.packing import pack
from rateflow.llm.quality import cascade
from rateflow.llm.quality_model import fit, measure, score
from rateflow.llm.sharding import jump_shards
from rateflow.llm.suffix_dedup import repeated_spans
from rateflow.llm.url_trust import judge

SHARDS = 40
VOCABULARY, END_ID, SEQUENCE = "word_bpe_49k.json", 2, 4096


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: its longest rule's, else its host's."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", "licence", "licence_at", "n_confirmed", "n_unconfirmed")


def op3_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at least once, no source more than twice, in blocks of 2**20 tokens."""
    return mix(table(spark, sf_dir, "documents"), repetition=2.0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 4096."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_ID, SEQUENCE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the bytes of repeated 100-byte strings taken out (first ones stay)."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeated_spans(table(spark, sf_dir, "documents"), 100).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op6_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return jump_shards(sized, "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least doc_id of its near-duplicate group."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "n_links")


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from the labels of documents that are not held out."""
    measured = written(measure(table(spark, sf_dir, "documents")), "measured")
    model = fit(measured, table(spark, sf_dir, "labels").filter(~held_out()))
    return score(measured, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the faults of this query's contract, by the checksum of ``conv_id:turn``."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    lot = F.crc32(F.concat_ws(":", text["conv_id"], text["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), lot.alias("lot")).filter("lot != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's damage, cheapest repair, and hash of the repaired lines."""
    source = table(spark, sf_dir, "conversations")
    report, turns = repair(damaged(source))
    every = source.select(F.col("conv_id").alias("id")).distinct()
    hashes = line_hashes(turns).withColumnRenamed("conv_id", "of")
    zero = F.lit(0).cast("long")
    return every.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("id").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, zero).alias(c) for c in (*COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; labels of ids divisible by 7 are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_url_trust": op1_url_trust,
    "op2_licence_scan": op2_licence_scan,
    "op3_temperature_mixing": op3_temperature_mixing,
    "op4_packing": op4_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jump_sharding": op6_jump_sharding,
    "op7_quality_cascade": op7_quality_cascade,
    "op8_probminhash": op8_probminhash,
    "op9_cross_polytope": op9_cross_polytope,
    "op10_language_id": op10_language_id,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}
