"""The operators as queries on whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from declined.llm import (
    decontamination,
    jaccard_join,
    license_scan,
    line_dedup,
    lm_scoring,
    merkle,
    packing,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_dedup,
    turn_repair,
    url_filter,
)
from declined.llm.common import lower_ascii, table
from declined.llm.sql import oracle_sql

# The rules, in the order given.
URL_RULES = [
    url_filter.UrlRule("net", "/", "block"),
    url_filter.UrlRule("example.net", "/en/", "allow"),
    url_filter.UrlRule("example.com", "/de/", "block"),
    url_filter.UrlRule("org", "/fr/", "allow"),
]
SHARDS = 40
SEQUENCE_TOKENS = 2048
END_OF_DOCUMENT = 0


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages; the list holds the canonical URLs that several pages share."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.url_verdicts(pages, url_filter.repeated_urls(pages), URL_RULES)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.document_licenses(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Pieces and places; of the ids, which stay out of every shuffle, the checksum."""
    pieces = packing.token_pieces(docs, tokenizer_path(), SEQUENCE_TOKENS, END_OF_DOCUMENT)
    pieces = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(pieces, SEQUENCE_TOKENS)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"), report=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_index(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), items)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash", "root")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of those of which the id's checksum says so."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scores = lm_scoring.lm_scores(table(spark, sf_dir, "documents"), ~held_out)
    return scores.withColumn("held_out", held_out)


def left_over(docs: DataFrame, **sizes: int) -> DataFrame:
    """Per document how much of it goes, in how many stretches, and a hash of the rest."""
    left = suffix_dedup.repeats(docs, **sizes).select(
        "node",
        (F.col("n_bytes") - F.octet_length("kept")).alias("gone"),
        F.size("firsts").cast("long").alias("stretches"),
        F.sha2("kept", 256).alias("digest"),
    )
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        suffix_dedup.text_node().alias("node"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole"),
    )
    return rows.join(left, "node", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("gone", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("stretches", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 400 bytes that stand elsewhere."""
    return left_over(table(spark, sf_dir, "documents"), length=400)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows that the checksum of conversation and turn drops, empties, cuts, repeats or renames."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    damage = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.array_repeat(F.lit(0), F.when(damage == 3, 2).otherwise(1))
    rows = conversations.filter(damage > 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.repair_report(damaged(conversations), conversations.select("conv_id").distinct())


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' proofs; every fifth, by its id's checksum, is verified with a changed text."""
    id_checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(id_checksum % 5 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "source", merkle.leaf().alias("leaf"), merkle.leaf(text).alias("tampered")
    )
    folded_root = merkle.folded(F.col("tampered"), F.col("path"))
    return merkle.manifest(leaves).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        folded_root.alias("folded_root"),
        (folded_root == F.col("root")).alias("verified"),
    )


def queries() -> dict:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_license_scan": op2_license_scan,
        "op3_packing": op3_packing,
        "op4_line_dedup": op4_line_dedup,
        "op5_sharding": op5_sharding,
        "op6_decontamination": op6_decontamination,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_suffix_dedup": op11_suffix_dedup,
        "op12_turn_repair": op12_turn_repair,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


__all__ = ["oracle_sql", "queries"]
