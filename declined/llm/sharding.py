"""Weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import numbered


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose score for ``key`` is the highest; weight 0 takes nothing.

    Shard ``j`` scores ``-weights[j] / ln(u)``, where ``u`` in (0, 1) is a hash of the key and
    ``j``.  A score depends on nothing else, so a new shard takes keys only into itself,
    about its share of the weight, and a removed one hands on only its own.  A NULL key is
    a key like any other.  Ties, all but impossible, go to the higher number.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("some shard must have a positive weight")
    key = F.coalesce(key.cast("string"), F.lit("\0null"))

    def score(j: int, weight: float) -> Column:
        u = (F.pmod(F.xxhash64(F.lit(j), key), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(j).alias("shard"))

    scores = [score(j, w) for j, w in enumerate(weights) if w > 0]
    best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
    return best.getField("shard")


def sharded(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """``df`` with each row's shard.  No shuffle; a row with a NULL key has a shard too."""
    return df.withColumn(name, shard_of(F.col(f"`{key}`"), weights))


def shard_index(docs: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Per document row: key, size, checksum, shard, place in the shard, shard after growth.

    Texts stay where they are; the rows shuffled to number a shard's records hold the
    figures alone.  A NULL text has no bytes.  Repeated rows go to one shard, each to a
    place of its own.  Extra columns are ignored; an empty table gives an empty index.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), weights).alias("shard"),
        shard_of(F.col("doc_id"), grown).alias("grown_shard"),
    )
    rows = numbered(rows, "shard", ["doc_id", "size", "text_crc32"], "slot")
    return rows.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
