"""From raw documents to packed sequences, as stages that are written one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from declined.llm import decontamination, jaccard_join, line_dedup, quality_rules
from declined.llm.common import table, with_words, written
from declined.llm.queries import packed_documents


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go, those without a text among them."""
    return quality_rules.keep_quality(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go, and with them documents that had no others."""
    return with_words(line_dedup.line_dedup(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that is left, and their places in sequences."""
    return packed_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Token ids are not for SQL to tell; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
