"""Run by test_llm_retry: every other input task fails at its first attempt."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from declined.llm import decontamination, jaccard_join, line_dedup, lm_scoring, merkle, sharding, substring_dedup, turn_repair
from declined.llm.queries import left_over, packed_documents

SF_DIR, FOLDER = sys.argv[1:]


def failing_first(batches):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
        raise RuntimeError("first attempt")
    yield from batches


def rows(df):
    return sorted(map(str, df.collect()))


spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "6")
    .config("spark.checkpoint.dir", f"{FOLDER}/shared")
    .config("spark.sql.files.openCostInBytes", "128m")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(6, "doc_id").write.parquet(f"{FOLDER}/documents")
docs = spark.read.parquet(f"{FOLDER}/documents")
items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
unreliable = docs.mapInArrow(failing_first, docs.schema)
trains = F.col("doc_id") % 3 > 0


def repairs(d):
    turns = d.selectExpr(
        "doc_id % 40 AS conv_id", "doc_id AS turn", "IF(doc_id % 2 = 0, 'user', 'assistant') AS role", "substr(text, 1, 60) AS text"
    )
    return turn_repair.repair_report(turns, turns.select("conv_id").distinct())


steps = {
    "suffixes": lambda d: left_over(d, length=60, places_held=5000),
    "repairs": repairs,
    "manifest": lambda d: merkle.manifest(d.select("doc_id", "source", merkle.leaf().alias("leaf")), 4, 1),
    "packing": packed_documents,
    "sharding": lambda d: sharding.shard_index(d, [1.0] * 7),
    "lines": line_dedup.line_dedup,
    "contamination": lambda d: decontamination.contamination_report(d, items),
    "near-duplicates": jaccard_join.near_duplicates,
    "passages": substring_dedup.repeated_passages,
    "scores": lambda d: lm_scoring.lm_scores(d, trains, tokens_per_shard=20_000),
    "one of each": lambda d: corpus_pipeline.drop_near_duplicates(spark, d, SF_DIR),
}
for name, step in steps.items():
    assert rows(step(unreliable)) == rows(step(docs)), name
failed = sum(
    info.numFailedTasks
    for info in map(spark.sparkContext.statusTracker().getStageInfo, range(3000))
    if info
)
print("failed attempts:", failed)
