"""Rows of tables in a global order, numbered without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from declined.llm.common import written

ROW_BITS = 33  # of monotonically_increasing_id(): the lower ones number the rows of a partition


def in_order(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` written in the order of ``keys``, NULLs first, with ``part`` and ``at``.

    A range of the order is one partition; ``part`` numbers these in order and ``at`` the rows within.
    Ranges are chosen by Spark's sample, so ``rows`` should be cheap to read twice.  Only rows that
    agree in all keys stay together, whatever share of the table they are.
    """
    spot = F.monotonically_increasing_id()
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("spot", spot)
    part = F.shiftright("spot", ROW_BITS).alias("part")
    at = F.col("spot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("at")
    return written(rows.select("*", part, at).drop("spot"), name)


def ranked(
    rows: DataFrame, group: str, order: list[str], name: str, most_bytes: int = 32_000_000
) -> DataFrame:
    """``rows`` with ``n``, their number from 0 within ``group`` by ``order``, and ``of``, how many there are.

    ``group`` has no NULLs.  Rows are put in order once; what each range adds to a group is a table
    of about as many rows as there are ranges and groups, whose running sums give each range's first number.
    """
    placed = in_order(rows, [group, *order], name)
    parts = placed.groupBy(F.col(group).alias("group_of"), F.col("part").alias("part_of")).agg(
        F.min("at").alias("low"), F.count(F.lit(1)).alias("rows")
    )
    of_group = Window.partitionBy("group_of")
    before = F.sum("rows").over(of_group.orderBy("part_of")) - F.col("rows")
    parts = parts.select(
        "group_of", "part_of", (before - F.col("low")).alias("shift"), F.sum("rows").over(of_group).alias("of")
    )
    parts = written(parts, f"{name}-parts")
    if parts.count() * 100 <= most_bytes:
        parts = F.broadcast(parts)
    rows = placed.join(parts, (F.col("part") == F.col("part_of")) & (F.col(group) == F.col("group_of")))
    return rows.withColumn("n", F.col("at") + F.col("shift")).drop("part", "at", "group_of", "part_of", "shift")
