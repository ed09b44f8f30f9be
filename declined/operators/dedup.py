from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined import schemas


def one_per_key(
    df: DataFrame,
    key: str = schemas.KEY,
    smallest_by: Sequence[str] = schemas.SURVIVOR_ORDER,
) -> DataFrame:
    """One whole row per key: the smallest in ``smallest_by``, NULLs first.

    The remaining columns break further ties, so the survivor depends on the data
    alone, never on partitioning or task order.  ``min`` over a struct is a partial
    aggregate: each task first shrinks its own rows to one per key, so a key that
    holds a third of all rows still ships only one row per task.
    """
    rest = [c for c in df.columns if c != key and c not in smallest_by]
    row = F.min(F.struct(*smallest_by, *rest)).alias("row")
    return df.groupBy(key).agg(row).select(*(c if c == key else f"row.`{c}`" for c in df.columns))
