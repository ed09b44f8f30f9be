from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from declined import schemas

Paths = str | Sequence[str]


def read_orders(
    spark: SparkSession,
    path: Paths,
    separator: str = ";",
    header: bool = True,
    timestamp: str = "timestamp",
) -> DataFrame:
    """Orders from delimited text; ``path`` may be a glob.

    A malformed row fails the job.  Columns bind by position, so the header, if there
    is one, must name the schema's columns in order (``enforceSchema`` off); with it on,
    a file with two swapped columns would load silently swapped.  The codec follows
    from the file extension.
    """
    return spark.read.schema(schemas.orders_schema(timestamp)).csv(
        path if isinstance(path, str) else list(path),
        sep=separator,
        header=header,
        enforceSchema=False,
        mode="FAILFAST",
    )


def read_payments(spark: SparkSession, path: Paths, timestamp: str = "timestamp") -> DataFrame:
    """Payments from JSON Lines with the nested fraud evaluation; ``path`` may be a glob.

    A malformed record fails the job; a missing field is NULL.
    """
    return spark.read.schema(schemas.payments_schema(timestamp)).json(
        path if isinstance(path, str) else list(path), mode="FAILFAST"
    )
