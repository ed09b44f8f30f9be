from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """``dataset`` and ``n_rows`` for each named frame, an empty one included."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        for name, df in inputs.items()
    ]
    return reduce(DataFrame.unionByName, counts)
