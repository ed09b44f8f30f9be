"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node that it is linked with, itself included.

    Only nodes with a link appear.  Each round hands every node the smallest root among its
    neighbours and then that root's root, so that chains shorten by half or more; it ends
    when no root changes.  All steps are joins and partial minima of tables that are written
    after each round; nothing is gathered on the driver but the number of changes.
    """
    edges = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    edges = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    edges = written(edges.distinct(), "edges")
    first = edges.groupBy("node").agg(F.min("other").alias("least"))
    roots = written(first.select("node", F.least("node", "least").alias("root")), "roots")
    while True:
        of_other = roots.select(F.col("node").alias("other"), F.col("root").alias("seen"))
        least = edges.join(of_other, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        nearer = roots.join(least, "node").select(
            "node", F.col("root").alias("before"), F.least("root", "seen").alias("via")
        )
        of_root = roots.select(F.col("node").alias("via"), F.col("root").alias("beyond"))
        after = nearer.join(of_root, "via").select(
            "node", "before", F.least("via", "beyond").alias("root")
        )
        after = written(after, "roots")
        changed = after.filter("root < before").limit(1).count()
        roots = after.select("node", "root")
        if not changed:
            return roots
