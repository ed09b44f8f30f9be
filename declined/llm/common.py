"""What the operators share: text normalisation, row numbers, the shared folder."""

from __future__ import annotations

import os
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space that separates words, and the letters that are lower-cased.
BLANK = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def blank_words(text: Column) -> Column:
    """The runs of characters between white space; no words for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def with_words(docs: DataFrame) -> DataFrame:
    """The documents whose text has a word."""
    return docs.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def for_tasks(df: DataFrame) -> DataFrame:
    """``df`` itself; Python tasks that are made from now on look for this package where it is here.

    That serves sessions on one machine, or with a shared installation, whatever folder they were
    started in.  On other clusters the package comes with ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, here)))
    return df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all machines share.

    The cluster names that folder in ``spark.checkpoint.dir``.  Where the setting is
    absent, as in tests, the session's warehouse, which is shared as well, stands in.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs no earlier stage, and what several later
    steps read is computed once, so that all of them see the same rows.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(
    df: DataFrame, group: str, order: list[str], name: str, rows_per_bucket: int = 2000
) -> DataFrame:
    """``df`` with a number from 0, without gaps, to each row of each ``group``.

    A window over ``group`` alone would give a whole group to one task.  So equal rows
    are first counted, then each group is cut into as many buckets as it has
    ``rows_per_bucket`` rows, by a hash of the row; a bucket's first number is the sum of the
    buckets before it, and only rows of one bucket meet in a task.  The numbers depend on
    the rows' values alone, so a repeated task gives the same ones.  Equal rows get numbers
    next to each other; they are drawn out of one counted row in runs of
    ``rows_per_bucket``, which are dealt out before.

    There should be few groups, of any size: beyond 100,000 their sizes are not broadcast.
    """
    flat = [f"c{i}" for i in range(len(df.columns))]
    of = dict(zip(df.columns, flat, strict=True))
    counted = df.toDF(*flat).groupBy(*flat).agg(F.count(F.lit(1)).alias("copies"))
    counted = written(counted, "numbered")
    groups = counted.groupBy(F.col(of[group]).alias("of")).agg(F.sum("copies").alias("rows"))
    groups = groups.select("of", F.ceil(F.col("rows") / rows_per_bucket).alias("buckets"))
    groups = written(groups, "groups")
    if groups.count() <= 100_000:
        groups = F.broadcast(groups)
    dealt = counted.join(groups, F.col(of[group]).eqNullSafe(F.col("of")))
    dealt = dealt.withColumn("b", F.pmod(F.xxhash64(*flat), F.col("buckets"))).drop("buckets")
    sizes = dealt.groupBy("of", "b").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.partitionBy("of").orderBy("b")) - F.col("n")
    sizes = sizes.select(F.col("of").alias("g"), F.col("b").alias("gb"), before.alias("first"))
    within = Window.partitionBy("of", "b").orderBy(*[of[c] for c in order], F.xxhash64(*flat), *flat)
    placed = dealt.withColumn("upto", F.sum("copies").over(within) - F.col("copies")).join(
        sizes, F.col("of").eqNullSafe(F.col("g")) & (F.col("b") == F.col("gb"))
    )
    first = F.col("first") + F.col("upto")
    placed = placed.select(*flat, first.alias("n"), (first + F.col("copies") - 1).alias("last"))
    runs = placed.select(
        *flat, "last", F.explode(F.sequence("n", "last", F.lit(rows_per_bucket))).alias("n")
    )
    end = F.least(F.col("last"), F.col("n") + F.lit(rows_per_bucket - 1))
    rows = runs.hint("rebalance").select(*flat, F.explode(F.sequence("n", end)).alias("n"))
    return rows.select(*[F.col(c).alias(name) for name, c in of.items()], F.col("n").alias(name))


def texts_of(docs: DataFrame, wanted: DataFrame, most_bytes: int) -> DataFrame:
    """``node`` and ``text``, once for each ``node`` in ``wanted``, a table of distinct nodes.

    ``docs`` have both columns.  Where the wanted nodes measure at most ``most_bytes`` they are
    broadcast, and no other text is shuffled; beyond, the documents are joined on their node.
    """
    wanted = written(wanted, "wanted")
    if wanted.count() * 100 <= most_bytes:
        wanted = F.broadcast(wanted)
    return docs.select("node", "text").join(wanted, "node").dropDuplicates(["node"])
