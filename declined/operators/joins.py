from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined import schemas
from declined.operators.projections import lift_field

COPIES = "copies"
RUN = 10_000


def count_matches(orders: DataFrame, payments: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """The distinct pairs of an order and one of its payments, and how many there are of each.

    The seven match columns and ``copies``.  Inner equi-join with bag semantics: an order
    appears with each of its payments, orders without one and NULL keys vanish.
    ``orders`` must already carry its total.

    Each side first counts its rows that agree in all columns in use, as a partial
    aggregate, so equal payments of one order, however many, cross the network as one row
    per task.  What is left of a hot order differs, so its bytes show, and adaptive
    execution splits it: the exchange on the key lies right below the join.  No sample is
    taken and no size decides; the plan is the same for every input.
    """
    left = orders.select(key, "uf", "valor_total_pedido", "data_criacao_pedido")
    right = lift_field(payments).select(key, "forma_pagamento", schemas.STATUS, "fraude")

    def counted(df: DataFrame, name: str) -> DataFrame:
        known = df.filter(F.col(key).isNotNull())
        return known.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))

    pairs = counted(left, "of_orders").join(counted(right, "of_payments"), key)
    copies = F.col("of_orders") * F.col("of_payments")
    return pairs.select(key, *schemas.MATCH_COLUMNS[1:], copies.alias(COPIES))


def expand_copies(
    df: DataFrame, copies: str = COPIES, number: str | None = None, run: int = RUN
) -> DataFrame:
    """Each row as often as its ``copies`` say, without that column.

    The count is cut into runs of ``run`` rows, the runs are dealt out evenly, and only then
    expanded, so that no task gets more of one row than another.  ``number`` names a column for the
    copy's number, from 1.  Dealing is by round robin in the order of the rows' values, so a
    repeated task deals alike; it is to a fixed number of partitions, since adaptive execution
    would merge them by bytes, which runs understate.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in df.columns if c != copies]
    starts = F.sequence(F.lit(1).cast("long"), F.col(copies), F.lit(run).cast("long"))
    runs = df.select(*kept, copies, F.explode(starts).alias("first of run"))
    last = F.least(F.col(copies), F.col("`first of run`") + (run - 1))
    each = F.explode(F.sequence(F.col("`first of run`"), last)).alias(number or "number of copy")
    expanded = runs.repartition(parts).select(*kept, each)
    return expanded if number else expanded.select(*kept)


def match_payments(orders: DataFrame, payments: DataFrame, key: str = schemas.KEY) -> DataFrame:
    """Every pair of an order and one of its payments, as the seven match columns.

    The rows of ``count_matches``, each as often as it occurs.  No join strategy is forced.
    """
    return expand_copies(count_matches(orders, payments, key))
