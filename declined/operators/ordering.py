from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from declined import schemas
from declined.operators.joins import expand_copies

NUMBER = "number of copy"


def in_report_order(
    df: DataFrame,
    columns: Sequence[str] = schemas.REPORT_ORDER,
    spread_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """Global ascending sort, NULLs first.

    The key at the end makes the order of distinct orders total and lets Spark's range
    partitioning cut through any run of rows that agree on state, method and date.  Rows that
    agree in the key as well it cannot tell apart; where there may be many, they are given
    once each, with their number in the column ``copies``: they are then expanded before
    the sort, the copy's number is the last sort column, and any run can be cut.

    A global sort first runs its input to sample it, and then again to shuffle it.  The
    rebalance keeps the rows in shuffle files, so that a join or aggregate below runs
    once; with ``copies`` the files that runs are dealt to do.  The rebalance deals the rows out
    evenly; ``spread_by`` hashes them instead, which is cheaper, and is meant for columns whose
    values hardly repeat.
    """
    if copies is None:
        return df.hint("rebalance", *spread_by).orderBy(*columns, ascending=True)
    expanded = expand_copies(df, copies, number=NUMBER)
    return expanded.orderBy(*columns, f"`{NUMBER}`", ascending=True).drop(NUMBER)
