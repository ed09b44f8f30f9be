from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_calendar_year(column: str, year: int) -> Column:
    """True where ``column`` falls in ``year``: the rows of ``year(column) = year``.

    Written as a half-open range, because a function around the column would stop
    the predicate at the scan; the two bounds fold to literals of the column's type
    and reach Parquet's row-group statistics.  Bounds of an instant are midnights of
    the session time zone, as they are for ``year``.
    """
    first_day = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    next_first_day = F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    return (F.col(column) >= first_day) & (F.col(column) < next_first_day)


def line_total(unit_price: str, quantity: str) -> Column:
    """``unit_price * quantity`` as a double; NULL if either is NULL.

    Both factors are widened first, so that the product is the same with ANSI mode on
    and off (off, Spark would multiply a float by a long in single precision).
    """
    return F.col(unit_price).cast("double") * F.col(quantity).cast("double")


def refused_but_legitimate(status: str, fraud: str) -> Column:
    """True where both flags are false.  A NULL flag is neither refused nor legitimate."""
    return ~F.col(status) & ~F.col(fraud)
