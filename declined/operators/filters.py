from __future__ import annotations

from pyspark.sql import DataFrame

from declined import schemas
from declined.functions import in_calendar_year, refused_but_legitimate


def orders_of_year(
    orders: DataFrame, year: int = 2025, column: str = "data_criacao_pedido"
) -> DataFrame:
    """Orders created in ``year``, first and last day included; an unknown date is dropped."""
    return orders.filter(in_calendar_year(column, year))


def refused_payments(
    payments: DataFrame, status: str = schemas.STATUS, fraud: str = schemas.FRAUD
) -> DataFrame:
    """Payments that were refused although the fraud check found them legitimate."""
    return payments.filter(refused_but_legitimate(status, fraud))
