from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined import schemas
from declined.functions import line_total


def with_order_total(
    orders: DataFrame,
    unit_price: str = "valor_unitario_pedido",
    quantity: str = "quantidade_pedido",
    name: str = "valor_total_pedido",
) -> DataFrame:
    """Adds the order's total value and keeps every other column."""
    return orders.withColumn(name, line_total(unit_price, quantity))


def lift_field(df: DataFrame, field: str = schemas.FRAUD, name: str | None = None) -> DataFrame:
    """Adds a nested field as a top-level column, named after the field unless ``name`` is given."""
    return df.withColumn(name or field.rpartition(".")[2], F.col(field))


def report_columns(df: DataFrame, columns: Sequence[str] = schemas.REPORT_COLUMNS) -> DataFrame:
    """Exactly the report's columns, in the contract's order."""
    return df.select(*columns)
