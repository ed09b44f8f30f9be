"""Column names, types and order of the three datasets.

Everything in this module is a fixed value of the data contract.  Schemas are
always explicit; nothing is ever inferred from files.

``timestamp`` selects Spark's type for the date columns.  The contract type is
``timestamp`` (an instant, read in the session time zone); ``timestamp_ntz`` is
for inputs whose wall-clock values must not depend on a zone.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

KEY = "id_pedido"

# Flags read from a payment: ``status`` false = refused, ``fraude`` false = legitimate.
STATUS = "status"
FRAUD = "avaliacao_fraude.fraude"

# Ascending report order, then the key, which makes the order total.
REPORT_ORDER = ("uf", "forma_pagamento", "data_criacao_pedido", KEY)

# Of several rows with one key the smallest in these columns is kept.
SURVIVOR_ORDER = ("forma_pagamento", "uf", "valor_total_pedido", "data_criacao_pedido")


def orders_schema(timestamp: str = "timestamp") -> StructType:
    return (
        StructType()
        .add(KEY, "string", False)
        .add("produto", "string")
        .add("valor_unitario_pedido", "float")
        .add("quantidade_pedido", "long")
        .add("data_criacao_pedido", timestamp)
        .add("uf", "string")
        .add("id_cliente", "long")
    )


def payments_schema(timestamp: str = "timestamp") -> StructType:
    evaluation = StructType().add("fraude", "boolean").add("score", "float")
    return (
        StructType()
        .add(KEY, "string", False)
        .add("forma_pagamento", "string")
        .add("valor_pagamento", "float")
        .add(STATUS, "boolean")
        .add("data_processamento", timestamp)
        .add("avaliacao_fraude", evaluation)
    )


def report_schema(timestamp: str = "timestamp") -> StructType:
    return (
        StructType()
        .add(KEY, "string", False)
        .add("uf", "string", False)
        .add("forma_pagamento", "string", False)
        .add("valor_total_pedido", "double", False)
        .add("data_criacao_pedido", timestamp, False)
    )


REPORT_COLUMNS = tuple(report_schema().fieldNames())
MATCH_COLUMNS = (*REPORT_COLUMNS, STATUS, "fraude")
