"""Orders and payments derived from the given tables, as DataFrames and as SQL.

The tables hold no payments, so each order line stands for one: its return flag gives
the status (R refused, A approved, N unknown), its line status the fraud flag.  The
year to report is 1998.  Dates stay ``timestamp_ntz``, so that no session time zone
can move them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = 1998
TIMESTAMP = "timestamp_ntz"

# Columns in use; declared, so that no job has to read them off the files first.
TABLES = {
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE,
                 o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "lineitem": """l_orderkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE,
                   l_discount DOUBLE, l_returnflag STRING, l_linestatus STRING,
                   l_shipdate TIMESTAMP_NTZ""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS id_pedido",
            "o_orderpriority AS produto",
            "CAST(o_totalprice AS FLOAT) AS valor_unitario_pedido",
            "o_orderkey % 5 AS quantidade_pedido",
            "o_orderdate AS data_criacao_pedido",
            "n_name AS uf",
            "o_custkey AS id_cliente",
        )
    )


def payments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS id_pedido",
        "'M' || CAST(l_linenumber AS STRING) AS forma_pagamento",
        "CAST(l_extendedprice AS FLOAT) AS valor_pagamento",
        "CASE l_returnflag WHEN 'R' THEN false WHEN 'A' THEN true END AS status",
        "l_shipdate AS data_processamento",
        """named_struct('fraude', l_linestatus = 'O',
                        'score', CAST(l_discount AS FLOAT)) AS avaliacao_fraude""",
    )


ORDERS_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id_pedido,
           o_orderpriority AS produto,
           CAST(o_totalprice AS FLOAT) AS valor_unitario_pedido,
           o_orderkey % 5 AS quantidade_pedido,
           o_orderdate AS data_criacao_pedido,
           n_name AS uf,
           o_custkey AS id_cliente
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
"""

PAYMENTS_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS id_pedido,
           'M' || CAST(l_linenumber AS VARCHAR) AS forma_pagamento,
           CAST(l_extendedprice AS FLOAT) AS valor_pagamento,
           CASE l_returnflag WHEN 'R' THEN false WHEN 'A' THEN true END AS status,
           l_shipdate AS data_processamento,
           l_linestatus = 'O' AS fraude,
           CAST(l_discount AS FLOAT) AS score
    FROM lineitem
"""
