"""Small literal frames of the domain."""

from datetime import datetime

from pyspark.sql.types import StructField, StructType

from declined import schemas

DAY = datetime(2025, 1, 1)
ORDER_DEFAULTS = ("p1", "TV", 100.0, 1, DAY, "SP", 1)
PAYMENT_DEFAULTS = ("p1", "pix", 100.0, False, DAY, (False, 0.1))
MATCH_DEFAULTS = ("p1", "SP", "pix", 100.0, DAY, False, False)


def _frame(spark, schema, defaults, rows):
    nullable = StructType([StructField(f.name, f.dataType) for f in schema])
    base = dict(zip(schema.fieldNames(), defaults))
    return spark.createDataFrame([tuple({**base, **row}.values()) for row in rows], nullable)


def orders(spark, *rows):
    return _frame(spark, schemas.orders_schema(), ORDER_DEFAULTS, rows)


def payments(spark, *rows):
    return _frame(spark, schemas.payments_schema(), PAYMENT_DEFAULTS, rows)


def matches(spark, *rows):
    schema = schemas.report_schema().add("status", "boolean").add("fraude", "boolean")
    return _frame(spark, schema, MATCH_DEFAULTS, rows)


def values(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with, after ``df`` was collected."""
    df.collect()
    return executed_plan(df).split("== Initial Plan ==")[0]


def plan_nodes(plan, name):
    """The nodes of a JVM physical plan whose name starts with ``name``."""
    found = [plan] if plan.nodeName().startswith(name) else []
    children = plan.children()
    for index in range(children.size()):
        found += plan_nodes(children.apply(index), name)
    return found


def run_unadapted(df):
    """Runs ``df``, with adaptive execution off, and returns its physical plan with metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan
