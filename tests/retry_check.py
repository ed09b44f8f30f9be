"""Run by test_retry: every other input task fails at its first attempt."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark import TaskContext
from pyspark.sql import SparkSession

from declined.operators import match_payments, orders_of_year, refused_payments, with_order_total
from declined.plans import audit_report, write_audit
from testdata_views import TIMESTAMP, YEAR, orders_view, payments_view

SF_DIR, OUTPUT = sys.argv[1:]


def failing_first(batches):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
        raise RuntimeError("first attempt")
    yield from batches


def unreliable(df):
    return df.repartition(6).mapInArrow(failing_first, df.schema)


def rows(df):
    return sorted(map(str, df.collect()))


spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .getOrCreate()
)
orders, payments = orders_view(spark, SF_DIR), payments_view(spark, SF_DIR)
expected = audit_report(orders, payments, YEAR).collect()
assert audit_report(unreliable(orders), unreliable(payments), YEAR).collect() == expected

outcome = write_audit(unreliable(orders), unreliable(payments), OUTPUT, YEAR, TIMESTAMP)
assert outcome.report_rows == len(expected)
assert rows(spark.read.parquet(OUTPUT)) == sorted(map(str, expected))


def pairs(orders, payments):
    in_scope = orders.transform(orders_of_year, YEAR).transform(with_order_total)
    return rows(match_payments(in_scope, refused_payments(payments)))


assert pairs(unreliable(orders), unreliable(payments)) == pairs(orders, payments)
failed = sum(
    info.numFailedTasks
    for info in map(spark.sparkContext.statusTracker().getStageInfo, range(200))
    if info
)
print("failed attempts:", failed)
