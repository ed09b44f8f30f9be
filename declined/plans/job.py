from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from declined import schemas
from declined.operators import (
    match_payments,
    orders_of_year,
    refused_payments,
    row_counts,
    with_order_total,
)
from declined.plans.report import audit_report
from declined.sources import (
    new_parquet,
    read_orders,
    read_payments,
    replace_parquet,
    require_contract,
    stage_parquet,
)

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class AuditOutcome:
    """How many rows the report has, where it is, and which inputs held nothing."""

    report_rows: int
    path: str
    empty_inputs: tuple[str, ...] = ()


def preview(df: DataFrame, rows: int = 5) -> None:
    """Prints the schema and the first rows.  Starts a job of its own."""
    df.printSchema()
    df.show(rows, truncate=False)


def write_audit(
    orders: DataFrame,
    payments: DataFrame,
    output_path: str,
    year: int = 2025,
    timestamp: str = "timestamp",
    show_previews: bool = False,
    new_folder: bool = False,
) -> AuditOutcome:
    """Writes the report on the given frames to ``output_path``, replacing an older one.

    With ``new_folder`` it goes to a new folder below ``output_path`` instead, which the outcome
    names: without any rename, as an object store wants it.  One plan and one write; the
    rows are then counted from the file footers.  Only if there are none are the inputs
    looked at, to tell an empty input from one with nothing to report.
    """
    report = audit_report(orders, payments, year)
    require_contract(report, schemas.report_schema(timestamp))
    if show_previews:
        in_scope = orders.transform(orders_of_year, year).transform(with_order_total)
        refused = refused_payments(payments)
        preview(payments)
        preview(orders)
        preview(match_payments(in_scope, refused), 10)

    if new_folder:
        path = new_parquet(report, output_path)
    else:
        path = output_path
        replace_parquet(report, path)
    written = orders.sparkSession.read.schema(report.schema).parquet(path)
    report_rows = written.count()
    logger.info("%d report rows written to %s", report_rows, path)
    if show_previews:
        preview(written.orderBy(*schemas.REPORT_ORDER), 10)

    empty = ()
    if report_rows == 0:
        counts = row_counts({"orders": orders, "payments": payments}).filter("n_rows = 0")
        empty = tuple(sorted(row.dataset for row in counts.collect()))
        for name in empty:
            logger.warning("the %s input holds no records", name)
    return AuditOutcome(report_rows, path, empty)


def run_audit(
    spark: SparkSession,
    orders_path: str | Sequence[str],
    payments_path: str | Sequence[str],
    output_path: str,
    year: int = 2025,
    separator: str = ";",
    header: bool = True,
    timestamp: str = "timestamp",
    staging_path: str | None = None,
    show_previews: bool = False,
    new_folder: bool = False,
) -> AuditOutcome:
    """The whole audit: orders and payments as text in, sorted report as Parquet out.

    With ``staging_path`` both inputs are first copied to new folders there as Parquet, which checks
    every column of every row and serves further reports without parsing text again.
    """
    orders = read_orders(spark, orders_path, separator, header, timestamp)
    payments = read_payments(spark, payments_path, timestamp)
    if staging_path:
        orders = stage_parquet(orders, f"{staging_path}/orders", ["data_criacao_pedido"])
        payments = stage_parquet(payments, f"{staging_path}/payments")
    return write_audit(orders, payments, output_path, year, timestamp, show_previews, new_folder)


def main(arguments: Sequence[str] | None = None) -> None:
    """Command line of the job.  Errors propagate, so that a failed run exits non-zero."""
    parser = argparse.ArgumentParser(description=run_audit.__doc__.splitlines()[0])
    parser.add_argument("--orders", required=True, help="path or glob of the orders text")
    parser.add_argument("--payments", required=True, help="path or glob of the payments JSON Lines")
    parser.add_argument("--output", required=True, help="folder of the Parquet report")
    parser.add_argument("--year", type=int, default=2025)
    parser.add_argument("--separator", default=";")
    parser.add_argument("--no-header", dest="header", action="store_false")
    parser.add_argument("--time-zone", help="zone of dates without one; default: the session's")
    parser.add_argument("--staging", help="folder for Parquet copies of the inputs")
    parser.add_argument(
        "--new-folder", action="store_true", help="write to a new folder below the output"
    )
    parser.add_argument("--preview", action="store_true", help="print schemas and first rows")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("refused payment audit").getOrCreate()
    if options.time_zone:
        spark.conf.set("spark.sql.session.timeZone", options.time_zone)
    run_audit(
        spark,
        options.orders,
        options.payments,
        options.output,
        year=options.year,
        separator=options.separator,
        header=options.header,
        staging_path=options.staging,
        show_previews=options.preview,
        new_folder=options.new_folder,
    )
