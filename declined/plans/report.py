from __future__ import annotations

from pyspark.sql import DataFrame

from declined import schemas
from declined.operators import (
    in_report_order,
    one_per_key,
    orders_of_year,
    refused_payments,
    report_columns,
    with_order_total,
)


def report_of_matches(matches: DataFrame) -> DataFrame:
    """The report of a frame of matches: five columns, one row per order, sorted."""
    reduced = matches.transform(report_columns).transform(one_per_key)
    return in_report_order(reduced, spread_by=[schemas.KEY])


def best_matches(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One report row per matched order, unsorted.

    Same rows as ``one_per_key(report_columns(match_payments(orders, payments)))``, but
    each side is brought to one row per key *before* the join.  The survivor is the
    smallest (method, state, total, date) over all pairs of an order's rows and its
    payments; since a pair is free in both halves, that is the smallest method of the
    payments next to the smallest (state, total, date) of the orders.

    The join is then one-to-one: no fan-out to dedup afterwards, and a hot key costs
    one row per upstream task instead of one overfull task.  Both aggregates leave
    their side hashed and sorted on the key, so the join adds no exchange and no sort.
    """
    order_rows = orders.select(schemas.KEY, "uf", "valor_total_pedido", "data_criacao_pedido")
    payment_rows = payments.select(schemas.KEY, "forma_pagamento")
    return (
        one_per_key(order_rows, smallest_by=schemas.SURVIVOR_ORDER[1:])
        .join(one_per_key(payment_rows, smallest_by=schemas.SURVIVOR_ORDER[:1]), schemas.KEY)
        .transform(report_columns)
    )


def audit_report(orders: DataFrame, payments: DataFrame, year: int = 2025) -> DataFrame:
    """Orders of ``year`` whose payment was refused though legitimate, in report order."""
    in_scope = orders.transform(orders_of_year, year).transform(with_order_total)
    reduced = best_matches(in_scope, refused_payments(payments))
    return in_report_order(reduced, spread_by=[schemas.KEY])
