"""Reusable ``DataFrame -> DataFrame`` steps, for use with ``DataFrame.transform``."""

from declined.operators.counts import row_counts
from declined.operators.dedup import one_per_key
from declined.operators.filters import orders_of_year, refused_payments
from declined.operators.joins import count_matches, expand_copies, match_payments
from declined.operators.ordering import in_report_order
from declined.operators.projections import lift_field, report_columns, with_order_total

__all__ = [
    "count_matches",
    "expand_copies",
    "in_report_order",
    "lift_field",
    "match_payments",
    "one_per_key",
    "orders_of_year",
    "refused_payments",
    "report_columns",
    "row_counts",
    "with_order_total",
]
