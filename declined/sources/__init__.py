"""Readers, the report contract and the Parquet sink."""

from declined.sources.contract import ContractViolation, contract_violations, require_contract
from declined.sources.parquet import (
    delete_folder,
    new_parquet,
    replace_parquet,
    stage_parquet,
)
from declined.sources.text import read_orders, read_payments

__all__ = [
    "ContractViolation",
    "contract_violations",
    "delete_folder",
    "new_parquet",
    "read_orders",
    "read_payments",
    "replace_parquet",
    "require_contract",
    "stage_parquet",
]
