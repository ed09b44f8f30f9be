from __future__ import annotations

from itertools import zip_longest

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from declined import schemas


class ContractViolation(AnalysisException):
    """A frame does not have the columns its contract names."""


def contract_violations(actual: StructType, contract: StructType) -> list[str]:
    """Differences in the number, name, type or order of columns, one line each.

    Nullability is not compared: a join makes every column nullable.
    """
    found = []
    for position, (has, wants) in enumerate(zip_longest(actual, contract), start=1):
        if wants is None:
            found.append(f"column {position}: unexpected {has.name} {has.dataType.simpleString()}")
        elif has is None:
            found.append(f"column {position}: missing {wants.name} {wants.dataType.simpleString()}")
        elif (has.name, has.dataType) != (wants.name, wants.dataType):
            found.append(
                f"column {position}: {has.name} {has.dataType.simpleString()}"
                f" instead of {wants.name} {wants.dataType.simpleString()}"
            )
    return found


def require_contract(df: DataFrame, contract: StructType | None = None) -> DataFrame:
    """``df`` itself, or :class:`ContractViolation`.  Compares schemas only; starts no job."""
    contract = contract or schemas.report_schema()
    violations = contract_violations(df.schema, contract)
    if violations:
        raise ContractViolation(
            "\n".join(
                [
                    "the frame does not match its contract",
                    *violations,
                    f"expected: {contract.simpleString()}",
                    f"received: {df.schema.simpleString()}",
                ]
            )
        )
    return df
