"""Every registered query against its SQL twin on the given tables."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = Path("/root/testdata")
# Rows of the report at each scale.
REPORT_ROWS = {"sf0.001": 114, "sf0.01": 1120}


def types(table):
    return {field.name: str(field.type) for field in table.schema}


def rows(table):
    columns = sorted(table.column_names)
    return sorted(map(repr, table.select(columns).to_pylist()))


@pytest.fixture(scope="module", params=sorted(REPORT_ROWS))
def scale(request):
    return request.param


@pytest.fixture(scope="module")
def database(scale):
    connection = duckdb.connect()
    for file in (TABLES / scale).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


# The training-data operators, where they are present, have tests of their own.
OWN = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, database, scale, name):
    actual = contract.queries()[name](spark, str(TABLES / scale)).toArrow()
    expected = database.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert types(actual) == types(expected)
    assert rows(actual) == rows(expected)


@pytest.mark.parametrize("name", ["report", "audit_report", "dedup_one_row_per_order"])
def test_report_size(spark, scale, name):
    assert contract.queries()[name](spark, str(TABLES / scale)).count() == REPORT_ROWS[scale]


@pytest.mark.parametrize("name", ["report", "audit_report", "report_sorted"])
def test_report_comes_out_in_order(spark, scale, name):
    rows = contract.queries()[name](spark, str(TABLES / scale)).collect()
    order = [(r.uf, r.forma_pagamento, r.data_criacao_pedido, r.id_pedido) for r in rows]
    assert order == sorted(order)


def test_every_query_has_its_sql():
    assert len(OWN) == 17 and set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """In a copy without them the entry module imports and has every other query."""
    here = Path(contract.__file__).parent
    for name in ("__spark_entry__.py", "testdata_views.py"):
        shutil.copy(here / name, tmp_path)
    shutil.copytree(here / "declined", tmp_path / "declined", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr
    assert [line.split() for line in done.stdout.splitlines()] == [OWN, OWN]


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "id_pedido", "uf", "forma_pagamento", "valor_total_pedido", "data_criacao_pedido",
    ]
    assert result.count() == REPORT_ROWS["sf0.001"]
