import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from declined import schemas
from declined.functions import in_calendar_year
from declined.operators import (
    count_matches,
    expand_copies,
    in_report_order,
    lift_field,
    match_payments,
    one_per_key,
    orders_of_year,
    refused_payments,
    report_columns,
    row_counts,
    with_order_total,
)
from declined.plans import report_of_matches
from frames import DAY, matches, orders, payments, values

# --- order total


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "price, quantity, total",
    [(12.5, 4, 50.0), (0.25, 0, 0.0), (None, 3, None), (7.75, None, None), (-2.5, 3, -7.5)],
)
def test_order_total(spark, setting, ansi, price, quantity, total):
    setting("spark.sql.ansi.enabled", ansi)
    df = orders(spark, {"valor_unitario_pedido": price, "quantidade_pedido": quantity})
    assert values(with_order_total(df), "valor_total_pedido") == [(total,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_order_total_is_computed_in_double_precision(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    df = orders(spark, {"valor_unitario_pedido": 0.1, "quantidade_pedido": 3})
    assert values(with_order_total(df), "valor_total_pedido") == [(0.30000000447034836,)]


def test_order_total_keeps_the_other_columns(spark):
    df = orders(spark, {})
    assert with_order_total(df).columns == [*df.columns, "valor_total_pedido"]
    assert with_order_total(df).schema["valor_total_pedido"].dataType.simpleString() == "double"


# --- calendar year


def test_year_bounds(spark):
    dates = {
        "before": datetime(2024, 12, 31, 23, 59, 59, 999999),
        "first": datetime(2025, 1, 1),
        "last": datetime(2025, 12, 31, 23, 59, 59, 999999),
        "after": datetime(2026, 1, 1),
        "unknown": None,
    }
    df = orders(spark, *({"id_pedido": k, "data_criacao_pedido": d} for k, d in dates.items()))
    kept = orders_of_year(df)
    assert sorted(values(kept, "id_pedido")) == [("first",), ("last",)]
    assert kept.columns == df.columns


def test_leap_day(spark):
    df = orders(spark, {"data_criacao_pedido": datetime(2024, 2, 29, 12)})
    assert orders_of_year(df, 2024).count() == 1
    assert orders_of_year(df, 2025).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_year_range_equals_year_function(spark, setting, zone, kind):
    setting("spark.sql.session.timeZone", zone)
    instants = spark.range(20_000).select(
        F.timestamp_seconds(F.lit(1735689600) + (F.col("id") - 10_000) * 7919).cast(kind).alias("d")
    )
    differs = [in_calendar_year("d", y) != (F.year("d") == y) for y in (2023, 2024, 2025, 2026)]
    assert instants.filter(in_calendar_year("d", 2025)).count() > 3000
    assert instants.filter(F.greatest(*differs)).isEmpty()


def test_year_of_an_instant_follows_the_session_zone(spark, setting):
    half_past_midnight_utc = spark.range(1).select(F.timestamp_seconds(F.lit(1735691400)).alias("d"))
    setting("spark.sql.session.timeZone", "UTC")
    assert orders_of_year(half_past_midnight_utc, 2025, "d").count() == 1
    setting("spark.sql.session.timeZone", "America/Sao_Paulo")
    assert orders_of_year(half_past_midnight_utc, 2025, "d").count() == 0


# --- refused but legitimate


def test_only_two_false_flags_pass(spark):
    flags = list(itertools.product((True, False, None), repeat=2))
    rows = [
        {"id_pedido": f"{status}/{fraud}", "status": status, "avaliacao_fraude": (fraud, 0.1)}
        for status, fraud in flags
    ]
    rows.append({"id_pedido": "no evaluation", "avaliacao_fraude": None})
    df = payments(spark, *rows)
    kept = refused_payments(df)
    assert values(kept, "id_pedido") == [("False/False",)]
    assert kept.columns == df.columns


# --- nested field


def test_lift_field(spark):
    df = payments(spark, {"avaliacao_fraude": (True, 0.5)}, {"avaliacao_fraude": None})
    assert sorted(values(lift_field(df), "fraude"), key=str) == [(None,), (True,)]
    lifted = lift_field(df, "avaliacao_fraude.score", "risk")
    assert lifted.columns == [*df.columns, "risk"]
    assert sorted(values(lifted, "risk"), key=str) == [(0.5,), (None,)]


# --- join


def test_match_columns_and_values(spark):
    left = with_order_total(
        orders(
            spark,
            {"id_pedido": "k7", "uf": "AC", "quantidade_pedido": 3},
            {"id_pedido": "k8", "uf": "PA"},
            {"id_pedido": "unpaid"},
        )
    )
    right = payments(
        spark,
        {"id_pedido": "k8", "forma_pagamento": "debito", "avaliacao_fraude": (True, 0.7)},
        {"id_pedido": "k7", "forma_pagamento": "vale", "status": True},
        {"id_pedido": "unknown"},
    )
    joined = match_payments(left, right)
    assert joined.columns == [
        "id_pedido", "uf", "forma_pagamento", "valor_total_pedido",
        "data_criacao_pedido", "status", "fraude",
    ]
    assert sorted(values(joined, "*")) == [
        ("k7", "AC", "vale", 300.0, DAY, True, False),
        ("k8", "PA", "debito", 100.0, DAY, False, True),
    ]


def test_match_fans_out_and_ignores_null_keys(spark):
    left = with_order_total(orders(spark, {"id_pedido": "p1"}))
    left = left.unionByName(left.withColumn("id_pedido", F.lit(None).cast("string")))
    right = payments(spark, {}, {}, {"forma_pagamento": "boleto"})
    right = right.unionByName(right.withColumn("id_pedido", F.lit(None).cast("string")))
    assert match_payments(left, right).count() == 3


def test_counted_matches_expand_to_all_pairs(spark):
    left = with_order_total(orders(spark, {}, {}, {"uf": "AC"}))
    right = payments(spark, *[{}] * 5, {"forma_pagamento": "vale"})
    counted = count_matches(left, right)
    assert sorted(values(counted, "uf", "forma_pagamento", "copies")) == [
        ("AC", "pix", 5), ("AC", "vale", 1), ("SP", "pix", 10), ("SP", "vale", 2),
    ]
    assert match_payments(left, right).count() == 18


@pytest.mark.parametrize("run", [1, 3, 10_000])
def test_copies_are_numbered_without_gaps(spark, run):
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 0), (None, 3), ("a", 2)], "k string, n long")
    counted = df.filter("n > 0")
    numbered = values(expand_copies(counted, "n", "i", run=run), "k", "i")
    want = [("a", i) for i in (*range(1, 8), 1, 2)] + [("b", 1)] + [(None, i) for i in (1, 2, 3)]
    assert sorted(numbered, key=str) == sorted(want, key=str)
    assert expand_copies(counted, "n", run=run).columns == ["k"]
    assert expand_copies(counted.limit(0), "n").count() == 0


def test_row_counts(spark):
    counts = row_counts({"some": spark.range(5), "none": spark.range(0)})
    assert sorted(values(counts, "*")) == [("none", 0), ("some", 5)]


def test_match_of_frames_with_a_common_origin(spark):
    both = payments(spark, {"id_pedido": "p1"}, {"id_pedido": "p2"}).selectExpr(
        "*", "'SP' as uf", "1.0D as valor_total_pedido",
        "data_processamento as data_criacao_pedido",
    )
    assert match_payments(both, both).count() == 2


# --- projection, dedup, order


def test_report_has_exactly_the_contract_columns(spark):
    assert report_of_matches(matches(spark, {})).columns == [
        "id_pedido", "uf", "forma_pagamento", "valor_total_pedido", "data_criacao_pedido",
    ]


def test_report_columns_keep_duplicates(spark):
    assert report_columns(matches(spark, {}, {})).count() == 2


def test_one_row_per_order(spark):
    methods = {"k1": ["vale", "debito", "vale"], "k2": ["ted"], "k3": ["b", None, "a"]}
    rows = [{"id_pedido": k, "forma_pagamento": m} for k, ms in methods.items() for m in ms]
    kept = values(report_of_matches(matches(spark, *rows)), "id_pedido", "forma_pagamento")
    assert dict(kept) == {"k1": "debito", "k2": "ted", "k3": None} and len(kept) == 3


def test_survivor_is_a_whole_row_whatever_the_partitioning(spark):
    rng = random.Random(7)
    rows = [
        {
            "id_pedido": f"p{rng.randrange(40)}",
            "forma_pagamento": rng.choice([None, "boleto", "cartao", "pix"]),
            "uf": rng.choice([None, "RJ", "SP"]),
            "valor_total_pedido": rng.choice([None, 0.0, 1.5, 2.5]),
            "data_criacao_pedido": rng.choice([None, DAY, DAY + timedelta(days=1)]),
        }
        for _ in range(600)
    ]
    by = schemas.SURVIVOR_ORDER
    null_first = lambda row: [(row[c] is not None, row[c]) for c in by]
    expected = {}
    for row in rows:
        best = expected.get(row["id_pedido"])
        if best is None or null_first(row) < null_first(best):
            expected[row["id_pedido"]] = row
    df = report_columns(matches(spark, *rows))
    for parts in (1, 3, 17):
        kept = one_per_key(df.repartition(parts, F.rand(parts))).collect()
        assert {r.id_pedido: {c: r[c] for c in by} for r in kept} == {
            k: {c: row[c] for c in by} for k, row in expected.items()
        }
        assert len(kept) == len(expected)


def test_columns_beyond_the_survivor_order_break_ties(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("a", 2, "a")], "k string, n int, s string")
    for parts in (1, 3):
        assert values(one_per_key(df.repartition(parts), "k", ["n"]), "*") == [("a", 1, "x")]


def test_identical_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 1)], "k string, n int")
    assert sorted(values(one_per_key(df, "k", ["n"]), "*"), key=str) == [("a", 1), (None, 1)]


def test_report_order(spark):
    """State before method before date before id."""
    keys = [
        (uf, method, DAY + timedelta(days=day), f"k{number}")
        for uf in ("AC", "PA") for method in ("debito", "vale") for day in (0, 40) for number in (1, 2)
    ]
    numbered = [(*key[:3], f"{key[3]}-{i}") for i, key in enumerate(keys)]
    rows = [
        {"uf": uf, "forma_pagamento": method, "data_criacao_pedido": day, "id_pedido": k}
        for uf, method, day, k in random.Random(3).sample(numbered, len(numbered))
    ]
    ordered = values(report_of_matches(matches(spark, *rows)), "uf", "forma_pagamento", "data_criacao_pedido", "id_pedido")
    assert ordered == sorted(numbered)


def test_order_puts_nulls_first_and_breaks_ties_by_key(spark):
    df = matches(
        spark,
        {"id_pedido": "b"},
        {"id_pedido": "a"},
        {"id_pedido": "c", "forma_pagamento": None},
        {"id_pedido": "d", "uf": None},
        {"id_pedido": "e", "data_criacao_pedido": None},
    )
    assert [k for (k,) in values(in_report_order(df), "id_pedido")] == ["d", "c", "e", "a", "b"]


# --- missing columns are reported when the operator is applied


@pytest.mark.parametrize(
    "apply",
    [
        orders_of_year,
        with_order_total,
        refused_payments,
        lift_field,
        report_columns,
        in_report_order,
        one_per_key,
        report_of_matches,
        lambda df: match_payments(df, df),
    ],
)
def test_missing_column_raises_at_once(spark, apply):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|FIELD_NOT_FOUND"):
        apply(spark.createDataFrame([("x",)], "something_else string"))
