"""The registered queries against their SQL, and against plain versions; the pipeline."""

from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from plain import held_out, least_id, model_scores, shingles, words
from pyspark.sql import functions as F
from test_llm_corpus import plain_contamination, plain_line_dedup, plain_sharing
from test_llm_models import plain_ids
from test_llm_rows import plain_quality

import __spark_entry__ as contract
import corpus_pipeline
from declined.llm import packing, quality_rules
from declined.llm.queries import oracle_sql, queries

TABLES = Path("/root/testdata")
SMALL = str(TABLES / "sf0.001")


def as_rows(table):
    columns = sorted(table.column_names)
    return sorted(map(repr, table.select(columns).to_pylist()))


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return sorted(map(tuple, rows.collect()))


def test_every_operator_has_a_query(spark):
    names = sorted(queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries()) | {"pipeline"} <= set(contract.queries())
    assert set(oracle_sql()) == set(contract.oracle_sql()) & (set(queries()) | {"pipeline"})


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_sql(spark, scale, name):
    with duckdb.connect() as database:
        for file in (TABLES / scale).glob("*.parquet"):
            database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        expected = database.sql(oracle_sql()[name]).to_arrow_table()
    actual = queries()[name](spark, str(TABLES / scale)).toArrow()
    assert {f.name: str(f.type) for f in actual.schema} == {f.name: str(f.type) for f in expected.schema}
    assert as_rows(actual) == as_rows(expected)


def checked_sequences(rows):
    whole = defaultdict(list)
    for r in rows:
        whole[r.sequence_id].append((r.offset, r.length))
    for places in whole.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(whole) <= sum(r.length for r in rows) / 2048 * 1.02 + 1


def plain_pieces(texts):
    return Counter(
        (doc_id, piece, start, n)
        for doc_id, text in texts
        for piece, (start, n) in enumerate(packing.cut(len(plain_ids(text)) + 1, 2048))
    )


def test_packing_query(spark, documents):
    got = queries()["op3_packing"](spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == plain_pieces((r[0], r[1]) for r in documents)
    checked_sequences(got)


def test_sharding_query(spark, documents):
    got = queries()["op5_sharding"](spark, SMALL)
    assert sorted(r.doc_id for r in got.collect()) == [r[0] for r in documents]
    slots = got.groupBy("shard").agg(F.count("slot").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d"))
    assert slots.filter("n <> d OR n <> m + 1 OR shard NOT BETWEEN 0 AND 39").count() == 0
    assert got.filter("grown_shard <> shard AND grown_shard <> 40").count() == 0


def test_passages_query(spark, documents):
    got = queries()["op8_substring_dedup"](spark, SMALL).collect()
    exact = {i for r in got if r.similarity == 1 for i in (r.doc_id, r.of_doc_id)}
    assert exact == plain_sharing(documents)


def test_scoring_query(spark, documents):
    got = {r.doc_id: r for r in queries()["op10_lm_scoring"](spark, SMALL).collect()}
    outs = [held_out(r[0]) for r in documents]
    want = model_scores([r[1] for r in documents], [not out for out in outs])
    for row, out, (n, known, total, base, score) in zip(documents, outs, want, strict=True):
        r = got[row[0]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def plain_kept(text):
    n, chars, symbols, dups, _, failed = plain_quality(text)
    lines = [x for x in text.split("\n") if words(x)]
    capitals = sum(c.isupper() for c in text)
    return not (failed or 10 * symbols > 3 * n or 2 * dups > len(lines) or not 2 * n <= chars <= 15 * n or 2 * capitals > chars)


def test_pipeline_equals_its_plain_version(spark, documents):
    left = [r for r in documents if plain_kept(r[1])]
    cut = {i: t for i, t, *_ in plain_line_dedup(left, 8)}
    left = [(r[0], cut[r[0]], *r[2:]) for r in left if words(cut[r[0]])]
    sets = [shingles(r[1]) for r in left]
    left = [r for r, c, s in zip(left, least_id(left, sets), sets, strict=True) if c == r[0] or not s]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {i for i, *_, contaminated in plain_contamination(left, items) if contaminated}
    want = plain_pieces((r[0], r[1]) for r in left if r[0] not in hit)
    got = contract.queries()["pipeline"](spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    checked_sequences(got)


def test_stages_keep_the_documents_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SMALL)
        none = stage(spark, docs.limit(0), SMALL)
        assert none.count() == 0 and none.columns == got.columns
        assert got.columns == docs.columns or name == "packing"


def test_labelled_junk_goes_and_the_rest_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality_rules.quality_report(docs).join(labels, "doc_id").filter("n_words >= 50")
    shares = dict(map(tuple, kept.groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()))
    assert shares[1] > 0.99 and shares[0] < 0.02
