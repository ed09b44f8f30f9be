"""Suffix dedup against all strings of a length, compared in plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from plain import CLASHING, hard_rows
from pyspark.sql import functions as F

from declined.llm import suffix_dedup
from declined.llm.queries import left_over

SCHEMA = "doc_id LONG, text STRING"


def plain_left(texts, length):
    """(bytes, removed, stretches, hash of what is left) of each text."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((len(t), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return found


def left(spark, texts, length, parts=4, **sizes):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(parts)
    return [tuple(r)[1:] for r in sorted(left_over(docs, length=length, **sizes).collect())]


def edges():
    rng = random.Random(5)
    base = "".join(rng.choice("abcde ") for _ in range(3000))
    return [
        base, base[100:700], "q" * 30 + base[500:1200] + "z" * 500, base[1000:1399] + "!", base[1000:1400] + "?",
        base[2000:2400] * 2, "é" * 700, "ab" * 300, base[150:900] + "x" + base[900:1500], "ba" * 201, base[:29], "",
        None, "z" * 5000, "中" * 200, base[700:1099] + base[300:699],
    ]


@pytest.mark.parametrize("length", [1, 26, 98, 400, 1000, 5000])
def test_the_cover_has_every_difference(length):
    period, residues = suffix_dedup.difference_cover(length)
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))
    assert period == 1 or 2 * period <= length


@pytest.mark.parametrize("length", [400, 60, 30, 7])
@pytest.mark.parametrize("sizes", [{}, {"places_held": 300, "places_per_bucket": 2000, "most_bytes": 0}])
def test_edges_of_passages(spark, length, sizes):
    texts = edges()
    assert left(spark, texts, length, **sizes) == plain_left(texts, length)


@pytest.mark.parametrize("length", [400, 50])
def test_hard_rows(spark, length):
    texts = [r[1] for r in hard_rows() if r[1] is None or len(r[1]) < 50_000]
    assert left(spark, texts, length) == plain_left(texts, length)


def test_random_passages_in_random_places(spark):
    rng = random.Random(11)
    source = bytes(rng.choice(b"abcdefgh") for _ in range(4000)).decode()
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            at, n = rng.randrange(3500), rng.randrange(20, 500)
            parts += [source[at : at + n], "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 200)))]
        texts.append("".join(parts))
    assert left(spark, texts, 90, places_per_bucket=5000) == plain_left(texts, 90)


def test_copies_go_whole_and_short_ones_stay(spark):
    texts = ["long " * 100] * 5 + ["short"] * 5 + [None] * 3 + ["once only " + "".join(map(str, range(200)))]
    got = left(spark, texts, 400)
    assert got == plain_left(texts, 400) and [x[1] for x in got] == [500] * 5 + [0] * 9


def test_a_string_that_repeats_in_a_text_is_sent_twice():
    node = np.arange(3, dtype=np.int64)
    of, at = np.repeat(np.arange(3), 1000), np.tile(np.arange(1000), 3)
    key = np.where(at % 7 == 0, np.uint64(5 << 40), suffix_dedup.mixed((of * 1000 + at).astype(np.uint64)))
    batch = suffix_dedup._placed(7, node, of, at, key, 4, 8)
    sent = sum(len(x) // 8 for x in batch.column("keys").to_pylist() if x is not None)
    assert sent == np.count_nonzero(at % 7) + 2


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert left_over(docs, length=400).count() == 0
    extra = spark.createDataFrame(list(enumerate(edges())), SCHEMA)
    extra = extra.withColumns({c: F.lit(c) for c in ["places", "hand", "keys", "counts", "gone", *CLASHING]})
    assert [tuple(r)[1:] for r in sorted(left_over(extra, length=60).collect())] == plain_left(edges(), 60)


def test_numbers_of_seven_bits_a_byte_come_back():
    values = np.array([0, 1, 127, 128, 300, 2**14, 2**31, 2**40, 5], np.int64)
    data, sizes = suffix_dedup.short(values)
    assert sizes.sum() == len(data) and (suffix_dedup.unshort(data) == values).all()


def test_kept_bytes_are_what_stretches_leave(spark):
    docs = spark.createDataFrame(list(enumerate(edges())), SCHEMA)
    texts = {r.node: (r.text or "").encode() for r in docs.select(suffix_dedup.text_node().alias("node"), "text").collect()}
    found = suffix_dedup.repeats(docs, 60).collect()
    assert len({r.node for r in found}) == len(found) > 5
    for r in found:
        gone = {i for a, b in zip(r.firsts, r.ends, strict=True) for i in range(a, b)}
        assert gone and r.n_bytes == len(texts[r.node])
        assert bytes(r.kept) == bytes(b for i, b in enumerate(texts[r.node]) if i not in gone)
