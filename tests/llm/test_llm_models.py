"""Token ids and packing, the n-gram trie and its scores."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import SCHEMA, hard_docs, hard_rows, held_out, model_scores, prose, with_clashes
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from declined.llm import lm_scoring, packing
from declined.llm.elias_fano import EliasFano
from declined.llm.tokens import ByteBpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
BPE = ByteBpe(PATH, most=9000)  # forgets often


def plain_ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4")


# Tokens --------------------------------------------------------------------------------------

PARTS = ["a", "Word", " ", "  ", "\n", "\t", "é", "É", "'s", "'", "’", "1", "23", ".", "!!", "**", "<|endoftext|>",
         "<|", "|>", "\x1c", "\xa0", " ", "中文", "ñandú", "ª", "\U0001f600", "-", "_", "ing"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    assert BPE.ids(text) == plain_ids(text).tobytes()


def test_ids_of_long_and_empty_texts():
    assert BPE.ids(None) == BPE.ids("") == b""
    for text in (prose(1, 5000, 900), "x" * 3000, " " * 500, "word. " * 300, "\n" * 50):
        assert BPE.ids(text) == plain_ids(text).tobytes()


def bytes_held(encoded):
    return sum(4 * len(k) + len(v) for known in (encoded, encoded.older) for k, v in known.items())


def test_text_without_blanks_is_encoded_in_bounded_memory():
    """Twenty million characters of which every line, or the whole text, is a string of its own."""
    bpe = ByteBpe(PATH, most=2_000_000)
    rng = np.random.default_rng(1)
    for k in range(40):
        text = "".join(map(chr, rng.integers(0x4E00, 0x9000, 500_000)))
        if k % 2:
            text = "\n\n".join(text[i : i + 50] for i in range(0, 100_000, 50))  # short lines are held, and forgotten
        ids = bpe.ids(text)
        assert k > 1 or ids == plain_ids(text).tobytes()
        assert bytes_held(bpe.first) + bytes_held(bpe.after_blank) <= 2 * (2_000_000 + 250_000) + 2000
    assert len(bpe.first) > 0


# Packing -------------------------------------------------------------------------------------


@given(st.integers(1, 500), st.integers(1, 40))
def test_cut(n, capacity):
    pieces = packing.cut(n, capacity)
    assert [at for at, _ in pieces] == list(np.cumsum([0] + [k for _, k in pieces])[:-1])
    assert sum(k for _, k in pieces) == n and all(k == capacity for _, k in pieces[1:])
    assert 1 <= pieces[0][1] <= capacity and (n > capacity or len(pieces) == 1)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), max_size=12))
def test_plan_uses_every_piece_once_and_fills_no_sequence_over(counts):
    plan = packing.packing_plan(counts, 24)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 24 and times > 0
        used.update({k: n * times for k, n in Counter(pattern).items()})
    assert used == Counter(counts)
    total = sum(k * n for k, n in counts.items())
    assert sum(times for _, times in plan) <= 2 * -(-total // 24)


def test_plan_fills_gaps_exactly():
    assert packing.packing_plan({20: 3, 4: 3}, 24) == [((20, 4), 3)]
    assert packing.packing_plan({20: 3, 3: 3, 1: 3}, 24) == [((20, 3, 1), 3)]
    assert packing.packing_plan({17: 2, 4: 2, 2: 2, 1: 2}, 24) == [((17, 4, 2, 1), 2)]
    assert packing.packing_plan({20: 2, 2: 2, 1: 4}, 24) == [((20, 2, 2), 1), ((20, 1, 1, 1, 1), 1)]
    assert sum(n for _, n in packing.packing_plan({24: 10**9, 12: 10**9}, 24)) == 15 * 10**8
    assert packing.packing_plan({}, 24) == []


def packed(spark, docs, capacity=64):
    return packing.pack(packing.token_pieces(docs, PATH, capacity), capacity)


def test_packed_documents(spark):
    rows = [*hard_rows(), (50, "<|endoftext|> a", None, None, 0)]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA))
    got = packed(spark, docs).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.append(plain_ids(text), np.uint32(0)).astype("<u4")
        for piece, (start, n) in enumerate(packing.cut(len(ids), 64)):
            want[doc_id, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == want
    whole = defaultdict(list)
    for r in got:
        whole[r.sequence_id].append((r.offset, r.length))
    for places in whole.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 64
    total = sum(r.length for r in got)
    assert len(whole) <= 1.02 * total / 64 + 1


def test_sequences_hold_the_ids_in_order(spark):
    rows = packed(spark, hard_docs(spark).filter("doc_id < 9"))
    got = {r.sequence_id: r.ids for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert got[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids


def test_many_equal_pieces_and_none(spark):
    pieces = spark.range(20_000).select("id", F.lit(0).alias("piece"), F.lit(1).alias("doc_id"), F.lit(30).cast("long").alias("length"))
    got = packing.pack(pieces, 64).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("at"))
    assert got.count() == 10_000 and got.filter("n <> 60 OR at <> 0").count() == 0
    assert packing.pack(pieces.limit(0), 64).count() == 0 and packed(spark, hard_docs(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces, 20)


# Elias-Fano and the trie ---------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=200), st.integers(0, 60), st.lists(st.integers(0, (1 << 64) - 1), max_size=20))
def test_elias_fano(values, shift, others):
    v = np.sort(np.array(values, np.uint64) >> np.uint64(shift))
    coded = EliasFano(EliasFano.encode(v, 1 << (64 - shift)))
    assert coded.get(np.arange(len(v))).tolist() == v.tolist()
    asked = np.concatenate([v, np.array(others, np.uint64) >> np.uint64(shift)])
    first = np.searchsorted(v, asked)
    if len(v):
        assert coded.successor(asked).tolist() == first.tolist()
    there = np.isin(asked, v)
    assert coded.find(asked).tolist() == np.where(there, first, -1).tolist()


def test_elias_fano_takes_little_more_than_the_differences():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 50_000, dtype=np.uint64))
    bits = 8 * len(EliasFano.encode(v, 1 << 40)) / len(v)
    assert bits < 2 + np.log2((1 << 40) / 50_000) + 2


def test_trie_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(2)
    word = np.sort(rng.choice(rng.integers(0, 1 << 63, 50, dtype=np.uint64), 900))
    after = rng.integers(0, 1 << 40, 900, dtype=np.uint64)
    order = np.lexsort((after, word))
    word, after, n = word[order], after[order], rng.integers(1, 9, 900)
    (tmp_path / "trie").write_bytes(lm_scoring.Trie.encode(word, after, n, 0.75))
    trie = lm_scoring.Trie(np.memmap(tmp_path / "trie", mode="r"))
    words = np.unique(word)
    place, seen, kinds = trie.known(np.append(words, np.uint64(5)))
    assert place.tolist() == [*range(len(words)), -1]
    assert seen.tolist() == [*(n[word == w].sum() for w in words), 0]
    assert kinds.tolist() == [*((word == w).sum() for w in words), 0]
    at = np.searchsorted(words, word)
    want = np.minimum(np.ceil(-np.log10((n - 0.75) / seen[at]) * lm_scoring.STEPS), 254)
    assert trie.codes_of(at, after).tolist() == want.tolist()
    assert set(trie.codes_of(at, after ^ np.uint64(1 << 39))) == {lm_scoring.NOT_SEEN}
    assert set(trie.codes_of(np.full(3, -1), after[:3])) == {lm_scoring.NOT_SEEN}


def test_what_follows_a_word_adds_up_to_one_at_most():
    n = np.array([5, 3, 1, 1])
    trie = lm_scoring.Trie(lm_scoring.Trie.encode(np.full(4, 9, np.uint64), np.arange(4, dtype=np.uint64), n, 0.75))
    codes = trie.codes_of(np.zeros(4, np.int64), np.arange(4, dtype=np.uint64))
    assert (10.0 ** (codes / -lm_scoring.STEPS)).sum() + 0.75 * 4 / 10 <= 1


# Scores --------------------------------------------------------------------------------------


def scored_rows():
    rows = hard_rows() + [(100 + k, prose(k, 200, 300), None, None, 0) for k in range(80)]
    return rows + [(200 + k, "the cat " * k + prose(k + 1, 9), None, None, 0) for k in range(60)]


def trains_model():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2


@pytest.mark.parametrize("per_shard", [3_000_000, 4000, 300])
def test_scores_are_those_of_the_plain_model(spark, per_shard):
    """The smallest shards make the pair of words that is everywhere hot, and deal it out."""
    rows = scored_rows()
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    models = []
    got = lm_scoring.lm_scores(docs, trains_model(), tokens_per_shard=per_shard, models=models).collect()
    trains = [held_out(r[0]) is False for r in rows]
    want = defaultdict(list)
    for r, scores in zip(rows, model_scores([r[1] for r in rows], trains), strict=True):
        want[r[0]].append(scores)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for doc_id, scores in want.items():
        own = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got if r.doc_id == doc_id)
        for a, b in zip(own, sorted(scores), strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
            # A hot word's probabilities are rounded once more.
            assert a[4] == pytest.approx(b[4], abs=1e-6 if per_shard > 300 else a[0] / 32 + 1e-6)
    assert models[0].count() == len({r.shard for r in models[0].collect()}) > (per_shard < 10_000)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm_scoring.lm_scores(docs, trains_model()).join(docs.select("doc_id", (~trains_model()).alias("out")), "doc_id").filter("out")
    sums = got.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > sums[1] + 0.3 * sums[2]


def test_scores_of_nothing_and_by_nothing(spark):
    docs = hard_docs(spark)
    assert lm_scoring.lm_scores(docs.limit(0), trains_model()).count() == 0
    for trains in (F.lit(False), F.lit(None).cast("boolean")):
        got = lm_scoring.lm_scores(docs, trains).collect()
        assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
