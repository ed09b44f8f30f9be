"""Operators that look across documents: lines, benchmark windows, near-duplicates, passages."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import SCHEMA, hard_docs, hard_rows, least_id, prose, shingles, with_clashes, words
from pyspark.sql import functions as F

from declined.llm import decontamination, jaccard_join, line_dedup, substring_dedup
from declined.llm.components import components
from declined.llm.shingles import shingle_hashes, word_hashes


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def doc(doc_id, text, source="s"):
    return (doc_id, text, "en", source, len(text or ""))


# Components ----------------------------------------------------------------------------------


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a LONG, b LONG").repartition(5)).collect()))
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200, 202: 200, 300: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


# Lines ---------------------------------------------------------------------------------------


def plain_line_dedup(rows, min_sites, low=1, high=1 << 60):
    edge = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
    trim = lambda x: re.sub(edge, "", x)
    sites, first = defaultdict(set), {}
    for i, t, _, site, _ in rows:
        for line in {trim(x) for x in (t or "").split("\n")}:
            if low <= len(words(line)) <= high:
                sites[line].add(site)
                first[line] = min((v for v in (first.get(line), i) if v is not None), default=None)
    gone = {x for x, s in sites.items() if len(s - {None}) >= min_sites}
    out = []
    for i, t, *_ in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if not (trim(x) in gone and (i is None or i != first[trim(x)]))]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def line_rows():
    rows = hard_rows()
    for k in range(40):
        text = f"{prose(k, 30)}\n  on every page here \nonly on some\t\n{prose(k + 99, 25)}\nok ok\n\v\f word\r"
        text += f"\n{prose(50, 60) if k % 2 else prose(51, 300)}\n \n{prose(k % 5, 21)}"
        rows.append(doc(100 + k, text, f"site{k % 12}" if k % 3 else f"site{k % 4}"))
    rows.append(doc(None, "on every page here\nand more text", "site1"))
    return rows


@pytest.mark.parametrize("most_bytes", [32_000_000, 0])
@pytest.mark.parametrize("min_sites", [2, 8, 9, 10, 12, 13, 99])
def test_line_dedup(spark, min_sites, most_bytes):
    docs = frame(spark, line_rows()).repartition(3)
    got = line_dedup.line_dedup(docs, min_sites=min_sites, report=True, most_bytes=most_bytes)
    assert as_rows(got) == plain_line_dedup(line_rows(), min_sites)


def test_lines_of_other_lengths_can_be_left_out(spark):
    got = line_dedup.line_dedup(frame(spark, line_rows()), 8, min_words=3, max_words=20, report=True)
    assert as_rows(got) == plain_line_dedup(line_rows(), 8, 3, 20)


def test_lines_of_any_length_go(spark):
    """One word, a few, and hundreds of words: all are looked at."""
    common = ["word", "ok ok", "on every page here", prose(50, 60), prose(51, 300)]
    left = as_rows(line_dedup.line_dedup(frame(spark, line_rows()), 4, report=True))
    for line in common:
        holders = [i for i, text, *_ in left if line in [x.strip() for x in (text or "").split("\n")]]
        assert len(holders) == 1


def test_texts_do_not_move_where_boilerplate_is_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    scan = plan[: plan.index("Subquery")]
    assert "Exchange" not in scan and "Join" not in scan and "AS buckets" not in scan


def test_line_dedup_keeps_columns(spark):
    docs = with_clashes(frame(spark, line_rows()))
    got = line_dedup.line_dedup(docs, min_sites=8)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    want = {(i, t) for i, t, *_ in plain_line_dedup(line_rows(), 8)}
    assert {(r.doc_id, r.text) for r in got.collect()} == want
    assert got.filter("doc_id >= 101 AND n_chars <> length(text)").count() == 0
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
    no_text = docs.withColumn("text", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    assert line_dedup.line_dedup(no_text).filter("text IS NULL").count() == docs.count()


def test_sketches_agree_with_exact_counts(spark):
    """With no margin the sketches decide alone, with a wide one exact counts do."""
    docs = frame(spark, line_rows())
    lines = line_dedup.word_lines(docs)
    sketched = as_rows(line_dedup.boilerplate_lines(lines, 9, margin=0.0))
    assert sketched == as_rows(line_dedup.boilerplate_lines(lines, 9, margin=0.99)) and sketched


# Benchmark -----------------------------------------------------------------------------------

APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(APART, lower) if w]


def plain_contamination(rows, items, width=10):
    grams = defaultdict(set)
    for item, text in items:
        w = normal(text)
        k = min(width, len(w))
        for at in range(len(w) - k + 1) if k else ():
            grams[tuple(w[at : at + k])].add(item)
    out = []
    for i, t, *_ in rows:
        w, hit, found = normal(t), set(), set()
        for k in {len(g) for g in grams}:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in grams:
                    hit |= set(range(at, at + k))
                    found |= grams[tuple(w[at : at + k])]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        n = len([x for x in found if x is not None])
        out.append((i, len(w), len(hit), n, hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, prose(3, 300)), (2, "One TWO!"), (3, None), (4, ""), (5, "..."), (10, "one, two"), (None, prose(7, 40)),
    (6, "É w é ñandú " + prose(8, 12)), (6, "É w é ñandú " + prose(8, 12)), (7, "x x x x x x x x x x x"),
]


@pytest.mark.parametrize("most_bytes", [64_000_000, 0])
def test_contamination(spark, most_bytes):
    rows = [*hard_rows(), doc(40, "a é ñandú; " + prose(8, 12)), doc(41, prose(3, 300).replace(" ", "-- ").upper())]
    items = spark.createDataFrame(ITEMS, "item_id LONG, text STRING").withColumn("gram", F.lit("other"))
    got = decontamination.contamination_report(with_clashes(frame(spark, rows)), items, most_bytes=most_bytes)
    assert as_rows(got) == plain_contamination(rows, ITEMS)


def test_contamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    docs = hard_docs(spark)
    assert as_rows(decontamination.contamination_report(docs, none)) == plain_contamination(hard_rows(), [])
    items = spark.createDataFrame(ITEMS, "item_id LONG, text STRING")
    assert decontamination.contamination_report(docs.limit(0), items).count() == 0


def test_removal_of_documents_and_spans(spark):
    rows = [doc(1, "Before. One two three four five! After it."), doc(2, "clean text, É only"), doc(None, "one two THREE four five"), doc(4, None)]
    items = spark.createDataFrame([(1, "one two three four five")], "item_id LONG, text STRING")
    docs = with_clashes(frame(spark, rows))
    kept = decontamination.decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4]
    cut = decontamination.decontaminated(docs, items, remove="spans")
    assert cut.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in cut.collect()} == {
        (1, "Before! After it.", 17), (2, "clean text, É only", 18), (None, "", 0), (4, None, 0),
    }
    with pytest.raises(ValueError):
        decontamination.decontaminated(docs, items, remove="words")


# Near-duplicates -----------------------------------------------------------------------------


def edited(text, seed, n_edits):
    w, rng = text.split(), np.random.default_rng(seed)
    for at in rng.choice(len(w), n_edits, replace=False):
        w[at] = f"e{seed}x{at}"
    return " ".join(w)


def near_rows():
    """Groups of copies with few to many edits, a passage in many texts, texts of all sizes."""
    rows, base = hard_rows(), prose(50, 200)
    rows += [doc(1000 + k, edited(base, k, 1 + k % 14)) for k in range(120)]
    rows += [doc(2000 + k, prose(300 + k, 60 + k) + " " + prose(51, 25)) for k in range(60)]
    rows += [doc(3000 + k, prose(51, 25) + " " + prose(600 + k, k)) for k in range(25)]
    for k in range(1, 40):
        rows += [doc(4000 + k, prose(700 + k, k)), doc(5000 + k, prose(700 + k, k) + " end")]
    return rows


@pytest.mark.parametrize("per_bucket", [2_000_000, 500])
def test_components_of_near_duplicates(spark, per_bucket):
    rows = near_rows()
    docs = with_clashes(frame(spark, rows).repartition(4))
    sets = [shingles(r[1]) for r in rows]
    want = Counter((r[0], len(s), c) for r, s, c in zip(rows, sets, least_id(rows, sets), strict=True))
    got = jaccard_join.near_duplicates(docs, signatures_per_bucket=per_bucket, most_bytes=0 if per_bucket == 500 else 1 << 25)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == want


def test_one_document_of_each_component_stays(spark):
    rows = near_rows()
    docs = with_clashes(frame(spark, rows))
    sets = [shingles(r[1]) for r in rows]
    roots = least_id(rows, sets)
    for most_bytes in (1 << 25, 0):
        kept = jaccard_join.one_of_each(docs, most_bytes)
        assert kept.schema == docs.schema
        got = Counter((r.doc_id, r.text) for r in kept.collect())
        assert {i for i, _ in got} - {None} == {r for r in roots if r is not None}
        assert all(n == 1 for (i, _), n in got.items() if i is not None)
        # Without an id stay those that are alike to nothing with an id, and texts without words.
        assert {t for i, t in got if i is None} == {None, prose(5, 70)}
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.floats(0, 0.4), st.integers(0, 1 << 30))
def test_linked_sets_agree_in_a_signature_and_sketches_bound_their_difference(n, share, seed):
    rng = np.random.default_rng(seed)
    universe = rng.integers(1, 1 << 63, 2 * n + 2, dtype=np.uint64)
    a = np.unique(universe[:n])
    drop = int(share * n)
    b = np.unique(np.concatenate([a[drop // 2 :], universe[n : n + drop - drop // 2]]))
    if not len(b):
        return
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    common = np.sort(a[: len(a) // 3])
    both = len(np.intersect1d(a, b))
    if 100 * both >= 75 * (len(a) + len(b) - both):
        for known, counts in (none, (common, np.arange(4, 4 + len(common)))):
            met = np.intersect1d(jaccard_join.signatures(a, known, counts), jaccard_join.signatures(b, known, counts))
            assert len(met)
        assert len(a) + len(b) - 2 * both <= jaccard_join.most_apart(len(a), len(b))
    bits = [np.frombuffer(jaccard_join.parity_bits(x), np.uint8) for x in (a, b)]
    width = min(map(len, bits))
    apart = np.bitwise_count(jaccard_join.folded(bits[0], width) ^ jaccard_join.folded(bits[1], width)).sum()
    assert apart <= len(a) + len(b) - 2 * both


def test_shingles_tell_word_sequences_apart():
    h = lambda t: shingle_hashes(word_hashes(t)).tolist()
    assert h("a b c d e f") == h("A  b\tC d\ne F") and len(h("a b c d e f")) == 2
    assert h("a b c d") != h("a b c d e") and len(h("a")) == 1 and h("") == h(None) == []
    assert len(set(h("a b c d e") + h("e d c b a") + h("ab c d e f") + h("É b c d e") + h("é b c d e"))) == 5


# Passages ------------------------------------------------------------------------------------


def passage_rows():
    rows, shared = hard_rows(), prose(90, 60)
    rows += [doc(100 + k, prose(800 + k, 40 + 5 * k) + " " + shared + " " + prose(900 + k, 50)) for k in range(30)]
    rows += [doc(200 + k, prose(1000 + k, 150) + " " + prose(91, 30)) for k in range(30)]  # too short a passage
    rows += [doc(300, prose(92, 120)), doc(301, prose(93, 20) + " " + edited(prose(92, 120), 1, 2))]
    return rows


def plain_sharing(rows, width=50):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            holders[tuple(w[k : k + width])].add(i)
    return {i for ids in holders.values() if len(ids - {None}) > 1 for i in ids - {None}}


def plain_sharing_pairs(rows, width=50):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            holders[tuple(w[k : k + width])].add(i)
    return {(i, j) for ids in holders.values() for i in ids - {None} for j in ids - {None} if i < j}


def met_in_a_text(rows, width=50):
    """Pairs of texts with a row each that cover the same ``width`` words of one text, and those of the rows."""
    met, seen = {(r.of_doc_id, r.doc_id) for r in rows}, defaultdict(set)
    for r in rows:
        seen[r.of_doc_id].add((r.doc_id, r.of_start, r.of_start + r.n_words))
        seen[r.doc_id].add((r.of_doc_id, r.start, r.start + r.n_words))
    for there in seen.values():
        for (i, x, y), (j, low, high) in combinations(there, 2):
            if i != j and min(y, high) - max(x, low) >= width:
                met.add((min(i, j), max(i, j)))
    return met


@pytest.mark.parametrize("per_bucket", [2_000_000, 200])
def test_every_pair_of_texts_with_an_equal_passage_meets(spark, per_bucket):
    """Passages of 30 texts, parts of them in others, twice in some; each text has passages of its own as well."""
    rng, rows, n = random.Random(5), [], 60
    parts = [prose(400 + k, 130).split(" ") for k in range(3)]
    for i in range(n):
        own = prose(500 + i, 40).split(" ")
        for part in rng.sample(parts, rng.randrange(1, 4)):
            low = rng.randrange(0, 60)
            own += part[low : low + rng.randrange(45, 100)] * rng.choice([1, 1, 2]) + prose(rng.randrange(10**6), 20).split(" ")
        rows.append(doc(i + 1, " ".join(own)))
    copied = [*rows, *(doc(i, rows[i % n][1]) for i in range(100, 110)), doc(200, None), doc(201, "too short")]
    find = partial(substring_dedup.repeated_passages, windows_per_bucket=per_bucket)
    got = find(frame(spark, rows).repartition(4)).filter("kind = 'exact'").collect()
    want = plain_sharing_pairs(rows)
    assert len(want) > 500 and met_in_a_text(got) == want
    found = find(frame(spark, copied).repartition(4))
    assert {tuple(r) for r in substring_dedup.exact_links(found).collect()} == plain_sharing_pairs(copied)


@pytest.mark.parametrize("per_bucket", [2_000_000, 200])
def test_repeated_passages(spark, per_bucket):
    rows = passage_rows()
    text = {r[0]: words(r[1]) for r in rows if r[0] != 11}
    docs = with_clashes(frame(spark, rows).repartition(4))
    got = substring_dedup.repeated_passages(docs, windows_per_bucket=per_bucket, most_bytes=0 if per_bucket == 200 else 1 << 25).collect()
    exact = [r for r in got if r.similarity == 1]
    assert {i for r in exact for i in (r.doc_id, r.of_doc_id)} == plain_sharing(rows)
    assert not {i for r in got for i in (r.doc_id, r.of_doc_id)} & set(range(200, 230))
    for r in got:
        assert r.of_doc_id < r.doc_id and r.n_words >= 50 and 0.75 <= r.similarity <= 1
        if r.doc_id != 11 and r.similarity == 1:
            assert text[r.doc_id][r.start : r.start + r.n_words] == text[r.of_doc_id][r.of_start : r.of_start + r.n_words]
        elif r.similarity < 1:
            a = shingles(" ".join(w.decode() for w in text[r.doc_id][r.start : r.start + r.n_words]))
            b = shingles(" ".join(w.decode() for w in text[r.of_doc_id][r.of_start : r.of_start + r.n_words]))
            assert abs(len(a & b) / len(a | b) - r.similarity) < 1e-9


def near_corpus(seed, n, passages):
    """Texts with copies of passages of which up to two words are others, and a sentence that a third of all have."""
    rng = random.Random(seed)
    some = lambda k: [f"v{rng.randrange(3000)}" for _ in range(k)]
    hot, known, texts = some(30), [some(rng.randrange(50, 110)) for _ in range(passages)], []
    for _ in range(n):
        parts = some(rng.randrange(10, 80))
        before = rng.random() < 0.3
        if before:
            parts += hot + some(10)
        if rng.random() < 0.8:
            own = list(rng.choice(known))
            for _ in range(rng.choice([0, 1, 1, 2, 2])):
                k = rng.randrange(len(own))
                own[k : k + 1] = rng.choice([some(1), [], [*some(1), own[k]]])
            if not before and rng.random() < 0.3:
                parts += hot
            parts += own
        texts.append(" ".join(parts + some(rng.randrange(10, 80))))
    return texts


def plain_near_pairs(texts, width=46):
    """Pairs of texts with a stretch of ``width`` shingles that are three quarters alike; no text repeats a shingle."""
    sets, found = [shingle_hashes(word_hashes(t)) for t in texts], set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = a[:, None] == b[None, :]
            if min(len(a), len(b)) >= width and same.sum() * 7 >= 6 * width:
                sums = np.zeros((len(a) + 1, len(b) + 1), int)
                sums[1:, 1:] = same.cumsum(0).cumsum(1)
                common = sums[width:, width:] - sums[:-width, width:] - sums[width:, :-width] + sums[:-width, :-width]
                if (common * 7 >= 6 * width).any():
                    found.add((j, i))
    return found


@pytest.mark.parametrize(("seed", "n", "passages"), [(1, 300, 30), (2, 250, 4), (3, 500, 90)])
def test_recall_of_near_passages_over_a_corpus(spark, seed, n, passages):
    """Nearly all pairs of texts with a near passage are joined by links, most of those in small groups directly."""
    texts = near_corpus(seed, n, passages)
    want = plain_near_pairs(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(4)
    got = {(r.of_doc_id, r.doc_id) for r in substring_dedup.repeated_passages(docs).collect()}
    linked = dict(map(tuple, components(spark.createDataFrame(sorted(got), "a LONG, b LONG")).collect()))
    together = [linked.get(a, -1) == linked.get(b, -2) for a, b in want]
    assert len(want) > 500 and sum(together) >= 0.97 * len(want)
    assert passages < 10 or len(want & got) >= 0.75 * len(want)


def test_the_same_shingles_in_another_order_are_no_exact_passage():
    one = np.arange(60, dtype=np.uint32)
    two = one.copy()
    two[[10, 50]] = two[[50, 10]]
    anchors = [[dict(zip(("at_a", "at_b", "before", "after"), x, strict=True)) for x in rows] for rows in ([(30, 30, 30, 29)], [(0, 0, 0, 0)])]
    columns = {"a": [1, 3], "b": [2, 4], "anchors": anchors, "shingles_a": [one.tobytes()] * 2, "shingles_b": [x.tobytes() for x in (two, one)]}
    (got,) = substring_dedup._verified(iter([pa.RecordBatch.from_pydict(columns)]), 46, 0.75)
    assert [(r["a"], r["n"], r["similarity"], r["exact"]) for r in got.to_pylist()] == [(1, 64, 1.0, False), (3, 64, 1.0, True)]


def test_pieces_of_a_long_text_have_the_windows_of_the_whole():
    text = prose(21, 3000, 700)
    batch = pa.RecordBatch.from_pydict({"node": [5], "text": [text]})

    def records(piece):
        found = set()
        for rows in substring_dedup._windows(iter([batch]), 46, 4, 3, piece):
            for row in rows.to_pylist():
                columns = [np.frombuffer(row[c], kind) for c, kind in substring_dedup.FIELDS.items() if c != "ref"]
                found |= set(zip(*(c.tolist() for c in columns), strict=True))
        return found

    whole, cut = records(1 << 22), records(500)
    names = [c for c in substring_dedup.FIELDS if c != "ref"]
    at = lambda rows: {r[names.index("at")] for r in rows}
    assert whole and at(cut) == at(whole) and len(cut & whole) == len(whole)


def test_more_places_than_a_sort_key_holds_are_refused():
    n = (1 << substring_dedup.PLACE_BITS) + 1
    with pytest.raises(ValueError, match="places"):
        substring_dedup.compact_windows(np.zeros(n, np.uint64), np.zeros(n, np.uint8), 46)


def test_repeated_passages_of_nothing(spark):
    docs = hard_docs(spark)
    assert substring_dedup.repeated_passages(docs.limit(0)).count() == 0
    assert substring_dedup.repeated_passages(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_exact_passages_between_texts_that_share_only_half(spark):
    """Each pair shares 54 words, of which 48 stand in many other texts as well."""
    rows, pairs = [], 40
    for k in range(pairs):
        common, rare = prose(5000 + k, 48), prose(6000 + k, 6)
        both = [rare[: len(rare) // 2].rsplit(" ", 1)[0], rare.split(" ", 3)[3]]
        passage = f"{both[0]} {common} {both[1]}"
        rows += [doc(10_000 * k + 1 + i, f"{prose(7000 + 2 * k + i, 60)} {passage} {prose(8000 + 2 * k + i, 60)}") for i in (0, 1)]
        rows += [doc(10_000 * k + 10 + i, f"{prose(9000 + 40 * k + i, 60)} {common} {prose(20_000 + 40 * k + i, 60)}") for i in range(40)]
    got = substring_dedup.repeated_passages(frame(spark, rows).repartition(4)).collect()
    met = {i for r in got if r.similarity == 1 for i in (r.doc_id, r.of_doc_id)}
    assert met == plain_sharing(rows) and len(met) == 2 * pairs


@pytest.mark.parametrize("n_words, least", [(50, 0.9), (55, 0.9), (60, 0.95), (70, 0.95), (100, 0.95)])
def test_near_passages_in_different_texts(spark, n_words, least):
    """By brute force all of them are alike enough; those with one word in the middle third changed."""
    rows, near = [], 200
    for k in range(near):
        passage = prose(30_000 + k, n_words).split(" ")
        other = list(passage)
        other[n_words // 3 + k % (n_words // 3)] = "changed"
        a, b = shingles(" ".join(passage)), shingles(" ".join(other))
        assert len(a & b) >= 0.75 * len(a | b)
        for i, p in enumerate((passage, other)):
            rows.append(doc(2 * k + i, f"{prose(40_000 + 2 * k + i, 80)} {' '.join(p)} {prose(50_000 + 2 * k + i, 80)}"))
    got = substring_dedup.repeated_passages(frame(spark, rows).repartition(4)).collect()
    assert len({r.doc_id for r in got if r.doc_id % 2 and r.of_doc_id == r.doc_id - 1}) >= least * near


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=8, max_size=24), st.data())
def test_best_stretch_is_that_of_all_stretches(values, data):
    n, width = len(values), 6
    other = data.draw(st.lists(st.integers(0, 12), min_size=n, max_size=n).map(lambda x: [v if v < 7 else w for v, w in zip(x, values)]))
    node = data.draw(st.integers(0, n - 1))
    want = None
    for x in range(node + 1):
        for y in range(max(node, x + width - 1), n):
            a, b = set(values[x : y + 1]), set(other[x : y + 1])
            if len(a & b) >= 0.75 * len(a | b):
                want = max(want or (0, 0), (len(a & b), x - y - 1))
    got = substring_dedup.best_stretch(np.array(values), np.array(other), node, width, 0.75)
    assert (got is None) == (want is None)
    if got:
        x, size, alike = got
        a, b = set(values[x : x + size]), set(other[x : x + size])
        assert x <= node < x + size and alike == len(a & b) / len(a | b) and (len(a & b), -size) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=120), st.integers(1, 12), st.lists(st.integers(0, 3), min_size=1, max_size=4))
def test_compact_windows_are_those_of_the_cartesian_tree(values, width, cuts):
    of = np.sort(np.resize(np.array(sorted(cuts)), len(values)))
    hashes = np.array(values, np.uint64) << np.uint64(substring_dedup.PLACE_BITS)
    got = sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(hashes, of, width)), strict=True))
    want = []
    for c in range(len(values)):
        left = right = c
        while left and of[left - 1] == of[c] and values[left - 1] > values[c]:
            left -= 1
        while right + 1 < len(values) and of[right + 1] == of[c] and values[right + 1] >= values[c]:
            right += 1
        if right - left + 1 >= width:
            want.append((c, max(left, c - width + 1), min(right, c + width - 1)))
    assert got == want
