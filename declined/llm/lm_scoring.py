"""Log probabilities of texts under a word model that the corpus itself trains.

The model backs off from pairs of words to single words: a word ``w`` that was seen ``n`` times
after ``v``, which was seen ``c`` times before ``t`` distinct words, has ``(n - D) / c``; any other
has ``D t / c`` times its probability as a single word, ``(c(w) + 1) / (N + V + 1)``.  What words
may follow a word thus adds up to one at most.  A document is framed by one boundary, which
counts as its last token and as what stands before its first.

The pairs are dealt by their first word to shards, none of which any task or the driver holds
together with another.  A shard is a trie of two levels in one buffer (``Trie``).
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import for_tasks, written
from declined.llm.elias_fano import EliasFano
from declined.llm.shingles import mixed

BOUNDARY = 0  # stands for the word at both ends of a document
SUCCESSOR_BITS = 40  # of a word's hash tell a word's successors apart
STEPS = 32  # of a stored log10 probability, for each power of ten
NOT_SEEN = 255  # in place of a stored probability
TOKENS_HELD, DOCUMENTS_HELD = 1_500_000, 200_000  # by a task before it passes them on
U64 = np.uint64


class Trie:
    """Words, and below each the words that followed it, in one buffer that may be mapped.

    First level: the rising 64-bit hashes of the words, and how often each was seen.  The
    pointers to the second level rise as well.  A successor is stored relative to its word,
    as the word's place and the successor's short hash in one number, so that the whole
    second level rises; what followed a word is one stretch of it, in which the successor is
    searched.  All three are in Elias-Fano form.  A pair's probability is one byte, its
    negative logarithm rounded up to ``1 / STEPS``.
    """

    def __init__(self, buffer):
        self.words = EliasFano(buffer)
        self.pointers = EliasFano(buffer, self.words.end)
        self.pairs = EliasFano(buffer, self.pointers.end)
        at = self.pairs.end
        self.seen = np.frombuffer(buffer, U64, self.words.n, at)
        self.codes = np.frombuffer(buffer, np.uint8, self.pairs.n, at + 8 * self.words.n)

    @staticmethod
    def encode(word: np.ndarray, after: np.ndarray, n: np.ndarray, discount: float) -> bytes:
        """From distinct pairs, by ``word`` and the short hash ``after``, seen ``n`` times each."""
        words, first = np.unique(word, return_index=True)
        place = np.repeat(np.arange(len(words)), np.diff(np.append(first, len(word))))
        seen = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
        with np.errstate(divide="ignore"):
            log = np.log10((n - discount) / np.repeat(seen, np.diff(np.append(first, len(word)))))
        codes = np.minimum(np.ceil(-log * STEPS), NOT_SEEN - 1).astype(np.uint8)
        pairs = (place.astype(U64) << U64(SUCCESSOR_BITS)) | after
        return b"".join(
            [
                EliasFano.encode(words, 1 << 64),
                EliasFano.encode(np.append(first, len(word)), len(word) + 1),
                EliasFano.encode(pairs, max(1, len(words)) << SUCCESSOR_BITS),
                seen.astype(U64).tobytes(),
                codes.tobytes(),
            ]
        )

    @staticmethod
    def mapped(encoded: bytes) -> Trie:
        """From anonymous mapped memory: no file of one machine takes part."""
        memory = mmap.mmap(-1, len(encoded))
        memory[:] = encoded
        return Trie(memory)

    def known(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word, or -1, how often it was seen, and before how many words."""
        place = self.words.find(word)
        there = place >= 0
        seen, kinds = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        at = place[there]
        seen[there] = self.seen[at].astype(np.int64)
        kinds[there] = (self.pointers.get(at + 1) - self.pointers.get(at)).astype(np.int64)
        return place, seen, kinds

    def codes_of(self, place: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The stored probability of ``after`` behind the word at ``place``, else ``NOT_SEEN``."""
        key = (np.maximum(place, 0).astype(U64) << U64(SUCCESSOR_BITS)) | after
        at = np.where(place >= 0, self.pairs.find(key), -1)
        codes = np.full(len(at), NOT_SEEN, np.uint8)
        codes[at >= 0] = self.codes[at[at >= 0]]
        return codes


def _words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words; none is that of the boundary."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    return np.maximum(h, U64(1))


def _shard(word: np.ndarray, after: np.ndarray, shards: int, hot: np.ndarray, ways: np.ndarray):
    """Shard of each pair: that of its first word, or for a hot word one of several."""
    dealt = mixed(word)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        is_hot = hot[at] == word
        dealt = np.where(is_hot, dealt + mixed(after) % ways[at], dealt)
    return (dealt % U64(shards)).astype(np.int32)


class Batch:
    """Documents that a task holds at a time, as places of their words among the distinct ones.

    The same rows give the same batch, so that answers to what it asks for can be matched
    with it again: its pairs of words rise, and those of a shard keep that order.
    """

    def __init__(self, words: np.ndarray, places: np.ndarray, lengths: np.ndarray):
        """``places`` of each document: the boundary's, its words', and the boundary's."""
        self.words, self.lengths = words, lengths
        end = np.cumsum(lengths)
        inner = np.ones(len(places), bool)
        inner[end - 1] = False
        before = np.flatnonzero(inner)
        self.first, self.second = places[before].astype(U64), places[before + 1].astype(U64)
        self.of = np.repeat(np.arange(len(lengths)), lengths - 1)

    @staticmethod
    def of_texts(texts: list[np.ndarray]) -> Batch:
        edge = np.array([BOUNDARY], U64)
        sequence = np.concatenate([part for t in texts for part in (edge, t, edge)])
        words, places = np.unique(sequence, return_inverse=True)
        lengths = np.array([len(t) + 2 for t in texts], np.int64)
        return Batch(words, places.astype(np.uint32), lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs, as one number each, and for every token which pair it ends."""
        return np.unique(self.first * U64(len(self.words)) + self.second, return_inverse=True)

    def by_shard(self, pairs: np.ndarray, shards: int, hot: np.ndarray, ways: np.ndarray):
        """Shard by shard: the places of its pairs, of its words, and how many pairs each has."""
        first, second = pairs // U64(len(self.words)), pairs % U64(len(self.words))
        first, second = first.astype(np.int64), second.astype(np.int64)
        shard = _shard(self.words[first], self.words[second], shards, hot, ways)
        order = np.argsort(shard, kind="stable")
        cut = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for own in np.split(order, cut[1:]):
            start = np.flatnonzero(np.diff(first[own], prepend=-1))
            runs = np.diff(np.append(start, len(own)))
            yield int(shard[own[0]]), own, first[own][start], second[own], runs


def _packed(values: np.ndarray, kind) -> bytes:
    return pa.compress(values.astype(kind).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Batch, list, np.ndarray, list]]:
    """Key, batch, ids, which documents train, and texts as word hashes, as many as are held."""
    task, passed = TaskContext.get().partitionId(), 0
    ids, trains, texts, held = [], [], [], 0

    def one():
        digest = xxhash.xxh3_64()
        for t in texts:
            digest.update(t.tobytes() + b"\0")
        digest.update(f"{task} {passed} {ids}".encode())
        return digest.intdigest() - (1 << 63), Batch.of_texts(texts), ids, np.array(trains, bool)

    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("trains").to_pylist(), batch.column("text"), strict=True)
        for doc_id, train, text in rows:
            ids.append(doc_id)
            trains.append(train)
            texts.append(_words(text.as_py()))
            held += len(texts[-1]) + 1
            if held >= TOKENS_HELD or len(ids) >= DOCUMENTS_HELD:
                yield one()
                ids, trains, texts, held, passed = [], [], [], 0, passed + 1
    if ids:
        yield one()


ASKED = "batch LONG, shard INT, n_words INT, n_pairs INT, words BINARY, runs BINARY, low BINARY, high BINARY, n BINARY"


def _asked(
    rows: Iterator[pa.RecordBatch], shards: int, hot: np.ndarray, ways: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """For each batch and shard its distinct pairs, and how often training documents have each."""
    for key, batch, _, trains in _batches(rows):
        pairs, pair_of = batch.pairs()
        n = np.bincount(pair_of, trains[batch.of], len(pairs)).astype(np.int64)
        short = batch.words & U64((1 << SUCCESSOR_BITS) - 1)
        found = []
        for shard, own, firsts, second, runs in batch.by_shard(pairs, shards, hot, ways):
            after = short[second]
            found.append(
                (
                    key, shard, len(firsts), len(own), batch.words[firsts].tobytes(), _packed(runs, np.uint32),
                    after.astype(np.uint32).tobytes(), (after >> U64(32)).astype(np.uint8).tobytes(), _packed(n[own], np.uint32),
                )
            )
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()] + [pa.binary()] * 5
        arrays = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ASKED.split(", ")])


ANSWERED = pa.schema(
    [("kind", pa.string()), ("batch", pa.int64()), ("shard", pa.int32()), ("codes", pa.binary())]
    + [("counts", pa.binary()), ("kinds", pa.binary()), ("n", pa.int64()), ("v", pa.int64()), ("word", pa.int64())]
)
ANSWERED_DDL = """kind STRING, batch LONG, shard INT, codes BINARY, counts BINARY, kinds BINARY, n LONG, v LONG,
                  word LONG"""


def _answered(rows: pa.Table, discount: float, hot: np.ndarray) -> pa.Table:
    """Counts a shard's pairs, builds its trie, and looks up in it what each batch asks for.

    Returns, by ``kind``: ``answer``, for a batch the codes of its pairs and the counts and
    kinds of successors of its words, in the order asked; ``total``, tokens and words that
    only this shard has; ``hot``, what it knows of a word that others share; ``trie``, the model (in ``codes``).
    """
    asked = rows.to_pylist()
    shard = asked[0]["shard"]
    del rows
    words, afters, counts = [], [], []
    for r in asked:
        runs = _unpacked(r["runs"], r["n_words"], np.uint32)
        words.append(np.repeat(np.frombuffer(r["words"], U64), runs))
        low, high = np.frombuffer(r["low"], np.uint32), np.frombuffer(r["high"], np.uint8)
        afters.append(low.astype(U64) | (high.astype(U64) << U64(32)))
        counts.append(_unpacked(r["n"], r["n_pairs"], np.uint32))
        r["low"] = r["high"] = r["n"] = None
    word, after = np.concatenate(words), np.concatenate(afters)
    del words, afters
    listed, place = np.unique(word, return_inverse=True)
    key = (place.astype(U64) << U64(SUCCESSOR_BITS)) | after
    del word, after, place
    # Distinct pairs in order, so that searches run through the levels once.
    pairs, pair_of = np.unique(key, return_inverse=True)
    del key
    trained = np.bincount(pair_of, np.concatenate(counts), len(pairs)).astype(np.int64)
    pair_place = (pairs >> U64(SUCCESSOR_BITS)).astype(np.int64)
    pair_after = pairs & U64((1 << SUCCESSOR_BITS) - 1)
    del pairs
    kept = trained > 0
    encoded = Trie.encode(listed[pair_place[kept]], pair_after[kept], trained[kept], discount)
    trie = Trie.mapped(encoded)
    at_word, count, kinds = trie.known(listed)
    codes = trie.codes_of(at_word[pair_place], pair_after)

    found, start = [], 0
    for r in asked:
        at = np.searchsorted(listed, np.frombuffer(r["words"], U64))
        end = start + r["n_pairs"]
        answer = codes[pair_of[start:end]].tobytes()
        found.append(("answer", r["batch"], shard, answer, _packed(count[at], U64), _packed(kinds[at], U64), None, None, None))
        start = end
    is_hot = np.isin(listed, hot)
    own = count[~is_hot]
    found.append(("total", None, shard, None, None, None, int(count.sum()), int((own > 0).sum()), None))
    for w in np.flatnonzero(is_hot & (count > 0)):
        hash_ = int(listed[w : w + 1].view(np.int64)[0])
        found.append(("hot", None, shard, None, None, None, int(count[w]), int(kinds[w]), hash_))
    found.append(("trie", None, shard, encoded, None, None, None, None, None))
    arrays = [pa.array([f[k] for f in found], field.type) for k, field in enumerate(ANSWERED)]
    return pa.Table.from_arrays(arrays, schema=ANSWERED)


HELD = """batch LONG, n_words INT, n_places INT, words BINARY, places BINARY, lengths BINARY, ids ARRAY<LONG>"""


def _held(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches again, each as one row that its answers are matched with."""
    for key, batch, ids, _ in _batches(rows):
        starts = np.flatnonzero(np.diff(batch.of, prepend=-1))
        # Of each document's places all but the last, which is the boundary's like the first.
        values = [
            [key], [len(batch.words)], [len(batch.first)], [batch.words.tobytes()], [_packed(batch.first, np.uint32)],
            [_packed(np.diff(np.append(starts, len(batch.of))), np.uint32)], [ids],
        ]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        arrays = [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in HELD.split(", ")])


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)


def _scores(
    held: pa.Table,
    answers: pa.Table,
    mass: float,
    discount: float,
    shards: int,
    hot: np.ndarray,
    ways: np.ndarray,
    hot_totals: np.ndarray,
) -> pa.Table:
    """The scores of a batch's documents, from the answers of all shards."""
    if held.num_rows != 1:
        raise RuntimeError("the documents were read in another order the second time")
    row = held.to_pylist()[0]
    del held
    words = np.frombuffer(row["words"], U64)
    inner = _unpacked(row["places"], row["n_places"], np.uint32)
    tokens = _unpacked(row["lengths"], len(row["ids"]), np.uint32).astype(np.int64)
    edge = np.searchsorted(words, U64(BOUNDARY)).astype(np.uint32)
    batch = Batch(words, np.insert(inner, np.cumsum(tokens), edge), tokens + 1)
    pairs, pair_of = batch.pairs()
    by_shard = {r["shard"]: r for r in answers.to_pylist()}
    del answers
    count, kinds = np.zeros(len(words)), np.zeros(len(words))
    codes, part = np.full(len(pairs), NOT_SEEN, np.uint8), np.ones(len(pairs))
    for shard, own, firsts, _, runs in batch.by_shard(pairs, shards, hot, ways):
        r = by_shard.pop(shard)
        codes[own] = np.frombuffer(r["codes"], np.uint8)
        counted = _unpacked(r["counts"], len(firsts), U64).astype(np.float64)
        count[firsts] = counted
        kinds[firsts] = _unpacked(r["kinds"], len(firsts), U64)
        part[own] = np.repeat(counted, runs)
    if by_shard:
        raise RuntimeError("the documents were read in another order the second time")
    _, own, of_hot = np.intersect1d(words, hot, assume_unique=True, return_indices=True)
    count[own], kinds[own] = hot_totals[of_hot].T
    first, second = (pairs // U64(len(words))).astype(np.int64), (pairs % U64(len(words))).astype(np.int64)
    alone = np.log10((count + 1.0) / mass)
    with np.errstate(divide="ignore", invalid="ignore"):
        # Of a hot word a shard knows a part, which its codes are relative to.
        seen = codes / -STEPS + np.log10(part / count[first])
        weight = np.where(count > 0, np.log10(discount * kinds / count), 0.0)
    score = np.where(codes == NOT_SEEN, weight[first] + alone[second], seen)
    starts = np.cumsum(tokens) - tokens
    # A document's words and boundary are what its pairs begin with.
    token = batch.first.astype(np.int64)
    columns = [
        row["ids"], tokens, np.add.reduceat((count[token] > 0).astype(np.int64), starts),
        np.add.reduceat(alone[token], starts), np.add.reduceat(score[pair_of], starts),
    ]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCORES, strict=True)], schema=SCORES)


def hot_words(
    docs: DataFrame, rows: int, shards: int, sample_rows: int = 2000
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words that hold more than two shards' share of a sample of the pairs.

    There are at most half as many as shards.  They decide to how many shards a word's pairs
    are dealt, never a count or a score.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                h = np.append(_words(text.as_py()), U64(BOUNDARY)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h)], ["word"])

    sample = docs.select("text").sample(min(1.0, sample_rows / max(rows, 1)), seed=1)
    counted = written(sample.mapInArrow(hashes, "word LONG").groupBy("word").count(), "sampled")
    total = counted.agg(F.sum("count")).first()[0] or 0
    top = counted.filter(F.col("count") > 2.0 / shards * total).collect()
    found = sorted((int(np.int64(r["word"]).view(U64)), r["count"] / total) for r in top)
    hot = np.array([w for w, _ in found], U64)
    ways = np.array([max(2, int(share * shards * 2)) for _, share in found], U64)
    return hot, ways


def lm_scores(
    docs: DataFrame,
    trains: Column,
    discount: float = 0.75,
    tokens_per_shard: int = 2_000_000,
    models: list | None = None,
) -> DataFrame:
    """Per document row: ``doc_id``, token counts, and its log10 probability under two models.

    The documents for which ``trains`` holds train both.  All are scored, whole.  Returns
    ``doc_id``, ``n_tokens`` (words and the boundary), ``n_known`` (those that training has),
    ``train_tokens``, ``base_score`` (single words with one added to each count) and ``score``
    (pairs, see above).

    Documents are read in batches.  A batch asks each shard for its distinct pairs of words, once;
    the shard counts those of all batches, builds its trie, and answers with a byte for
    each pair and the counts of the words before them.  Every word stands before another, so the answers
    hold the counts of all words of the batch as well, and with them its documents, read a second
    time, are scored.  So what is shuffled does not grow with the number of shards, which grows
    with the corpus.  A word that holds more than two shards' share is dealt by its successors to
    several, and what these know of it is added up in between: a few numbers for each of such words.
    Were the batches not the same the second time, the
    job would fail; with the same files they are, and repeated tasks make the same ones.

    A NULL or empty text is a boundary alone.  Without training documents every count is 0.
    Repeated rows are scored each, extra columns are left out, an empty table gives an empty one.
    ``models``, a list, receives a table of the shards' tries, as written in the shared folder.
    """
    docs = for_tasks(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(trains, F.lit(False)).alias("trains")
    )
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = (facts["bytes"] or 0) // 6 // tokens_per_shard + 1
    hot, ways = hot_words(docs, facts["n"], shards)
    dealing = {"shards": shards, "hot": hot, "ways": ways}
    answering = partial(_answered, discount=discount, hot=hot)
    asked = docs.mapInArrow(partial(_asked, **dealing), ASKED)
    answered = asked.groupBy("shard").applyInArrow(lambda rows: answering(rows), ANSWERED_DDL)
    answered = written(answered, "answered")
    if models is not None:
        models.append(answered.filter("kind = 'trie'").select("shard", F.col("codes").alias("trie")))
    total = answered.filter("kind = 'total'").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    of_hot = answered.filter("kind = 'hot'").groupBy("word").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    hot_totals = np.zeros((len(hot), 2))
    for row in of_hot.collect():
        at = np.searchsorted(hot, np.int64(row["word"]).view(U64))
        hot_totals[at] = row["n"], row["v"]
    n_trained = total["n"] or 0
    n_words = (total["v"] or 0) + int((hot_totals[:, 0] > 0).sum())

    scoring = partial(
        _scores, mass=float(n_trained + n_words + 1), discount=discount, hot_totals=hot_totals, **dealing
    )
    answers = answered.filter("kind = 'answer'").select("batch", "shard", "codes", "counts", "kinds")
    held = docs.mapInArrow(_held, HELD)
    scores = held.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda one, other: scoring(one, other),
        "doc_id LONG, n_tokens LONG, n_known LONG, base_score DOUBLE, score DOUBLE",
    )
    return scores.select(
        "doc_id", "n_tokens", "n_known", F.lit(n_trained).cast("long").alias("train_tokens"), "base_score", "score"
    )
