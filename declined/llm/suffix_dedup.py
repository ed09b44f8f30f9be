"""Bytes of texts that stand elsewhere as well, by blockwise sorting of suffixes.

Sorting all suffixes of a corpus would move a record for each byte.  A difference cover saves most of them:
of a set of residues every two places, moved on together by less than the period, both hit one.  So if
strings of ``length`` bytes agree, then at some equal distance from their starts both have a place of the cover, and
from there on ``length - period + 1`` bytes agree.  The cover's places, one in eleven, are sorted first, by
fingerprints of that many bytes; those that stand alone have the rank 0.  A suffix that has no ranked place
of the cover before it ends is tied with no other for so long, and is not sorted at all.  The rest is sorted
by fingerprints of ``length`` bytes, one bucket of suffixes at a time; a bucket is a range of
fingerprints, and their number grows with the corpus, so that a bucket's memory does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import for_tasks, written
from declined.llm.shingles import STEP, mixed

FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)  # odd, so it has an inverse
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)
BLOCK = 1 << 15  # starts whose sums are held at a time


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """A period of at most half of ``length`` and residues that contain every difference modulo it.

    After Colbourn and Ling: for each ``r`` there are ``6 r + 4`` residues for the period
    ``24 r ** 2 + 36 r + 13``, given by the steps between them.
    """
    period, residues, r = 1, np.zeros(1, np.int64), 0
    while 2 * (24 * r * r + 36 * r + 13) <= length:
        period = 24 * r * r + 36 * r + 13
        steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
        residues = np.concatenate(([0], np.cumsum(steps)))
        r += 1
    return period, residues


def fingerprints(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """64 bits for the ``width`` bytes from each start on; ``starts`` rise.  From running sums of each block."""
    n = BLOCK + width
    powers = np.cumprod(np.full(n, FACTOR, np.uint64), dtype=np.uint64)
    inverse = np.cumprod(np.full(BLOCK, pow(int(FACTOR), -1, 1 << 64), np.uint64), dtype=np.uint64)
    found, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        first = starts[i]
        j = np.searchsorted(starts, first + BLOCK)
        part = BYTES[data[first : starts[j - 1] + width]]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)], dtype=np.uint64)))
        at = starts[i:j] - first
        found[i:j] = (sums[at + width] - sums[at]) * inverse[at]
        i = j
    return mixed(found)


def runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, as many as ``sizes`` says."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def steps_of(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Differences to the value before; where ``fresh``, the value itself."""
    return np.where(fresh, values, np.diff(values, prepend=0))


def short(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of seven bits a byte, of which all but the last have the eighth set; and the bytes each takes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(7, 64, 7):
        if not (more := values >> np.uint64(k) > 0).any():
            break
        size += more
    end = np.cumsum(size)
    data = np.zeros(end[-1] if len(end) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        low = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        data[end[has] - size[has] + k] = low | np.where(size[has] > k + 1, np.uint64(128), np.uint64(0))
    return data, size


def unshort(data: np.ndarray) -> np.ndarray:
    end = np.flatnonzero(data < 128)
    if len(end) == len(data):
        return data.astype(np.int64)
    first = np.concatenate(([0], end[:-1] + 1))
    place = (np.arange(len(data)) - np.repeat(first, end - first + 1)).astype(np.uint64)
    parts = (data & np.uint8(127)).astype(np.uint64) << (place * np.uint64(7))
    return np.add.reduceat(parts, first).astype(np.int64)


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``data`` cut into values of ``sizes`` bytes."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of binaries, and where its values start, and end."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def places_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places in each value of a column of rising places, and how many each value has."""
    data, offsets = bytes_of(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(column), np.int64)
    steps = unshort(data)
    upto = np.concatenate(([0], np.cumsum(data < 128)))[offsets]
    counts = np.diff(upto)
    sums = np.concatenate(([0], np.cumsum(steps)))
    return sums[1:] - np.repeat(sums[upto[:-1]], counts), counts


PLACED = "hand LONG, bucket INT, nodes BINARY, counts BINARY, places BINARY, keys BINARY"


def _hands() -> Iterator[int]:
    """Numbers for what a task passes on, the same ones when it is repeated."""
    first = TaskContext.get().partitionId() << 32
    return count(first)


def _placed(
    hand: int, node: np.ndarray, of: np.ndarray, at: np.ndarray, key: np.ndarray, n_buckets: int, key_bytes: int
) -> pa.RecordBatch:
    """Per bucket the places ``at`` of the texts ``of``, and the fingerprints there; ``hand`` numbers them all.

    Of a fingerprint that comes several times among them two places stand for all, which are known to
    repeat: they go along without a fingerprint, to be passed on.  So however often a string
    repeats, its bucket receives two places from a task's hands.
    """
    key = key >> np.uint64(64 - 8 * key_bytes)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    before = np.concatenate(([False], same))
    again = np.zeros(len(key), bool)
    again[order] = before | np.concatenate((same, [False]))
    third = np.zeros(len(key), bool)
    third[order] = before & np.concatenate(([False], before[:-1]))
    top = key >> np.uint64(max(0, 8 * key_bytes - 32))
    bucket = ((top * np.uint64(n_buckets)) >> np.uint64(min(32, 8 * key_bytes))).astype(np.int64)
    sent = [(np.flatnonzero(~third), bucket, True), (np.flatnonzero(again), np.full(len(at), hand % n_buckets), False)]
    rows = []
    for chosen, to, keyed in sent:
        chosen = chosen[np.argsort(to[chosen], kind="stable")]
        if not len(chosen):
            continue
        to, ref, place = to[chosen].astype(np.int64), of[chosen], at[chosen]
        cut = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        fresh = np.concatenate(([True], (to[1:] != to[:-1]) | (ref[1:] != ref[:-1])))
        places, sizes = short(steps_of(place, fresh))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        keys = key[chosen].view(np.uint8).reshape(-1, 8)[:, :key_bytes] if keyed else None
        for a, b in zip(cut, np.append(cut[1:], len(chosen)), strict=True):
            first = np.flatnonzero(fresh[a:b])
            counts, _ = short(np.diff(np.append(first, b - a)))
            rows.append((hand, int(to[a]), node[ref[a:b][first]].tobytes(), counts.tobytes(), places[ends[a] : ends[b]].tobytes(),
                         keys[a:b].tobytes() if keyed else None))
    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4
    arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PLACED.split(", ")])


def _cover_places(
    batches: Iterator[pa.RecordBatch], length: int, n_buckets: int, key_bytes: int, held: int
) -> Iterator[pa.RecordBatch]:
    """The cover's places of all texts, each text once for a task, with fingerprints of what two of them share."""
    period, residues = difference_cover(length)
    width = length - period + 1
    known: set[int] = set()
    hands = _hands()
    for batch in batches:
        node = batch.column("node").to_numpy()
        data, offsets = bytes_of(batch.column("text"))
        size = np.diff(offsets)
        fresh = np.zeros(len(node), bool)
        for i in np.flatnonzero(size >= length).tolist():
            if node[i] not in known:
                fresh[i] = True
                known.add(node[i])
        if len(known) > 1_000_000:
            known.clear()
        rows = np.flatnonzero(fresh)
        if not len(rows):
            continue
        cover = (np.arange(size[rows].max() // period + 1)[:, None] * period + residues).ravel()
        counts = np.searchsorted(cover, size[rows] - width, side="right")
        upto = np.cumsum(counts)
        for low in range(0, int(upto[-1]), held):
            # The places from ``low`` on, as part of the texts' lists of places.
            first = np.maximum(0, low - (upto - counts))
            own = np.maximum(0, np.minimum(counts, low + held - (upto - counts)) - first)
            at = cover[runs(first, own)]
            of = np.repeat(rows, own)
            key = fingerprints(data, offsets[of] + at, width)
            yield _placed(next(hands), node, of, at, key, n_buckets, key_bytes)


def _suspect_places(
    batches: Iterator[pa.RecordBatch], length: int, n_buckets: int, held: int
) -> Iterator[pa.RecordBatch]:
    """The starts that have a ranked place of the cover within a period, with fingerprints of ``length`` bytes."""
    period, _ = difference_cover(length)
    hands = _hands()
    for batch in batches:
        node = batch.column("node").to_numpy()
        data, offsets = bytes_of(batch.column("text"))
        lists = batch.column("places")
        ranked, counts = places_of(lists.flatten())
        row = np.repeat(np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy())), counts)
        place = np.unique(offsets[row] + ranked)
        of = np.searchsorted(offsets, place, side="right") - 1
        first = np.maximum(place - period + 1, offsets[of])
        first[1:] = np.maximum(first[1:], np.where(of[1:] == of[:-1], place[:-1] + 1, 0))
        last = np.minimum(place, offsets[of + 1] - length)
        sizes = np.maximum(0, last - first + 1)
        upto = np.cumsum(sizes)
        cuts = np.searchsorted(upto, np.arange(held, (upto[-1] if len(upto) else 0) + held, held)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
            starts, of_start = runs(first[a:b], sizes[a:b]), np.repeat(of[a:b], sizes[a:b])
            if len(starts):
                key = fingerprints(data, starts, length)
                yield _placed(next(hands), node, of_start, starts - offsets[of_start], key, n_buckets, 8)


REPEATED = "hand LONG, nodes BINARY, counts BINARY, places BINARY, n LONG"


def repeated(key_bytes: int) -> Callable[[pa.Table], pa.Table]:
    def of_bucket(table: pa.Table) -> pa.Table:
        return _repeated(table, key_bytes)

    return of_bucket


def _repeated(table: pa.Table, key_bytes: int) -> pa.Table:
    """One bucket: sorts its places by fingerprint and keeps those whose fingerprint another place has.

    They go back to the hands that they came from.
    """
    keys, nodes, counts, places, hands, rows = [], [], [], [], [], []
    for hand, *row in zip(*(table.column(c) for c in ("hand", "nodes", "counts", "places", "keys")), strict=True):
        node, many, at, key = (x.as_py() for x in row)
        if key is None:
            rows.append((hand.as_py(), node, many, at, int((np.frombuffer(at, np.uint8) < 128).sum())))
            continue
        whole = np.zeros((len(key) // key_bytes, 8), np.uint8)
        whole[:, :key_bytes] = np.frombuffer(key, np.uint8).reshape(-1, key_bytes)
        keys.append(whole.view(np.uint64).ravel())
        nodes.append(np.frombuffer(node, np.int64))
        counts.append(unshort(np.frombuffer(many, np.uint8)))
        places.append(rising(np.frombuffer(at, np.uint8), counts[-1]))
        hands.append(hand.as_py())
    if keys:
        sizes = list(map(len, keys))
        key, node, at = map(np.concatenate, (keys, nodes, places))
        keys.clear()
        of = np.repeat(np.arange(len(node)), np.concatenate(counts))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        several = np.repeat(size > 1, size)
        order, lead = order[several], np.repeat(order[first], size)[several]
        # Tasks that each saw one copy of a text name the same place twice.
        other = (node[of[order]] != node[of[lead]]) | (at[order] != at[lead])
        size = size[size > 1]
        kept = np.zeros(len(at), bool)
        if len(size):
            kept[order] = np.repeat(np.logical_or.reduceat(other, np.cumsum(size) - size), size)
        for hand, low, n in zip(hands, np.cumsum(sizes) - sizes, sizes, strict=True):
            own = np.flatnonzero(kept[low : low + n]) + low
            if len(own):
                rows.append((hand, *listed(node, of[own], at[own]), len(own)))
    kinds = [pa.int64(), *[pa.binary()] * 3, pa.int64()]
    arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.table(arrays, [c.split()[0] for c in REPEATED.split(", ")])


def rising(data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of several texts, of which the first ones are given as they are and others by their steps."""
    sums = np.concatenate(([0], np.cumsum(unshort(data))))
    end = np.cumsum(counts)
    return sums[1:] - np.repeat(sums[end - counts], counts)


def listed(node: np.ndarray, of: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Texts, how many places each has, and the places."""
    fresh = np.concatenate(([True], of[1:] != of[:-1]))
    first = np.flatnonzero(fresh)
    counts, _ = short(np.diff(np.append(first, len(of))))
    places, _ = short(steps_of(at, fresh))
    return node[of[first]].tobytes(), counts.tobytes(), places.tobytes()


GATHERED = "node LONG, places BINARY"


def gathered(table: pa.Table) -> pa.Table:
    """What came back to one hand from all buckets: a row for each text."""
    nodes, places = [], []
    for row in zip(*(table.column(c) for c in ("nodes", "counts", "places")), strict=True):
        node, counts, at = (np.frombuffer(x.as_py(), kind) for x, kind in zip(row, (np.int64, np.uint8, np.uint8), strict=True))
        counts = unshort(counts)
        nodes.append(np.repeat(node, counts))
        places.append(rising(at, counts))
    node, at = np.concatenate(nodes), np.concatenate(places)
    order = np.lexsort((at, node))
    node, at = node[order], at[order]
    fresh = np.concatenate(([True], node[1:] != node[:-1]))
    data, sizes = short(steps_of(at, fresh))
    first = np.flatnonzero(fresh)
    return pa.table([pa.array(node[first]), binaries(data, np.add.reduceat(sizes, first))], ["node", "places"])


REMAINING = "node LONG, n_bytes LONG, firsts ARRAY<LONG>, ends ARRAY<LONG>, kept BINARY"


def _remaining(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The stretches of each text that a repeated start covers, and the bytes that none does."""
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        firsts, ends, kept = [], [], []
        for i, value in enumerate(batch.column("places")):
            at = np.unique(places_of(value.values)[0])
            apart = at[1:] > at[:-1] + length
            first, end = at[np.append(True, apart)], at[np.append(apart, True)] + length
            edges = np.append(0, end), np.append(first, offsets[i + 1] - offsets[i])
            own = data[offsets[i] : offsets[i + 1]]
            kept.append(b"".join(own[a:b].tobytes() for a, b in zip(*edges, strict=True)))
            firsts.append(first)
            ends.append(end)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(np.diff(offsets)), pa.array(firsts, longs), pa.array(ends, longs), pa.array(kept, pa.binary())],
            [c.split()[0] for c in REMAINING.split(", ")],
        )


def repeats(
    docs: DataFrame,
    length: int = 400,
    places_per_bucket: int = 4_000_000,
    places_held: int = 2_000_000,
    most_bytes: int = 32_000_000,
) -> DataFrame:
    """Per distinct text that loses bytes: ``node``, ``n_bytes``, ``firsts`` and ``ends`` of what goes, ``kept``.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in ``docs``, in
    another text or in the same one, overlapping or not.  Texts count as UTF-8 bytes, NULL as an empty one;
    strings end where their text ends.  ``kept`` are the bytes left.  ``node`` is a hash of the text, by which
    ``docs`` find it (``text_node``); texts that are not returned lose nothing.  A text that stands in
    several rows goes whole, if it has ``length`` bytes.

    Shuffled are: the cover's places with a few bytes of fingerprint; the starts near a ranked place, with
    64 bits; and each distinct text that has one, once.  Where hashes of these texts measure at most
    ``most_bytes`` they are broadcast, and the other texts stay where they are; beyond, all texts are shuffled
    by that join.  A string that repeats many times in what a task holds is sent twice, so no bucket
    grows with a string's frequency in one text.  A task holds about ``places_held`` places and the texts
    of a batch of rows.  Extra columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    docs = for_tasks(docs).select(text_node().alias("node"), text.cast("binary").alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    period, residues = difference_cover(length)
    n_cover = n_bytes * len(residues) // period
    n_buckets = n_cover // places_per_bucket + 1
    # Wide enough that a chance meeting, which only costs time, is rare for any number of places.
    key_bytes = min(8, max(5, -(-(n_cover.bit_length() + 14) // 8)))
    covering = partial(_cover_places, length=length, n_buckets=n_buckets, key_bytes=key_bytes, held=places_held)
    placed = docs.mapInArrow(covering, PLACED)
    # A task for each bucket, however many there are.
    placed = placed.repartitionById(n_buckets, "bucket").groupBy("bucket")
    ranked = written(placed.applyInArrow(repeated(key_bytes), REPEATED), "ranked")

    n_ranked = ranked.agg(F.sum("n")).first()[0] or 0
    n_buckets = n_ranked * period * 3 // (2 * len(residues)) // places_per_bucket + 1
    ranked = written(by_text(ranked), "ranked-texts")
    wanted = ranked.select("node")
    if wanted.count() * 100 <= most_bytes:
        wanted = F.broadcast(wanted)
    # One exchange of the texts serves both joins.
    texts = docs.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    suspecting = partial(_suspect_places, length=length, n_buckets=n_buckets, held=places_held)
    placed = texts.join(ranked, "node").select("node", "text", "places").mapInArrow(suspecting, PLACED)
    placed = placed.repartitionById(n_buckets, "bucket").groupBy("bucket")
    starts = by_text(placed.applyInArrow(repeated(8), REPEATED))
    left = texts.join(starts, "node").select("node", "text", "places")
    left = left.mapInArrow(partial(_remaining, length=length), REMAINING)

    size = F.octet_length("text").cast("long").alias("n_bytes")
    copied = docs.select("node", size).filter(F.col("n_bytes") >= length)
    copied = copied.groupBy("node", "n_bytes").count().filter("count > 1").select(
        "node",
        "n_bytes",
        F.array(F.lit(0).cast("long")).alias("firsts"),
        F.array("n_bytes").alias("ends"),
        F.lit("").cast("binary").alias("kept"),
    )
    copied = written(copied, "copied")
    return left.join(copied, "node", "left_anti").unionByName(copied)


def by_text(found: DataFrame) -> DataFrame:
    """Per text the lists of its places; a long text was in several hands, or several tasks' ones."""
    rows = found.groupBy("hand").applyInArrow(gathered, GATHERED)
    return rows.groupBy("node").agg(F.collect_list("places").alias("places"))


def text_node() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))
