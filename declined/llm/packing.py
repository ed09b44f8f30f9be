"""Packing of tokenized documents into sequences of a fixed capacity."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined.llm.common import for_tasks, numbered, written
from declined.llm.tokens import byte_bpe

PIECES = "piece INT, start LONG, length LONG, ids BINARY"
BATCH_BYTES = 16_000_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: full ones, after a shorter first one."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    tokenizer = byte_bpe(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        ids_of, rows, held = batch.column("doc_id"), [], 0
        for i in range(batch.num_rows):
            ids = tokenizer.ids(batch.column("text")[i].as_py()) + end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                rows.append((i, piece, start, length, ids[4 * start : 4 * (start + length)]))
            held += len(ids)
            if held > BATCH_BYTES or i == batch.num_rows - 1:
                at, *columns = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(at, pa.int32())), *arrays],
                    ["doc_id", "piece", "start", "length", "ids"],
                )
                rows, held = [], 0


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Per piece: ``doc_id``, ``piece`` (from 0), ``start``, ``length``, ``ids``.

    A document is its text's ids and then ``end_id``; a NULL or empty text is ``end_id``
    alone.  Only a document longer than ``capacity`` is cut, its first piece taking what
    full ones leave.  ``ids`` are little-endian unsigned 32-bit integers.  Extra columns are
    left out, repeated rows come out repeated.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    cutting = partial(_pieces, path=tokenizer_path, capacity=capacity, end_id=end_id)
    return for_tasks(docs).select("doc_id", "text").mapInArrow(cutting, f"doc_id {doc_type}, {PIECES}")


class _Counts:
    """How many pieces there are of each length, and which lengths fill a gap exactly."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.n[length] = n

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap and self.n[gap] else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """Two lengths that add up to ``gap``, the longer one as long as possible."""
        if gap < 2:
            return None
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        there = (self.n[longer] > 0) & (self.n[gap - longer] > 0)
        there &= (longer != gap - longer) | (self.n[longer] > 1)
        at = np.flatnonzero(there)
        return (int(longer[at[0]]), int(gap - longer[at[0]])) if len(at) else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for longest in range(gap - 2, (gap - 1) // 3, -1):
            if self.n[longest]:
                self.n[longest] -= 1
                two = self.pair(gap - longest)
                self.n[longest] += 1
                if two:
                    return (longest, *two)
        return None

    def take(self, pattern: tuple[int, ...]) -> int:
        """Uses ``pattern`` up as often as its scarcest length allows; how often that was."""
        lengths, uses = np.unique(pattern, return_counts=True)
        times = int((self.n[lengths] // uses).min())
        self.n[lengths] -= uses * times
        return times


def packing_plan(
    counts: Mapping[int, int], capacity: int
) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths that share a sequence, and how many sequences each fills.

    From the longest length down, the gap that a piece leaves is filled exactly by a single
    length, a pair or a triple of which pieces are left, as often as they last.  What finds
    no exact complement is packed best fit: into each gap the longest piece that fits.
    Every pattern uses up one of its lengths, so there are a few thousand for any number
    of pieces.
    """
    left, plan = _Counts(counts, capacity), []
    if left.n[capacity]:
        plan.append(((capacity,), left.take((capacity,))))
    for length in range(capacity - 1, 0, -1):
        while left.n[length]:
            left.n[length] -= 1
            gap = capacity - length
            others = left.single(gap) or left.pair(gap) or left.triple(gap)
            left.n[length] += 1
            if others is None:
                break
            plan.append(((length, *others), left.take((length, *others))))
    for length in range(capacity, 0, -1):
        while left.n[length]:
            pattern, gap = [length], capacity - length
            left.n[length] -= 1
            used = {length: 1}
            at = min(gap, capacity)
            while gap > 0 and at > 0:
                fits = np.flatnonzero(left.n[1 : min(at, gap) + 1])
                if not len(fits):
                    break
                at = int(fits[-1]) + 1
                most = int(min(left.n[at], gap // at))
                pattern += [at] * most
                used[at] = used.get(at, 0) + most
                left.n[at] -= most
                gap -= at * most
            for one, n in used.items():
                left.n[one] += n
            plan.append((tuple(pattern), left.take(tuple(pattern))))
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, ...]]:
    """For runs of equal lengths in a pattern: length, first rank, last rank, sequences, first
    sequence, first offset.  The pieces of a length are dealt to its runs by their rank."""
    rows, rank, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        lengths, at, runs = np.unique(pattern, return_index=True, return_counts=True)
        for i in np.argsort(at):
            length, many = int(lengths[i]), int(runs[i])
            first = rank.get(length, 0)
            rank[length] = first + many * times
            rows.append((length, first, rank[length] - 1, times, sequence, offset))
            offset += many * length
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no two overlap, and none leaves a hole.

    ``pieces`` have ``doc_id``, ``piece`` and a ``length`` of 1 to ``capacity``; other columns
    pass through.  How sequences are put together depends on the number of pieces of each
    length alone: at most ``capacity`` counts reach the driver, and the plan that goes back
    to the tasks is as small, for any number of pieces.  Each piece is numbered among those
    of its length, without a task that sees all of a length, and finds its place by number.
    An empty table gives an empty one.
    """
    pieces = written(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    schema = "of INT, first LONG, last LONG, times LONG, sequence LONG, from_offset LONG"
    places = pieces.sparkSession.createDataFrame(_places(packing_plan(counts, capacity)), schema)
    ranked = numbered(pieces, "length", ["doc_id", "piece"], "rank_in_length")
    placed = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("of")) & F.col("rank_in_length").between(F.col("first"), F.col("last")),
    )
    rank = F.col("rank_in_length") - F.col("first")
    return placed.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (F.col("sequence") + rank % F.col("times")).alias("sequence_id"),
        (F.col("from_offset") + F.floor(rank / F.col("times")).cast("long") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence its ``ids`` in one array, from packed pieces that carry theirs.

    A sequence has at most ``capacity`` tokens, so its group is bounded.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
