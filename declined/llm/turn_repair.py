"""Cheapest repairs of conversations whose turns are blank, repeated, cut off or out of order.

What a repair costs depends on each row's role and fault alone, sixteen letters.  Conversations are words
of these letters, and Re-Pair replaces pairs that are frequent in them by symbols, round by round, for all
conversations at once.  A symbol stands for a run of rows; its transfer matrix has, for each state
before and after the run, the least cost of edits and the edits themselves, as a rope.  Matrices are put
together in the tropical semiring, those of a rule once, from the bottom up; a conversation's is the
product of those of the few symbols that its word has become.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from declined.llm.common import for_tasks, written
from declined.llm.ordered import in_order

# Roles by their initials, faults in the order in which they count, costs of edits.
ROLES = "uas"  # any other initial is the fourth
FAULTS = ["clean", "blank", "duplicate", "truncated"]
RENAME, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
NAMES = {"u": "user", "a": "assistant"}

# States: nothing yet, a system turn, the user's turn was last, the assistant's was last.
STATES = ["", "s", "u", "a"]
AFTER = {("", "s"): 1, ("", "u"): 2, ("s", "u"): 2, ("a", "u"): 2, ("u", "a"): 3}
AT_END = {0: "", 1: "II", 2: "I", 3: ""}  # what is inserted to end with the assistant

LETTERS = "abcdefghijklmnop"  # one for each fault and role
FIRST_SYMBOL, MOST_RULES = 0xE000, 6000  # rules are characters for private use
HASH_BASE, HASH_PRIME = 0x1F3D5B79A2C4E681, (1 << 61) - 1


class Rope:
    """A text as a tree of parts that ropes share, with a hash that tells equal texts without reading them."""

    __slots__ = ("left", "right", "size", "code")

    def __init__(self, left, right=None):
        self.left, self.right = left, right
        if right is None:
            self.size, self.code = len(left), 0
            for c in left:
                self.code = (self.code * HASH_BASE + ord(c)) % HASH_PRIME
        else:
            self.size = left.size + right.size
            self.code = (left.code * pow(HASH_BASE, right.size, HASH_PRIME) + right.code) % HASH_PRIME

    def __add__(self, other: Rope) -> Rope:
        return Rope(self, other) if self.size and other.size else self if self.size else other

    def __lt__(self, other: Rope) -> bool:
        mine, its = [self], [other]
        while mine and its:
            x, y = mine.pop(), its.pop()
            if x.size == y.size and x.code == y.code:
                continue
            if x.right is None and y.right is None:
                n = min(x.size, y.size)
                if x.left[:n] != y.left[:n]:
                    return x.left < y.left
                for rest, stack in ((x.left[n:], mine), (y.left[n:], its)):
                    if rest:
                        stack.append(Rope(rest))
            elif y.right is None or (x.right is not None and x.size >= y.size):
                mine += [x.right, x.left]
                its.append(y)
            else:
                its += [y.right, y.left]
                mine.append(x)
        return bool(its) and not mine

    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            x = stack.pop()
            if x.right is None:
                parts.append(x.left)
            else:
                stack += [x.right, x.left]
        return "".join(parts)


# A summary: cost and rope of the best edits per state before and after, None where there are none; then what
# is counted: faults, pairs of neighbours that may not be, the first and the last role, rows.
Matrix = list[list[tuple[int, Rope] | None]]
Summary = tuple[Matrix, tuple[int, int, int], int, str, str, int]


def best(candidates: list[tuple[int, Rope]]) -> tuple[int, Rope] | None:
    return min(candidates, default=None)


def together(one: Matrix, two: Matrix) -> Matrix:
    """The min-plus product; of equal costs the edits that come first in ASCII.

    The edits for the same rows end with a row's edit, never with an insertion, so of two of
    equal cost neither begins with the other, and what follows does not change which comes first.
    """
    return [
        [
            best([(x[0] + y[0], x[1] + y[1]) for x, k in zip(row, range(4), strict=True) if x and (y := two[k][j])])
            for j in range(4)
        ]
        for row in one
    ]


def both(one: Summary, two: Summary) -> Summary:
    faults = tuple(x + y for x, y in zip(one[1], two[1], strict=True))
    illegal = one[2] + two[2] + (one[4] + two[3] not in ("su", "ua", "au"))
    return together(one[0], two[0]), faults, illegal, one[3], two[4], one[5] + two[5]


def of_letter(letter: str) -> Summary:
    """One row: insertions before it, then its own edit."""
    fault, role = divmod(LETTERS.index(letter), 4)
    initial = (ROLES + "?")[role]
    late = LEFT_TRUNCATED if FAULTS[fault] == "truncated" else 0
    matrix: Matrix = []
    for start in range(4):
        found: list[list[tuple[int, Rope]]] = [[], [], [], []]
        state, inserted = start, ""
        for _ in range(3):
            paid = INSERT * len(inserted)
            found[state].append((paid + DELETE, Rope(inserted + "D")))
            if FAULTS[fault] in ("clean", "truncated"):
                if (to := AFTER.get((STATES[state], initial))) is not None:
                    found[to].append((paid + late, Rope(inserted + "K")))
                to = AFTER[STATES[state], "a" if STATES[state] == "u" else "u"]
                found[to].append((paid + late + RENAME, Rope(inserted + "R")))
            state, inserted = AFTER[STATES[state], "a" if STATES[state] == "u" else "u"], inserted + "I"
        matrix.append([best(x) for x in found])
    counts = tuple(int(FAULTS[fault] == f) for f in FAULTS[1:])
    return matrix, counts, 0, initial, initial, 1


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and edits from nothing to an end that is allowed."""
    ends = [(x[0] + INSERT * len(AT_END[j]), x[1] + Rope(AT_END[j])) for j, x in enumerate(matrix[0]) if x]
    cost, edits = min(ends)
    return cost, edits.text()


SUMMARY = (
    "costs ARRAY<LONG>, edits ARRAY<STRING>, blank LONG, duplicate LONG, truncated LONG, "
    "illegal LONG, first STRING, last STRING, n LONG"
)
SUMMARY_FIELDS = [c.split()[0] for c in SUMMARY.split(", ")]


def as_row(summary: Summary) -> tuple:
    matrix, faults, illegal, first, last, n = summary
    cells = [x for row in matrix for x in row]
    return [x and x[0] for x in cells], [x and x[1].text() for x in cells], *faults, illegal, first, last, n


def as_summary(row: dict) -> Summary:
    cells = [None if c is None else (c, Rope(e)) for c, e in zip(row["costs"], row["edits"], strict=True)]
    faults = row["blank"], row["duplicate"], row["truncated"]
    return [cells[i : i + 4] for i in range(0, 16, 4)], faults, row["illegal"], row["first"], row["last"], row["n"]


def summary_batch(keys: dict[str, pa.Array], summaries: list[Summary]) -> pa.RecordBatch:
    kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
    rows = list(map(as_row, summaries))
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*keys.values(), *columns], [*keys, *SUMMARY_FIELDS])


def re_pair(words: DataFrame, pairs_a_round: int, most_rounds: int) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``words`` (distinct, in ``word``) with their grammar's symbols in ``short``, and the rules in order.

    Each round counts the pairs of all words and replaces the most frequent ones, until none occurs
    twice.  ``pairs_a_round`` and ``most_rounds`` bound what reaches the driver; where they end it early
    words stay longer, and results the same.
    """
    rules: list[tuple[str, str]] = []
    words = written(words.select("word", F.col("word").alias("short")), "words")
    for _ in range(most_rounds):
        starts = F.sequence(F.lit(1), F.length("short") - 1)
        pairs = words.filter(F.length("short") > 1).select(
            F.explode(F.transform(starts, lambda i: F.substring("short", i, F.lit(2)))).alias("pair")
        )
        left = min(pairs_a_round, MOST_RULES - len(rules))
        top = pairs.groupBy("pair").count().filter("count > 1").orderBy(F.desc("count"), "pair").limit(left)
        fresh = [(r["pair"], chr(FIRST_SYMBOL + len(rules) + k)) for k, r in enumerate(top.collect())]
        if not fresh:
            break
        rules += fresh
        words = written(words.mapInArrow(replacing(fresh), "word STRING, short STRING"), "words")
    return words, rules


def replacing(rules: list[tuple[str, str]]):
    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = "\n".join(batch.column("short").to_pylist())
            for pair, symbol in rules:
                whole = whole.replace(pair, symbol)
            short = whole.split("\n") if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(short, pa.string())], ["word", "short"])

    return replaced


def evaluated(rules: list[tuple[str, str]]) -> dict[str, Summary]:
    """The summary of each symbol, from the bottom up."""
    known = {letter: of_letter(letter) for letter in LETTERS}
    for (x, y), symbol in rules:
        known[symbol] = both(known[x], known[y])
    return known


def product(summaries: list[Summary]) -> Summary:
    whole = summaries[0]
    for s in summaries[1:]:
        whole = both(whole, s)
    return whole


def summing(rules: list[tuple[str, str]]):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = evaluated(rules)
        for batch in batches:
            found = [product([known[c] for c in word]) for word in batch.column("short").to_pylist()]
            yield summary_batch({"word": batch.column("word")}, found)

    return summed


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of summaries as one each."""
    for batch in batches:
        found = [product([as_summary(x) for x in run]) for run in batch.column("run").to_pylist()]
        yield summary_batch({"key": batch.column("key"), "at": batch.column("at")}, found)


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.select(["costs", "edits"]).to_pylist()
        ends = []
        for row in rows:
            cells = [None if c is None else (c, Rope(e)) for c, e in zip(row["costs"], row["edits"], strict=True)]
            ends.append(cheapest([cells[:4]]))
        kept = ["key", "blank", "duplicate", "truncated", "illegal"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array([c for c, _ in ends], pa.int64()), pa.array([e for _, e in ends], pa.string())],
            [*kept, "cost", "audit"],
        )


def key_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


IN_TURN = ["turn", "role", "digest"]


def read_rows(conversations: DataFrame) -> DataFrame:
    """The columns in use; a NULL role or text is one space."""
    blank = F.lit(" ")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return conversations.select(
        key_of(F.col("conv_id")).alias("key"), "turn", role.alias("role"), text.alias("text"), F.md5(text).alias("digest")
    )


def audits(
    conversations: DataFrame, rows_per_word: int = 4096, pairs_a_round: int = 256, most_rounds: int = 12
) -> DataFrame:
    """Per conversation with rows: ``key``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``.

    Rows are taken by turn, NULL first; rows of one turn by role and by the md5 of their text.  A
    conversation of any length is cut into words, whose matrices are put together in runs of 64.
    """
    text = F.col("text")
    rows = read_rows(conversations).select(
        "key",
        *IN_TURN,
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "rows")
    spot = F.struct("turn", "row")
    first = rows.groupBy("key", "role", "digest").agg(F.min(spot).alias("first"))
    known = rows.join(first, ["key", "role", "digest"]).withColumn("again", spot != F.col("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("cut"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "", 3).otherwise(F.least(F.lit(3), (F.instr(F.lit(ROLES), initial) + 3) % 4))
    letter = F.substring(F.lit(LETTERS), fault * 4 + role + 1, F.lit(1))
    placed = in_order(written(known.select("key", *IN_TURN, "row", letter.alias("letter")), "letters"), ["key", *IN_TURN, "row"], "placed")
    own = placed.groupBy("key", "part", F.floor(F.col("at") / rows_per_word).alias("chunk"))
    own = own.agg(F.sort_array(F.collect_list(F.struct("at", "letter"))).alias("letters"))
    word = F.array_join(F.transform("letters", lambda x: x["letter"]), "")
    chunks = written(own.select("key", "part", "chunk", word.alias("word")), "chunks")

    words, rules = re_pair(for_tasks(chunks).select("word").distinct(), pairs_a_round, most_rounds)
    summaries = written(words.mapInArrow(summing(rules), f"word STRING, {SUMMARY}"), "summaries")
    in_key = Window.partitionBy("key").orderBy("part", "chunk")
    placed = chunks.withColumn("at", (F.row_number().over(in_key) - 1).cast("long")).join(summaries, "word")
    found = written(placed.select("key", "at", *SUMMARY_FIELDS), "found")
    while (found.agg(F.max("at")).first()[0] or 0) > 0:
        run = F.sort_array(F.collect_list(F.struct("at", *SUMMARY_FIELDS))).alias("run")
        runs = found.groupBy("key", F.floor(F.col("at") / 64).alias("at")).agg(run)
        found = written(runs.mapInArrow(_joined, f"key STRING, at LONG, {SUMMARY}"), "found")
    return found.mapInArrow(
        _ended, "key STRING, blank LONG, duplicate LONG, truncated LONG, illegal LONG, cost LONG, audit STRING"
    )


def edited(role: str | None, text: str | None, edits: str, last: str) -> tuple[list[tuple[str, str]], str]:
    """The turns that some edits, ending with a row's own or without a row, leave; and the last one's initial."""
    turns = []
    for edit in edits:
        if edit == "D":
            continue
        name = role if edit == "K" else NAMES["a" if last == "u" else "u"]
        turns.append((name, "" if edit == "I" else text))
        last = name[0]
    return turns, last


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Key and turns, some at a time, from each conversation's edits followed by its rows."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("key", "kind", "role", "text")), strict=True))
    for key, own in groupby(rows, lambda row: row[0]):
        edits, at, last = "", 0, ""
        for _, kind, role, text in own:
            if not kind:
                edits = text
                continue
            start = at
            while edits[at] == "I":
                at += 1
            at += 1
            turns, last = edited(role, text, edits[start:at], last)
            yield key, turns
        yield key, edited(None, None, edits[at:], last)[0]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's turns, read one after the other."""
    keys, digests = [], []
    for key, parts in groupby(_repaired(batches), lambda x: x[0]):
        whole, between = hashlib.sha256(), b""
        for _, turns in parts:
            for role, text in turns:
                whole.update(between + f"{role}:{text}".encode())
                between = b"\n"
        keys.append(key)
        digests.append(whole.hexdigest())
        if len(keys) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(digests)], ["key", "sha256"])
            keys, digests = [], []
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "sha256"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, parts in groupby(_repaired(batches), lambda x: x[0]):
        place = 0
        for _, turns in parts:
            if turns:
                columns = [[key] * len(turns), range(place, place + len(turns)), *zip(*turns, strict=True)]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "place", "role", "text"])
                place += len(turns)


def edits_and_rows(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits, then its rows in order, next to each other."""
    none = F.lit(None)
    edits = found.select(
        "key", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), F.col("audit").alias("text"),
    )
    rows = read_rows(conversations).select("key", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "digest", "text")
    return for_tasks(edits.unionByName(rows)).repartition("key").sortWithinPartitions("key", "kind", *IN_TURN)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role`` and ``text``.

    Conversations of which nothing is left have no rows.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    found = written(audits(conversations), "audits")
    turns = edits_and_rows(conversations, found).mapInArrow(_turns, "key STRING, place LONG, role STRING, text STRING")
    ids = conversations.select("conv_id", key_of(F.col("conv_id")).alias("key")).distinct()
    return turns.join(ids, "key").select("conv_id", "place", "role", "text")


def repair_report(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the hash of what they leave, for each ``conv_id`` in ``ids``, a distinct one.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text seen earlier in
    the conversation), truncated (its last other character is none of ``.!?``).  ``illegal`` counts
    neighbours whose roles' initials are none of su, ua, au; ``gaps`` the turns missing between the smallest
    and the largest.  Edits: K keeps a row, R makes it the user's or the assistant's (2), D deletes it (3; a
    must for blank and duplicate rows), I inserts an empty turn of either (2); a truncated row that stays
    costs 1.  What is left is empty, or pairs of user and assistant behind at most one system turn.  ``audit``
    are the cheapest edits, of several the first in ASCII.

    A NULL role or text counts as one space, a NULL turn comes first and is no gap, a NULL id is a
    conversation of its own.  Ids without rows have zeros, no edits and the hash of nothing.  Extra columns are
    ignored.  A long conversation is cut for all but its hash, which is read off its rows in order, as they stream by.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    found = written(audits(conversations), "audits")
    digests = edits_and_rows(conversations, found).mapInArrow(_hashed, "key STRING, sha256 STRING")
    turns = conversations.select(key_of(F.col("conv_id")).alias("key"), "turn").distinct().groupBy("key")
    turns = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    whole = ids.select("conv_id", key_of(F.col("conv_id")).alias("key"))
    for part in (found, digests, turns):
        whole = whole.join(part, "key", "left")
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return whole.select(
        "conv_id",
        *[count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
