"""Documents whose sets of word shingles are alike, by parity sketches.

The sketch of a set has one place for each of some blocks: the exclusive or of the hashes
of the elements that fall into the block.  An element that only one of two sets has changes
one place at most, so two sets of which ``d`` elements are not common differ in at most
``d`` places.  By pigeonhole, any ``d + 1`` places that one of them fills hold a place in which
the two agree.  Sets are sketched per band of sizes, since sizes limit ``d``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from declined.llm.common import for_tasks, texts_of, written
from declined.llm.components import components
from declined.llm.shingles import STEP, mixed, packed, shingle_hashes, unpacked, word_hashes

# Links: LINK_OF * common >= LINK * union, and so sizes a <= b with LINK * b <= LINK_OF * a.
LINK, LINK_OF = 75, 100
SIGNATURES_HELD = 1_500_000  # by a task before it passes them on
BYTES_PER_NODE = 100  # of a broadcast hash table of nodes
MEMBERS_A_ROW = 1000  # of a meeting
BLOCK, BLOCK_ELEMENTS = 500, 1_000_000  # members of a group, and of their sets, that are compared at a time
PAIRS_A_MEMBER = 2  # of two blocks that become rows, at most


# Where bands of sizes start; neighbours differ by a third, so that links stay in a band or cross
# into the next.
STARTS = [1]
while STARTS[-1] < 1 << 40:
    STARTS.append(-(-STARTS[-1] * LINK_OF // LINK))
BAND_KEYS = mixed(np.arange(1, len(STARTS) + 1, dtype=np.uint64) * STEP)


def band_of(size: int) -> int:
    return bisect_right(STARTS, size) - 1


def most_apart(one: int, other: int) -> int:
    """Elements that linked sets of these sizes have not in common, at most."""
    return (LINK_OF - LINK) * (one + other) // (LINK_OF + LINK)


def filled_places(
    elements: np.ndarray, n_blocks: int, common: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The places of a sketch that hold an element, and how soon each is to be used.

    With few elements each has a block of its own.  Places are used in one order for all
    sets: first those that a sample of the corpus does not show to be frequent, of these the
    ones made of several elements; then by frequency.  Any order finds all links; this
    one meets few others.
    """
    order = np.argsort(block := elements if not n_blocks else elements % np.uint64(n_blocks))
    block, elements = block[order], elements[order]
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    many = np.diff(np.append(first, len(block)))
    place = mixed(np.bitwise_xor.reduceat(elements, first) + block[first] * STEP)
    if len(common):
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        seen = np.where(common[at] == elements, counts[at], 0)
        level = np.minimum.reduceat(seen, first)
    else:
        level = np.zeros(len(first), np.int64)
    rank = np.minimum(2 * level + (many == 1), 65535).astype(np.uint64)
    return place, (rank << np.uint64(48)) | (place >> np.uint64(16))


def signatures(
    elements: np.ndarray, common: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """What a set is joined on: places of its sketch for its band, and for the one below.

    Sets of bands ``k`` and ``k + 1`` meet in the sketches for band ``k``, those of one band in
    their own.  The number of blocks is three quarters of the band's end, which fills more
    places than may differ; sets of under 48 elements have a block for each element, where
    this is so by count.
    """
    size = len(elements)
    own = band_of(size)
    found = []
    for band in {own, max(own - 1, 0)}:
        end = STARTS[band + 1] - 1
        # The largest partner that is joined here, for which the bound is highest.
        partner = size * LINK_OF // LINK if band == own else end
        apart = most_apart(size, partner)
        n_blocks = 0 if end < 48 else end * 3 // 4
        place, rank = filled_places(elements, n_blocks, common, counts)
        use = min(apart + 1, len(place))
        if use < len(place):
            place = place[np.argpartition(rank, use - 1)[:use]]
        found.append(mixed(place ^ BAND_KEYS[band]))
    return np.concatenate(found)


def parity_bits(elements: np.ndarray) -> bytes:
    """The sketch of a set in bits, of which there are four to eight for each element.

    The number is a power of two, so that a longer sketch folds to the length of a shorter one.
    """
    n_bits = max(64, 1 << (4 * len(elements) - 1).bit_length())
    places = (elements >> np.uint64(8)) & np.uint64(n_bits - 1)
    odd = np.bincount(places.astype(np.int64), minlength=n_bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, n_bytes: int) -> np.ndarray:
    """Sketches, in rows, of ``n_bytes`` each: halves are put together by exclusive or."""
    while bits.shape[-1] > n_bytes:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text)))


SKETCHED = """doc_id LONG, text_hash LONG, n_shingles LONG, node LONG, bits BINARY,
              bucket INT, n INT, nodes BINARY, places BINARY, refs BINARY"""


def _sketched(
    batches: Iterator[pa.RecordBatch], common: np.ndarray, counts: np.ndarray, n_buckets: int
) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each bucket of what a task holds."""
    known: dict[int, int] = {}
    nodes, places, refs, held = [], [], [], 0

    def passed_on() -> pa.RecordBatch:
        place, ref, node = np.concatenate(places), np.concatenate(refs), np.array(nodes, np.int64)
        bucket, low = (place >> np.uint64(32)) % np.uint64(n_buckets), place & np.uint64(0xFFFFFFFF)
        # Rising places need few bytes, as differences.
        order = np.argsort((bucket << np.uint64(32)) | low)
        low, ref, bucket = low[order].astype(np.int64), ref[order], bucket[order]
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        rows = []
        for start, end in zip(first, np.append(first[1:], len(bucket)), strict=True):
            used, own = np.unique(ref[start:end], return_inverse=True)
            steps = np.diff(low[start:end], prepend=0)
            rows.append((int(bucket[start]), int(end - start), node[used].tobytes(), packed(steps), packed(own)))
        return sketch_batch([], [], [], [], [], rows)

    def sketch_batch(ids, hashes, sizes, keys, bits, rows) -> pa.RecordBatch:
        n, m = len(ids), len(rows)
        own = lambda values, kind: pa.array([*values, *[None] * m], kind)
        of = lambda k, kind: pa.array([*[None] * n, *[r[k] for r in rows]], kind)
        return pa.RecordBatch.from_arrays(
            [own(ids, pa.int64()), own(hashes, pa.int64()), own(sizes, pa.int64()), own(keys, pa.int64()), own(bits, pa.binary()),
             of(0, pa.int32()), of(1, pa.int32()), *[of(k, pa.binary()) for k in (2, 3, 4)]],
            ["doc_id", "text_hash", "n_shingles", "node", "bits", "bucket", "n", "nodes", "places", "refs"],
        )

    for batch in batches:
        ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
        sizes, keys, bits = [], [], []
        for text in batch.column("text"):
            elements = shingle_set(text.as_py())
            sizes.append(len(elements))
            if not len(elements):
                keys.append(None)
                bits.append(None)
                continue
            key = xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)
            keys.append(key)
            bits.append(parity_bits(elements))
            if key not in known:
                known[key] = len(nodes)
                nodes.append(key)
                places.append(signatures(elements, common, counts))
                refs.append(np.full(len(places[-1]), known[key], np.uint32))
                held += len(places[-1])
            if held > SIGNATURES_HELD:
                yield passed_on()
                known.clear()
                nodes, places, refs, held = [], [], [], 0
        yield sketch_batch(ids, hashes, sizes, keys, bits, [])
    if held:
        yield passed_on()


def _meetings(rows: pd.DataFrame) -> pd.DataFrame:
    """Sets of nodes that agree in a place of the sketch, each set once for a bucket, in rows of some members."""
    node, place = [], []
    for row in rows.itertuples():
        node.append(np.frombuffer(row.nodes, np.int64)[unpacked(row.refs, row.n)])
        place.append(np.cumsum(unpacked(row.places, row.n), dtype=np.uint32))
    node, place = np.concatenate(node), np.concatenate(place)
    order = np.lexsort((node, place))
    node, place = node[order], place[order]
    fresh = np.concatenate(([True], (place[1:] != place[:-1]) | (node[1:] != node[:-1])))
    node, place = node[fresh], place[fresh]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    end = np.append(first[1:], len(place))
    found = {}
    for a, b in zip(first[end - first > 1], end[end - first > 1], strict=True):
        found.setdefault(xxhash.xxh3_64_intdigest(node[a:b].tobytes()) - (1 << 63), node[a:b])
    parts = [
        (meeting, k, len(members), members[k : k + MEMBERS_A_ROW].tolist())
        for meeting, members in found.items()
        for k in range(0, len(members), MEMBERS_A_ROW)
    ]
    meeting, first, n, members = zip(*parts, strict=True) if parts else ((),) * 4
    longs = {"meeting": meeting, "first": first, "n": n}
    columns = {c: pd.Series(values, dtype=np.int64) for c, values in longs.items()}
    return pd.DataFrame(columns | {"members": pd.Series(members, dtype=object)})


def _near_hubs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of pairs with sizes and sketches those whose sketches are near enough for a link."""
    for rows in batches:
        near = []
        for m, n, x, y in zip(rows["size_a"], rows["size_b"], rows["bits_a"], rows["bits_b"], strict=True):
            one, two = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            width = min(len(one), len(two))
            apart = np.bitwise_count(folded(one, width) ^ folded(two, width)).sum(dtype=np.int64)
            near.append(apart <= most_apart(m, n))
        yield rows.loc[np.array(near, bool), ["a", "b"]]


class Parted:
    """Which nodes are known to be linked, by way of others."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (y := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(y, y)
        return x

    def put_together(self, x: int, y: int) -> None:
        self.above[self.top(x)] = self.top(y)


def _by_width(block: pa.StructArray, if_asking: bool) -> dict[int, dict[str, np.ndarray]]:
    """The members of one block, all or those that ask, by the width of their sketches."""
    bits = block.field("bits").to_pylist()
    width = np.array([len(x) for x in bits], np.int64)
    if if_asking:
        width *= block.field("asks").to_numpy(zero_copy_only=False)
    found = {}
    for one in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == one)
        fields = {c: block.field(c).to_numpy(zero_copy_only=False)[own] for c in ("node", "root", "hub", "size", "asks")}
        fields["bits"] = np.frombuffer(b"".join(bits[i] for i in own), np.uint8).reshape(len(own), one)
        found[one] = fields | {"row": own}
    return found


def _possible_pairs(sides: list[pa.StructArray], blocks: tuple[int, int], other_hubs: bool) -> list[tuple[int, int, int]]:
    """Pairs of two blocks whose sketches are near enough for a link: how far apart, and the rows.

    One side asks, the other is asked; if both ask each other, the pair is looked at once.
    """
    asking, asked = _by_width(sides[0], True), _by_width(sides[1], False)
    pairs = []
    for width, these in asking.items():
        for i in range(len(these["node"])):
            for other_width, those in asked.items():
                least = min(width, other_width)
                apart = folded(those["bits"], least) ^ folded(these["bits"][i], least)
                apart = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
                most = (LINK_OF - LINK) * (those["size"] + these["size"][i]) // (LINK_OF + LINK)
                fits = (apart <= most) & (those["root"] != these["root"][i])
                if other_hubs:
                    fits &= those["hub"] != these["hub"][i]
                if blocks[0] > blocks[1]:
                    fits &= ~those["asks"]
                elif blocks[0] == blocks[1]:
                    fits &= ~those["asks"] | (those["node"] > these["node"][i])
                found = np.flatnonzero(fits)
                pairs += zip(apart[found].tolist(), [these["row"][i]] * len(found), those["row"][found].tolist())
    return pairs


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[int, int], list[pa.StructArray]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            group, *blocks = (batch.column(c)[row].as_py() for c in ("group", "block", "other_block"))
            asking, asked = (batch.column(c).slice(row, 1) for c in ("asking", "asked"))
            yield group, tuple(blocks), [(asked if asking.null_count else asking).flatten(), asked.flatten()]


def _possible(batches: Iterator[pa.RecordBatch], other_hubs: bool) -> Iterator[pa.RecordBatch]:
    """Possible pairs of blocks that have few for their members; of the others, the blocks."""
    for group, blocks, sides in _blocks_of(batches):
        pairs = _possible_pairs(sides, blocks, other_hubs)
        nodes = [side.field("node").to_numpy() for side in sides]
        if len(pairs) > PAIRS_A_MEMBER * sum(map(len, nodes)):
            rows = [(None, None, group, *blocks)]
        else:
            rows = [(min(x, y), max(x, y), None, None, None) for x, y in ((nodes[0][i], nodes[1][j]) for _, i, j in pairs)]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "group", "block", "other_block"])


def _forest(batches: Iterator[pa.RecordBatch], other_hubs: bool) -> Iterator[pa.RecordBatch]:
    """Links that join components within two blocks, as few as do.

    The nearest pairs come first; those that are by then linked through others are passed over, and the
    sets of the others are compared.
    """
    for _, blocks, sides in _blocks_of(batches):
        sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in side.field("elements")] for side in sides]
        nodes, roots = ([x.field(c).to_pylist() for x in sides] for c in ("node", "root"))
        linked, links = Parted(), []
        for _, i, j in sorted(_possible_pairs(sides, blocks, other_hubs)):
            if linked.top(roots[0][i]) == linked.top(roots[1][j]):
                continue
            one, two = sets[0][i], sets[1][j]
            common = len(np.intersect1d(one, two, assume_unique=True))
            if common * LINK_OF >= (len(one) + len(two) - common) * LINK:
                linked.put_together(roots[0][i], roots[1][j])
                links.append(sorted((nodes[0][i], nodes[1][j])))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        elements = [shingle_set(text.as_py()).tobytes() for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(elements, pa.binary())], ["node", "elements"])


def block_pairs(members: DataFrame, *columns: str) -> DataFrame:
    """Per group and two of its blocks the members of the one that ask, and all of the other.

    Most groups have one block, which meets itself; there ``asking`` is NULL.
    """
    member = F.struct("node", "root", "hub", "size", "bits", "asks", *columns)
    gathered = members.groupBy("group", "block", "blocks").agg(F.collect_list(member).alias("asked"))
    itself = F.lit(None).cast(gathered.schema["asked"].dataType).alias("asking")
    alone = gathered.filter("blocks = 1").select("group", "block", itself, F.col("block").alias("other_block"), "asked")
    several = members.filter("blocks > 1")
    whole = several.groupBy("group", F.col("block").alias("other_block")).agg(F.collect_list(member).alias("asked"))
    asking = several.filter("asks").groupBy("group", "block").agg(F.collect_list(member).alias("asking"))
    return alone.unionByName(asking.join(whole, "group"))


def pairs_within(
    groups: DataFrame, nodes: DataFrame, texts: DataFrame, other_hubs: bool, most_bytes: int
) -> tuple[DataFrame, DataFrame | None]:
    """Pairs ``a`` and ``b`` of a group that may link and are to be verified, and links that are.

    ``groups`` have ``group``, ``node``, ``root``, ``hub`` and ``asks``; nodes that ask are compared with all others
    of another root.  A group is cut into blocks that meet two by two, so none is gathered in one place.
    Pairs become rows only where sketches leave few of them for the members of two blocks; other blocks
    bring their members' sets along, and give links alone, as many as join components.
    """
    members = groups.join(nodes.select("node", "size"), "node")
    sizes = members.groupBy("group").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_ELEMENTS)).alias("blocks")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    members = members.join(sizes, "group").withColumn("block", block).join(nodes.select("node", "bits"), "node")
    members = written(members, "compared")
    kinds = "a LONG, b LONG, group LONG, block LONG, other_block LONG"
    possible = block_pairs(members).mapInArrow(partial(_possible, other_hubs=other_hubs), kinds)
    possible = written(possible, "possible")
    sparse = possible.filter("a IS NOT NULL").select("a", "b")
    dense = possible.filter("a IS NULL").select("group", "block", "other_block")
    if dense.isEmpty():
        return sparse, None
    wanted = dense.select("group", "block").unionByName(dense.select("group", F.col("other_block").alias("block")))
    members = members.join(wanted.distinct(), ["group", "block"])
    sets = texts_of(texts, members.select("node").distinct(), most_bytes).mapInArrow(_sets, "node LONG, elements BINARY")
    pairs = block_pairs(members.join(sets, "node"), "elements").join(dense, ["group", "block", "other_block"])
    return sparse, written(pairs.mapInArrow(partial(_forest, other_hubs=other_hubs), "a LONG, b LONG"), "forest")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a`` and ``b`` whose texts link."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)
    return written(pairs.mapInPandas(_linking, "a LONG, b LONG"), "links")


def _linking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of pairs with texts those that link."""
    kept: dict[int, np.ndarray] = {}

    def set_of(node: int, text: str) -> np.ndarray:
        if node not in kept:
            if len(kept) > 500:
                kept.clear()
            kept[node] = shingle_set(text)
        return kept[node]

    for rows in batches:
        links = []
        for a, b, x, y in zip(rows["a"], rows["b"], rows["text_a"], rows["text_b"], strict=True):
            one, two = set_of(a, x), set_of(b, y)
            both = len(np.intersect1d(one, two, assume_unique=True))
            links.append(both * LINK_OF >= (len(one) + len(two) - both) * LINK)
        yield rows.loc[np.array(links, bool), ["a", "b"]]


def frequent_shingles(
    docs: DataFrame, rows: int, sample_rows: int = 4000, at_least: int = 4, most: int = 20_000
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, of shingles that several documents of a sample have, and how many.

    At most ``sample_rows`` documents, about, are looked at, and ``most`` hashes reach the
    driver.  They decide in which order places of a sketch are used, never which links
    are found.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                h = shingle_set(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h)], ["h"])

    sample = for_tasks(docs).select("text").sample(min(1.0, sample_rows / max(rows, 1)), seed=1)
    counted = sample.mapInArrow(hashes, "h LONG").groupBy("h").count().filter(f"count >= {at_least}")
    top = counted.orderBy(F.desc("count"), "h").limit(most).collect()
    common = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    counts = np.array([r["count"] for r in top], np.int64)
    order = np.argsort(common)
    return common[order], counts[order]


def near_duplicates(
    docs: DataFrame, signatures_per_bucket: int = 2_000_000, most_bytes: int = 32_000_000
) -> DataFrame:
    """Per document row: ``doc_id``, ``n_shingles``, ``component_id``, ``text_hash``, ``root``.

    A document's set holds its distinct shingles of five words; with fewer words, all of them
    are the one shingle; without words or text the set is empty and linked with nothing.  Two documents
    link where three quarters of the union of their sets are common.  ``component_id`` is
    the smallest ``doc_id`` that links lead to; ``root`` names the component, NULL for an empty set.

    Documents with equal sets are one node.  Nodes that agree in a place of their sketches meet
    in a bucket; the number of buckets grows with the corpus, and a meeting of the same nodes
    counts once.  Every node is first compared with its hub, of those it meets the one that meets
    the most, which finds the components of groups of copies in one comparison for each member.
    Nodes that are not linked with their hub are then compared with all others of that hub, and
    nodes of different hubs and components that meet with each other, block by block, so that no link between
    components is lost.  A comparison looks at sketches of some bits for each
    element first, which tell most texts that are not alike apart, and is then exact, on whole texts.  Of two
    blocks only links come out, and of these as many as it takes to join their components.

    NULL in other columns does not matter, extra columns are ignored, repeated rows come
    out repeated.  Documents without an id take part; ids are compared without them.
    """
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_buckets = max(1, (facts["bytes"] or 0) // 9 // signatures_per_bucket + 1)
    common, counts = frequent_shingles(docs, facts["n"])
    sketching = partial(_sketched, common=common, counts=counts, n_buckets=n_buckets)
    docs = for_tasks(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sketched = written(sketched.mapInArrow(sketching, SKETCHED), "sketches")
    rows = sketched.filter("bucket IS NULL").select(
        "doc_id", "text_hash", "n_shingles", "node", "bits"
    )

    blobs = sketched.filter("bucket IS NOT NULL").select("bucket", "n", "nodes", "places", "refs")
    # A task for each bucket, however many there are.
    meetings = blobs.repartitionById(n_buckets, "bucket").groupBy("bucket").applyInPandas(_meetings, "meeting LONG, first LONG, n LONG, members ARRAY<LONG>")
    meetings = written(meetings.dropDuplicates(["meeting", "first"]), "meetings")
    roots = _linked(docs, rows, meetings, most_bytes)

    placed = rows.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    placed = written(placed.select("doc_id", "text_hash", "n_shingles", F.coalesce("root", "node").alias("root")), "placed")
    least = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    least = written(least.withColumnRenamed("root", "of"), "least")
    return placed.join(least, F.col("root") == F.col("of"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        "text_hash",
        "root",
    )


def one_of_each(docs: DataFrame, most_bytes: int = 32_000_000) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id, NULL last.

    Documents without words stay.  All columns stay, extra ones too.  Of rows that agree in
    the smallest id, the one with the smallest hash of its text stays, and of repeated rows
    one.  What goes is known by id and text; it is broadcast where it measures at most
    ``most_bytes``, so that no text is shuffled, and joined beyond.
    """
    found = written(near_duplicates(docs).filter("root IS NOT NULL"), "found")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    firsts = written(found.groupBy("root").agg(F.min(rank).alias("first")), "firsts")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    ranked = rows.join(firsts, "root").withColumn("stays", rank == F.col("first"))
    keys = [F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")]
    gone = written(ranked.filter(~F.col("stays")).select(*keys).distinct(), "gone")
    several = written(ranked.filter("stays AND copies > 1").select(*keys), "several")

    def by_size(keyed: DataFrame) -> DataFrame:
        return F.broadcast(keyed) if keyed.count() * BYTES_PER_NODE <= most_bytes else keyed

    on = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash"))
    left = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("own_hash"))
    left = left.join(by_size(gone), on, "left_anti")
    if several.isEmpty():
        return left.select("row.*")
    several = by_size(several)
    once = left.join(several, on, "left_semi").withColumn("own_id", F.col("row.doc_id"))
    once = once.dropDuplicates(["own_id", "own_hash"]).drop("own_id")
    return left.join(several, on, "left_anti").unionByName(once).select("row.*")


def _linked(docs: DataFrame, rows: DataFrame, meetings: DataFrame, most_bytes: int) -> DataFrame:
    """``node`` and ``root`` of the nodes that links join, from who meets whom."""
    met = meetings.select("meeting", F.explode("members").alias("node"), "n")
    weight = met.groupBy("node").agg(F.sum("n").alias("weight"))
    met = met.join(weight, "node")
    met = written(met.select("meeting", "node", F.struct("weight", "node").alias("rank")), "met")
    # One row for each node, with the text of its first document by hash and id.
    nodes = rows.groupBy("node").agg(
        F.min(F.struct("text_hash", "doc_id")).alias("first"),
        F.min(F.struct("n_shingles", "bits")).alias("set"),
    )
    nodes = nodes.join(met.select("node").distinct(), "node").select(
        "node",
        F.col("set.n_shingles").alias("size"),
        F.col("set.bits").alias("bits"),
        F.col("first.text_hash").alias("hash"),
        F.col("first.doc_id").alias("id"),
    )
    nodes = written(nodes, "nodes")
    wanted = nodes.select("node", "hash", "id")
    if wanted.count() * BYTES_PER_NODE <= most_bytes:
        wanted = F.broadcast(wanted)  # else the documents are shuffled as well
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
        wanted, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))
    )
    texts = texts.select("node", "text")
    if not rows.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["node"])  # else each node has one row, that of its first document
    texts = written(texts, "texts")

    def side(table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def links(pairs: DataFrame) -> DataFrame:
        sketched = pairs.join(side(nodes, "a", "size", "bits"), "a").join(side(nodes, "b", "size", "bits"), "b")
        return verified(sketched.mapInPandas(_near_hubs, "a LONG, b LONG"), texts)

    # 1. Each node with its hub.  A node that meets no larger one is its own hub.
    hubs = met.join(met.groupBy("meeting").agg(F.max("rank").alias("hub")), "meeting")
    hubs = hubs.groupBy("node").agg(F.max("hub").alias("hub"))
    hubs = written(hubs.select("node", F.col("hub.node").alias("hub")), "hubs")
    to_hubs = hubs.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    done = links(to_hubs)
    roots = components(done)

    # 2. Nodes that are not linked with their hub, strays, with all others of that hub.
    of_hub = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    members = hubs.filter("node <> hub").join(roots, "node", "left").join(of_hub, "hub", "left")
    root = F.coalesce("root", "node")
    members = members.select(
        F.col("hub").alias("group"),
        "node",
        root.alias("root"),
        "hub",
        (root != F.coalesce("hub_root", "hub")).alias("asks"),
    )
    members = written(members, "members")
    with_strays = members.filter("asks").select("group").distinct()
    near = pairs_within(members.join(with_strays, "group"), nodes, texts, False, most_bytes)

    # 3. Nodes of different hubs and components that meet.
    placed = met.join(roots, "node", "left").join(hubs, "node").select(
        F.col("meeting").alias("group"), "node", root.alias("root"), "hub", F.lit(True).alias("asks")
    )
    several = placed.groupBy("group").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min("hub").alias("one"), F.max("hub").alias("other")
    )
    several = several.filter("low < high AND one < other").select("group")
    across = pairs_within(written(placed.join(several, "group"), "open"), nodes, texts, True, most_bytes)
    pairs = written(near[0].unionByName(across[0]).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = [done, verified(pairs, texts_of(texts, wanted, most_bytes))]
    return components(reduce(DataFrame.unionByName, [*found, *[x for _, x in (near, across) if x is not None]]))
