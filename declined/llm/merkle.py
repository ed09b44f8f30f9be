"""A manifest of a dataset as Merkle trees, one for each source and one above their roots.

The leaves of a source, in order, are cut into aligned blocks of ``fanout ** levels``.  A block is a
partition of the tree: it hashes its own subtree.  What lies above is found by a butterfly exchange:
in round ``r`` blocks swap the roots of their subtrees with those whose numbers, written to the base
``fanout``, differ in digit ``r`` alone, and each hashes the node above for itself.  After a round
for each level every block holds the root and its siblings on the way there, so nothing has
to be handed down afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import written
from declined.llm.ordered import ranked

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The hash of a document's fields, with ``text`` in place of its own."""
    values = [F.col(c) for c in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(field, values)), 256)


def joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def level_above(hashes: Column, fanout: int) -> Column:
    """The hashes of runs of ``fanout``; the last run may be shorter."""
    firsts = F.sequence(F.lit(1), F.size(hashes), F.lit(fanout))
    return F.transform(firsts, lambda i: F.sha2(joined(F.slice(hashes, i, fanout)), 256))


def siblings(hashes: Column, at: Column, fanout: int) -> Column:
    """The hashes left and right of number ``at`` in its run."""
    first = (at - at % fanout).cast("int")
    at = at.cast("int")
    return F.struct(
        joined(F.slice(hashes, first + 1, at - first)).alias("left"),
        joined(F.slice(hashes, at + 2, first + fanout - 1 - at)).alias("right"),
    )


def no_path() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def climbed(blocks: DataFrame, fanout: int, name: str) -> DataFrame:
    """``key``, ``block``, ``root`` and ``path``: each block's tree root and its siblings below that.

    ``blocks`` have ``key`` (of a tree), ``block`` (from 0), ``blocks`` (of the tree) and ``hash``.  In
    each round a block receives one hash from each of at most ``fanout`` subtrees.  In a last
    subtree, which may have fewer blocks than the others, each block serves several.
    """
    state = blocks.select("key", "block", "blocks", F.col("hash").alias("root"), no_path().alias("path"))
    state = written(state, name)
    most = state.agg(F.max("blocks")).first()[0] or 0
    below = 1  # blocks in a full subtree of this round
    while below < most:
        block, of, width = F.col("block"), F.col("blocks"), F.lit(below)
        own = F.floor(block / below)
        first = own - own % fanout
        last = F.least(first + fanout, F.ceil(of / below)) - 1
        low, size = block % below, F.least(width, of - own * below)
        partners = F.flatten(
            F.transform(
                F.sequence(first, last),
                lambda tree: F.transform(
                    F.filter(F.sequence(low, width - 1, size), lambda x: tree * below + x < of),
                    lambda x: tree * below + x,
                ),
            )
        )
        done, going = state.filter(of <= below), state.filter(of > below)
        sent = going.select(
            "key", "blocks", "block", "root", "path", (own % fanout).alias("digit"), F.explode(partners).alias("to")
        )
        itself = F.col("to") == F.col("block")
        met = sent.groupBy("key", F.col("to").alias("block")).agg(
            F.first("blocks").alias("blocks"),
            F.sort_array(F.collect_list(F.struct("digit", "root"))).alias("run"),
            F.max(F.when(itself, F.struct("digit", "path"))).alias("own"),
        )
        roots = F.transform("run", lambda x: x["root"])
        left = F.filter("run", lambda x: x["digit"] < F.col("own.digit"))
        right = F.filter("run", lambda x: x["digit"] > F.col("own.digit"))
        beside = F.struct(
            joined(F.transform(left, lambda x: x["root"])).alias("left"),
            joined(F.transform(right, lambda x: x["root"])).alias("right"),
        )
        above = met.select(
            "key",
            "block",
            "blocks",
            F.sha2(joined(roots), 256).alias("root"),
            F.concat("own.path", F.array(beside)).alias("path"),
        )
        state = written(above.unionByName(done), name)
        below *= fanout
    return state.drop("blocks")


def manifest(
    leaves: DataFrame, fanout: int = 16, levels: int = 2, most_bytes: int = 32_000_000
) -> DataFrame:
    """Each leaf with its way to the root: all columns of ``leaves``, ``subroot``, ``root`` and ``path``.

    ``leaves`` have ``doc_id``, ``source`` and ``leaf``, and any other columns.  The leaves of a source are
    ordered by id, NULL first, then by hash; while several nodes are left, runs of ``fanout`` become one.
    The last node is the source's ``subroot`` (of one leaf, the leaf); subroots, by the source's bytes, NULL first,
    become ``root`` in the same way.  ``path`` has for each level the siblings' hashes to the left and to the
    right, joined.  Columns of ``leaves`` that are called like these three are replaced.  Repeated rows are
    leaves of their own.  No leaves, no rows.

    Blocks of leaves are all that meets in a task, however many leaves a source has; sources
    may be as many as they like.  The tables that steps read again are written to the shared folder.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    kept = [c for c in leaves.columns if c not in ("subroot", "root", "path")]
    keep = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    rows = leaves.select(
        key.alias("key"), F.col("doc_id").alias("id"), F.col("leaf").alias("hash"), keep,
        F.monotonically_increasing_id().alias("copy"),
    )
    rows = ranked(written(rows, "leaves"), "key", ["id", "hash", "copy"], "order", most_bytes)

    width = fanout**levels
    member = F.struct("n", "hash", "row")
    blocks = rows.groupBy("key", F.floor(F.col("n") / width).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("hashes"),
        F.collect_list(member).alias("members"),
        F.first("of").alias("of"),
    )
    # Levels that a block has of its own; it has fewer than ``levels`` only as the one block of a source.
    tree = [F.transform("hashes", lambda x: x["hash"])]
    steps = []
    for level in range(levels):
        steps.append(F.col("of") > fanout**level)
        tree.append(F.when(steps[-1], level_above(F.col(f"level{level}"), fanout)).otherwise(F.col(f"level{level}")))
    for level, hashes in enumerate(tree):
        blocks = blocks.withColumn(f"level{level}", hashes)
    blocks = written(blocks.drop("hashes"), "blocks")
    tops = blocks.select(
        "key", "block", F.ceil(F.col("of") / width).alias("blocks"), F.col(f"level{levels}")[0].alias("hash")
    )
    tops = climbed(tops, fanout, "tops")

    sources = tops.filter("block = 0").select("key", F.lit("").alias("all"), F.col("root").alias("hash"))
    sources = written(ranked(sources, "all", ["key"], "sources", most_bytes), "sources")
    roots = sources.select(
        F.col("all").alias("key"), F.col("n").alias("block"), F.col("of").alias("blocks"), "hash"
    )
    roots = climbed(roots, fanout, "roots").select(
        F.col("block").alias("n"), "root", F.col("path").alias("root_path")
    )
    of_source = written(sources.select("key", "n").join(roots, "n").drop("n"), "of-source")
    if of_source.count() * 1000 <= most_bytes:
        of_source = F.broadcast(of_source)
    upper = tops.select("key", "block", F.col("root").alias("subroot"), "path").join(of_source, "key")
    upper = upper.select("key", "block", "subroot", "root", F.concat("path", "root_path").alias("upper"))

    def way(n: Column) -> Column:
        """Siblings in the block, by level; ``n`` numbers a leaf of the source."""
        own = n % width
        found = [
            F.when(
                steps[level],
                F.array(siblings(F.col(f"level{level}"), F.floor(own / fanout**level), fanout)),
            ).otherwise(no_path())
            for level in range(levels)
        ]
        return F.concat(*found, F.col("upper"))

    ways = F.transform("members", lambda m: F.struct(m["row"].alias("row"), way(m["n"]).alias("path")))
    found = blocks.join(upper, ["key", "block"]).select("subroot", "root", F.explode(ways).alias("found"))
    return found.select("found.row.*", "subroot", "root", "found.path")


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the hashes beside its way lead to."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof(path: Column) -> Column:
    """One hash of all siblings on the way, in order."""
    return F.sha2(joined(F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)
