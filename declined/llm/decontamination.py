"""Words of training documents that occur as windows of benchmark items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import lower_ascii, written

# What separates words, before and after A-Z are lower-cased.
APART_LOWER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
APART = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def normal_words(text: Column) -> Column:
    """Lower-cased words without punctuation; no words for NULL."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), APART_LOWER), "")


def item_windows(items: DataFrame, width: int = 10) -> DataFrame:
    """The distinct windows of the items: ``gram`` (words), ``k``, ``gram_hash``, ``item``.

    A window is ``width`` consecutive words; an item of fewer, but not none, is one window.
    ``item`` is the item's id as a string; items without an id share the NULL id.
    """
    words = items.select(F.col("item_id").cast("string").alias("item"), normal_words(F.col("text")).alias("w"))
    words = words.filter(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(width)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1))
    grams = words.select("item", "w", "k", at.alias("at")).select(
        "item", "k", F.slice("w", F.col("at"), F.col("k")).alias("gram")
    )
    grams = grams.distinct()
    return grams.withColumn("gram_hash", F.xxhash64(F.transform("gram", lambda w: F.xxhash64(w))))


def document_hits(
    docs: DataFrame, items: DataFrame, width: int = 10, most_bytes: int = 64_000_000
) -> DataFrame:
    """Per distinct ``(doc_id, text)``: words, hit spans and items.

    Returns ``doc_id``, ``text_hash``, ``copies`` (how many rows hold this id and text),
    ``n_words``, ``spans`` (array of ``at``, ``k``: a window of ``k`` words at word ``at``,
    from 0) and ``items`` (the ids of items with an occurring window).

    Every word of every text starts a window.  The windows' hashes are probed in one pass
    against a hash table of the items' windows; that table is broadcast if its measured size
    is at most ``most_bytes``; beyond, Spark chooses the join by its own estimates.  Only
    possible hits and one row per document are shuffled.  The few documents with possible hits are
    read again to verify these on their words.

    A NULL or empty text has no words; without items, or with an empty table, nothing is
    hit.  Columns other than ``doc_id`` and ``text`` are ignored.
    """
    grams = item_windows(items, width)
    facts = grams.agg(
        F.collect_set("k").alias("lengths"),
        F.sum(F.octet_length(F.array_join("gram", " ")) + 200).alias("bytes"),
    ).first()
    if (facts["bytes"] or 0) <= most_bytes:
        grams = F.broadcast(grams)
    grams = grams.withColumnRenamed("k", "gram_k")

    words = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("w")
    )
    hashed = words.select(
        "doc_id", "text_hash", F.size("w").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("h")
    )

    def windows(k: int) -> Column:
        starts = F.when(F.col("n") >= k, F.sequence(F.lit(1), F.col("n") - k + 1))
        hashes = F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.struct(
                (i - 1).alias("at"), F.lit(k).alias("k"), F.xxhash64(F.slice("h", i, k)).alias("hash")
            ),
        )
        return hashes

    # One row per window, and one with place -1 that stands for the document itself.
    document = F.array(
        F.struct(F.lit(-1).alias("at"), F.lit(0).alias("k"), F.lit(None).cast("long").alias("hash"))
    )
    each = F.concat(document, *[windows(k) for k in sorted(facts["lengths"])])
    starts = hashed.select("doc_id", "text_hash", "n", F.inline(each))
    is_document, is_hit = F.col("at") < 0, F.col("gram").isNotNull()
    probed = starts.join(
        grams, (F.col("hash") == F.col("gram_hash")) & (F.col("k") == F.col("gram_k")), "left"
    ).filter(is_document | is_hit)
    possible = probed.groupBy("doc_id", "text_hash").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if(is_document).alias("copies"),
        F.collect_set(F.when(is_hit, F.struct("at", "k", "gram", "item"))).alias("found"),
    )
    possible = written(possible, "possible")

    suspects = possible.filter(F.size("found") > 0)
    suspects = suspects.select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "n_words", "copies", "found"
    )
    on = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    keys = suspects.select("id", "hash")
    if keys.count() * 100 <= most_bytes:
        keys = F.broadcast(keys)  # then no text but theirs is shuffled
    true = F.filter("found", lambda f: F.slice("w", f["at"] + 1, f["k"]) == f["gram"])
    verified = words.join(keys, on, "left_semi").join(suspects, on).select(
        "doc_id", "text_hash", "n_words", "copies", true.alias("found")
    )
    verified = verified.dropDuplicates(["doc_id", "text_hash"])
    item_of = F.transform("found", lambda f: f["item"])
    return (
        possible.filter(F.size("found") == 0)
        .unionByName(verified)
        .select(
            "doc_id",
            "text_hash",
            "copies",
            "n_words",
            F.array_distinct(
                F.transform("found", lambda f: F.struct(f["at"].alias("at"), f["k"].alias("k")))
            ).alias("spans"),
            F.array_distinct(F.filter(item_of, lambda i: i.isNotNull())).alias("items"),
        )
    )


def words_hit(spans: Column) -> Column:
    """Words covered by spans, which may overlap."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(seen: Column, span: Column) -> Column:
        end = F.greatest(seen["end"], span["at"] + span["k"])
        new = end - F.greatest(seen["end"], span["at"])
        return F.struct((seen["n"] + F.greatest(new, F.lit(0))).alias("n"), end.alias("end"))

    return F.aggregate(F.sort_array(spans), zero, add, lambda seen: seen["n"]).cast("long")


def contamination_report(
    docs: DataFrame, items: DataFrame, width: int = 10, most_bytes: int = 64_000_000
) -> DataFrame:
    """One row per document row: its words, those hit, the items, ``contaminated``."""
    hits = document_hits(docs, items, width, most_bytes)
    return hits.select(
        "doc_id",
        "n_words",
        words_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def without_spans(text: Column, spans: Column) -> Column:
    """The text less the words in ``spans`` and what separates them from the word before."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[{APART}]*[^{APART}]+"), F.lit(0))
    covered = F.flatten(
        F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["k"] - 1))
    )
    rest = F.regexp_extract(text, rf"[{APART}]*$", 0)
    kept = F.filter(pieces, lambda p, i: ~F.array_contains(covered, i))
    return F.concat(F.array_join(kept, ""), rest)


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "documents",
    width: int = 10,
    most_bytes: int = 64_000_000,
) -> DataFrame:
    """The documents less those that are contaminated, or less the words that are hit.

    ``remove`` is ``documents`` or ``spans``; spans leave every document, its text cut and,
    where there is such a column, ``n_chars`` counted anew where something went.  All columns stay, extra ones
    too.  A document is matched by its id and text, NULLs included, so that repeated rows
    share a verdict.  The contaminated documents, a small share, are what is joined.
    """
    hits = document_hits(docs, items, width, most_bytes).filter(F.size("spans") > 0)
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "spans"
    )
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("hash"))
    on = (F.col("hash") == F.col("hit_hash")) & F.col("row.doc_id").eqNullSafe(F.col("hit_id"))
    if remove == "documents":
        return rows.join(hits, on, "left_anti").select("row.*")
    if remove != "spans":
        raise ValueError(f"remove must be documents or spans, not {remove}")
    cut = F.when(F.col("hit_hash").isNull(), F.col("row.text")).otherwise(
        without_spans(F.col("row.text"), F.col("spans"))
    )
    cut_rows = rows.join(hits, on, "left").withColumn("row", F.col("row").withField("text", cut))
    if "n_chars" in docs.columns:
        n_chars = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        n_chars = F.when(F.col("hit_hash").isNull(), F.col("row.n_chars")).otherwise(n_chars)
        cut_rows = cut_rows.withColumn("row", F.col("row").withField("n_chars", n_chars))
    return cut_rows.select("row.*")
