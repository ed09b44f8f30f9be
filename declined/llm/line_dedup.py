"""Removal of lines that stand on many sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import written


# The white space around a line that does not count.
EDGES = " \t\n\x0b\x0c\r"
BYTES_PER_LINE = 60  # of boilerplate, in memory


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(EDGES))


def hashes(line: Column) -> tuple[Column, Column]:
    """Two hashes of 64 bits that stand for a line."""
    line = trimmed(line)
    return F.xxhash64(line), F.xxhash64(F.lit(1), line)


def word_lines(docs: DataFrame, min_words: int = 1, max_words: int | None = None) -> DataFrame:
    """Per document and distinct line with a word: ``id``, ``site``, ``text_hash``, and ``h1`` and ``h2``, which
    stand for the line.  Lines of less than ``min_words`` words, or of more than ``max_words``, can be left out."""
    lines = F.array_remove(F.array_distinct(F.transform(F.split("text", "\n"), trimmed)), "")
    if min_words > 1 or max_words is not None:
        words = F.lit(r"[^\x20\x09-\x0D]+")
        most = F.lit(1 << 31 if max_words is None else max_words)
        lines = F.filter(lines, lambda x: F.regexp_count(x, words).between(F.lit(min_words), most))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.col("source").cast("string").alias("site"),
        F.xxhash64("text").alias("text_hash"),
        F.explode(lines).alias("line"),
    )
    h1, h2 = hashes(F.col("line"))
    return rows.select("id", "site", "text_hash", h1.alias("h1"), h2.alias("h2"))


def line_spread(lines: DataFrame, precision: int = 12) -> DataFrame:
    """Per line: ``h1``, ``h2``, the estimated number of distinct sites, and ``first_id``, the
    smallest ``doc_id`` that holds it.

    Each task merges its own sketches before the shuffle, so a line that holds a third of
    all lines ships one sketch per task.  A NULL site does not count.
    """
    return lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(precision))).alias("sites"),
        F.min("id").alias("first_id"),
    )


def boilerplate_lines(
    lines: DataFrame, min_sites: int = 8, margin: float = 0.1, precision: int = 12
) -> DataFrame:
    """Of ``word_lines`` those on at least ``min_sites`` distinct sites: ``h1``, ``h2``, ``first_id``.

    The sketches decide where their estimate is further from the threshold than
    ``margin`` (at the default precision six standard errors); for lines nearer to it the
    sites are counted exactly.
    """
    spread = line_spread(lines, precision).filter(F.col("sites") >= min_sites * (1 - margin))
    spread = written(spread, "spread")
    near = F.col("sites") <= min_sites * (1 + margin)
    sure = spread.filter(~near).select("h1", "h2", "first_id")
    unsure = spread.filter(near).select("h1", "h2", "first_id")
    # Distinct pairs before the join: a frequent line then brings one row per site.
    pairs = lines.select("h1", "h2", "site").distinct()
    exact = pairs.join(unsure, ["h1", "h2"]).groupBy("h1", "h2", "first_id")
    exact = exact.agg(F.count("site").alias("sites")).filter(F.col("sites") >= min_sites)
    return sure.unionByName(exact.select("h1", "h2", "first_id"))


def in_buckets(boilerplate: DataFrame, n: int) -> Column:
    """All boilerplate as one value, an array of ``n`` buckets by ``h1``, for looking lines up row by row."""
    line = F.struct("h1", "h2", "first_id")
    full = boilerplate.groupBy(F.pmod("h1", F.lit(n)).alias("bucket")).agg(F.collect_list(line).alias("in_it"))
    every = boilerplate.sparkSession.range(n).join(full, F.col("id") == F.col("bucket"), "left")
    numbered = F.sort_array(F.collect_list(F.struct("id", F.coalesce("in_it", F.array().cast(full.schema["in_it"].dataType)))))
    return every.agg(F.transform(numbered, lambda x: x["col2"])).scalar()


def line_dedup(
    docs: DataFrame,
    min_sites: int = 8,
    min_words: int = 1,
    max_words: int | None = None,
    margin: float = 0.1,
    precision: int = 12,
    report: bool = False,
    most_bytes: int = 32_000_000,
) -> DataFrame:
    """``docs`` without boilerplate: lines that stand on many distinct sites.

    Every line with a word counts, whatever its length, and all by the same number of sites; ``min_words``
    and ``max_words`` leave lines out where that is wanted.  A line is compared without white space
    at its ends.  The document with the smallest ``doc_id`` keeps it, so that no line is lost from the whole; the
    other documents lose it wherever it stands in them, and so do documents without an id.

    Only hashes of lines are shuffled.  Where the boilerplate measures at most ``most_bytes``, each
    document's lines are looked up in it as it is read, and no text moves; beyond, what a document loses is
    joined with it.  All columns stay, extra ones too; ``n_chars``, where it exists, is counted anew in texts
    that lose a line.  A NULL text stays NULL.  Repeated rows are treated alike.  With
    ``report`` the result is ``doc_id``, ``text``, ``n_lines``, ``n_removed`` instead.
    """
    lines = written(word_lines(docs, min_words, max_words), "lines")
    boilerplate = written(boilerplate_lines(lines, min_sites, margin, precision), "boilerplate")
    n = boilerplate.count()
    text, lines_of = F.col("row.text"), F.split("row.text", "\n")
    if 0 < n * BYTES_PER_LINE <= most_bytes:
        rows = docs.select(F.struct("*").alias("row")).select("row", in_buckets(boilerplate, n).alias("buckets"))
        own = F.col("row.doc_id")

        def stays(line: Column) -> Column:
            h1, h2 = hashes(line)
            bucket = F.element_at("buckets", (F.pmod(h1, F.lit(n)) + 1).cast("int"))
            return ~F.exists(
                bucket, lambda x: (x["h1"] == h1) & (x["h2"] == h2) & (own.isNull() | (own != x["first_id"]))
            )

        rows = rows.select("row", F.filter(lines_of, stays).alias("kept"))
    elif n:
        removed = lines.join(boilerplate, ["h1", "h2"]).filter(
            F.col("id").isNull() | (F.col("id") != F.col("first_id"))
        )
        removed = removed.groupBy("id", "text_hash").agg(F.collect_set(F.struct("h1", "h2")).alias("removed"))
        rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("hash"))
        on = (F.col("hash") == F.col("text_hash")) & F.col("row.doc_id").eqNullSafe(F.col("id"))
        rows = rows.join(removed, on, "left").select("row", "removed")
        as_struct = lambda h1, h2: F.struct(h1.alias("h1"), h2.alias("h2"))
        kept = F.filter(lines_of, lambda x: ~F.array_contains(F.col("removed"), as_struct(*hashes(x))))
        rows = rows.select("row", F.when(F.col("removed").isNull(), lines_of).otherwise(kept).alias("kept"))
    else:
        rows = docs.select(F.struct("*").alias("row")).select("row", lines_of.alias("kept"))
    shorter = F.coalesce(F.size("kept") < F.size(lines_of), F.lit(False))
    cut = F.when(shorter, F.array_join("kept", "\n")).otherwise(text)
    if report:
        count = lambda lines: F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")
        return rows.select(
            F.col("row.doc_id"),
            cut.alias("text"),
            count(lines_of).alias("n_lines"),
            (count(lines_of) - count(F.col("kept"))).alias("n_removed"),
        )
    row = F.col("row").withField("text", cut)
    if "n_chars" in docs.columns:
        n_chars = F.length(cut).cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(shorter, n_chars).otherwise(F.col("row.n_chars")))
    return rows.select(row.alias("row")).select("row.*")
