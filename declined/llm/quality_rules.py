"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import BLANK, blank_words, written


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``rejects`` is true; NULL rejects nothing."""

    name: str
    rejects: Column


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.size(F.split(text, BLANK)) + 1).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    )
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more, the first included.

    If the windows' hashes are not all distinct, they are sorted together with their places;
    equal neighbours are the repeated windows.  In order of their places each covers
    ``width`` words, or as many as there are up to the next one.  ``n log n`` steps for a
    text of ``n`` words.
    """
    n = F.size(words) - F.lit(width - 1)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def hashes(h: Column) -> Column:
        return F.transform(
            places, lambda i: F.xxhash64(*[F.get(h, i + F.lit(k - 1)) for k in range(width)])
        )

    def repeated(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, k: (F.get(s, k - 1).getField("h") == x["h"])
            | (F.get(s, k + 1).getField("h") == x["h"]),
        )
        return F.sort_array(F.transform(same, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(
            at, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - x, F.lit(width)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(v: Column) -> Column:
        placed = F.transform(v, lambda x, k: F.struct(x.alias("h"), k.alias("at")))
        found = let(F.sort_array(placed), lambda s: let(repeated(s), covered))
        return F.when(F.size(F.array_distinct(v)) < F.size(v), found).otherwise(F.lit(0).cast("long"))

    return let(hashed, lambda h: let(hashes(h), count))


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, whatever the optimizer collapses."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), F.lit(0))


def measures(text: str = "text") -> dict[str, Column]:
    """What the rules look at, by name, as expressions on the text column."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(blank_words(t)).cast("long"),
        "word_chars": word_chars(t),
        "n_symbols": n_symbols(t),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": n_dup_lines(t),
        "n_repeat_words": let(blank_words(t), n_repeat_words),
        "n_capitals": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
    }


def default_rules(m: Mapping[str, Column] | None = None) -> list[Rule]:
    """Rules on ``measures``.  Their limits are fixed values, set with room for clean prose."""
    m = measures() if m is None else m
    return [
        Rule("few_words", m["n_words"] < 50),
        Rule("repeated_windows", m["n_repeat_words"] * 100 > m["n_words"] * 50),
        Rule("symbols", m["n_symbols"] * 10 > m["n_words"] * 3),
        Rule("repeated_lines", m["n_dup_lines"] * 2 > m["n_lines"]),
        Rule(
            "word_length",
            (m["word_chars"] < m["n_words"] * 2) | (m["word_chars"] > m["n_words"] * 15),
        ),
        Rule("shouting", m["n_capitals"] * 2 > m["word_chars"]),
    ]


def cascade_order(
    docs: DataFrame,
    rules: Sequence[Rule],
    sample_rows: int = 256,
    most_bytes: int = 1_000_000,
    repeats: int = 20,
) -> list[Rule]:
    """``rules`` by falling rejections per second, as estimated on a sample.

    The sample is random, of about ``sample_rows`` documents of at most ``most_bytes`` bytes, written to the
    shared folder; no text reaches the driver.  It decides the order alone, never a verdict: a document is
    kept if no rule rejects it, in any order.  Each rule is timed on ``repeats`` copies of the sample, less the
    time of a rule that does nothing.  The next rule is always the one that rejects most per second of
    what those before it leave.  Without a sample the order stays as given.
    """
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = written(docs.select("text").filter(short).sample(share, seed=1), "quality-sample")
    verdicts = F.array(*[F.coalesce(rule.rejects, F.lit(False)) for rule in rules])
    alike = sample.groupBy(verdicts.alias("verdicts")).count().collect()  # at most one row a document
    if not alike:
        return list(rules)
    copies = sample.coalesce(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def seconds(rejects: Column) -> float:
        counting = copies.agg(F.count_if(F.coalesce(rejects, F.lit(False))))
        counting.collect()
        start = time.perf_counter()
        counting.collect()
        return time.perf_counter() - start

    idle = seconds(F.octet_length("text") < 0)
    costs = [max(seconds(rule.rejects) - idle, 1e-4) for rule in rules]
    order, left = [], list(range(len(rules)))
    while left:
        rejected = {k: sum(r["count"] for r in alike if r["verdicts"][k]) for k in left}
        best = min(left, key=lambda k: (-rejected[k] / costs[k], rules[k].name))
        order.append(rules[best])
        left.remove(best)
        alike = [r for r in alike if not r["verdicts"][best]]
    return order


def first_rejection(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, else NULL; later rules are then not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def keep_quality(
    docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 256
) -> DataFrame:
    """The documents that no rule rejects, with their columns as they are.

    A row at a time, without a shuffle: repeated rows get the same verdict each, extra
    columns pass through, NULL columns other than the text do not matter.  A NULL or empty
    text has no words and is rejected.  An empty table gives an empty table.
    """
    rules = default_rules() if rules is None else rules
    verdict = first_rejection(cascade_order(docs, rules, sample_rows))
    return docs.filter(verdict.isNull())


# Measures that the report returns for every document; the others are taken where the cascade asks for them.
REPORTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_report(docs: DataFrame, sample_rows: int = 256) -> DataFrame:
    """Per row: ``doc_id``, the text's counts, ``base_failed``, ``kept``.

    The counts are returned, so each is computed once, from words that are split once.  Where the base limits
    hold, the cascade decides: it looks at the counts first computed, and takes any other measure of the text only
    when no rule before has rejected it.  Repeated rows come out repeated, a NULL text counts as
    one without words, extra columns are left out.
    """
    order = [r.name for r in cascade_order(docs, default_rules(), sample_rows)]
    text, words = F.col("text"), F.col("words")
    split = docs.select("doc_id", "text", blank_words(text).alias("words"))
    of_words = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_repeat_words": n_repeat_words(words),
    }
    found = measures() | of_words
    counts = split.select("doc_id", "text", *[found[name].alias(name) for name in REPORTED])
    rules = {r.name: r for r in default_rules(measures() | {name: F.col(name) for name in REPORTED})}
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    verdict = first_rejection([rules[name] for name in order])
    return counts.select(
        "doc_id", *REPORTED, failed.alias("base_failed"), F.when(failed, False).otherwise(verdict.isNull()).alias("kept")
    )
