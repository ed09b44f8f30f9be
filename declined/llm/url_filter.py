"""Verdicts on URLs: host and path rules, then a list behind a blocked Bloom filter."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from declined.llm.common import lower_ascii, written

WORDS_PER_BLOCK = 4  # of 64 bits: a block of 256


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host, its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(host)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """One spelling for the URLs of one page; NULL for what has no ``://``.

    Scheme, fragment, a leading ``www.``, a trailing slash and tracking parameters go;
    the other parameters are sorted.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    own = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"(?s)^(utm_.*|ref|fbclid|gclid)(=.*)?$")
    )
    full = F.concat(host, path, F.when(F.size(own) > 0, F.lit("?")).otherwise(F.lit("")),
                    F.array_join(F.array_sort(own), "&"))
    return F.when(F.contains(url, F.lit("://")), full)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as ``name`` and ``verdict``; NULL if none does.

    Of rules of one length the one with the longer host wins, then a block over an allow.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in reversed(ranked):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        named = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks))


def _mask(url: Column, bits: int) -> list[Column]:
    """For each word of a block, the bits that ``url`` sets in it: six bits of a hash name one."""
    h = F.xxhash64(F.lit(1), url)
    one = F.lit(1).cast("long")
    words = [F.lit(0).cast("long")] * WORDS_PER_BLOCK
    for b in range(bits):
        place = F.pmod(F.shiftright(h, 6 * b), F.lit(64)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        words[b % WORDS_PER_BLOCK] = words[b % WORDS_PER_BLOCK].bitwiseOR(bit)
    return words


def bloom_blocks(listed: DataFrame, n_blocks: int, bits: int = 8) -> DataFrame:
    """The filter of ``listed`` (a column ``listed_url``): a row for each block in use.

    All bits of a URL lie in one block, so that a probe reads one row.  Blocks are built by
    a partial aggregate of bitwise ors.
    """
    masks = [m.alias(f"m{w}") for w, m in enumerate(_mask(F.col("listed_url"), bits))]
    return (
        listed.select(_block(F.col("listed_url"), n_blocks).alias("block"), *masks)
        .groupBy("block")
        .agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS_PER_BLOCK)])
    )


def url_verdicts(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[UrlRule] = (),
    bits_per_url: int = 16,
    bits: int = 8,
    most_bytes: int = 64_000_000,
) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``listed``.

    ``listed`` has a column ``listed_url`` of canonical URLs.  A rule that fits decides;
    else a listed page is blocked and any other allowed.

    Every canonical URL is probed against the Bloom filter of the list, which has
    ``bits_per_url`` bits for each listed URL.  It is broadcast if its measured size is at
    most ``most_bytes``; beyond, Spark chooses the join.  Pages that the filter lets by stay
    where they are.  Only possible hits are shuffled, to a hash join with the list that
    removes false positives; it is an outer join of rows that adaptive execution may
    split, if one URL holds many of them.

    A NULL URL, or one without ``://``, has no host, no path and no canonical URL: it is
    allowed.  Repeated pages come out repeated, extra columns are left out, an empty list
    blocks nothing.
    """
    listed = listed.select("listed_url").filter(F.col("listed_url").isNotNull()).distinct()
    listed = written(listed, "listed")  # it is counted, made a filter of and joined
    n_blocks = max(1, math.ceil(listed.count() * bits_per_url / (64 * WORDS_PER_BLOCK)))
    blocks = bloom_blocks(listed, n_blocks, bits)
    if n_blocks * 100 <= most_bytes:
        blocks = F.broadcast(blocks)

    url = F.col("url")
    rows = pages.select(
        "page_id",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        canonical_url(url).alias("canonical"),
    )
    masks = [m.alias(f"m{w}") for w, m in enumerate(_mask(F.col("canonical"), bits))]
    rows = rows.select("*", _block(F.col("canonical"), n_blocks).alias("at"), *masks)
    rows = rows.join(blocks, F.col("at") == F.col("block"), "left")
    every = F.lit(True)
    for w in range(WORDS_PER_BLOCK):
        every = every & (F.col(f"m{w}").bitwiseAND(F.col(f"w{w}")) == F.col(f"m{w}"))
    maybe = F.coalesce(F.col("canonical").isNotNull() & every, F.lit(False))
    rows = rows.select("page_id", "host", "path", "canonical", maybe.alias("maybe"))

    passed = rows.filter(~F.col("maybe")).select("page_id", "host", "path", F.lit(False).alias("listed"))
    possible = rows.filter("maybe").join(listed, F.col("canonical") == F.col("listed_url"), "left")
    possible = possible.select(
        "page_id", "host", "path", F.col("listed_url").isNotNull().alias("listed")
    )
    judged = passed.unionByName(possible).withColumn(
        "fit", rule_of(F.col("host"), F.col("path"), rules)
    )
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fit.name").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_list).alias("verdict"),
        "listed",
    )


def repeated_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs that more than one page has, as a list for ``url_verdicts``."""
    urls = pages.select(canonical_url(F.col("url")).alias("listed_url"))
    counted = urls.filter(F.col("listed_url").isNotNull()).groupBy("listed_url").count()
    return counted.filter("count > 1").select("listed_url")
