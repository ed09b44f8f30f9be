"""Operators that look at one row at a time: URL verdicts, licences, shards, quality."""

import math
import re
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from plain import SCHEMA, hard_docs, hard_rows, prose, with_clashes
from pyspark.sql import functions as F

from declined.llm import license_scan, quality_rules, sharding, url_filter
from declined.llm.url_filter import UrlRule

RULES = [UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"), UrlRule("org", "/fr/", "allow")]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# URL filter ----------------------------------------------------------------------------------

URLS = [
    "http://www.Example.NET/en/1?utm_source=a&b=2&a=1#x", "https://example.net/en/1/?a=1&b=2", "http://a.net", "ftp://x.net/",
    "no scheme", "", None, "http://b.org/fr/1", "http://b.org/FR/1", "http://h?q#f", "x://y://z/p", "http://Éa.org/é",
    "http://c.com/1", "http://c.com/1",
]


def pages(spark, urls=URLS):
    return spark.createDataFrame(list(enumerate(urls)), "page_id LONG, url STRING")


def test_host_path_rule_and_verdict(spark):
    listed = spark.createDataFrame([("c.com/1",), ("c.com/1",), (None,), ("example.net/en/1",)], "listed_url STRING")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages(spark), listed, RULES).collect()}
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict, got[0].listed) == (
        "www.example.net", "/en/1", "example.net/en/", "allow", False,
    )
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("a.net", "", None, "allow")
    assert (got[3].rule, got[3].verdict) == ("net/", "block")
    for k in (4, 5, 6):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == ("", "", None, "allow")
    assert got[7].rule == "org/fr/" and got[8].rule is None
    assert (got[9].host, got[10].host, got[10].path) == ("h", "y:", "//z/p")
    assert (got[11].host, got[11].path) == ("Éa.org".replace("A", "a"), "/é")
    assert [got[k].verdict for k in (12, 13)] == ["block", "block"] and len(got) == len(URLS)


def test_canonical_urls(spark):
    urls = pages(spark).select("page_id", url_filter.canonical_url(F.col("url")).alias("c"))
    got = dict(map(tuple, urls.collect()))
    assert got[0] == got[1] == "example.net/en/1?a=1&b=2" and got[4] is None and got[6] is None
    assert [r.listed_url for r in url_filter.repeated_urls(pages(spark)).orderBy("listed_url").collect()] == [
        "c.com/1", "example.net/en/1?a=1&b=2",
    ]


@pytest.mark.parametrize("most_bytes", [64_000_000, 0])
def test_bloom_filter_lets_no_listed_url_by(spark, most_bytes):
    urls = [f"http://h{k % 7}.com/{k}" for k in range(3000)] + ["http://hot.com/x"] * 1000
    listed = pages(spark, urls[::3]).select(url_filter.canonical_url(F.col("url")).alias("listed_url"))
    got = url_filter.url_verdicts(pages(spark, urls), listed, most_bytes=most_bytes, bits_per_url=4)
    want = {u for u in urls[::3]}
    assert {r.page_id: r.listed for r in got.collect()} == {k: u in want for k, u in enumerate(urls)}


def test_bloom_filter_passes_few_others(spark):
    listed = pages(spark, [f"http://h.com/{k}" for k in range(2000)]).select(
        url_filter.canonical_url(F.col("url")).alias("listed_url")
    )
    blocks = url_filter.bloom_blocks(listed, 125)
    ones = blocks.select(sum(F.bit_count(f"w{k}") for k in range(4)).alias("n")).agg(F.avg("n")).first()[0]
    assert blocks.count() == 125 and 60 < ones < 140  # about half of 256 bits


def test_url_tables_that_are_empty_or_have_other_columns(spark):
    none = pages(spark, [])
    assert url_filter.url_verdicts(none, url_filter.repeated_urls(none), RULES).count() == 0
    more = pages(spark).select("*", *[F.lit(1).alias(c) for c in ("host", "path", "maybe", "at", "block", "w0", "m0")])
    plain = url_filter.url_verdicts(pages(spark), url_filter.repeated_urls(pages(spark)), RULES)
    assert as_rows(url_filter.url_verdicts(more, url_filter.repeated_urls(more), RULES)) == as_rows(plain)


# Licences ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "license"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("  licenced under the APACHE licence -- version 2.0", "Apache-2.0"),
        ("Copyright (c) 2019 Some One\nReleased under the MIT License", "MIT"),
        ("© 2020 A\n(c) 2021 B\n* Released under the MIT Licence. *", "MIT"),
        ("Released under the MIT License. And more.", None),
        ("", None), (None, None), (" ... ", None), ("Copyright (c) 2019 Some One", None),
        ("all rights reserved", "proprietary"),
    ],
)
def test_license_of_a_whole_text(spark, text, license):
    units = spark.createDataFrame([(text, "kept")], "text STRING, digest STRING")
    row = license_scan.license_scan(units).first()
    assert row.license == license and (row.digest == "") == (text is None)


def test_every_known_notice_is_found_in_other_forms(spark):
    notices = [(k, t) for k, ts in license_scan.KNOWN_LICENSES.items() for t in ts]
    other = [(k, "Copyright 2001 X.\n" + re.sub(r"[,.]", " ;", t.upper()).replace(" ", "\n ")) for k, t in notices]
    units = spark.createDataFrame(notices + other, "want STRING, text STRING")
    assert license_scan.license_scan(units).filter("want <> license OR license IS NULL").count() == 0


@pytest.mark.parametrize("most_bytes", [32_000_000, 0])
def test_whole_texts_are_found_in_a_table_of_notices(spark, most_bytes):
    """Full licence texts as files have them: wrapped, with their own copyright line and spelling."""
    import textwrap

    notices = [(name, t) for name, texts in license_scan.KNOWN_LICENSES.items() for t in texts]
    table = spark.createDataFrame([*notices, ("Mine", "Do as you like, 2024 edition."), ("None", "..."), ("None", None)], "license STRING, notice STRING")
    rows = [(k, name, f"Copyright (c) {1990 + k} Some One\n\n" + textwrap.fill(re.sub(r"\blicense\b", "licence", t), 60)) for k, (name, t) in enumerate(notices)]
    rows += [(100, "Mine", "do as you like -- 2024 EDITION"), (101, None, "..."), (102, None, None), (103, None, notices[-1][1] + " more")]
    docs = spark.createDataFrame(rows, "doc_id LONG, want STRING, text STRING")
    digests = license_scan.known_digests(docs, table)
    for known in (table, digests):
        got = license_scan.license_scan(docs, known, most_bytes=most_bytes)
        assert got.count() == len(rows) and got.filter("NOT (want <=> license)").count() == 0


def test_license_lines_of_documents(spark):
    text = "Some words.\nReleased under the MIT License.\nAll rights reserved.\nreleased under the MIT licence"
    docs = spark.createDataFrame([(1, text), (1, text), (None, "All rights reserved."), (3, None)], "doc_id LONG, text STRING")
    got = as_rows(license_scan.document_licenses(docs).select("doc_id", "license", "n_license_lines", "line_licenses"))
    one = (1, None, 3, "MIT,proprietary")
    assert got == sorted([one, one, (None, "proprietary", 1, "proprietary"), (3, None, 0, None)], key=repr)
    hard = hard_docs(spark)
    assert as_rows(license_scan.document_licenses(with_clashes(hard))) == as_rows(license_scan.document_licenses(hard))
    assert license_scan.document_licenses(hard.limit(0)).count() == 0


# Shards --------------------------------------------------------------------------------------


def test_shards_are_those_of_rendezvous_hashing_done_again(spark):
    """Scores of all shards for each key, computed without Spark."""
    weights = [1.0, 2.0, 0.0, 0.5, 1.0, 3.0]

    def shard(key, weights):
        scores = []
        for j, w in enumerate(weights):
            seed = xxhash.xxh64_intdigest(struct.pack("<i", j), seed=42)
            h = xxhash.xxh64_intdigest("\0null".encode() if key is None else str(key).encode(), seed=seed)
            if w > 0:
                scores.append((-w / math.log((h % (1 << 52) + 0.5) / (1 << 52)), j))
        return max(scores)[1]

    docs = spark.range(800).selectExpr("IF(id = 7, NULL, id * 37 - 900) AS doc_id", "'t' AS text")
    grown = [*weights, sum(weights) / len(weights)]
    for r in sharding.shard_index(docs, weights).collect():
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, weights), shard(r.doc_id, grown))


def test_shard_index_on_hard_documents(spark):
    got = sharding.shard_index(with_clashes(hard_docs(spark)), [1.0] * 5).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in hard_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    of = {}
    for r in got:
        assert of.setdefault(r.doc_id, r.shard) == r.shard and r.grown_shard in (r.shard, 5)
    assert sharding.shard_index(hard_docs(spark).limit(0), [1.0] * 5).count() == 0


def test_weights_and_growth(spark):
    keys = spark.range(20_000).select("id", *[
        sharding.shard_of(F.col("id"), weights).alias(name)
        for name, weights in {"old": [1, 2, 0, 1], "new": [1, 2, 0, 1, 1], "less": [1, 2]}.items()
    ]).collect()
    n = Counter(r.old for r in keys)
    assert set(n) == {0, 1, 3} and abs(n[1] - 10_000) < 400 and abs(n[0] - 5000) < 300
    assert all(r.new in (r.old, 4) for r in keys) and abs(sum(r.new == 4 for r in keys) - 4000) < 300
    assert all(r.less == r.old for r in keys if r.old < 2)
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [0.0])


def test_slots_of_a_hot_row_are_gapless(spark):
    hot = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    docs = hot.unionByName(spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))
    got = sharding.shard_index(docs, [1.0] * 3)
    gaps = got.groupBy("shard").agg(F.count("slot").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in gaps.collect()) and got.count() == 30_100


# Quality -------------------------------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {p for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for p in range(k, k + 3)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
        len(w) < 50 or 100 * len(hit) > 50 * len(w),
    )


def test_quality_counts_on_hard_documents(spark):
    extra = [(30, "a a a a a", None, None, None), (31, "a b c x a b c a b c d", None, None, None), (32, "a b\na b\n\n \na b ", None, None, None)]
    docs = hard_docs(spark).unionByName(spark.createDataFrame(extra, SCHEMA))
    for table in (docs, with_clashes(docs)):
        got = quality_rules.quality_report(table)
        want = sorted([(r[0], *plain_quality(r[1])) for r in hard_rows() + extra], key=repr)
        assert as_rows(got.drop("kept")) == want
        assert got.filter("base_failed AND kept").count() == 0
    kept = {r.doc_id for r in got.filter("kept").collect()}
    assert {1, 2, 3, 11, 14, 18, 20} <= kept and not {4, 5, 7, 12, 19, 30} & kept


def test_quality_filter_keeps_rows_as_they_are(spark):
    docs = with_clashes(hard_docs(spark))
    kept = quality_rules.keep_quality(docs)
    assert kept.schema == docs.schema
    report = quality_rules.quality_report(docs)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in report.filter("kept").collect())
    none = docs.limit(0)
    assert quality_rules.keep_quality(none).count() == 0 == quality_rules.quality_report(none).count()


def test_verdict_does_not_depend_on_the_order(spark):
    docs = hard_docs(spark)
    rules = quality_rules.default_rules()
    forward = docs.filter(quality_rules.first_rejection(rules).isNull()).select("doc_id", "text")
    back = docs.filter(quality_rules.first_rejection(rules[::-1]).isNull()).select("doc_id", "text")
    assert as_rows(forward) == as_rows(back)


def test_cascade_puts_what_rejects_much_for_little_first(spark):
    docs = spark.createDataFrame([(k, prose(k, 200)) for k in range(60)], "doc_id LONG, text STRING")
    cheap = quality_rules.Rule("cheap", F.length("text") > 0)
    never = quality_rules.Rule("never", F.regexp_count("text", F.lit("q(.*)z$")) > 5)
    dear = quality_rules.Rule("dear", quality_rules.measures()["n_repeat_words"] >= 0)
    order = [r.name for r in quality_rules.cascade_order(docs, [never, dear, cheap])]
    assert order == ["cheap", "dear", "never"]


def test_later_rules_are_not_evaluated(spark):
    first = quality_rules.Rule("first", F.col("doc_id") >= 0)
    raises = quality_rules.Rule("raises", F.raise_error(F.lit("evaluated")).cast("boolean"))
    names = spark.range(3).withColumnRenamed("id", "doc_id").select(quality_rules.first_rejection([first, raises]))
    assert [r[0] for r in names.collect()] == ["first"] * 3


def test_report_takes_further_measures_only_where_the_cascade_asks(spark, monkeypatch):
    """A measure behind a rule that rejects, or behind the base limits, is not evaluated."""
    own = quality_rules.measures
    raising = {"n_capitals": F.raise_error(F.lit("evaluated")).cast("long")}
    monkeypatch.setattr(quality_rules, "cascade_order", lambda docs, rules, *_: list(rules))
    monkeypatch.setattr(quality_rules, "measures", lambda text="text": own(text) | raising)
    few, marks = "too few words", prose(1, 60) + " #" * 60
    rejected = spark.createDataFrame([(1, few), (2, marks), (3, None)], "doc_id LONG, text STRING")
    assert [r.kept for r in quality_rules.quality_report(rejected).collect()] == [False] * 3
    clean = spark.createDataFrame([(4, prose(2, 90))], "doc_id LONG, text STRING")
    with pytest.raises(Exception, match="evaluated"):
        quality_rules.quality_report(clean).collect()


def test_rates_are_those_of_what_earlier_rules_leave(spark, monkeypatch):
    """Of two rules that reject the same rows, the dearer one goes behind one that rejects others."""
    docs = spark.createDataFrame([(f"{'a' if k % 2 else 'b'} {k}",) for k in range(200)], "text STRING")
    some, same, rest = (quality_rules.Rule(n, F.col("text").startswith(x)) for n, x in (("1", "a"), ("2", "a"), ("3", "b 2")))
    monkeypatch.setattr(quality_rules.time, "perf_counter", iter(range(1000)).__next__)
    order = [r.name for r in quality_rules.cascade_order(docs, [same, rest, some])]
    assert order == ["1", "3", "2"]
