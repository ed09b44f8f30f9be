"""Plain versions of the operators, and documents that are hard on them."""

import collections
import math
import zlib

CLASHING = [
    "row", "hash", "id", "copies", "n_words", "kept", "removed", "lines", "line", "shard", "slot", "size",
    "piece", "start", "length", "ids", "offset", "rank_in_length", "node", "root", "bits", "bucket", "text_hash",
    "component_id", "spans", "items", "w", "h", "k", "at", "ref", "words", "count", "score", "base", "trains",
    "group", "b", "n", "first", "last", "digest", "license", "own_hash", "own_id", "passed", "listed_url",
]


def words(text):
    return (text or "").encode().lower().split()


def prose(seed, n, vocabulary=4000):
    state, out = seed * 7919 + 13, []
    for i in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"w{(state >> 33) % vocabulary}" + ("." if i % 11 == 10 else ""))
    return " ".join(out)


def hard_rows():
    """(doc_id, text, lang, source, n_chars): NULLs, empty, long, repeated and alike."""
    a, long = prose(1, 120), prose(2, 60_000, 500)
    near = a.replace("w", "W", 3) + " and a few more words"
    texts = [
        (1, a), (2, a), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one two"),
        (9, long), (10, long + " tail"), (11, prose(3, 300)), (11, prose(3, 300)), (11, prose(4, 80)),
        (None, a), (None, None), (None, prose(5, 70)), (12, "x " * 400), (13, "É È ß 中文 \U0001f600 " * 30),
        (14, "Shared line of four\n" + prose(6, 90)), (15, "Shared line of four\n" + prose(7, 90)),
        (16, prose(8, 70) + "\n" + prose(9, 55) + "\n" + prose(10, 60)), (17, prose(11, 30) + " " + prose(9, 55)),
        (18, prose(12, 100) + "\r\n\x0b\x0c" + prose(13, 10)), (19, "### *** $$$ " * 40),
    ]
    rows = [(i, t, "en", f"src{k % 9}", len(t) if t is not None else None) for k, (i, t) in enumerate(texts)]
    rows.append((20, prose(14, 60), None, None, None))
    return rows


SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def hard_docs(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"other {c}").alias(c) for c in CLASHING if c not in docs.columns])


def shingles(text, width=5):
    w = words(text)
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(sets, alike=lambda a, b: 100 * len(a & b) >= 75 * len(a | b)):
    """Index of the component of each set; empty ones are alone."""
    holders, parent = collections.defaultdict(list), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        met = {j for e in s for j in holders[e]}
        for e in s:
            holders[e].append(i)
        for j in met:
            if find(i) != find(j) and alike(s, sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def least_id(rows, sets):
    """Component ids as the query defines them: the least id, ids of None apart."""
    roots = components(sets)
    ids = collections.defaultdict(list)
    for (doc_id, *_), root in zip(rows, roots, strict=True):
        if doc_id is not None:
            ids[root].append(doc_id)
    return [
        (min(ids[root]) if ids[root] else None) if s else row[0]
        for row, root, s in zip(rows, roots, sets, strict=True)
    ]


def model_scores(texts, trains, discount=0.75, steps=32):
    """(n_tokens, n_known, train_tokens, base, score) of each text."""
    tokens = [[*words(t), 0] for t in texts]
    single, pairs = collections.Counter(), collections.Counter()
    for t, own in zip(tokens, trains, strict=True):
        if own:
            single.update(t)
            pairs.update(zip([0, *t[:-1]], t, strict=True))
    n, v = sum(single.values()), len(single)
    seen, kinds = collections.Counter(), collections.Counter()
    for (a, _), k in pairs.items():
        seen[a] += k
        kinds[a] += 1

    def alone(w):
        return math.log10((single[w] + 1) / (n + v + 1))

    def after(a, w):
        if not seen[a]:
            return alone(w)
        if pairs[a, w]:
            return -min(255, math.ceil(-math.log10((pairs[a, w] - discount) / seen[a]) * steps)) / steps
        return math.log10(discount * kinds[a] / seen[a]) + alone(w)

    return [
        (
            len(t), sum(single[w] > 0 for w in t), n, sum(map(alone, t)),
            sum(after(a, w) for a, w in zip([0, *t[:-1]], t, strict=True)),
        )
        for t in tokens
    ]


def held_out(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7 == 2
