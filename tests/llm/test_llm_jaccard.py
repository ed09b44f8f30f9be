"""The Jaccard join where nothing meets, and in large groups."""

import random

import pytest
from plain import least_id, prose, shingles

from declined.llm import jaccard_join

SCHEMA = "doc_id LONG, text STRING"


def found(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs, **sizes).collect()}


def plain(rows):
    sets = [shingles(text) for _, text in rows]
    return {i: (len(s), c) for (i, _), s, c in zip(rows, sets, least_id(rows, sets), strict=True)}


def edited(base, n, most, seed):
    """Copies of a text of which up to ``most`` words are others."""
    rng, texts = random.Random(seed), []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(1, most + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(100_000)}"
        texts.append(" ".join(words))
    return texts


def with_few(pairs):
    """Comparison of blocks that leaves pairs to be rows where there are at most so many for a member."""

    def possible(batches, other_hubs):
        from declined.llm import jaccard_join as in_task

        in_task.PAIRS_A_MEMBER = pairs
        yield from in_task._possible(batches, other_hubs)

    return possible


@pytest.mark.parametrize("n", [1, 2, 1000])
@pytest.mark.parametrize("per_bucket", [100, 2_000_000])
def test_unrelated_documents(spark, n, per_bucket):
    rows = [(i, prose(i, 40, 100_000)) for i in range(n)]
    assert found(spark, rows, signatures_per_bucket=per_bucket) == plain(rows)


@pytest.mark.parametrize(("most", "pairs"), [(2, 0), (5, 0), (5, 2), (12, 0), (12, 99)])
def test_groups_around_the_threshold(spark, monkeypatch, most, pairs):
    """Blocks meet each other, as pairs or with their sets; links that are not to the hub count as well."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    monkeypatch.setattr(jaccard_join, "_possible", with_few(pairs))
    texts = edited(prose(1, 60), 250, most, 1) + edited(prose(1, 60), 1, 1, 2) + edited(prose(2, 300), 60, 3 * most, 3)
    rows = list(enumerate(texts))
    assert found(spark, rows, most_bytes=0) == plain(rows)


def test_a_hot_place_comes_in_rows_of_some_members(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    from declined.llm.shingles import packed

    monkeypatch.setattr(jaccard_join, "MEMBERS_A_ROW", 10)
    nodes = np.arange(35, dtype=np.int64)
    row = {"n": 35, "nodes": nodes.tobytes(), "refs": packed(nodes), "places": packed(np.array([7] + [0] * 34))}
    got = jaccard_join._meetings(pd.DataFrame([row]))
    assert sorted(map(len, got.members)) == [5, 10, 10, 10] and set(got.n) == {35} and got.meeting.nunique() == 1
    assert sorted(x for m in got.members for x in m) == nodes.tolist()


def test_compared_pairs_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Texts of one base that are mostly not linked: what comparisons bring are few rows."""
    made = []
    within = jaccard_join.pairs_within

    def counted(*arguments):
        found = within(*arguments)
        made[-1] += sum(x.count() for x in found if x is not None)
        return found

    monkeypatch.setattr(jaccard_join, "pairs_within", counted)
    sizes = [200, 400, 800]
    for n in sizes:
        made.append(0)
        rows = list(enumerate(edited(prose(5, 60), n, 5, n)))
        assert found(spark, rows) == plain(rows)
    assert all(rows <= 4 * n for rows, n in zip(made, sizes, strict=True))
