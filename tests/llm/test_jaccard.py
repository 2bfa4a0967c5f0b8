from __future__ import annotations

import random

import pytest

from seatlens.llm import graph, jaccard
from tests.llm import helpers as H


def families(seed: int, many: int = 60) -> list[tuple[int, str]]:
    """Texts with copies, near copies of all degrees, chains of them, and one passage shared by all."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    rows = []
    for _ in range(many // 6):
        size = rng.choice([1, 2, 3, 4, 8, 15, 40, 90, 200])
        base = [rng.choice(vocabulary) for _ in range(size)]
        now = base
        for _ in range(6):
            rows.append((rng.randrange(10_000) * 1000 + len(rows), " ".join(passage + now if size > 20 else now)))
            now = list(now if rng.random() < 0.5 else base)
            for _ in range(rng.randrange(1 + size // 12 + 1)):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shingle", "percent", "block"), [(3, 90, 2048), (5, 80, 2048), (2, 60, 4)])
def test_components_equal_brute_force(spark, monkeypatch, shingle, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)  # a small block cuts large buckets into cells
    monkeypatch.setattr(jaccard, "HOT_ROWS", 2 if block == 4 else 1000)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 3)
    rows = sorted(families(shingle))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs, shingle=shingle, percent=percent).collect()}
    sets = [H.shingle_set(t, shingle) for _, t in rows]
    roots = H.component_labels(sets, percent)
    assert got == {rows[i][0]: (len(sets[i]), rows[roots[i]][0]) for i in range(len(rows))}
    assert len({v[1] for v in got.values()}) < len(rows)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(rng.randrange(8)):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
    roots = H.component_labels([H.shingle_set(t, 3) for _, t in rows], 90)
    assert got == dict(enumerate(roots))


@pytest.mark.parametrize("clashes", [False, True])
def test_odd_rows(spark, clashes):
    rows = jaccard.jaccard_groups(H.odd_docs(spark, clashes)).collect()
    assert len(rows) == len(H.ODD)
    own = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    size = len(H.shingle_set(H.PROSE, 3))
    assert own[1] == (0, 1) and own[2] == (0, 2) and own[3] == (0, 3)
    assert own[4] == own[5] == own[6] == (size, 4)
    assert own[7] == (len(H.shingle_set(H.LONG, 3)), 7)
    assert own[10] == (1, 10)
    nulls = sorted(((r.n_shingles, r.component_id) for r in rows if r.doc_id is None), key=str)
    assert nulls == [(0, None), (size + 4, None)]


@pytest.mark.parametrize("clashes", [False, True])
def test_keep_one_row_per_group(spark, clashes):
    docs = H.odd_docs(spark, clashes)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 5 and 6 are copies of 4; the longer text without an id shares four fifths with it
    assert ids == sorted([1, 2, 3, 4, 7, 8, None, 9, 10], key=str)


def test_empty_table(spark):
    assert jaccard.jaccard_groups(H.no_docs(spark)).collect() == []
    assert jaccard.keep_one(H.no_docs(spark)).collect() == []


def test_chain_and_star_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "u long, v long")
    got = {r.node: r.label for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert graph.components(edges.limit(0)).collect() == []


def test_regular_texts_are_not_linked(spark):
    """Words, and texts of words, that sums over powers don't tell apart."""
    x = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    y = x.translate(str.maketrans("ab", "ba"))
    rows = [(1, x), (2, y), (3, " ".join(x)), (4, " ".join(y)), (5, x)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
    sets = [H.shingle_set(t, 3) for _, t in rows]
    assert got == {rows[i][0]: rows[r][0] for i, r in enumerate(H.component_labels(sets, 90))}
    assert got[1] == got[5] != got[2]
