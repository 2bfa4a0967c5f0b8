from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seatlens.llm import language, neighbours, queries, rules
from seatlens.llm import words as W
from tests.llm import helpers as H

LINES = [
    "a b c d e f g h i\n" * 5,
    "é x\r\n" * 30,
    "x " * 5000,
    "a\x0bb\x0cc\x1cd e " * 9,
    "one two\n\none two\n \n \none two",
    "#tag <b> 5% & more | $",
]


def _counts(text: str | None) -> tuple:
    own, seen, doubled = H.words(text), set(), 0
    for line in (text or "").split("\n"):
        if H.words(line):
            doubled += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    times, inside = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            inside.update(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(own) < 20 or 100 * len(inside) > 30 * len(own)
    return len(own), sum(map(len, own)), symbols, doubled, len(inside), failed


def test_rule_counts_equal_plain_python(spark, sf_dir):
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(LINES)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd)
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    judged = rules.judge(docs, marks).collect()
    assert {r.doc_id: (*[r[c] for c in rules.COUNTS], r.base_failed) for r in judged} == {
        i: _counts(t) for i, t in texts.items()
    }
    assert not any(r.kept for r in judged if r.base_failed)
    kept = {r.doc_id for r in rules.keep_good(docs, marks).collect()}
    assert kept == {r.doc_id for r in judged if r.kept}
    label = {r.doc_id: r.quality for r in marks.collect()}
    passed = [(label[r.doc_id], r.kept) for r in judged if r.doc_id in label and not r.base_failed]
    assert all(kept for good, kept in passed if good) and not any(kept for good, kept in passed if not good)


def test_path_lengths_follow_the_tree():
    tree = (np.full(4 << rules.DEPTH, -1), np.zeros(4 << rules.DEPTH), np.zeros(4 << rules.DEPTH))
    tree[0][1], tree[1][1], tree[2][2], tree[2][3] = 0, 0.5, 1.0, 9.0
    low, high = rules.path_lengths(np.array([[0.2], [0.5]]), [tree])
    assert high == pytest.approx(9 * low)
    assert rules.path_lengths(np.array([[0.2]]), []).tolist() == [1.0]


@pytest.mark.parametrize("clashes", [False, True])
def test_rules_on_odd_rows(spark, clashes):
    docs = H.odd_docs(spark, clashes)
    judged = rules.judge(docs, H.labels(spark)).collect()
    assert len(judged) == len(H.ODD)
    assert {r.doc_id for r in judged if r.n_words == 0} == {1, 2, 3, None}
    kept = rules.keep_good(docs, H.labels(spark))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([4, 5, 5, 6, 7, None], key=str)
    assert rules.judge(H.no_docs(spark), H.labels(spark)).collect() == []
    assert len(rules.keep_good(docs, H.labels(spark, [])).collect()) == 6


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in queries.op4_quality_neighbours(spark, sf).collect()}
    marks = spark.read.parquet(f"{sf}/labels.parquet").collect()
    unseen = [(scored[m.doc_id].predicted, m.quality) for m in marks if scored[m.doc_id].held_out]
    assert len(unseen) > 60
    assert sum(p == q for p, q in unseen) >= 0.95 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    from pyspark.sql import functions as F

    held = neighbours.held_out("doc_id", 4, 2)
    turned = marks.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: r.score for r in neighbours.classify(docs, marks, learn=~held).collect()}
    two = {r.doc_id: r.score for r in neighbours.classify(docs, turned, learn=~held).collect()}
    assert one == two


@pytest.mark.parametrize("clashes", [False, True])
def test_classifier_on_odd_rows(spark, clashes):
    docs = H.odd_docs(spark, clashes)
    rows = neighbours.classify(docs, H.labels(spark)).collect()
    assert len(rows) == len(H.ODD)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[1] == by_id[2] and by_id[4] == by_id[5]
    none = neighbours.classify(docs, H.labels(spark, []))
    assert {r.score for r in none.collect()} == {0.5}
    kept = neighbours.keep_predicted(docs, H.labels(spark, [(4, 1, 0)]))
    assert kept.columns == docs.columns and kept.count() == len(H.ODD)
    assert neighbours.classify(H.no_docs(spark), H.labels(spark)).collect() == []


def _plain_profile(texts: list[str], most: int) -> list[bytes]:
    counts = Counter()
    for text in texts:
        raw = (" " + re.sub(r"[^a-zà-ÿß]+", " ", text.lower()).strip() + " ").encode()
        for n in (1, 2, 3):
            counts.update(raw[i : i + n] for i in range(len(raw) - n + 1))
    counts.pop(b" ", None)
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:most]


def test_language_profiles_and_distance_equal_plain_python(spark):
    texts = {"en": ["The cat sat, on the mat. " * 3, "A hat!"], "fr": ["Été à la mer; ça va bien, là-bas. " * 3]}
    docs = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, own in texts.items() for t in own)]
    learned = {k: _plain_profile(own, language.PROFILE) for k, own in texts.items()}
    expected = {}
    for i, text, _ in docs:
        own = _plain_profile([text], language.DOCUMENT)
        far = {
            k: sum(abs(p.index(g) - r) if g in p else language.PROFILE for r, g in enumerate(own)) for k, p in learned.items()
        }
        best = min(far, key=lambda k: (far[k], k))
        expected[i] = (best, pytest.approx(1 - far[best] / (language.PROFILE * len(own))))
    rows = language.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in rows} == expected


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    told = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op10_language(spark, sf).collect()
    unseen = [r.lang_pred == told[r.doc_id] for r in rows if r.held_out]
    assert len(unseen) > 250 and sum(unseen) >= 0.97 * len(unseen)


@pytest.mark.parametrize("clashes", [False, True])
def test_language_on_odd_rows(spark, clashes):
    rows = language.identify(H.odd_docs(spark, clashes)).collect()
    assert len(rows) == len(H.ODD)
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {1, 2, 3, None} or unknown == {1, 2, 3}
    no_lang = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.identify(no_lang).collect()] == [(1, "und", 0.0)]
    digits = spark.createDataFrame([(1, "12 34 !", "en"), (2, "word", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language.identify(digits).collect()} == {1: "und", 2: "en"}
    assert language.identify(H.no_docs(spark)).collect() == []


def test_slices_and_hashes_do_not_depend_on_the_cut(monkeypatch):
    import pyarrow as pa

    texts = [None, "", "one two  three\nfour", "x" * 100, " a ", "é one"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]).slice(1)

    def hashes() -> list[list[int]]:
        out = []
        for own in W.slices(batch):
            spans = W.words(own)
            hashed = W.hashes(own.data, spans.start, spans.end, lower=True)
            out += [hashed[spans.first[i] : spans.first[i + 1]].tolist() for i in range(len(own))]
        return out

    whole = hashes()
    monkeypatch.setattr(W, "SLICE_BYTES", 7)
    assert hashes() == whole
    assert [len(h) for h in whole] == [len(H.words(t)) for t in texts[1:]]
    assert whole[1][0] == whole[4][1]  # the same word in two texts


def test_copies_leave_no_tree_without_rows(spark, monkeypatch):
    """A text labelled good in most rows is one text of the forest's sample; every tree gets its rows."""
    monkeypatch.setattr(rules, "TREES", 10)
    monkeypatch.setattr(rules, "TREE_ROWS", 8)
    texts = [H.PROSE] * 500 + [f"{H.PROSE} {'x' * i} {i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stats = rules.statistics(docs)
    drawn = rules._drawn(stats).select("tree", "row").collect()
    assert len(drawn) == len(set(drawn)) == 80 and {r.tree for r in drawn} == set(range(10))
    good = spark.createDataFrame([(i, 1) for i in range(503)], "id long, label int")
    assert len(rules.grow_forest(stats, good)) == 10  # four distinct texts are too few for ten trees of their own


def test_regular_lines_are_not_equal():
    x = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    y = x.translate(str.maketrans("ab", "ba"))
    (texts,) = W.slices(pa.RecordBatch.from_arrays([pa.array([f"{x}\n{y}", f"{x}\n{y}\n{x}"])], names=["text"]))
    assert rules._counts(texts)["n_dup_lines"].tolist() == [0, 1]


def test_of_an_ids_texts_the_smallest_hash_is_learnt_from(spark):
    rows = [(1, H.PROSE), (1, H.PROSE[::-1]), (2, "#$%^ " * 30), (3, H.PROSE), (4, "##")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = H.labels(spark, [(1, 1, 0), (2, 0, 0)])
    score = lambda d: [round(r.score, 4) for r in neighbours.classify(d, marks).orderBy("doc_id", "score").collect()]
    assert score(docs) == score(docs.orderBy(F.desc("text")))


def _plain_bag(text: str | None) -> np.ndarray:
    """Hashed trigrams of the bytes, words that repeat the one before, symbols."""
    data, own = (text or "").encode(), re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    bag = np.zeros(neighbours.DIMENSIONS + 2, dtype=np.float64)
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        bag[((((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 20) % neighbours.DIMENSIONS] += 1
    repeats = sum(x == y for x, y in zip(own, own[1:], strict=False))
    bag[-2] = neighbours.TERM_WEIGHT * max(0, repeats - neighbours.CHANCE)
    bag[-1] = neighbours.TERM_WEIGHT * sum(data.count(s) for s in b"#*$%&|<>{}=~^_")
    return bag


def test_votes_equal_plain_cosines(spark, sf_dir):
    """Every document against every labelled vector, one by one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(H.odd_docs(spark).select("doc_id", "text"))
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = neighbours.train(docs, marks, "doc_id", "text", "quality", None)
    got = Counter((r.doc_id, round(r.score, 3)) for r in neighbours.classify(docs, marks).collect())
    close = 0
    for doc_id, text in [tuple(r) for r in docs.collect()]:
        bag = np.sqrt(_plain_bag(text))
        vector = (bag / (np.linalg.norm(bag) or 1)) @ model.projection
        vector = vector / np.linalg.norm(vector) if np.linalg.norm(vector) > 1e-9 else 0 * vector
        similar = sorted(((float(v @ vector), i) for i, v in enumerate(model.vectors)), reverse=True)[: neighbours.NEIGHBOURS]
        votes = [(max(s, 0) ** 4 * float(model.weights[i]), float(model.labels[i])) for s, i in similar]
        score = (sum(w * y for w, y in votes) + neighbours.PRIOR_VOTE * model.prior) / (sum(w for w, _ in votes) + neighbours.PRIOR_VOTE)
        near = [k for k in got if k[0] == doc_id and abs(k[1] - score) < 3e-3]
        close += bool(near)
    assert close == docs.count()


def test_paths_and_threshold_equal_a_plain_walk(spark):
    rng = np.random.default_rng(4)
    import pandas as pd

    rows = rng.random((300, 8))
    forest, frames = [], []
    for tree in range(3):
        frame = rules._grow(pd.DataFrame({"row": range(300), "features": list(rows), "tree": tree}))
        feature, cut, path = np.full(4 << rules.DEPTH, -1), np.zeros(4 << rules.DEPTH), np.zeros(4 << rules.DEPTH)
        feature[frame["node"]], cut[frame["node"]], path[frame["node"]] = frame["feature"], frame["cut"], frame["path"]
        forest.append((feature, cut, path))
        frames.append(frame)
    expected = lambda n: 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def walk(row, tree) -> tuple[int, int]:
        feature, cut, _ = tree
        node, depth = 1, 0
        while feature[node] >= 0:
            node, depth = 2 * node + int(row[feature[node]] >= cut[node]), depth + 1
        return node, depth

    new = np.vstack([rows[:50], rng.random((50, 8)), np.zeros((1, 8)), np.ones((1, 8))])
    sizes = [Counter(walk(r, t)[0] for r in rows) for t in forest]
    longest = rules.DEPTH + expected(2 * rules.TREE_ROWS)
    plain = []
    for row in new:
        paths = []
        for tree, held in zip(forest, sizes, strict=True):
            node, depth = walk(row, tree)
            paths.append(depth + expected(held[node]))
        plain.append(np.mean(paths) / longest)
    assert np.allclose(rules.path_lengths(new, forest), plain)

    scored = [(i, int(rng.integers(0, 40)), float(d)) for i, d in enumerate(rng.random(400))]
    marks = [(i, int(d > 0.3 or rng.random() < 0.01)) for i, _, d in scored]
    frame = spark.createDataFrame([(i, n + 20, 0, d) for i, n, d in scored], "id long, n_words long, n_repeat_words long, depth double")
    found = rules.threshold(frame, spark.createDataFrame(marks, "id long, label int"))
    good, bad = ([d for (_, _, d), (_, y) in zip(scored, marks, strict=True) if y == k] for k in (1, 0))
    best = (0, 0.0)
    for b in range(rules.BINS):
        border = (b + 1) / rules.BINS
        lost, caught = sum(int(d * rules.BINS) <= b for d in good), sum(int(d * rules.BINS) <= b for d in bad)
        if lost <= rules.MOST_LOST * len(good) and caught > best[0]:
            best = (caught, border)
    assert found == best[1] > 0
