"""Quality rules: an isolation forest over rule statistics.

Each text gets a handful of counts, from which rule statistics between 0 and 1
follow that don't depend on its length. An isolation forest splits the space of
those statistics at random; texts that few random splits set apart are anomalous.
The trees are grown in tasks of their own, on bounded random samples of the distinct
texts labelled good. Their splits are uniform in a node's part of the unit cube rather
than between its rows' extremes: a statistic that is the same in all good rows,
such as no symbols at all, would otherwise never be split on. The path length
above which a text is kept is calibrated on all labelled rows: the threshold that
catches most bad rows among those that lose at most ``MOST_LOST`` of the good.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatlens.llm import words as W
from seatlens.session import stage

#: Trees, rows a tree is grown on (the forest sees TREES * TREE_ROWS texts at most), and its depth.
TREES, TREE_ROWS, DEPTH = 100, 256, 10
#: The share of rows labelled good that the calibrated threshold may reject.
MOST_LOST = 0.005
#: Score bins for the calibration; counts per bin are all that reaches the driver.
BINS = 4096

_WINDOW = 8
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?=_~^@\\{}")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _within(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive positions."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] - total[at[:-1]]


def _repeated(windows: np.ndarray) -> np.ndarray:
    """Which values of an array occur twice or more in it."""
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(windows), dtype=bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out


def repeat_words(hashed: np.ndarray) -> int:
    """Words inside an eight-word window that the text has twice or more."""
    if len(hashed) <= _WINDOW:
        return 0
    twice = _repeated(W.shingles(hashed, _WINDOW))
    edge = np.zeros(len(hashed) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + _WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _counts(texts: W.Texts) -> dict[str, np.ndarray]:
    data, at = texts.data, texts.offsets
    words, lines = W.words(texts), W.lines(texts)
    hashed = W.hashes(data, words.start, words.end)
    line_hash = W.hashes(data, lines.start, lines.end)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    chars = begins[words.end] - begins[words.start]
    follow = np.zeros(len(hashed), dtype=bool)
    follow[1:] = hashed[1:] == hashed[:-1]
    follow[words.first[:-1][words.first[:-1] < len(follow)]] = False
    holds_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    n = len(texts)
    out = {
        "n_words": np.diff(words.first),
        "word_chars": np.array([chars[words.first[i] : words.first[i + 1]].sum() for i in range(n)]),
        "n_symbols": _within(_SYMBOL[data], at),
        "n_upper": _within(_UPPER[data], at),
        "n_letters": _within(_LETTER[data], at),
        "n_digits": _within(_DIGIT[data], at),
        "n_marks": _within(_MARK[data], at),
        "n_short_words": _within(chars <= 1, words.first),
        "n_follow_words": _within(follow, words.first),
    }
    dup, many, repeats = [], [], []
    for i in range(n):
        own = line_hash[lines.first[i] : lines.first[i + 1]][holds_word[lines.first[i] : lines.first[i + 1]]]
        many.append(len(own))
        dup.append(len(own) - len(np.unique(own)))
        repeats.append(repeat_words(hashed[words.first[i] : words.first[i + 1]]))
    return out | {"n_dup_lines": np.array(dup), "n_lines": np.array(many), "n_repeat_words": np.array(repeats)}


def _features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics in [0, 1) that don't grow with the text's length, a row per text.

    Each is a share, scaled so that an unusual one is large, and drawn towards its
    usual value in short texts.
    """

    def share(count: str, of: str, more: float, usual: float, scale: float) -> np.ndarray:
        return scale * (c[count] + more * usual) / (c[of] + more)

    columns = [
        share("n_symbols", "word_chars", 20, 0, 8),
        share("n_upper", "n_letters", 60, 0.03, 1),
        share("n_marks", "word_chars", 50, 0, 8),
        share("n_follow_words", "n_words", 20, 0, 2),
        share("n_repeat_words", "n_words", 20, 0, 1),
        share("n_dup_lines", "n_lines", 5, 0, 1),
        share("n_digits", "word_chars", 50, 0, 2),
        share("word_chars", "n_words", 20, 5, 0.05),
    ]
    return np.clip(np.stack(columns, axis=1), 0, 1 - 1e-9)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.slices(batch):
            counts = _counts(texts)
            columns = [batch.column(batch.schema.get_field_index(c)).slice(texts.first, len(texts)) for c in ("row", "id")]
            columns += [pa.array(np.asarray(counts[c], dtype=np.int64)) for c in COUNTS]
            columns.append(pa.array(list(_features(counts)), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", *COUNTS, "features"])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (a hash of the text), ``id``, the counts and the ``features``; written once."""
    text = docs.select(F.xxhash64(text_col).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"{c} long" for c in COUNTS)
    id_type = text.schema["id"].dataType.simpleString()
    return stage(text.mapInArrow(_measure, f"row long, id {id_type}, {counts}, features array<double>"), "statistics")


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _expected(n: np.ndarray | float) -> np.ndarray:
    """The mean path length of an unsuccessful search among n rows."""
    n = np.maximum(np.asarray(n, dtype=float), 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def _grow(tree: pd.DataFrame) -> pd.DataFrame:
    """One tree as rows: node, feature (-1 for a leaf), cut, and the path length a leaf stands for."""
    rows = np.stack(tree.sort_values("row")["features"].to_list())
    rng = np.random.default_rng(int(tree["tree"].iloc[0]))
    many = rows.shape[1]
    out, todo = [], [(1, np.arange(len(rows)), 0, np.zeros(many), np.ones(many))]
    while todo:
        node, own, depth, low, high = todo.pop()
        if depth == DEPTH or len(own) < 2:
            out.append((node, -1, 0.0, depth + float(_expected(len(own)))))
            continue
        feature = int(rng.integers(many))
        cut = float(rng.uniform(low[feature], high[feature]))
        out.append((node, feature, cut, 0.0))
        left, at = rows[own, feature] < cut, np.arange(many) == feature
        todo.append((2 * node, own[left], depth + 1, low, np.where(at, cut, high)))
        todo.append((2 * node + 1, own[~left], depth + 1, np.where(at, cut, low), high))
    return pd.DataFrame(out, columns=["node", "feature", "cut", "path"]).assign(tree=tree["tree"].iloc[0])


def _marks(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label) with one label of 0 or 1 per id; of contradicting ones the smaller."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    return marks.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg(F.min("label").alias("label"))


def _drawn(rows: DataFrame) -> DataFrame:
    """(row, features, tree): the texts that each tree is grown on.

    The TREES * TREE_ROWS distinct texts with the smallest hashes are the sample. Each
    tree takes its TREE_ROWS from it by hashes of its own, so trees may share texts.
    """
    sample = stage(rows.select("row", "features").dropDuplicates(["row"]).orderBy("row").limit(TREES * TREE_ROWS), "sample")
    dealt = sample.select("row", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    own = Window.partitionBy("tree").orderBy(F.xxhash64("row", "tree"), "row")
    dealt = dealt.withColumn("r", F.row_number().over(own)).where(F.col("r") <= TREE_ROWS).drop("r")
    return dealt.join(sample, "row")


Forest = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def grow_forest(stats: DataFrame, marks: DataFrame) -> Forest:
    """TREES trees, each grown on TREE_ROWS of the texts labelled good, or on all if there are fewer.

    At most TREES * 2^(DEPTH + 1) nodes reach the driver, whatever the input.
    Texts that the base rules fail take no part. Without a row labelled good, all
    rows are drawn from.
    """
    passed = stats.where(~base_failed()).select("id", F.xxhash64("row", F.lit(7)).alias("row"), "features")
    for rows in (passed.join(marks.where("label = 1"), "id", "left_semi"), passed):
        nodes = _drawn(rows).groupBy("tree").applyInPandas(_grow, "node int, feature int, cut double, path double, tree int")
        grown = nodes.toPandas()
        if len(grown):
            break
    forest = []
    for _, tree in grown.groupby("tree", sort=True):
        feature, cut, path = np.full(4 << DEPTH, -1), np.zeros(4 << DEPTH), np.zeros(4 << DEPTH)
        at = tree["node"].to_numpy()
        feature[at], cut[at], path[at] = tree["feature"], tree["cut"], tree["path"]
        forest.append((feature, cut, path))
    return forest


def path_lengths(rows: np.ndarray, forest: Forest) -> np.ndarray:
    """The mean path length of each row, as a share of the longest; 1 without a forest."""
    if not forest:
        return np.ones(len(rows))
    total = np.zeros(len(rows))
    for feature, cut, path in forest:
        node = np.ones(len(rows), dtype=np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            right = rows[np.arange(len(rows)), np.maximum(f, 0)] >= cut[node]
            node = np.where(f >= 0, 2 * node + right, node)
        total += path[node]
    return total / len(forest) / (DEPTH + float(_expected(2 * TREE_ROWS)))


def _score(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("features")
        flat = batch.column(at).flatten().to_numpy(zero_copy_only=False)
        depth = path_lengths(flat.reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 1)), forest)
        names = [n for n in batch.schema.names if n != "features"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(depth)], names=[*names, "depth"])


def threshold(scored: DataFrame, marks: DataFrame) -> float:
    """The path length below which a text is rejected, from the labelled rows; 0 without good and bad ones.

    Counts per bin of path length are aggregated over all labelled rows that pass
    the base rules. Of the bin borders that lose at most MOST_LOST of the good
    rows, the one with the most bad rows beyond it wins, the lowest among equals.
    """
    bin_ = F.floor(F.least(F.col("depth"), F.lit(1 - 1e-9)) * BINS).cast("int")
    counts = scored.where(~base_failed()).join(marks, "id").groupBy(bin_.alias("bin")).agg(
        F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")
    )
    table = counts.toPandas()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    good[table["bin"]], bad[table["bin"]] = table["good"], table["bad"]
    lost, caught = np.cumsum(good), np.cumsum(bad)
    allowed = np.flatnonzero(lost <= MOST_LOST * lost[-1])
    if not lost[-1] or not len(allowed) or not caught[allowed].max():
        return 0.0
    return float(allowed[caught[allowed].argmax()] + 1) / BINS


def _fit(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> tuple[DataFrame, Forest, float]:
    """The rows with their path lengths, the forest and the threshold."""
    marks = stage(_marks(labels, id_col, label_col), "marks")
    forest = grow_forest(stats, marks)
    id_type = stats.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    scored = stats.mapInArrow(partial(_score, forest=forest), f"row long, id {id_type}, {counts}, depth double")
    scored = stage(scored, "scored")
    return scored, forest, threshold(scored, marks)


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """Per row of ``docs``: ``row`` (hash of the text), id, the counts, ``depth``, ``base_failed`` and ``kept``.

    A null text has no words and fails the base rules. Rows that repeat are judged
    alike. Labels that are null, doubled (the smallest counts) or for no row do no
    harm; without rows labelled good and bad only the base rules reject. Other columns of
    ``docs`` are ignored, whatever their names.
    """
    scored, _, least = _fit(statistics(docs, id_col, text_col), labels, id_col, label_col)
    failed = base_failed()
    out = scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("depth") >= least))
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def _keep(batches: Iterator[pa.RecordBatch], text_col: str, forest: Forest, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.slices(batch, text_col):
            c = _counts(texts)
            good = (c["n_words"] >= 20) & (100 * c["n_repeat_words"] <= 30 * c["n_words"])
            good &= path_lengths(_features(c), forest) >= least
            yield batch.slice(texts.first, len(texts)).filter(pa.array(good))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; the same verdicts as ``judge``.

    The texts are measured again rather than shuffled to meet their verdicts.
    """
    _, forest, least = _fit(statistics(docs, id_col, text_col), labels, id_col, label_col)
    return docs.mapInArrow(partial(_keep, text_col=text_col, forest=forest, least=least), docs.schema)
