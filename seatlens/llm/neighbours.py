"""Quality classifier: votes of the nearest labelled texts in a latent-semantic space.

A text is the bag of its byte trigrams, hashed into DIMENSIONS counts, together with
two terms of their own, a word that repeats the one before and a symbol; counts are
square-rooted, weighted by inverse document frequency and reduced to RANK latent
dimensions by a singular value decomposition of the labelled sample. The labelled vectors are
broadcast; every document is compared with all of them in exact, blocked cosine
products, and its NEIGHBOURS closest ones vote with their similarity.

The sample has at most SAMPLE rows, so the model and everything that is broadcast
or reaches the driver has a fixed size, whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.llm import words as W
from seatlens.session import stage

#: Labelled rows in the sample, half of them of either label where there are enough.
SAMPLE = 4096
DIMENSIONS, RANK, NEIGHBOURS = 4096, 64, 15
#: The terms beside the trigrams, and how many trigrams one of them counts for.
TERMS, TERM_WEIGHT = 2, 25
#: Repeated words that ordinary prose may have by chance and that don't count.
CHANCE = 2
#: The vote of the labels' overall share, as a number of identical neighbours.
PRIOR_VOTE = 0.5
#: A score of this or more predicts label 1.
CUT = 0.7
#: Parts the sample's counts are summed in, and rounds of the decomposition.
CHUNKS, ROUNDS = 16, 4
#: Texts whose counts and similarities are held at once.
BLOCK = 128


class Model(NamedTuple):
    projection: np.ndarray  # (DIMENSIONS + TERMS) x rank, with the inverse document frequencies
    vectors: np.ndarray  # sample x rank, of length one or zero
    labels: np.ndarray
    weights: np.ndarray  # a vote's weight: the label's share of all labels over its share of the sample
    prior: float  # the share of label 1


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the checksum of the id's text leaves the remainder ``fold``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>{}=~^_")] = True


def _bags(texts: W.Texts) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts) for blocks of the slice's texts."""
    data, at = texts.data, texts.offsets
    with np.errstate(over="ignore"):
        wide = data.astype(np.uint32)
        code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) if len(data) > 2 else np.empty(0, np.uint32)
        code = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64) % DIMENSIONS
    words = W.words(texts)
    hashed = W.hashes(data, words.start, words.end)
    follows, symbols = np.append(False, hashed[1:] == hashed[:-1]), _SYMBOL[data]
    for lo in range(0, len(texts), BLOCK):
        hi = min(len(texts), lo + BLOCK)
        counts = np.zeros((hi - lo, DIMENSIONS + TERMS), dtype=np.float32)
        for i in range(lo, hi):
            own = code[at[i] : max(at[i], at[i + 1] - 2)]
            counts[i - lo, :DIMENSIONS] = np.bincount(own, minlength=DIMENSIONS)
            repeats = np.count_nonzero(follows[words.first[i] + 1 : words.first[i + 1]])
            counts[i - lo, DIMENSIONS:] = max(0, repeats - CHANCE), np.count_nonzero(symbols[at[i] : at[i + 1]])
        counts[:, DIMENSIONS:] *= TERM_WEIGHT
        yield lo, counts


def _weighted(counts: np.ndarray) -> np.ndarray:
    out = np.sqrt(counts)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.where(norm > 1e-9, vectors / np.where(norm > 1e-9, norm, 1), 0).astype(np.float32)


def _sample_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "label")]
        for texts in W.slices(batch):
            for lo, counts in _bags(texts):
                bags = pa.array([c.tobytes() for c in counts], pa.binary())
                own = [c.slice(texts.first + lo, len(counts)) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, bags], names=["id", "label", "bag"])


def training_rows(labels: DataFrame, id_col: str, label_col: str, learn: Column) -> tuple[DataFrame, float]:
    """At most SAMPLE (id, label) rows, those with the smallest hashes of either label; and the share of label 1.

    Null ids and labels other than 0 and 1 don't count; of an id's contradicting
    labels the smaller does.
    """
    usable = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    share = usable.agg(F.avg("label")).first()[0]
    halves = [
        usable.where(F.col("label") == y).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(SAMPLE // 2) for y in (0, 1)
    ]
    return halves[0].union(halves[1]), 0.5 if share is None else float(share)


def _by_chunk(bags: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(chunk, made): what ``work`` makes of the counts of each chunk.

    A chunk's rows are put in order first, so the results don't depend on how
    Spark has dealt them.
    """

    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        counts = np.frombuffer(b"".join(chunk.sort_values("id")["bag"]), np.float32)
        made = work(counts.reshape(-1, DIMENSIONS + TERMS))
        return pd.DataFrame({"chunk": chunk["chunk"].iloc[:1], "made": [made.astype(np.float32).tobytes()]})

    return bags.groupBy("chunk").applyInPandas(run, "chunk int, made binary")


def _placed(made: DataFrame) -> np.ndarray:
    """The chunks' results, one after another."""
    rows = sorted(made.collect(), key=lambda r: r.chunk)
    return np.concatenate([np.frombuffer(r.made, np.float32) for r in rows])


def _summed(made: DataFrame) -> np.ndarray:
    """The sum of the chunks' results, in chunk order; it is all that reaches the driver."""

    def add(chunks: pd.DataFrame) -> pd.DataFrame:
        total = 0.0
        for part in chunks.sort_values("chunk")["made"]:
            total = total + np.frombuffer(part, np.float32).astype(np.float64)
        return pd.DataFrame({"total": [total.tobytes()]})

    total = made.groupBy().applyInPandas(add, "total binary").first().total  # CHUNKS rows of a fixed size
    return np.frombuffer(total, np.float64)


def fit(docs: DataFrame, sample: DataFrame, prior: float, id_col: str, text_col: str) -> Model:
    """The model of a sample of labelled rows.

    Of several texts with one labelled id, the one with the smallest hash is learnt from.
    The sample's counts stay in Spark: inverse document frequencies and each step
    of the subspace iteration are sums over chunks, so the driver holds a few
    arrays of DIMENSIONS by RANK numbers.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    id_type = rows.schema["id"].dataType.simpleString()
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"), "text"))  # of an id's texts
    once = rows.withColumn("first", first).where("first = 1").drop("first")
    bags = once.mapInArrow(_sample_bags, f"id {id_type}, label int, bag binary")
    bags = stage(bags.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(CHUNKS)).cast("int")), "bags")
    labels = [r.label for r in bags.select("chunk", "id", "label").orderBy("chunk", "id").collect()]
    if not labels:
        nothing = np.empty((0, 0), np.float32)
        return Model(nothing, nothing, np.empty(0), np.empty(0), prior)

    width, rank = DIMENSIONS + TERMS, min(RANK, len(labels))
    held = _summed(_by_chunk(bags, lambda counts: (counts > 0).sum(axis=0)))
    idf = (np.log((1 + len(labels)) / (1 + held)) + 1).astype(np.float32)
    basis = np.random.default_rng(5).standard_normal((width, rank + 16)).astype(np.float32)
    for _ in range(ROUNDS):  # subspace iteration towards the leading right singular vectors

        def turned(counts: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
            matrix = _weighted(counts) * idf
            return matrix.T @ (matrix @ basis)

        total = _summed(_by_chunk(bags, turned)).reshape(width, -1)
        basis = np.linalg.qr(total)[0].astype(np.float32)
    placed = _placed(_by_chunk(bags, lambda counts: (_weighted(counts) * idf) @ basis)).reshape(len(labels), -1)
    _, _, right = np.linalg.svd(placed.astype(np.float64), full_matrices=False)
    turn = right[:rank].T.astype(np.float32)
    marks = np.array(labels, dtype=np.float32)
    share = float(marks.mean())
    weight = np.where(marks > 0, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9)).astype(np.float32)
    return Model((basis @ turn) * idf[:, None], _unit(placed @ turn), marks, weight, prior)


def _vote(counts: np.ndarray, model: Model) -> np.ndarray:
    """The score of each text: its closest labelled texts' labels, weighted by cosine."""
    if not len(model.vectors):
        return np.full(len(counts), model.prior)
    cosine = _unit(_weighted(counts) @ model.projection) @ model.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 4 * model.weights[near]
    votes = (weight * model.labels[near]).sum(axis=1) + PRIOR_VOTE * model.prior
    return votes / (weight.sum(axis=1) + PRIOR_VOTE)


def _scores(batch: pa.RecordBatch, text_col: str, model: Model) -> np.ndarray:
    out = [np.clip(_vote(counts, model), 0, 1) for texts in W.slices(batch, text_col) for _, counts in _bags(texts)]
    return np.concatenate(out) if out else np.empty(0)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(_scores(batch, "text", model))], names=[*kept, "score"]
        )


def _keep(batches: Iterator[pa.RecordBatch], text_col: str, model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.slices(batch, text_col):
            good = np.concatenate([np.clip(_vote(counts, model), 0, 1) for _, counts in _bags(texts)]) >= CUT
            yield batch.slice(texts.first, len(texts)).filter(pa.array(good))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column | None
) -> Model:
    sample, prior = training_rows(labels, id_col, label_col, F.lit(True) if learn is None else learn)
    return fit(docs, sample, prior, id_col, text_col)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learn: Column | None = None,
) -> DataFrame:
    """Per row of ``docs``: id, ``score`` in 0..1 and ``predicted`` (score >= CUT).

    ``learn`` is a condition on the labels' id column that says which may be learnt
    from. A null, empty or very short text has no trigrams and gets the share of
    label 1, as every text does without labels. Equal texts get equal scores.
    Other columns are ignored, whatever their names.
    """
    model = train(docs, labels, id_col, text_col, label_col, learn)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    scored = texts.mapInArrow(partial(_score, model=model), f"id {id_type}, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_predicted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learn: Column | None = None,
) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts label 1 for, with all their columns."""
    model = train(docs, labels, id_col, text_col, label_col, learn)
    return docs.mapInArrow(partial(_keep, text_col=text_col, model=model), docs.schema)
