"""Language identification by rank-order profiles.

An n-gram is one to MOST_BYTES bytes of the lower-cased text with every run of
characters other than letters read as one space, so n-grams know where words
begin and end. A language's profile is the PROFILE most frequent n-grams of all
its training texts, counted over the whole corpus. A document's most frequent
n-grams, DOCUMENT of them, are compared with each profile by the out-of-place
distance: how many ranks apart the two have an n-gram, and PROFILE for one that
the profile lacks. The closest language wins, the first by name among equals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.llm import words as W

MOST_BYTES = 3
PROFILE = 400
DOCUMENT = 300
UNKNOWN = "und"

_LETTER = r"\p{L}"
_SPACE = 32


def _grams(text: np.ndarray) -> np.ndarray:
    """All n-grams of one text as numbers; their length is in the highest byte."""
    wide = text.astype(np.uint32)
    out = [wide | np.uint32(1 << 24)]
    if len(wide) > 1:
        out.append(wide[:-1] << 8 | wide[1:] | np.uint32(2 << 24))
    if len(wide) > 2:
        out.append(wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:] | np.uint32(3 << 24))
    joined = np.concatenate(out)
    return joined[joined != (1 << 24 | _SPACE)]


def _counted(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(_grams(text))
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, np.int64)
    return grams[first], np.diff(np.append(first, len(grams)))


def _letters(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The texts as bytes: lower case, a space for each run without letters, and one at either end."""
    at = batch.schema.get_field_index("text")
    for texts in W.slices(batch):
        sub = pc.fill_null(batch.column(at).slice(texts.first, len(texts)), "")
        plain = pc.utf8_lower(pc.replace_substring_regex(sub, r"[^\p{L}]+", " "))
        for value in pc.binary_join_element_wise("", pc.utf8_trim(plain, " "), "", " "):
            yield np.frombuffer(value.as_buffer(), np.uint8)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts per language, summed over a batch; an n-gram is three bytes at most."""
    for batch in batches:
        languages = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        parts: dict[str, list[np.ndarray]] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for language, text in zip(languages, _letters(batch), strict=True):
            parts.setdefault(language, []).append(text)
            if sum(map(len, parts[language])) > W.SLICE_BYTES:
                held[language] = _added(held.get(language), parts.pop(language))
        for language, texts in parts.items():
            held[language] = _added(held.get(language), texts)
        for language, (grams, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )


def _added(held: tuple[np.ndarray, np.ndarray] | None, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of some texts, none reaching into the next, added to the ones held."""
    grams = np.sort(np.concatenate([_grams(t) for t in texts]))
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, np.int64)
    values, counts = grams[first], np.diff(np.append(first, len(grams)))
    if held is None:
        return values, counts
    both = np.concatenate([held[0], values])
    unique, place = np.unique(both, return_inverse=True)
    return unique, np.bincount(place, weights=np.concatenate([held[1], counts])).astype(np.int64)


def profiles(training: DataFrame) -> dict[str, np.ndarray]:
    """Per language its PROFILE most frequent n-grams, most frequent first, from (lang, text) rows.

    Counts are summed in the tasks, then per language and n-gram; only the ranked
    PROFILE rows of each language reach the driver. Ties go to the smaller n-gram.
    """
    counts = training.mapInArrow(_tally, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE)
    table = top.select("lang", "gram", "rank").toPandas().sort_values(["lang", "rank"])
    return {language: own["gram"].to_numpy().astype(np.uint32) for language, own in table.groupby("lang", sort=True)}


class _Ranks:
    """The profiles as one sorted table of n-grams with a rank per language."""

    def __init__(self, learned: dict[str, np.ndarray]) -> None:
        self.names = list(learned)
        self.grams = np.unique(np.concatenate(list(learned.values()))) if learned else np.empty(0, np.uint32)
        self.ranks = np.full((len(self.names), len(self.grams) + 1), -1, dtype=np.int64)
        for i, own in enumerate(learned.values()):
            self.ranks[i, np.searchsorted(self.grams, own)] = np.arange(len(own))

    def closest(self, text: np.ndarray) -> tuple[str, float]:
        grams, counts = _counted(text)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        top = np.argsort(-counts, kind="stable")[:DOCUMENT]  # grams are sorted, so ties go to the smaller one
        grams = grams[top]
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        place = np.where(self.grams[place] == grams, place, len(self.grams))
        ranks = self.ranks[:, place]
        apart = np.where(ranks < 0, PROFILE, np.minimum(np.abs(ranks - np.arange(len(grams))), PROFILE))
        distance = apart.sum(axis=1)
        best = int(distance.argmin())
        return self.names[best], 1.0 - float(distance[best]) / (PROFILE * len(grams))


def _identify(batches: Iterator[pa.RecordBatch], learned: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    ranks = _Ranks(learned)
    for batch in batches:
        found = [ranks.closest(t) if len(t) > 2 else (UNKNOWN, 0.0) for t in _letters(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("id")),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ],
            names=["id", "lang_pred", "score"],
        )


def identify(
    docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Per row of ``docs``: id, ``lang_pred`` and ``score``, one less the distance as a share of the largest.

    Profiles are learnt from all rows with a language for which ``learn`` holds. A
    null text, one without a letter, and every text if nothing could be learnt get
    ``und`` and 0. Equal texts get equal answers. Other columns are ignored.
    """
    training = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    training = training.where(F.lit(True) if learn is None else learn)
    learned = profiles(training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    found = texts.mapInArrow(partial(_identify, learned=learned), f"id {id_type}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)
