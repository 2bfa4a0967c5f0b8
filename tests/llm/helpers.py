"""Rows that every operator must bear, and plain versions of what the operators count."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of their input.
CLASHES = ["id", "node", "label", "key", "row", "text_hash", "kind", "spans", "score", "features", "sequence", "start"]

PROSE = "the quick brown fox jumps over a lazy dog while seven grey geese fly north along the cold river bank today"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t \r\n", None, "a", 5),
    (4, PROSE, "en", "a", len(PROSE)),
    (5, PROSE, "en", "b", len(PROSE)),
    (5, PROSE, "en", "b", len(PROSE)),
    (6, PROSE.upper(), None, None, None),
    (7, LONG, "en", "a", len(LONG)),
    (8, "é😀 ß́ \x1c中文 x", "de", "c", 3),
    (None, PROSE + " and then some more", "en", "a", None),
    (None, None, None, None, None),
    (9, "x" * 50_000, "fr", "a", 50_000),
    (10, "a b", "fr", "a", 3),
]


def odd_docs(spark, clashes: bool = False):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, DOCS).repartition(3)
    return docs.select("*", *[F.lit(7).alias(c) for c in CLASHES]) if clashes else docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=((4, 1, 0), (4, 0, 0), (8, 0, 1), (10, 0, None), (None, 1, 1), (77, 1, 0), (9, None, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text: str | None, size: int) -> set:
    own = [w.encode().lower() for w in words(text)]  # bytes lower-case A-Z only
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def linked(a: set, b: set, percent: int) -> bool:
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def component_labels(sets: list[set], percent: int) -> list[int]:
    """For each set the index of the first set of its component."""
    label = list(range(len(sets)))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if root(i) != root(j) and linked(a, sets[j], percent):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return [root(i) for i in range(len(sets))]
