"""Spans of pattern matches in texts, with DataFrame functions only.

One pass over the texts writes, per row, what the patterns found; positions are
then summed up from the lengths between matches, so a text with very many
matches costs no more than its matches. Positions count code points, ends are
exclusive. Patterns must not match the empty string.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.session import stage


class Pattern(NamedTuple):
    kind: str
    regex: str  # Java syntax, no empty match
    guard: str  # cheap pattern that any text with a match contains
    context: int = 0  # characters kept on both sides, up to the next match; positions() goes on from there


#: What identifies a text row: its id and its text. Rows equal in both have equal spans.
ROW = ("id", "text_hash")


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, text_hash, text ('' for null) and further columns, under names of our own."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"), *more)


_FOUND = "array<struct<kind:string,n:int,gap:int,hit:string,left:string,right:string>>"


def _found(p: Pattern) -> Column:
    """What one pattern matched, from the split texts and the matches between them."""
    parts, hits = F.col(f"{p.kind}_parts"), F.col(f"{p.kind}_hits")
    many = F.greatest(F.size(hits), F.lit(1))
    rows = F.arrays_zip(hits.alias("hit"), F.slice(parts, 1, many).alias("before"), F.slice(parts, 2, many).alias("after"))
    return F.transform(
        F.filter(rows, lambda x: x["hit"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(p.kind).alias("kind"),
            i.alias("n"),
            F.char_length(x["before"]).alias("gap"),
            x["hit"].alias("hit"),
            F.right(x["before"], F.lit(p.context)).alias("left"),
            F.left(x["after"], F.lit(p.context)).alias("right"),
        ),
    )


def scan(texts: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """The rows without their texts, and ``found``, an array of what each pattern matched; written once."""
    kept = [c for c in texts.columns if c != "text"]
    split = []
    for p in patterns:
        here = F.col("text").rlike(p.guard)
        split.append(F.when(here, F.split("text", p.regex, -1)).alias(f"{p.kind}_parts"))
        split.append(F.when(here, F.regexp_extract_all("text", F.lit(p.regex), F.lit(0))).alias(f"{p.kind}_hits"))
    texts = texts.select(*kept, *split)
    arrays = [F.coalesce(_found(p), F.array().cast(_FOUND)) for p in patterns]
    return stage(texts.select(*kept, F.concat(*arrays).alias("found")), "found")


def positions(scanned: DataFrame, context: int = 0) -> DataFrame:
    """One row per match of each distinct row: id, text_hash, kind, start, end, hit, left, right.

    With ``context``, the patterns' own, ``left`` and ``right`` reach across the two matches
    before and behind: they are that many characters, or fewer that hold both those matches.
    """
    rows = scanned.where(F.size("found") > 0).dropDuplicates(list(ROW))
    each = rows.select(*ROW, F.explode("found").alias("f")).select(*ROW, "f.*")
    row = Window.partitionBy(*ROW, "kind").orderBy("n")
    size = F.char_length("hit")
    end = F.sum(F.col("gap") + size).over(row.rowsBetween(Window.unboundedPreceding, 0))
    left, right = F.col("left"), F.col("right")
    if context:
        each = each.withColumn("head", F.left("hit", F.lit(context))).withColumn("tail", F.right("hit", F.lit(context)))
        lag, lead = (lambda c, n, f=f: f(c, n).over(row) for f in (F.lag, F.lead))
        left = F.concat_ws("", lag("tail", 2), lag("left", 1), lag("tail", 1), "left")
        right = F.concat_ws("", "right", lead("head", 1), lead("right", 1), lead("head", 2))
        left, right = F.right(left, F.lit(context)), F.left(right, F.lit(context))
    return each.select(
        *ROW, "kind", (end - size).alias("start"), end.alias("end"), "hit", left.alias("left"), right.alias("right")
    )


def outside(spans: DataFrame, taken: DataFrame) -> DataFrame:
    """The spans that overlap none of ``taken`` in the same row; both have id, text_hash, start and end."""
    marked = spans.withColumn("taken", F.lit(False)).unionByName(
        taken.select(*ROW, "start", "end").withColumn("taken", F.lit(True)), allowMissingColumns=True
    )
    row = Window.partitionBy(*ROW).orderBy("start", F.col("taken").desc())
    reached = F.max(F.when(F.col("taken"), F.col("end"))).over(row.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("taken"), F.col("start"))).over(row.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("end"), F.lit(True))
    return marked.withColumn("free", free).where(~F.col("taken") & F.col("free")).drop("taken", "free")


def joined(spans: DataFrame, order: list[str], by_kind: bool) -> DataFrame:
    """Per row: ``spans``, ``base`` (kind:start:end, comma-joined) and a count per kind of base span.

    Base spans are those with ``base`` true. The text order is kind and start, or start and kind.
    """
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("kind"))
    first, second = (rank, F.col("start")) if by_kind else (F.col("start"), rank)
    text = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(first.alias("a"), second.alias("b"), F.col("end").alias("c"), text.alias("t"))
    line = lambda condition: F.array_join(
        F.transform(F.sort_array(F.collect_list(F.when(condition, entry))), lambda e: e["t"]), ","
    )
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in order]
    return spans.groupBy(*ROW).agg(line(F.col("base")).alias("base_spans"), line(F.lit(True)).alias("spans"), *counts)


def digests(rows: DataFrame, spans: DataFrame, kinds: list[str], order: list[str], by_kind: bool) -> DataFrame:
    """Every row with its counts, ``base_sha256`` and ``spans``; rows without a span have zeros and ''."""
    found = joined(spans, order, by_kind)
    both = rows.join(found, (rows["id"].eqNullSafe(found["id"])) & (rows["text_hash"] == found["text_hash"]), "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in kinds]
    base, every = F.coalesce("base_spans", F.lit("")), F.coalesce("spans", F.lit(""))
    return both.select(rows["id"], rows["text_hash"], *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))
