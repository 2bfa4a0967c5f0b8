"""Secrets: pattern matches, judged by who owns them across the whole corpus.

Every candidate's value is hashed and counted over the corpus by distinct
repositories and distinct owners. A value that many owners carry, or many
repositories even of one owner, is a copied example; one that a single owner has in
a few repositories is likely to be live. Besides the base patterns, long mixed
tokens are candidates too; they are added when their value looks random and live.

Only DataFrame functions run. The texts are scanned once; the counts are
aggregated before they are shuffled, whatever share of rows one value has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatlens.llm import spans as S
from seatlens.session import stage

KINDS = ["assign", "access", "hex"]

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*+[:=]\x20*+[\x22']?([A-Za-z0-9+/_.=-]++)"
)
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

PATTERNS = [
    S.Pattern("assign", ASSIGN, r"(?i:passw|secret|token|api_?key)"),
    S.Pattern("access", ACCESS, "AKIA"),
    S.Pattern("hex", HEX, "[0-9a-f]{24}"),
    S.Pattern("token", TOKEN, "[A-Za-z0-9+/_-]{20}"),
]

#: A value of this many distinct owners, or of this many distinct repositories, or more is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 20


def _value(kind: Column, hit: Column) -> Column:
    return F.when(kind == "assign", F.regexp_extract(hit, ASSIGN, 1)).otherwise(hit)


def _kept(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern is long enough, or a token mixed enough."""
    size = F.char_length(value)
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9].*[0-9]")
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 12
    return (
        F.when(kind == "assign", size >= 6)
        .when(kind == "access", size >= 20)
        .when(kind == "hex", size >= 24)
        .otherwise(mixed & varied)
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, repositories, owners, verdict) over all candidates; nulls are no owner of their own."""
    counts = candidates.groupBy("value_hash").agg(
        F.count_distinct("repository").alias("repositories"), F.count_distinct("owner").alias("owners")
    )
    widely = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    verdict = F.when(widely, "example").when(F.col("owners") <= 1, "live").otherwise("shared")
    return counts.withColumn("verdict", verdict)


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The rows (id, text_hash), and their spans (id, text_hash, kind, start, end, value_hash,
    repositories, owners, verdict, base).

    A document is a repository and its source the owner unless told otherwise. A
    null text is empty. Equal rows of ``docs`` appear once among the spans and as
    often as they occur among the rows. Added spans overlap no base span. Other
    columns are ignored, whatever their names.
    """
    more = (F.col(repository_col).alias("repository"), F.col(owner_col).alias("owner"))
    scanned = S.scan(S.keyed(docs, id_col, text_col, *more), PATTERNS)
    value = _value(F.col("kind"), F.col("hit"))
    found = S.positions(scanned).withColumn("value", value).where(_kept(F.col("kind"), F.col("value")))
    found = found.select(*S.ROW, "kind", "start", "end", F.sha2("value", 256).alias("value_hash"))
    found = stage(found, "candidates")
    row = [scanned[c].eqNullSafe(found[c]) for c in S.ROW]
    held = found.join(scanned, row[0] & row[1]).select("value_hash", "repository", "owner").distinct()
    judged = stage(ownership(held), "ownership")
    spans = found.join(judged, "value_hash")
    base = spans.where(F.col("kind").isin(KINDS)).withColumn("base", F.lit(True))
    added = spans.where((F.col("kind") == "token") & (F.col("verdict") == "live"))
    added = S.outside(added, base).withColumn("base", F.lit(False))
    return scanned.select(*S.ROW), base.unionByName(added)


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex of base spans, base_sha256, spans,
    and how many of its spans are live, shared or copied examples."""
    rows, spans = secret_spans(docs, id_col, text_col, id_col, owner_col)
    out = S.digests(rows, spans, KINDS, [*KINDS, "token"], by_kind=False)
    verdicts = ["live", "shared", "example"]
    judged = spans.groupBy(*S.ROW).agg(*[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in verdicts])
    both = out.join(judged, out["id"].eqNullSafe(judged["id"]) & (out["text_hash"] == judged["text_hash"]), "left")
    counts = [F.coalesce(judged[f"n_{v}"], F.lit(0)).cast("long").alias(f"n_{v}") for v in verdicts]
    kept = [out[c].alias(id_col if c == "id" else c) for c in out.columns if c != "text_hash"]
    return both.select(*kept, *counts)
