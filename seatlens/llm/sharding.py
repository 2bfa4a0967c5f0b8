"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

*Permute locally.* Rows are written once, every partition in the order of a random
key. A partition is taken in chunks of at most CHUNK consecutive rows.

*Matrix.* How many rows of each chunk go to each shard is drawn exactly as a uniform
shuffle of all rows would deal them: chunks by shards, with the chunks' sizes and the
shards' sizes as sums. It is drawn along a tree over the chunks, FAN nodes by one
parent, multivariate hypergeometric at every step, so each task draws a small piece
and no process sees the whole matrix. The first rows of a chunk go to the first
shard, and so on; their order is random, so each such deal is equally likely.

*Exchange and permute again.* A shard's rows are dealt over slices of their random
key, ordered by it within the slice, and numbered slice after slice. Slots are thus
a uniform permutation, and a slice has a bounded number of rows.

All draws come from the seed and the place of a row in the written table: a task that
is run again draws the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.session import broadcast_if_small, stage

#: Rows of a chunk and of a slice of a shard, at most (a slice: about).
CHUNK, SLICE = 1 << 20, 1 << 14
#: Nodes that are drawn together, as a power of two.
FAN = 8
#: Populations up to which numpy draws; larger ones are drawn here.
_NUMPY_MOST = 10**9 - 1


def _large_draw(good: int, bad: int, many: int, rng: np.random.Generator) -> int:
    """One hypergeometric number of any size, by inversion around the mode.

    Probabilities are followed from the mode by their ratios as far as they matter
    to a double; the work grows with the standard deviation.
    """
    low, high = max(0, many - bad), min(good, many)
    if low == high:
        return low
    mode = min(max((good + 1) * (many + 1) // (good + bad + 2), low), high)
    total = good + bad
    deviation = (many * (good / total) * (bad / total) * max(total - many, 1) / max(total - 1, 1)) ** 0.5
    reach = int(40 + 12 * deviation)
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    up = (good - up) / (up + 1) * ((many - up) / (bad - many + up + 1))
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    down = down / (good - down + 1) * ((bad - many + down) / (many - down + 1))
    weight = np.concatenate([np.cumprod(down)[::-1], [1.0], np.cumprod(up)])
    reached = np.cumsum(weight)
    return mode - len(down) + int(np.searchsorted(reached, rng.random() * reached[-1], side="right"))


def _draw_one(sizes: np.ndarray, many: int, rng: np.random.Generator) -> np.ndarray:
    """How a uniform sample of ``many`` rows, without replacement, falls on parts of these sizes."""
    rest, out = int(sizes.sum()), np.zeros(len(sizes), dtype=np.int64)
    if rest <= _NUMPY_MOST:
        return rng.multivariate_hypergeometric(sizes, many, method="marginals")
    for i, size in enumerate(sizes.tolist()):
        if not many:
            break
        rest -= size
        if size + rest <= _NUMPY_MOST:
            out[i:] = rng.multivariate_hypergeometric(sizes[i:], many, method="marginals")
            break
        out[i] = many if not rest else _large_draw(size, rest, many, rng)
        many -= int(out[i])
    return out


def draw_matrix(rows: np.ndarray, columns: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A matrix with these sums of rows and columns, as a uniform shuffle deals them."""
    left, out = columns.astype(np.int64), np.zeros((len(rows), len(columns)), dtype=np.int64)
    for i, many in enumerate(rows.tolist()):
        out[i] = _draw_one(left, many, rng)
        left = left - out[i]
    return out


def _drawing(seed: int, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Draws the deals of one parent's children; its own come with each of them."""

    def draw(family: pd.DataFrame) -> pd.DataFrame:
        family = family.sort_values("node")
        rng = np.random.default_rng([seed, level, int(family["parent"].iloc[0])])
        drawn = draw_matrix(family["rows"].to_numpy(), np.array(family["parent_deal"].iloc[0]), rng)
        return pd.DataFrame({"node": family["node"], "deal": list(drawn)})

    return draw


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most, the larger ones first."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def deal_chunks(chunks: DataFrame, shards: int, seed: int) -> DataFrame:
    """(node, deal): per chunk the rows it sends to each shard; ``chunks`` has node (a long of 0 or more) and rows."""
    spark = chunks.sparkSession
    facts = chunks.agg(F.max("node").alias("last"), F.sum("rows").alias("rows")).first()
    levels = max(1, -(-int(facts.last or 0).bit_length() // FAN))
    sizes = ", ".join(f"{n}L" for n in shard_sizes(int(facts.rows or 0), shards))
    deals = spark.range(1).select(F.col("id").alias("node"), F.expr(f"array({sizes})").alias("deal"))
    for level in range(levels - 1, -1, -1):
        of = lambda bits: F.shiftright("node", bits) if bits < 63 else F.lit(0).cast("long")
        nodes = chunks.groupBy(of(FAN * level).alias("node"), of(FAN * (level + 1)).alias("parent")).agg(F.sum("rows").alias("rows"))
        known = deals.select(F.col("node").alias("parent"), F.col("deal").alias("parent_deal"))
        family = nodes.join(known, "parent")
        deals = stage(family.groupBy("parent").applyInPandas(_drawing(seed, level), "node long, deal array<long>"), f"deal-{level}")
    return deals


def shuffle_into_shards(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """``docs`` with ``shard`` (0 up to ``shards`` - 1) and ``slot`` (0, 1, 2, … in its shard).

    Every assignment of rows to slots is equally likely (as far as the seed's draws
    are random). Shards' row counts differ by one at most. All columns are kept; ones
    named ``shard`` or ``slot`` are replaced. Rows are dealt whatever they hold, nulls
    and repeated rows included. Fewer rows than shards leave shards empty; an empty
    table gives an empty one. The same table in the same partitions gets the same
    shards; the rows are written once before anything is drawn, so a task that is run
    again changes nothing.
    """
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")  # own names can't clash with it
    placed = docs.select(row, F.monotonically_increasing_id().alias("at"))
    mixed = placed.withColumn("key", F.xxhash64("at", F.lit(seed))).sortWithinPartitions("key", "at").drop("at", "key")
    place = F.monotonically_increasing_id()
    written = stage(mixed.withColumn("at", place), "permuted")

    bits = CHUNK.bit_length() - 1
    chunk = F.shiftright("at", bits)
    chunks = stage(written.groupBy(chunk.alias("node")).agg(F.count("*").alias("rows")), "chunks")
    deals = deal_chunks(chunks, shards, seed)
    # ends[i]: the rows of a chunk that go to shards up to i
    ends = F.transform("deal", lambda _, i: F.aggregate(F.slice("deal", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
    ends = stage(deals.select(F.col("node").alias("chunk"), ends.alias("ends")), "ends")
    rank = F.col("at") % CHUNK
    dealt = written.withColumn("chunk", chunk).join(broadcast_if_small(ends), "chunk")
    dealt = dealt.select(
        "row",
        F.size(F.filter("ends", lambda e: e <= rank)).alias("shard"),
        F.xxhash64("at", F.lit(seed + 1)).alias("key"),
        "at",
    )
    return _numbered(dealt, deals, shards, chunks).select(*[F.col("row")[c].alias(c) for c in names], "shard", "slot")


def _numbered(dealt: DataFrame, deals: DataFrame, shards: int, chunks: DataFrame) -> DataFrame:
    """``dealt`` (shard, key, at and more) with slot: its row's place among its shard's in the order of keys."""
    total = chunks.agg(F.sum("rows")).first()[0] or 0
    slices = max(1, -(-total // shards // SLICE))
    # keys are uniform: equal ranges of them hold about as many rows
    part: Column = F.floor(F.pmod(F.shiftrightunsigned("key", 33), F.lit(1 << 31)) * slices / (1 << 31)).cast("int")
    order = Window.partitionBy("shard", "part").orderBy(F.shiftrightunsigned("key", 33), "key", "at")
    sliced = dealt.withColumn("part", part)
    sizes = stage(sliced.groupBy("shard", "part").agg(F.count("*").alias("rows")), "slices")
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", "part", F.coalesce(before, F.lit(0)).alias("before"))
    offsets = stage(offsets, "offsets")
    numbered = sliced.withColumn("own", F.row_number().over(order))
    return numbered.join(broadcast_if_small(offsets), ["shard", "part"]).withColumn("slot", F.col("before") + F.col("own") - 1)


def write_shards(docs: DataFrame, folder: str, shards: int = 40, seed: int = 7) -> None:
    """Write the shards as Parquet folders ``shard=0`` … below ``folder``, files in the order of slots."""
    placed = shuffle_into_shards(docs, shards, seed)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def shard_digests(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    A null text has no bytes. The law is ``rows``: counts of rows differ by one at most.
    """
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    placed = shuffle_into_shards(docs.select(F.col(id_col).alias("id"), text.alias("bytes")), shards)
    return placed.select(
        F.col("id").alias(id_col),
        (F.octet_length("bytes") + 16).cast("long").alias("size"),
        F.crc32("bytes").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
