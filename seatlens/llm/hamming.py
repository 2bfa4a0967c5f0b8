"""Exact top-k search among binary codes by incremental multi-index hashing.

A code of BITS bits is cut into m segments; the index has one row per segment and
distinct code. If two codes are at most m * (r + 1) - 1 bits apart, they are at
most r bits apart in one segment at least (pigeonhole). A query looks its segments
up, then everything one bit away from them, then two, and so on: the probes of a
radius grow out of the previous radius's by flipping one bit more. Segments may
have different radii: what is at most sum(r + 1) - 1 bits away is found. Every
candidate is verified by its full distance. A query is done as soon as its kth
distance is covered, which proves that nothing closer is missed; in its last round
only as many segments grow as that takes.

Segments have somewhat less than log2(n) bits for n distinct codes, so a lookup
meets a few codes: a probe is a row that is shuffled, while a code that it meets
costs a bit count inside the join, which passes on only what is no farther than
the query's kth so far. Equal codes are one index row that keeps its k smallest
ids; more of them can't be in a top k.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.session import stage

BITS = 64


def sign_code(vector: Column) -> Column:
    """The signs of a vector's first BITS numbers as one long; missing and null ones count as not positive."""
    positive = F.transform(F.slice(vector, 1, BITS), lambda x: F.coalesce(x > 0, F.lit(False)))
    bits = F.transform(positive, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment, as even as can be."""
    at = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(at[:-1], at[1:], strict=True)]


def _segments(code: Column, cuts: list[tuple[int, int]]) -> Column:
    """An array of (segment, bits, value)."""
    mask = lambda bits: (1 << bits) - 1 if bits < BITS else -1
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("segment"),
                F.lit(bits).alias("bits"),
                F.shiftrightunsigned(code, first).bitwiseAND(F.lit(mask(bits)).cast("long")).alias("value"),
            )
            for i, (first, bits) in enumerate(cuts)
        ]
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k closest codes of each query, the ones with the smallest id among equals."""
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_codes(base: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, id, distance, rank): the k rows of ``base`` closest to each row of ``queries``.

    Both have ``id`` and ``code`` (a long of BITS bits). Ranks go by Hamming
    distance, then id; a query that is itself in ``base`` finds itself. Rows with
    a null id or code are ignored, on either side; queries that repeat count once,
    ids that repeat once per different code; a query of several codes is searched
    for by all of them. With fewer than k rows all are returned.
    """
    rows = base.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    order = Window.partitionBy("code").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    codes = stage(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    distinct, held = codes.agg(F.count("*"), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    want = queries.where("id IS NOT NULL AND code IS NOT NULL").select(F.col("id").alias("query_id"), "code").distinct()
    want = stage(want, "queries")

    segments = math.ceil(BITS / max(1, math.floor(math.log2(distinct + 1))))
    cuts = _cuts(segments)
    index = codes.select(F.explode(_segments(F.col("code"), cuts)).alias("s"), F.col("code").alias("near"), "ids")
    index = index.select("s.segment", "s.value", "near", "ids")

    need = min(k, held)
    probes = want.select("query_id", "code", F.explode(_segments(F.col("code"), cuts)).alias("s"))
    probes = probes.select("query_id", "code", "s.*", F.lit(BITS).alias("bound"), F.lit(0).alias("next"))
    probes = stage(probes, "probes")
    # ``covered``: the distance up to which the probes of this round leave nothing unseen.
    pending = want.select("query_id").distinct().withColumn("covered", F.lit(segments - 1))
    best, results = None, []
    for _ in range(max(bits for _, bits in cuts) + 1):
        apart = F.bit_count(F.col("code").bitwiseXOR(F.col("near"))).cast("int")
        same = (probes["segment"] == index["segment"]) & (probes["value"] == index["value"])
        met = probes.join(index, same & (apart <= F.col("bound")))
        met = met.select("query_id", "code", "near", "ids").distinct()
        found = met.select("query_id", F.explode("ids").alias("id"), apart.alias("distance"))
        if best is not None:
            found = found.union(best.select("query_id", "id", "distance")).distinct()
        best = stage(_best(found, k), "best")

        kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        known = F.coalesce(F.col("n") >= need, F.lit(False))
        state = pending.join(kth, "query_id", "left").withColumn("done", known & (F.col("kth") <= F.col("covered")))
        # Each segment that grows by one bit covers one bit of distance more.
        missing = F.when(known, F.least(F.col("kth") - F.col("covered"), F.lit(segments))).otherwise(segments)
        state = stage(state.withColumn("grow", missing), "state")
        results.append(best.join(state.where("done").select("query_id"), "query_id"))
        covered = (F.col("covered") + F.col("grow")).alias("covered")
        bound = F.when(known, F.col("kth")).otherwise(BITS).alias("bound")
        left = state.where("NOT done").select("query_id", "grow", bound, covered)
        if left.isEmpty():
            break
        pending = left.select("query_id", "covered")
        best = best.join(pending.select("query_id"), "query_id", "left_semi")
        grown = left.select("query_id", "grow", "bound")
        probes = probes.drop("bound").join(grown, "query_id").where("segment < grow AND next < bits")
        flip = F.explode(F.sequence("next", F.col("bits") - 1)).alias("bit")
        probes = probes.select("query_id", "code", "segment", "bits", "value", "bound", flip)
        flipped = F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
        probes = stage(
            probes.select(
                "query_id", "code", "segment", "bits", flipped.alias("value"), "bound", (F.col("bit") + 1).alias("next")
            ),
            "probes",
        )
    out = results[0]
    for part in results[1:]:
        out = out.union(part)
    return out.select("query_id", "id", "distance", "rank")
