"""Operator 12: exact sizes, nothing lost, and draws that are as likely as they should be."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatlens.llm import queries, sharding
from tests.llm import helpers as H


def _chances(good: int, bad: int, many: int) -> dict[int, float]:
    whole = math.comb(good + bad, many)
    return {k: math.comb(good, k) * math.comb(bad, many - k) / whole for k in range(max(0, many - bad), min(good, many) + 1)}


def _fits(seen: Counter, chances: dict, draws: int) -> bool:
    """Whether no frequency lies more than five standard deviations off."""
    return set(seen) <= set(chances) and all(
        abs(seen[k] - draws * p) <= 5 * (draws * p * (1 - p)) ** 0.5 + 1e-9 for k, p in chances.items() if draws * p > 5
    )


@pytest.mark.parametrize(("good", "bad", "many"), [(3, 4, 2), (10, 5, 12), (1, 9, 9), (40, 60, 33), (0, 5, 2), (5, 0, 3), (6, 6, 12)])
def test_large_draw_has_the_right_chances(good, bad, many):
    rng, draws = np.random.default_rng(1), 20_000
    seen = Counter(sharding._large_draw(good, bad, many, rng) for _ in range(draws))
    assert _fits(seen, _chances(good, bad, many), draws)


def test_large_draw_beyond_numpy():
    rng = np.random.default_rng(2)
    good, bad, many = 8 * 10**9, 24 * 10**9, 10**7
    drawn = np.array([sharding._large_draw(good, bad, many, rng) for _ in range(400)])
    deviation = (many * 0.25 * 0.75) ** 0.5
    assert abs(drawn.mean() - many / 4) < 5 * deviation / 20 and 0.8 < drawn.std() / deviation < 1.2
    sizes = np.array([5 * 10**8] * 7 + [3])
    out = sharding._draw_one(sizes, 10**9, rng)
    assert out.sum() == 10**9 and (out <= sizes).all()


@pytest.mark.parametrize("most", [10**9 - 1, 0])
def test_matrix_is_a_uniform_deal(monkeypatch, most):
    """Every matrix is as frequent as among all orders of the rows."""
    monkeypatch.setattr(sharding, "_NUMPY_MOST", most)
    rows, columns, draws = np.array([2, 3, 1]), np.array([3, 3]), 20_000
    rng, seen = np.random.default_rng(3), Counter()
    for _ in range(draws):
        drawn = sharding.draw_matrix(rows, columns, rng)
        assert (drawn.sum(axis=1) == rows).all() and (drawn.sum(axis=0) == columns).all()
        seen[tuple(drawn[:, 0].tolist())] += 1
    chances = {
        (a, b, c): math.comb(2, a) * math.comb(3, b) * math.comb(1, c) / math.comb(6, 3)
        for a in range(3) for b in range(4) for c in range(2) if a + b + c == 3
    }
    assert _fits(seen, chances, draws)


def test_tree_of_chunks_keeps_all_sums(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FAN", 2)
    rows = [(n, r) for n, r in [(0, 5), (1, 7), (5, 1), (6, 40), (1 << 33, 3), ((1 << 33) + 1, 11)]]
    deals = sharding.deal_chunks(spark.createDataFrame(rows, "node long, rows long"), 4, 1).collect()
    assert {d.node: sum(d.deal) for d in deals} == dict(rows)
    assert [sum(d.deal[i] for d in deals) for i in range(4)] == sharding.shard_sizes(67, 4)


def _check(rows, shards: int) -> None:
    slots = Counter((r.shard, r.slot) for r in rows)
    assert not rows or max(slots.values()) == 1
    sizes = sharding.shard_sizes(len(rows), shards)
    assert set(slots) == {(s, i) for s, n in enumerate(sizes) for i in range(n)}


def test_small_chunks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 16)
    monkeypatch.setattr(sharding, "SLICE", 8)
    monkeypatch.setattr(sharding, "FAN", 3)
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    for parts in (1, 7):
        monkeypatch.setattr("seatlens.session.BROADCAST_ROWS", 2 if parts == 7 else 10**6)
        rows = sharding.shuffle_into_shards(docs.repartition(parts), shards=7, seed=parts).collect()
        _check(rows, 7)
        assert sorted(r.doc_id for r in rows) == list(range(1003)) and all(r.text == str(r.doc_id) for r in rows)


def test_where_a_row_goes_has_no_pattern(spark):
    """Of some shuffles, how often rows of one half meet in the first shard, and where the first row lands."""
    docs = spark.range(64).repartition(3)
    shares, places = [], set()
    for seed in range(8):
        rows = sharding.shuffle_into_shards(docs, shards=4, seed=seed).collect()
        shares.append(sum(r.id < 32 for r in rows if r.shard == 0))
        places |= {(r.shard, r.slot) for r in rows if r.id == 0}
    # 16 of 64 drawn: mean 8, standard deviation sqrt(16 / 4 * 48 / 63)
    assert abs(np.mean(shares) - 8) < 5 * 1.75 / 8**0.5 and 0.4 < np.std(shares) < 3.5
    assert len(places) > 5


@pytest.mark.parametrize("clashes", [False, True])
def test_odd_rows(spark, clashes):
    docs = H.odd_docs(spark, clashes)
    more = docs.select("*", *[F.lit(3).alias(c) for c in ("shard", "at", "part", "own", "slot")]) if clashes else docs
    rows = sharding.shuffle_into_shards(more, shards=5).collect()
    _check(rows, 5)
    key = lambda r: str((r.doc_id, r.text))
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))
    digests = sharding.shard_digests(more, shards=20).collect()
    _check(digests, 20)
    size = lambda t: len((t or "").encode()) + 16
    want = [(r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in H.ODD]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r["size"], r.text_crc32)) for r in digests)
    assert sharding.shuffle_into_shards(H.no_docs(spark)).collect() == []


def test_written_shards_are_in_slot_order(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=3)
    rows = spark.read.parquet(str(tmp_path / "shards")).select("doc_id", "text", "shard", "slot").collect()
    _check(rows, 3)
    assert len(rows) == docs.count()


def test_registered_query(spark, sf_dir):
    rows = queries.queries()["op12_sharding"](spark, sf_dir).collect()
    _check(rows, 40)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t in texts.items()
    }
