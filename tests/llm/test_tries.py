"""Operator 13 against a plain trie of tuples, and its arrays against sets of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seatlens.llm import queries, sql, tries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn int, role string, text string"


def _rebuilt(rows: list[tuple]) -> dict[int, tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: tuple(t[3:] for t in sorted(ts)) for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - int(np.fmod(c, 100)), ())[: h[c]] + t[h[c] :] for c, t in own.items()}


def _plain(paths: dict[int, tuple]) -> list[tuple]:
    members, children = defaultdict(list), defaultdict(set)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if paths[c] == path)
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, ())),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def _rows(found) -> list[str]:
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in found.collect())


def _want(rows: list[tuple]) -> list[str]:
    return sorted(map(str, _plain(_rebuilt(rows))))


def _conversations(seed: int) -> list[tuple]:
    """Families that share beginnings, copies, one common first turn, null and equal turns, gaps."""
    rng = random.Random(seed)
    rows = []
    for conv in [*range(40), *range(100, 130), *range(201, 215), 300, 70_000, 70_001, -5, -105, 500]:
        size = rng.choice([1, 1, 2, 3, 5, 8, 14])
        for turn in range(size):
            text = rng.choice(["hello", "x", "é😀", "", None, f"t{rng.randrange(4)}", f"u{rng.randrange(500)}"])
            rows.append((conv, turn, rng.choice(["user", "assistant", None, ""]), "hello" if turn == 0 and conv % 3 else text))
    rows += [(500, None, "user", "late"), (500, 1, "a", "tie"), (500, 1, "b", "tie"), (500, 1, "b", "tie"), (None, 1, "user", "nobody")]
    rows += [(c, t, "user", f"same {t}") for c in range(600, 660) for t in range(9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "turns", "slots"), [(1, 100_000, 1), (2, 20, 4), (3, 1, 64)])
def test_nodes_equal_a_plain_trie(spark, monkeypatch, seed, turns, slots):
    """Whole, and cut into shards of a few turns, where most nodes are shared."""
    monkeypatch.setattr(tries, "SHARD_TURNS", turns)
    monkeypatch.setattr(tries, "task_slots", lambda spark: slots)
    rows = _conversations(seed)
    found = tries.prefix_trie(tries.branched(tries.conversation_paths(spark.createDataFrame(rows, TURNS).repartition(3))))
    assert _rows(found) == _want(rows)


def test_equals_sql_on_odd_conversations(spark):
    rows = _conversations(4)
    conversations = spark.createDataFrame(rows, TURNS).toPandas()  # noqa: F841 - DuckDB reads it
    conversations = conversations.astype({"conv_id": "Int64", "turn": "Int64"})
    expected = duckdb.sql(sql.prefix_trie_sql("conversations")).fetchall()
    assert sorted(map(str, expected)) == _want(rows)


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert _rows(queries.queries()["op13_prefix_trie"](spark, sf_dir)) == _want(rows)


def test_empty_turnless_and_clashing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert tries.prefix_trie(tries.branched(tries.conversation_paths(empty))).collect() == []
    # 5 is crc32 % 6 > 0 turns long at least, its family's first is absent: no turn is left
    lost = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    rows = [(lost, 0, "user", "gone")]
    named = spark.createDataFrame(rows, TURNS).select("*", *[F.lit(9).alias(c) for c in ("t", "turns", "path", "n", "key", "shard")])
    assert _rows(tries.prefix_trie(tries.branched(tries.conversation_paths(named)))) == _want(rows)
    assert _want(rows) == [str((lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest()))]
    nobody = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert tries.prefix_trie(tries.conversation_paths(nobody)).collect() == []


def test_long_conversation_and_text(spark, monkeypatch):
    monkeypatch.setattr(tries, "task_slots", lambda spark: 2)
    rows = [(c, t, "user", f"{t}") for c in (100, 101) for t in range(3000)] + [(100, 3000, "user", "x" * 1_000_000)]
    assert sorted(_rows(tries.prefix_trie(tries.branched(tries.conversation_paths(spark.createDataFrame(rows, TURNS))))))[:50] == _fast(rows)[:50]


def _fast(rows: list[tuple]) -> list[str]:
    """Two conversations of which one goes on: known without a trie."""
    texts = [t for c, _, _, t in rows if c == 100]
    none, both = hashlib.sha256(b"").hexdigest(), {3000: hashlib.sha256(b"101").hexdigest(), 3001: hashlib.sha256(b"100").hexdigest()}
    after = [0] * 3002
    for d in range(3000, 0, -1):
        after[d] = after[d + 1] + len(texts[d - 1])
    after[0] = after[1]
    return sorted(
        str((100, d, 100 if d else None, 1 if d == 3001 else 2, int(d < 3001), 1, after[d], both.get(d, none))) for d in range(3002)
    )


@pytest.mark.parametrize("seed", range(4))
def test_double_array_holds_exactly_its_rows(seed):
    rng = random.Random(seed)
    rows = sorted({tuple(rng.randrange(rng.choice([2, 50, 400])) for _ in range(rng.randrange(9))) for _ in range(600)})
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    symbols = np.array([s for r in rows for s in r], dtype=np.int64)
    trie = tries.DoubleArray(symbols, first)
    states = {}
    for depth, (own, at) in enumerate(trie.walk(symbols, first), 1):
        for r, s in zip(own.tolist(), at.tolist(), strict=True):
            assert states.setdefault(rows[r][:depth], s) == s
    assert len(set(states.values())) == len(states) == int((trie.check[1:] >= 0).sum())
    with pytest.raises(KeyError):
        list(trie.walk(np.array([401]), np.array([0, 1])))
