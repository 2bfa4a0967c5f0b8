"""Prefix trie of conversations, by one double-array trie per shard.

*Paths.* A conversation is the row of its turns' 16-byte digests, one binary value,
whose prefixes are the trie's nodes. Equal conversations are one path with a count.

*Shards.* Paths are sorted and cut into ranges, so a shard holds the subtrees of
neighbouring prefixes. Only prefixes common to two neighbouring shards' border paths
lie in several shards: the shared upper nodes.

*Double arrays.* A shard numbers its distinct turns densely and packs its trie into
two arrays: the child of state s by turn c is t = BASE[s] + c where CHECK[t] = s.
Nodes with one child take the next free places, all of a depth at once; a node with
several is put at the first base where all of them are free. All paths then walk the
arrays together, a turn a step, which counts members; sums over subtrees go up the
CHECK array, deepest nodes first.

*Merge.* What a shard knows of a shared node adds up with what other shards know:
members, leaves below, saved code points and children. The first shard that has the
node counts it as a child and takes off its own text; a node that goes on in the next
shard is no leaf. So shared nodes need one aggregation by the digest of their prefix
and one join for their children's parents; all other rows are final in their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.session import stage, task_slots

#: Turns of a shard, about; one path is never cut.
SHARD_TURNS = 100_000
#: Bytes of a turn's digest.
WIDTH = 16
#: Places that are tried for a node of several children before it goes behind all others.
TRIES = 64

_NOTHING = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie over rows of dense symbols, packed into BASE and CHECK."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray) -> None:
        """``symbols`` of all rows one after another (0, 1, 2, …), and where each row begins, with the end."""
        self.base = np.zeros(1024, dtype=np.int64)
        self.check = np.full(1024, -1, dtype=np.int64)
        self.check[0] = 0  # the root; no state has it for a child
        self._free, self._end = 1, 1
        length = np.diff(first)
        state = np.zeros(len(length), dtype=np.int64)
        for depth in range(int(length.max(initial=0))):
            rows = np.flatnonzero(length > depth)
            pairs = np.unique(np.stack([state[rows], symbols[first[rows] + depth]], axis=1), axis=0)
            self._place(pairs[:, 0], pairs[:, 1])
            state[rows] = self.base[state[rows]] + symbols[first[rows] + depth]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, dtype=np.int64))
            self.check = np.append(self.check, np.full(more, -1, dtype=np.int64))

    def _free_places(self, many: int) -> np.ndarray:
        """The first ``many`` free places."""
        self._grow(self._end + many)
        inside = self._free + np.flatnonzero(self.check[self._free : self._end] < 0)
        return np.append(inside, np.arange(self._end, self._end + many))[:many]

    def _take(self, places: np.ndarray, parents: np.ndarray) -> None:
        self.check[places] = parents
        self._end = max(self._end, int(places.max()) + 1)
        if self.check[self._free] >= 0:
            free = np.flatnonzero(self.check[self._free : self._end] < 0)
            self._free += int(free[0]) if len(free) else self._end - self._free

    def _place(self, parent: np.ndarray, symbol: np.ndarray) -> None:
        """Find places for the children of a depth; the pairs are sorted."""
        begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        size = np.diff(np.append(begin, len(parent)))
        for i in begin[size > 1].tolist():
            own = symbol[i : np.searchsorted(parent, parent[i], side="right")]
            base = self._base(own)
            self.base[parent[i]] = base
            self._take(base + own, parent[i])
        single = begin[size == 1]
        if len(single):
            places = self._free_places(len(single))
            self.base[parent[single]] = places - symbol[single]
            self._take(places, parent[single])

    def _base(self, own: np.ndarray) -> int:
        for place in self._free_places(TRIES).tolist():
            base = place - int(own[0])
            self._grow(base + int(own[-1]) + 1)
            if (self.check[base + own] < 0).all():
                return base
        base = self._end - int(own[0])
        self._grow(base + int(own[-1]) + 1)
        return base

    def walk(self, symbols: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per depth from 1 on: the rows that are that long, and their states."""
        length = np.diff(first)
        state = np.zeros(len(length), dtype=np.int64)
        for depth in range(int(length.max(initial=0))):
            rows = np.flatnonzero(length > depth)
            at = self.base[state[rows]] + symbols[first[rows] + depth]
            if (self.check[at] != state[rows]).any():
                raise KeyError("a row is not in the trie")
            state[rows] = at
            yield rows, at


def common_turns(a: bytes | None, b: bytes | None) -> int:
    """How many first turns two paths share; -1 where there is no other path, so not even the root is shared."""
    if a is None or b is None:
        return -1
    most = min(len(a), len(b)) // WIDTH
    x = np.frombuffer(a, np.uint8)[: most * WIDTH].reshape(most, WIDTH)
    y = np.frombuffer(b, np.uint8)[: most * WIDTH].reshape(most, WIDTH)
    apart = np.flatnonzero((x != y).any(axis=1))
    return int(apart[0]) if len(apart) else most


def _prefix_keys(path: bytes, most: int) -> list[str]:
    """Digests of a path's prefixes of 0 up to ``most`` turns."""
    running, out = hashlib.sha256(), []
    for depth in range(most + 1):
        out.append(running.hexdigest())
        running.update(path[depth * WIDTH : (depth + 1) * WIDTH])
    return out


_NODE = (
    "key string, parent_key string, conv_id {id}, depth long, parent_conv_id {id}, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


class _Counted(NamedTuple):
    depth: np.ndarray
    members: np.ndarray
    smallest: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    end: np.ndarray  # the path that ends at a state, -1 for none


def _count(trie: DoubleArray, walked: list[tuple], times: np.ndarray, conv: np.ndarray, length: np.ndarray,
           points: list[np.ndarray], heads: np.ndarray, known: int, last: np.ndarray, follows: int) -> _Counted:
    """Aggregates per state. ``heads`` and ``last`` are the states of the first and the last path; up to depth
    ``known`` the former are the previous shard's too, up to ``follows`` the latter the next shard's."""
    n = trie._end
    depth, end = np.full(n, -1), np.full(n, -1)
    depth[0] = 0
    members, saved = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    smallest = np.full(n, np.iinfo(np.int64).max)
    members[0], smallest[0] = times.sum(), conv.min()
    end[0] = next(iter(np.flatnonzero(length == 0)), -1)
    for d, (rows, states) in enumerate(walked, 1):
        np.add.at(members, states, times[rows])
        np.minimum.at(smallest, states, conv[rows])
        depth[states] = d
        saved[states] = points[d - 1]  # a node's code points are those of any row through it
        here = length[rows] == d
        end[states[here]] = rows[here]
    ours = np.ones(n, dtype=bool)  # nodes that an earlier shard doesn't have
    ours[heads[: known + 1]] = False
    saved = saved * (members - ours)
    used = np.flatnonzero(depth > 0)
    parent = trie.check[:n]
    children, below = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    np.add.at(children, parent[used[ours[used]]], 1)
    np.add.at(below, parent[used], 1)
    leaves = (below == 0) & (depth >= 0)
    leaves[last[: follows + 1]] = False
    leaves = leaves.astype(np.int64)
    for _, states in reversed(walked):
        own = np.unique(states)
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])
    return _Counted(depth, members, smallest, children, leaves, saved, end)


def _shard(paths: pa.Table, borders: pa.Table, schema: pa.Schema) -> pa.Table:
    """All nodes of a shard; those it shares with a neighbour have a key."""
    if not paths.num_rows:
        return schema.empty_table()
    paths = paths.sort_by("path")
    path = paths.column("path").to_pylist()
    before, after = (borders.column(c)[0].as_py() if borders.num_rows else None for c in ("before", "after"))
    known, follows = common_turns(before, path[0]), common_turns(path[-1], after)
    size = np.array([len(p) // WIDTH for p in path], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    _, symbols = np.unique(np.frombuffer(b"".join(path), f"V{WIDTH}"), return_inverse=True)
    points = paths.column("points").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    times, conv = (paths.column(c).to_numpy().astype(np.int64) for c in ("n", "conv_id"))

    trie = DoubleArray(symbols, first)
    walked = list(trie.walk(symbols, first))
    last = np.array([0] + [int(states[-1]) for rows, states in walked if rows[-1] == len(path) - 1], dtype=np.int64)
    heads = np.array([0] + [int(states[0]) for rows, states in walked if rows[0] == 0], dtype=np.int64)
    texts = [points[first[rows] + d] for d, (rows, _) in enumerate(walked)]
    c = _count(trie, walked, times, conv, size, texts, heads, known, last, follows)

    key = np.full(len(c.depth), None, dtype=object)
    for states, whole, most in ((heads, path[0], known), (last, path[-1], follows)):
        key[states[: most + 1]] = _prefix_keys(whole, most)[: most + 1]
    node = np.flatnonzero(c.depth >= 0)
    parent = trie.check[node]
    sha = np.array([*paths.column("ends_sha256").to_pylist(), _NOTHING], dtype=object)
    root = c.depth[node] == 0
    columns = {
        "key": key[node],
        "parent_key": np.where(root, None, key[parent]),
        "conv_id": c.smallest[node],
        "depth": c.depth[node],
        "parent_conv_id": pa.array(c.smallest[parent], mask=root),
        "n_convs": c.members[node],
        "n_children": c.children[node],
        "n_leaves": c.leaves[node],
        "saved_tokens": c.saved[node],
        "ends_sha256": sha[c.end[node]],
    }
    arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], from_pandas=True) for f in schema]
    return pa.table([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per path: its members' number, smallest id and the digest of all ids; rows arrive ordered by path and id."""
    at, many, smallest, running = None, 0, 0, hashlib.sha256()
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        rows = list(zip(*out, strict=True)) or [()] * 4
        out.clear()
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        names = ["path_key", "n", "conv_id", "ends_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=names)

    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("path_key")).to_pylist()
        for key, conv in zip(keys, batch.column(batch.schema.get_field_index("conv_id")).to_pylist(), strict=True):
            if key != at:
                if at is not None:
                    out.append((at, many, smallest, running.hexdigest()))
                at, many, smallest, running = key, 0, conv, hashlib.sha256()
            running.update(b",%d" % conv if many else b"%d" % conv)
            many += 1
        yield flushed()
    if at is not None:
        out.append((at, many, smallest, running.hexdigest()))
        yield flushed()


def conversation_paths(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest, code points of the text).

    Turns go by number, null first; among equal numbers by the digest. A null role or
    text is empty. Rows without a conversation id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat_ws(":", F.char_length(role).cast("string"), role, text))  # the length keeps role and text apart
    turn = F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("points"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("t"))
    own = F.transform(F.array_sort(F.collect_list("t"), _in_order), lambda t: F.struct(t["digest"].alias("digest"), t["points"].alias("points")))
    return rows.groupBy("conv_id").agg(own.alias("turns"))


def _in_order(a: Column, b: Column) -> Column:
    turn = F.when(a["turn"].isNull() & b["turn"].isNull(), 0).when(a["turn"].isNull(), -1).when(b["turn"].isNull(), 1)
    turn = F.coalesce(turn, F.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).otherwise(0))
    digest = F.when(a["digest"] < b["digest"], -1).when(a["digest"] > b["digest"], 1).otherwise(0)
    return F.when(turn != 0, turn).otherwise(digest)


def branched(paths: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Every conversation with its first h turns replaced by those of its family's first, h = crc32(id) % ``most``.

    The family's first is the id less its remainder by ``family``; without one, or where it is
    shorter, fewer turns or none come from it.
    """
    heads = paths.select(F.col("conv_id").alias("head"), F.slice("turns", 1, most).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    joined = paths.join(heads, paths["conv_id"] - paths["conv_id"] % family == heads["head"], "left")
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), 1, h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(lead, own).alias("turns"))


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, turns of digest and points).

    A node is a distinct sequence of first turns; a conversation is a member of all its prefixes'
    nodes, one without turns of the root's only. ``conv_id`` is the smallest member, ``depth`` the
    number of turns, ``parent_conv_id`` the parent's conv_id (null at the root); ``n_convs`` members,
    ``n_children``, ``n_leaves`` childless nodes in the subtree; ``saved_tokens`` the sum over the
    subtree of (n_convs - 1) times the code points of the node's last text; ``ends_sha256`` digests
    the decimal ids of the members that end there, ascending, comma-joined.

    Ids that repeat are members as often. Without conversations there is no root. One conversation's
    digests, 24 bytes a turn, have to fit a task; members of a path are read in order, one at a time.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    points = F.transform("turns", lambda t: t["points"])
    rows = stage(paths.select("conv_id", path.alias("path"), points.alias("points"), F.unhex(F.sha2(path, 256)).alias("path_key")), "paths")
    spark = rows.sparkSession

    ended = rows.select("path_key", "conv_id").repartition("path_key").sortWithinPartitions("path_key", "conv_id")
    ended = stage(ended.mapInArrow(_ends, "path_key binary, n long, conv_id long, ends_sha256 string"), "ends")
    distinct = rows.dropDuplicates(["conv_id", "path_key"]).join(ended, ["path_key", "conv_id"]).drop("path_key")
    distinct = stage(distinct, "distinct_paths")
    turns = distinct.agg(F.sum(F.octet_length("path"))).first()[0]
    shards = max(task_slots(spark), -(-(turns or 0) // (WIDTH * SHARD_TURNS)))
    cut = distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id())
    cut = stage(cut, "sharded_paths")

    borders = stage(cut.groupBy("shard").agg(F.min("path").alias("least"), F.max("path").alias("most")), "borders")
    row = Window.orderBy("shard")  # a row per shard
    borders = borders.select("shard", F.lag("most").over(row).alias("before"), F.lead("least").over(row).alias("after"))
    schema = _NODE.format(id="long")
    arrow = _arrow_schema()
    nodes = cut.groupBy("shard").cogroup(borders.groupBy("shard")).applyInArrow(lambda p, b: _shard(p, b, arrow), schema)
    nodes = stage(nodes, "nodes")

    shared = nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != _NOTHING, F.col("ends_sha256"))), F.lit(_NOTHING)).alias("ends_sha256"),
    )
    shared = stage(shared, "shared_nodes")
    names = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    final = nodes.where("key IS NULL")
    below = final.where("parent_key IS NOT NULL").drop("key", "parent_conv_id").unionByName(shared.drop("key"))
    below = below.join(names, "parent_key", "left").drop("parent_key")
    return final.where("parent_key IS NULL").drop("key", "parent_key").unionByName(below)


def _arrow_schema() -> pa.Schema:
    text, number = pa.string(), pa.int64()
    kinds = [("key", text), ("parent_key", text), ("conv_id", number), ("depth", number), ("parent_conv_id", number)]
    kinds += [(c, number) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    return pa.schema([*kinds, ("ends_sha256", text)])
