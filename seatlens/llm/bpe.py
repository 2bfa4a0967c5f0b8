"""Byte-level BPE by merge replay, task by task, and its inverse.

Every task gathers the distinct pieces of its texts that it has not met yet, lays
their bytes out as one long row of symbols and replays the merges over all of
them at once, lowest rank first. An inverted index holds, for each merge, the
positions where its pair stands; applying a merge touches those positions and
their neighbours only, whose new pairs are entered in the index. A piece in which
a merge brings up a pair of lower rank than its own is merged on its own, pair by
pair, because then the order within the piece matters. Texts are then put
together from their pieces' ids.

Ids travel as a binary column of little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose unseen pieces are merged together.
REPLAY_BYTES = 8 << 20
#: Pieces remembered between replays; beyond that they are forgotten and merged again.
REMEMBERED = 400_000

_NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of byte strings, and for each pair of ids the id it merges to."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[p] for p in self.pair.tolist()], dtype=np.int32)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids that pairs merge to; a huge value where they don't."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], _NONE)

    def one_by_one(self, piece: bytes) -> list[int]:
        """A single piece, always merging the lowest pair, the first among equals."""
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            whole = i >= 0 and part[i] is not None and after[i] < n
            return self.ranks.get(part[i] + part[after[i]]) if whole else None

        queue = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(queue)
        while queue:
            lowest, i = heapq.heappop(queue)
            if rank(i) != lowest:
                continue  # one of its two symbols has changed since
            gone = after[i]
            part[i], part[gone], after[i] = part[i] + part[gone], None, after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if (r := rank(j)) is not None:
                    heapq.heappush(queue, (r, j))
        return [self.ranks[p] for p in part if p is not None]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _apart(positions: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap in places, the ones to merge: from the left, none that is taken."""
    keep, taken = [], -1
    for at, after in zip(positions.tolist(), following[positions].tolist(), strict=True):
        if at != taken:
            keep.append(at)
            taken = after
    return np.array(keep, dtype=np.int64)


def replay(pieces: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All pieces' ids in one array, and where each piece's begin, with the end."""
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    n = int(first[-1])
    if not n:
        return np.empty(0, dtype=np.int32), first
    symbol = words.byte[np.frombuffer(b"".join(pieces), np.uint8)]
    following = np.arange(1, n + 1, dtype=np.int64)
    following[first[1:] - 1] = n  # n stands for no neighbour
    before = np.arange(-1, n, dtype=np.int64)
    before[first[:-1]] = n
    symbol, following = np.append(symbol, 0), np.append(following, n)
    merge = np.full(n + 1, _NONE, dtype=np.int32)
    paired = np.flatnonzero(following[:n] < n)
    merge[paired] = words.merge_of(symbol[paired], symbol[following[paired]])
    irregular: list[np.ndarray] = []

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(positions: np.ndarray) -> None:
        order = np.argsort(merge[positions], kind="stable")
        positions = positions[order]
        rank = merge[positions]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rank)], strict=True):
            own = int(rank[lo]) if hi > lo else int(_NONE)
            if own == _NONE:
                continue
            if own not in index:
                index[own] = []
                heapq.heappush(queue, own)
            index[own].append(positions[lo:hi])

    enter(paired[merge[paired] != _NONE])
    while queue:
        rank = heapq.heappop(queue)
        held = index.pop(rank)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else held[0]
        at = at[merge[at] == rank]
        if not len(at):
            continue
        if len(at) > 1 and (following[at[:-1]] == at[1:]).any():
            at = _apart(at, following)
        gone = following[at]
        after = following[gone]
        symbol[at], merge[gone] = rank, _NONE
        following[at], before[after] = after, at
        before[n] = n
        left = before[at]
        touched = np.unique(np.concatenate([at, left[left < n]]))
        right = following[touched]
        merge[touched] = np.where(right < n, words.merge_of(symbol[touched], symbol[right]), _NONE)
        lower = touched[merge[touched] < rank]
        if len(lower):
            irregular.append(np.searchsorted(first, lower, side="right") - 1)
        enter(touched[merge[touched] != _NONE])

    alive = _heads(following, first, n)
    ids, ends = symbol[:n][alive], np.concatenate([[0], np.cumsum(alive)])[first]
    if irregular:
        ids, ends = _redone(ids, ends, np.unique(np.concatenate(irregular)), pieces, words)
    return ids, ends


def _heads(following: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Which positions still stand for a symbol: the ones that another one, or a start, leads to."""
    alive = np.zeros(n + 1, dtype=bool)
    at = first[:-1][first[:-1] < first[1:]]
    while len(at):
        alive[at] = True
        at = following[at]
        at = at[at < n]
    return alive[:n]


def _redone(ids: np.ndarray, ends: np.ndarray, which: np.ndarray, pieces: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids with some pieces' replaced by those of ``one_by_one``."""
    parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    for i in which.tolist():
        parts[i] = np.array(words.one_by_one(pieces[i]), dtype=np.int32)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs values[start : start + size], one after another."""
    total = int(size.sum())
    if not total:
        return values[:0]
    step = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return values[step + np.arange(total)]


class Pieces:
    """Pieces met so far, as numbers, with their ids in one growing array."""

    def __init__(self, words: Vocabulary) -> None:
        self.words = words
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.fresh: list[str] = []
        self.ids = np.empty(0, dtype=np.int32)
        self.start = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)

    def numbers(self, found: list[str]) -> np.ndarray:
        number, fresh = self.number, self.fresh
        out = np.empty(len(found), dtype=np.int32)
        for i, piece in enumerate(found):
            at = number.get(piece)
            if at is None:
                at = number[piece] = len(number)
                fresh.append(piece)
            out[i] = at
        return out

    def learn(self) -> None:
        """Work out the ids of the pieces that are new."""
        if not self.fresh:
            return
        raw = [p.encode() for p in self.fresh]
        whole = [self.words.ranks.get(p) for p in raw]
        ids, ends = replay([b"" if w is not None else p for p, w in zip(raw, whole, strict=True)], self.words)
        known = np.array([-1 if w is None else w for w in whole], dtype=np.int32)
        start, size = ends[:-1].copy(), np.diff(ends)
        listed = np.flatnonzero(known >= 0)
        start[listed], size[listed] = len(ids) + np.arange(len(listed)), 1
        self.start = np.append(self.start, start + len(self.ids))
        self.size = np.append(self.size, size)
        self.ids = np.concatenate([self.ids, ids, known[listed]])
        self.fresh = []


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    split = regex.compile(pattern).findall
    pieces = Pieces(vocabulary(path))
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        names = [n for n in batch.schema.names if n != "text"]
        row = 0
        while row < batch.num_rows:
            if len(pieces.number) > REMEMBERED:
                pieces.forget()
            numbers, taken, begin = [], 0, row
            while row < batch.num_rows and taken < REPLAY_BYTES:
                text = column[row].as_py() or ""
                numbers.append(pieces.numbers(split(text)))
                taken += len(text)
                row += 1
            pieces.learn()
            ids = [gather(pieces.ids, pieces.start[n], pieces.size[n]).astype("<u4").tobytes() for n in numbers]
            kept = [batch.column(n).slice(begin, row - begin) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], names=[*names, "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = vocabulary(path).tokens
    for batch in batches:
        packed = batch.column(batch.schema.get_field_index("ids"))
        out = [b"".join(map(tokens.__getitem__, np.frombuffer(v.as_buffer(), "<u4").tolist())) if v.is_valid else None for v in packed]
        yield batch.append_column("decoded", pa.array(out, pa.binary()))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: each match of ``pattern`` is encoded by the ranks in ``path`` on its own.

    ``path`` names a file of base64 tokens and ranks that every executor can read;
    there are no special tokens. A null or empty text has no ids. Equal texts get
    equal ids, in any order of rows. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    encoded = texts.mapInArrow(partial(_encode, path=path, pattern=pattern), f"id {id_type}, ids binary")
    return encoded.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``, the bytes its ``ids`` stand for; null ids stay null."""
    schema = encoded.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return encoded.mapInArrow(partial(_decode, path=path), f"{schema},decoded:binary")
