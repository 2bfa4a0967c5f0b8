"""Packing of tokenised documents into sequences, online and in bounded space.

A document's ids are cut into full sequences and one remainder. Every task keeps
at most OPEN windows: a remainder goes to the window that it fills best. If none
has room, the fullest window is emitted; where more than SLACK of it would stay
empty, it is first topped up with the beginning of the remainder. What is open at
the end of a task is left over. Leftovers are merged in rounds, whole pieces at a
time, by the same rule in ever fewer tasks, until one task holds them.

Only piece rows are kept, not ids; a piece's checksum is taken where its ids are.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import os
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatlens.llm import words as W
from seatlens.llm.bpe import gather
from seatlens.session import stage

#: Tokens of a sequence, windows that a task keeps open, tokens that a cut window may leave empty.
LENGTH, OPEN, SLACK = 2048, 64, 8
#: Tasks whose leftovers one task of the next round takes.
FAN_IN = 32
#: Bytes of distinct words and their ids that a task remembers; beyond that they are forgotten and looked up again.
REMEMBERED = 24 << 20


class Piece(NamedTuple):
    document: object
    start: int
    length: int
    checksum: int
    tokens: int


class Windows:
    """At most OPEN open windows, ordered by fill."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.fills: list[tuple[int, int]] = []  # (fill, window), sorted
        self.pieces: dict[int, list] = {}
        self.opened = 0

    def best(self, size: int) -> int | None:
        """The index of the fullest window with room for ``size``."""
        at = bisect.bisect_right(self.fills, (self.length - size, 1 << 60)) - 1
        return at if at >= 0 else None

    def put(self, at: int | None, size: int, pieces: list) -> list | None:
        """Add to a window, or to a new one; a window that is full is closed and returned."""
        if at is None:
            fill, window = 0, self.opened
            self.opened += 1
            self.pieces[window] = []
        else:
            fill, window = self.fills.pop(at)
        self.pieces[window].extend(pieces)
        if fill + size == self.length:
            return self.pieces.pop(window)
        bisect.insort(self.fills, (fill + size, window))
        return None

    def full(self) -> bool:
        return len(self.fills) >= self.most

    def room(self) -> int:
        return self.length - self.fills[-1][0]

    def close_fullest(self) -> list:
        return self.pieces.pop(self.fills.pop()[1])

    def rest(self) -> Iterator[list]:
        while self.fills:
            yield self.close_fullest()


_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
# ASCII punctuation but for the apostrophe, which starts contractions, and what special tokens are made of.
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = True


class _Known:
    """A growing table from 64-bit hashes to consecutive numbers, as two sorted arrays."""

    FRESH = 100_000

    def __init__(self) -> None:
        nothing = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
        self.parts, self.size = [nothing, nothing], 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The hashes' numbers, -1 where they are new."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        for keys, numbers in self.parts:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, numbers[at], out)
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number new hashes; they are sorted."""
        numbers = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        self.parts[1] = self._merged(self.parts[1], (hashes, numbers))
        if len(self.parts[1][0]) > self.FRESH:
            self.parts = [self._merged(*self.parts), (hashes[:0], numbers[:0])]
        return numbers

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        keys, numbers = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(keys, kind="stable")
        return keys[order], numbers[order]


class _Growing:
    """An array that is added to at its end."""

    def __init__(self, dtype: type) -> None:
        self.values, self.size = np.empty(1024, dtype=dtype), 0

    def extend(self, more: np.ndarray) -> None:
        while self.size + len(more) > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        self.values[self.size : self.size + len(more)] = more
        self.size += len(more)


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Words:
    """Ids of words, each looked up once; the words are known by 64-bit hashes.

    A worker keeps the tokenizer; the table of words is a task's own and ends with it.

    The tokenizer drops ASCII white space, lower-cases, and splits ASCII letters
    and digits from ASCII punctuation. It never joins what it splits, so a text's
    ids are those of its parts, one after another. Only ASCII parts are lower-cased
    here: the tokenizer composes first, and a lower-case letter may compose with a
    mark where the capital doesn't. Parts with a less-than sign keep their case,
    because special tokens begin with one.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.forget()

    def forget(self) -> None:
        self.known, self.ids, self.start, self.count = _Known(), _Growing(np.uint32), _Growing(np.int64), _Growing(np.int32)

    def held(self) -> int:
        """Bytes that the table takes."""
        return 24 * self.known.size + 4 * self.ids.size

    def _learn(self, hashes: np.ndarray, words: list[str]) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [e.ids for e in encoded]
        count = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
        self.start.extend(self.ids.size + np.cumsum(count, dtype=np.int64) - count)
        self.count.extend(count)
        self.ids.extend(np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint32, count=int(count.sum())))
        return self.known.add(hashes)

    def encode(self, texts: W.Texts) -> Iterator[np.ndarray]:
        if self.held() > REMEMBERED:
            self.forget()
        data = texts.data
        alnum, mark = _ALNUM[data], _MARK[data]
        cuts = np.flatnonzero(alnum[1:] & mark[:-1] | alnum[:-1] & mark[1:]) + 1
        parts = W.words(texts, cuts)
        plain = W.LOWER[data]
        kept = np.flatnonzero((data >= 0x80) | (data == ord("<")))
        if len(kept):
            kept = np.unique(np.searchsorted(parts.start, kept, side="right") - 1)
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[parts.start[kept]] += 1
            inside[parts.end[kept]] -= 1
            plain = np.where(np.cumsum(inside[:-1], dtype=np.int8) > 0, data, plain)
        hashes = W.hashes(plain, parts.start, parts.end)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        number = self.known.find(unique)
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = plain.tobytes()
            spans = zip(parts.start[first[new]].tolist(), parts.end[first[new]].tolist(), strict=True)
            number[new] = self._learn(unique[new], [raw[a:b].decode() for a, b in spans])
        number = number[inverse]
        start, count = self.start.values[number], self.count.values[number]
        for i in range(len(texts)):
            own = slice(parts.first[i], parts.first[i + 1])
            yield gather(self.ids.values, start[own], count[own])


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class _Out:
    """Piece rows in columns; sequences numbered within the task."""

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset", "done"]

    def __init__(self, id_type: pa.DataType, task: int) -> None:
        self.id_type, self.task, self.sequence = id_type, task, 0
        self.rows: list[tuple] = []

    def add(self, pieces: list[Piece], done: bool) -> None:
        name, offset = (self.task << 32) + self.sequence, 0
        self.sequence += 1
        for p in pieces:
            self.rows.append((*p, name, offset, done))
            offset += p.length

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.names)
        self.rows = []
        kinds = [self.id_type, *[pa.int64()] * 6, pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=self.names)


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    words, windows, out = Words(path), Windows(length, OPEN), None
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("id"))
        out = out or _Out(ids.type, TaskContext.get().partitionId())
        for texts in W.slices(batch):
            for i, tokens in enumerate(words.encode(texts)):
                tokens = np.append(tokens, np.uint32(end_id))
                _place(ids[texts.first + i].as_py(), tokens, windows, out, length)
        yield out.batch()
    if out:
        for pieces in windows.rest():
            out.add(pieces, done=False)
        yield out.batch()


def _place(document: object, tokens: np.ndarray, windows: Windows, out: _Out, length: int) -> None:
    many = len(tokens)

    def piece(start: int, end: int) -> Piece:
        return Piece(document, start, end - start, _checksum(tokens[start:end]), many)

    start = 0
    while many - start >= length:
        out.add([piece(start, start + length)], done=True)
        start += length
    while start < many:
        at = windows.best(many - start)
        if at is None and windows.full():
            room = windows.room()
            if room > SLACK:
                out.add(windows.put(len(windows.fills) - 1, room, [piece(start, start + room)]), done=True)
                start += room
            else:
                out.add(windows.close_fullest(), done=True)
            continue
        closed = windows.put(at, many - start, [piece(start, many)])
        if closed:
            out.add(closed, done=True)
        start = many


def _whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each leftover window; they arrive ordered by sequence and offset."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        name = held.column("sequence").to_numpy()
        cuts = [0, *(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist()]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield held.slice(lo, hi - lo)
        held = held.slice(cuts[-1])
    if held is not None:
        yield held


def _merge(batches: Iterator[pa.RecordBatch], length: int, final: bool) -> Iterator[pa.RecordBatch]:
    """The windows of a task, merged by best fit."""
    windows, task, numbers = Windows(length, OPEN), TaskContext.get().partitionId(), itertools.count()

    def emit(parts: list[pa.Table], done: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(parts)
        size = rows.column("length").to_numpy()
        new = {
            "offset": np.cumsum(size) - size,
            "sequence": np.full(len(size), (task << 32) + next(numbers)),
            "done": np.full(len(size), done),
        }
        for name, values in new.items():
            rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(values))
        yield from rows.combine_chunks().to_batches()

    for window in _whole_windows(batches):
        size = int(window.column("length").to_numpy().sum())
        at = windows.best(size)
        if at is None and windows.full():
            yield from emit(windows.close_fullest(), done=True)
        closed = windows.put(at, size, [window])
        if closed:
            yield from emit(closed, done=True)
    for parts in windows.rest():
        yield from emit(parts, done=final)


def pack(
    docs: DataFrame, path: str, end_id: int = 1, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of a document: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text by the tokenizer file ``path``, which every
    executor can read, and then ``end_id``; a null or empty text is ``end_id``
    alone. Every id is in exactly one piece; the pieces of a sequence follow each
    other without a gap and hold ``length`` tokens at most. Rows that share an id
    are documents of their own. Other columns are ignored. An empty table gives
    an empty one.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, done boolean"
    )
    packed = stage(
        texts.mapInArrow(partial(_pack, path=path, end_id=end_id, length=length), schema).withColumn("round", F.lit(0)),
        "packed",
    )
    finished, left, rounds = packed.where("done"), packed.where("NOT done"), 0
    tasks = left.select(F.shiftright("sequence", 32)).distinct().count()
    while tasks:
        rounds += 1
        tasks = -(-tasks // FAN_IN)
        by_task = left.withColumn("task", F.pmod(F.shiftright("sequence", 32), F.lit(tasks)).cast("int"))
        # one range per task: the task numbers are consecutive
        dealt = by_task.repartitionByRange(tasks, "task").sortWithinPartitions("task", "sequence", "offset")
        merged = dealt.drop("task", "round").mapInArrow(partial(_merge, length=length, final=tasks == 1), schema)
        merged = stage(merged.withColumn("round", F.lit(rounds)), "packed")
        finished, left = finished.unionByName(merged.where("done")), merged.where("NOT done")
        if tasks == 1:
            break
    # a sequence's name: its round, task and number within the task
    name = F.shiftleft(F.col("round").cast("long"), 56) + F.col("sequence")
    return finished.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", name.alias("sequence_id"), "offset"
    )
