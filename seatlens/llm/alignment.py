"""Alignment of two tokenizers over a corpus, by inverted pair bitmaps.

*Units.* A text, with a space put in front, is cut before every space that follows
printable ASCII, and between an ASCII letter and a mark that no piece of the model
joins. Neither tokenizer has a token across such a cut, so tokens, groups and links
of a text are those of its units, and a task works out each distinct unit once.

*Groups and links.* Byte offsets where tokens of both end cut the tokens into
groups; every token of the one and every token of the other in a group are linked.

*Inverted bitmaps.* Documents are numbered within segments of up to 65,536. For
each id pair a segment has a bitmap of the documents that hold it linked, compressed
as a sorted array or, where it is dense, as bits. How often a document holds the
pair is in further planes: plane k > 0 has the documents whose count less one has
bit k - 1. The bitmaps of the slices of a segment are OR-merged in its task. Bitmaps
of different segments share no document, so a pair's whole bitmap is theirs side by
side, and its population counts are summed before anything is shuffled: plane 0
gives documents, all planes give links.

*Scores.* The bitmaps are the postings by which a pair's count finds its way back:
they meet the counts, go to their segments and are added up document by document.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
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
from seatlens.llm.packing import _Growing, _Known
from seatlens.session import BROADCAST_ROWS, stage

#: Documents of a segment at most, bytes of text after which it is closed.
SEGMENT, SEGMENT_BYTES = 1 << 16, 12 << 20
#: Bytes of units that a task remembers; beyond that they are forgotten and worked out again.
REMEMBERED = 48 << 20
#: Pairs in more segments than this have their counts broadcast, the most frequent ones first.
HOT_SEGMENTS = 1000
#: A bitmap of this many bytes is bits; a shorter one is a sorted array of 16-bit numbers.
_BITS = SEGMENT // 8

_PRINTABLE = np.zeros(256, dtype=bool)
_PRINTABLE[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Told apart from units that begin with a space.
_MARK_KEY = np.uint64(0x5851F42D4C957F2D)


def _byte_of_letter() -> dict[str, int]:
    """The bytes that a byte-level vocabulary's letters stand for: printable ones themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = _byte_of_letter()
        own = {i: bytes(map(letters.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [own.get(i, b"") for i in range(max(own) + 1)]
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [b.id_to_piece(i) for i in range(b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = [b.piece_to_id("▁")]
        # Marks that begin a token of either after a letter; the apostrophe may go on with the word's.
        joined = {y for p in pieces for x, y in itertools.pairwise(p) if x.isascii() and x.isalpha()}
        self.marks = np.zeros(256, dtype=bool)
        self.marks[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'" and chr(c) not in joined]] = True
        self.a_size = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)

    def encode(self, units: list[bytes], marks: list[bool]) -> tuple[list[list[int]], list[list[int]]]:
        """Both tokenizers' ids of units; none where their bytes aren't just the unit's.

        A unit that doesn't begin with a mark begins with a space, which it lacks here.
        The piece model gets a letter before a mark, for else it adds a space.
        """
        texts = [u.decode(errors="replace") for u in units]
        a_texts = [t if m else f" {t}" for t, m in zip(texts, marks, strict=True)]
        a = [e.ids for e in self.a.encode_batch_fast(a_texts, add_special_tokens=False)]
        b = self.b.encode([f"a{t}" if m else t for t, m in zip(texts, marks, strict=True)], num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for i, (unit, mark) in enumerate(zip(units, marks, strict=True)):
            if mark:
                b[i] = b[i][1:]
            else:
                unit = b" " + unit
                b[i] = b[i] or self.blank
            if b"".join(map(a_bytes, a[i])) != unit or b"".join(map(b_bytes, b[i])) != unit:
                a[i], b[i] = [], []
        return a, b


@functools.lru_cache(maxsize=1)
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64, count=int(size.sum())), size


def _counted(*keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct rows of key columns in order, the last key the least significant, and how often each is there."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    weight = np.ones(len(order), dtype=np.int64) if times is None else times[order]
    return *[k[at] for k in keys], np.add.reduceat(weight, at) if len(at) else weight


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ranges start : start + size, one after another, and each one's range."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size - start, size)


def _in_groups(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where tokens of both end, and the group of each token."""
    ends = np.intersect1d(a_end, b_end, assume_unique=True)
    return ends, np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)


class Units:
    """What both tokenizers make of units, each worked out once; units are known by 64-bit hashes."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.tokenizers = _tokenizers(path_a, path_b)
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        self.pair, self.times = _Growing(np.int64), _Growing(np.int64)
        self.start, self.size = _Growing(np.int64), _Growing(np.int64)
        #: per unit: tokens of either, groups, links; no token where the bytes aren't the unit's
        self.facts = [_Growing(np.int64) for _ in range(4)]
        self.groups: list[bytes] = []
        self.text_bytes = 0

    def held(self) -> int:
        return 120 * self.known.size + 16 * self.pair.size + self.text_bytes

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The numbers of spans; new ones are worked out."""
        hashes = W.hashes(data, start, end) ^ np.where(mark, _MARK_KEY, np.uint64(0))
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        number = self.known.find(unique)
        new = np.flatnonzero(number < 0)
        if len(new):
            spans = zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)
            self._learn([data[i:j].tobytes() for i, j in spans], mark[first[new]].tolist())
            number[new] = self.known.add(unique[new])
        return number[inverse]

    def _learn(self, units: list[bytes], marks: list[bool]) -> None:
        many, known = len(units), self.tokenizers
        ids_a, ids_b = known.encode(units, marks)
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        unit_a, unit_b = np.repeat(np.arange(many), n_a), np.repeat(np.arange(many), n_b)
        # Units one after another: their byte offsets don't meet, nor do their groups.
        a_end, b_end = np.cumsum(known.a_size[a]), np.cumsum(known.b_size[b])
        ends, in_a, in_b = _in_groups(a, b, a_end, b_end)
        n_groups = np.bincount(unit_b[np.searchsorted(b_end, ends)], minlength=many)
        links = np.bincount(in_a, minlength=len(ends)) * np.bincount(in_b, minlength=len(ends))
        unit_of = unit_b[np.searchsorted(b_end, ends)]
        n_links = np.zeros(many, dtype=np.int64)
        np.add.at(n_links, unit_of, links)

        group_a, id_a, times_a = _counted(in_a, a)
        group_b, id_b, times_b = _counted(in_b, b)
        first_b = np.searchsorted(group_b, np.arange(len(ends) + 1))
        left, right = _ranges(first_b[group_a], first_b[group_a + 1] - first_b[group_a])
        pair = id_a[left] << 32 | id_b[right]
        unit, pair, times = _counted(unit_of[group_a[left]], pair, times=times_a[left] * times_b[right])

        size = np.bincount(unit, minlength=many)
        self.start.extend(self.pair.size + np.cumsum(size) - size)
        self.size.extend(size)
        self.pair.extend(pair)
        self.times.extend(times)
        for column, values in zip(self.facts, (n_a, n_b, n_groups, n_links), strict=True):
            column.extend(values)
        texts = self._texts(a, b, in_a, in_b, len(ends))
        at = 0
        for n in n_groups.tolist():
            self.groups.append(";".join(texts[at : at + n]).encode())
            self.text_bytes += len(self.groups[-1])
            at += n

    @staticmethod
    def _texts(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, many: int) -> list[str]:
        def sides(ids: np.ndarray, group: np.ndarray) -> list[str]:
            size, written = np.bincount(group, minlength=many), list(map(str, ids.tolist()))
            if len(written) == many:  # one token a group
                return written
            cuts = np.concatenate([[0], np.cumsum(size)]).tolist()
            return [written[i] if j - i == 1 else ",".join(written[i:j]) for i, j in itertools.pairwise(cuts)]

        return [f"{x}|{y}" for x, y in zip(sides(a, in_a), sides(b, in_b), strict=True)]


def _units(texts: W.Texts, marks: np.ndarray) -> tuple[W.Words, np.ndarray]:
    """The units of texts, without the space that one may begin with, and whether it begins with a mark instead."""
    data, at = texts.data, texts.offsets
    n = len(data)
    blank, mark = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
    if n:
        blank[1:n] = (data[1:] == 0x20) & _PRINTABLE[data[:-1]]
        mark[1:n] = marks[data[1:]] & _LETTER[data[:-1]]
        blank[at] = mark[at] = False
    begin = blank | mark
    begin[at[:-1][np.diff(at) > 0]] = True
    start = np.flatnonzero(begin[:n])
    return W.Words(start + blank[start], np.append(start[1:], n)[: len(start)], np.searchsorted(start, at)), mark[start]


class _Aligned(NamedTuple):
    """The documents of a slice, and their postings in order of pair and document."""

    facts: list[np.ndarray]
    groups: list[bytes]
    pair: np.ndarray
    row: np.ndarray
    times: np.ndarray


def _aligned(texts: W.Texts, units: Units) -> _Aligned:
    if units.held() > REMEMBERED:
        units.forget()
    found, mark = _units(texts, units.tokenizers.marks)
    number = units.numbers(texts.data, found.start, found.end, mark)
    sums = [np.concatenate([[0], np.cumsum(f.values[number])]) for f in (*units.facts,)]
    strange = np.concatenate([[0], np.cumsum(units.facts[0].values[number] == 0)])
    good = np.diff(strange[found.first]) == 0
    facts = [np.where(good, np.diff(s[found.first]), 0) for s in sums]
    groups = [
        b";".join([units.groups[i] for i in number[found.first[r] : found.first[r + 1]].tolist()]) if good[r] else b""
        for r in range(len(texts))
    ]
    row = np.repeat(np.arange(len(texts)), np.diff(found.first))
    row, number, times = _counted(row[good[row]], number[good[row]])
    size = units.size.values[number]
    own = np.repeat(np.arange(len(number)), size)
    pair = gather(units.pair.values, units.start.values[number], size)
    each = gather(units.times.values, units.start.values[number], size)
    pair, row, times = _counted(pair, row[own], times=each * times[own])
    return _Aligned(facts, groups, pair, row, times)


def bitmaps(pair: np.ndarray, low: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(pair, plane, compressed bitmap) of postings in order of pair and document number."""
    for plane in range(int(times.max(initial=1) - 1).bit_length() + 1):
        mask = slice(None) if not plane else np.flatnonzero((times - 1) >> (plane - 1) & 1)
        own, docs = pair[mask], low[mask].astype("<u2")
        if not len(own):
            continue
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
        dense = np.flatnonzero(2 * np.diff(cuts) >= _BITS)
        if not len(dense):
            packed = pa.Array.from_buffers(
                pa.binary(), len(cuts) - 1, [None, pa.py_buffer((2 * cuts).astype(np.int32)), pa.py_buffer(docs)]
            )
        else:
            values = [docs[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            for i in dense.tolist():
                bits = np.zeros(SEGMENT, dtype=np.uint8)
                bits[docs[cuts[i] : cuts[i + 1]]] = 1
                values[i] = np.packbits(bits, bitorder="little").tobytes()
            packed = pa.array(values, pa.binary())
        yield own[cuts[:-1]], np.full(len(cuts) - 1, plane, dtype=np.int32), packed


def unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The document numbers of compressed bitmaps, and which bitmap each is of; sparse bitmaps come first."""
    size = np.diff(np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1])
    sparse = np.flatnonzero(size < _BITS)
    values = packed.take(pa.array(sparse))
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[: int(size[sparse].sum())].view("<u2")
    numbers, owners = [data], [np.repeat(sparse, size[sparse] // 2)]
    for i in np.flatnonzero(size >= _BITS).tolist():
        bits = np.unpackbits(np.frombuffer(packed[i].as_buffer(), np.uint8), bitorder="little")
        numbers.append(np.flatnonzero(bits))
        owners.append(np.full(len(numbers[-1]), i))
    return np.concatenate(numbers).astype(np.int64), np.concatenate(owners)


_FACTS = ["n_a", "n_b", "n_groups", "n_links"]


class _Segments:
    """Numbers the documents of a task, gathers their postings and writes both out as batches of one schema."""

    def __init__(self, id_type: pa.DataType, task: int, keep_groups: bool) -> None:
        self.keep_groups, self.segment = keep_groups, task << 32
        self.schema = pa.schema(
            [("segment", pa.int64()), ("low", pa.int32()), ("id", id_type), *[(c, pa.int64()) for c in _FACTS]]
            + [("groups", pa.string()), ("groups_sha256", pa.string())]
            + [("pair", pa.int64()), ("plane", pa.int32()), ("docs", pa.binary())]
        )
        self._empty()

    def _empty(self) -> None:
        self.rows, self.bytes = 0, 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _batch(self, columns: dict[str, object], rows: int) -> pa.RecordBatch:
        columns = {"segment": np.full(rows, self.segment), **columns}
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def close(self) -> Iterator[pa.RecordBatch]:
        """The segment's bitmaps: those of its slices, which have different documents, OR-merged."""
        if self.held:
            pair, low, times = (np.concatenate(c) for c in zip(*self.held, strict=True))
            order = np.argsort(pair, kind="stable")  # slices follow each other, so documents stay in order
            for own, plane, docs in bitmaps(pair[order], low[order], times[order]):
                yield self._batch({"pair": own, "plane": plane, "docs": docs}, len(own))
        self.segment += 1
        self._empty()

    def add(self, ids: pa.Array, size: int, found: _Aligned) -> Iterator[pa.RecordBatch]:
        rows = len(ids)
        if self.rows and (self.rows + rows > SEGMENT or self.bytes + size > SEGMENT_BYTES):
            yield from self.close()
        digest = [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups]
        columns = {"low": np.arange(self.rows, self.rows + rows), "id": ids, "groups_sha256": digest}
        columns |= dict(zip(_FACTS, found.facts, strict=True))
        if self.keep_groups:
            columns["groups"] = [g.decode() for g in found.groups]
        yield self._batch(columns, rows)
        if len(found.pair):
            self.held.append((found.pair, found.row + self.rows, found.times))
        self.rows, self.bytes = self.rows + rows, self.bytes + size


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    units, out = Units(path_a, path_b), None
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("id"))
        out = out or _Segments(ids.type, TaskContext.get().partitionId(), keep_groups)
        for begin in range(0, batch.num_rows, SEGMENT):
            for texts in W.slices(batch.slice(begin, SEGMENT)):
                own = ids.slice(begin + texts.first, len(texts))
                yield from out.add(own, len(texts.data), _aligned(texts, units))
    if out:
        yield from out.close()


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the sums over its postings; rows arrive ordered by segment."""
    at: int | None = None
    totals = np.zeros((2, SEGMENT), dtype=np.int64)

    def done() -> Iterator[pa.RecordBatch]:
        low = np.flatnonzero(totals[0])
        columns = [np.full(len(low), at, dtype=np.int64), low.astype(np.int32), totals[0, low], totals[1, low]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["segment", "low", "count_sum", "n_best"])

    for batch in batches:
        segment = batch.column(batch.schema.get_field_index("segment")).to_numpy()
        cuts = [0, *(np.flatnonzero(segment[1:] != segment[:-1]) + 1).tolist(), len(segment)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            if segment[lo] != at:
                if at is not None:
                    yield from done()
                    totals[:] = 0
                at = int(segment[lo])
            rows = batch.slice(lo, hi - lo)
            plane, count, best = (
                rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("plane", "documents", "best")
            )
            low, owner = unpacked(rows.column(rows.schema.get_field_index("docs")))
            links = np.int64(1) << np.maximum(plane - 1, 0)
            np.add.at(totals[0], low, (links * count)[owner])
            np.add.at(totals[1], low, (links * best)[owner])
    if at is not None:
        yield from done()


class Alignment(NamedTuple):
    """``documents``, one row per row of the input, and ``pairs``, one per linked id pair."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False
) -> Alignment:
    """Align a byte-level BPE (``path_a``) with a piece model (``path_b``) over all texts.

    ``documents`` has id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2``, null
    unless ``keep_groups``), ``groups_sha256`` ('' without tokens), ``n_best`` (links whose pair no other
    pair of its A id surpasses in documents) and ``count_sum`` (the documents of each link's pair, summed).
    ``pairs`` has a, b, ``documents``, ``links``, ``best`` and ``bitmaps`` (segments it is in).

    A text that is null or empty, or from which the tokens of either don't give back a
    space and the text, has no tokens. Rows that repeat are documents of their own. Other
    columns are ignored, whatever their names. An empty table gives empty ones. Both files
    must be readable by every executor. A pair's bitmaps are spread over the segments it
    is in; no task sees all of them.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    schema = f"segment long, low int, id {id_type}, {', '.join(f'{c} long' for c in _FACTS)}, groups string, groups_sha256 string"
    schema += ", pair long, plane int, docs binary"
    work = partial(_align, path_a=path_a, path_b=path_b, keep_groups=keep_groups)
    inverted = stage(texts.mapInArrow(work, schema), "inverted")

    postings = inverted.where("pair IS NOT NULL").select("segment", "pair", "plane", "docs")
    ones = F.when(F.octet_length("docs") < _BITS, F.octet_length("docs") / 2).otherwise(F.bitmap_count("docs")).cast("long")
    links = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    counts = postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, ones)).alias("documents"),
        F.sum(ones * links).alias("links"),
        F.count_if(F.col("plane") == 0).alias("bitmaps"),
    )
    counts = stage(counts.withColumn("a", F.shiftright("pair", 32).cast("int")), "counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    pairs = counts.join(most, "a").withColumn("best", F.col("documents") == F.col("most")).drop("most")
    pairs = stage(pairs, "pairs")

    scored = pairs.select("pair", "documents", "best")
    # The pairs that most bitmaps wait for come to the bitmaps; what is left has no hot key.
    hot = pairs.where(F.col("bitmaps") > HOT_SEGMENTS).orderBy(F.desc("bitmaps"), "pair").limit(BROADCAST_ROWS)
    hot = stage(hot.select("pair", "documents", "best"), "hot_pairs")
    met = postings.join(F.broadcast(hot), "pair").unionByName(
        postings.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(scored, "pair")
    )
    met = met.select("segment", "plane", "docs", "documents", "best")
    dealt = met.repartition("segment").sortWithinPartitions("segment")
    sums = dealt.mapInArrow(_scores, "segment long, low int, count_sum long, n_best long")

    rows = inverted.where("pair IS NULL").drop("pair", "plane", "docs").join(sums, ["segment", "low"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    documents = rows.select(
        F.col("id").alias(id_col), *_FACTS, "groups", "groups_sha256", zero("n_best"), zero("count_sum")
    )
    b = F.expr("cast(pair & 4294967295 AS int)").alias("b")
    return Alignment(documents, pairs.select("a", b, "documents", "links", "best", "bitmaps"))
