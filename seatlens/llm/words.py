"""Words of texts as arrays: spans and 64-bit hashes, worked out for many texts at once.

A word is a run of bytes other than space and 0x09-0x0D. Texts stay in Arrow's
buffers; no Python string is made. Everything here runs inside a task on slices
of a few megabytes, however long the batch is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = np.asarray(x, dtype=_U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BLOCK_KEY = 0xD1342543DE82EF97
#: Bytes of a span that are summed up before their sum is mixed.
BLOCK = 256
# One value for every byte at every place of a block.
_PLACED = mix(mix(np.arange(1, BLOCK * 256 + 1, dtype=_U)) ^ _U(0x9E3779B97F4A7C15))


class Texts(NamedTuple):
    """A slice of a batch: rows ``first`` up to ``first + len(offsets) - 1``."""

    first: int
    data: np.ndarray  # bytes of all texts of the slice
    offsets: np.ndarray  # where each text begins, and the end

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text, the index of its first word; and the end


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[Texts]:
    """The texts of a batch in slices of about ``SLICE_BYTES``; a null text is empty."""
    array = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "").cast(pa.large_string())
    if not len(array):
        return
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(array):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(len(array), max(end, row + 1))
        yield Texts(row, bytes_[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def _runs(inside: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, none reaching over a ``cut``."""
    n = len(inside)
    after = np.ones(n + 1, dtype=bool)  # a new run can begin here
    after[1:n] = ~inside[:-1]
    after[cut[cut < n]] = True
    return np.flatnonzero(inside & after[:n]), np.flatnonzero(inside & np.append(after[1:n] | ~inside[1:], True)) + 1


def words(texts: Texts, cuts: np.ndarray | None = None) -> Words:
    """The words of texts, or the parts of words that further ``cuts`` make of them."""
    cut = texts.offsets if cuts is None else np.concatenate([texts.offsets, cuts])
    start, end = _runs(_IS_WORD[texts.data], cut) if len(texts.data) else (np.empty(0, np.int64),) * 2
    return Words(start, end, np.searchsorted(start, texts.offsets))


def lines(texts: Texts) -> Words:
    """The newline-separated lines that hold at least one character."""
    start, end = _runs(texts.data != 10, texts.offsets) if len(texts.data) else (np.empty(0, np.int64),) * 2
    return Words(start, end, np.searchsorted(start, texts.offsets))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span's bytes, A-Z lower-cased if asked for.

    Spans are in order and don't overlap. A block's hash is the sum of one random
    value per place and byte (tabulation); blocks are mixed with their number, so
    that no rule in a text, however long, cancels out.
    """
    if not len(start):
        return np.empty(0, dtype=_U)
    place = np.zeros(len(data), dtype=np.int64)
    inside = start[start < len(data)]  # an empty span may stand at the end
    place[inside] = inside
    place = np.arange(len(data), dtype=np.int64) - np.maximum.accumulate(place)
    place = (place & (BLOCK - 1)) << 8
    place |= LOWER[data] if lower else data
    total = np.zeros(len(data) + 1, dtype=_U)
    size = (end - start).astype(_U)
    with np.errstate(over="ignore"):
        np.cumsum(_PLACED[place], out=total[1:])
        long = np.flatnonzero(size > BLOCK)
        sums = total[end] - total[start]
        if len(long):
            many = -(-(end[long] - start[long]) // BLOCK)
            first = np.cumsum(many) - many
            block = np.arange(many.sum()) - np.repeat(first, many)
            begin = np.repeat(start[long], many) + block * BLOCK
            own = mix(total[np.minimum(begin + BLOCK, np.repeat(end[long], many))] - total[begin])
            sums[long] = mix(np.add.reduceat(mix(own ^ mix(block.astype(_U) ^ _U(_BLOCK_KEY))), first))
        return mix(sums ^ mix(size))


_SHINGLE = mix(np.arange(11, 75, dtype=_U))


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """The hashes of a text's windows of ``size`` words, in order.

    A text of fewer words has one window, the whole of it; one without words none.
    """
    n = len(word_hashes)
    if not n:
        return np.empty(0, dtype=_U)
    width = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, width, dtype=_U)
        for i in range(width):
            total += word_hashes[i : n - width + 1 + i] * (_SHINGLE[i] | _U(1))
    return mix(total)
