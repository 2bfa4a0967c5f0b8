"""Records of CSV files whose quoted texts hold line breaks, read in blocks by many tasks.

A line alone doesn't say whether it begins inside a quoted text, but what it does to
that state: it keeps it, turns it over, or ends inside or outside whatever came
before. These four are closed under composition, so a block of a file, and any run of
blocks, is one of them too.

One pass over the lines, in the tasks that read them, puts a block's lines together
to records. Until the first line that ends the same way whatever came before, it
notes what each line would be for both states that the block may begin in; behind
that line all is known. A prefix pass over the blocks (a row each) then tells how each
one begins, which settles the lines noted; those of records that go on from block to
block are joined. So nothing but these few is shuffled.

Quotes count where a field begins; a quote within an unquoted field is a plain
character, two of them within a quoted one stand for one. Lines end in \\n or \\r\\n.
A file in which a quoted text never ends is left out with that reason.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatlens.session import broadcast_if_small, stage

UNENDED = "a quoted text does not end"

# On lines without doubled quotes: whether the end is inside, for a line that begins outside or inside.
_FIELDS = r'(?:(?:"[^"]*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+$'
_OPENS = f"^{_FIELDS}"
_OPENS_AGAIN = rf'^[^"]*+"[^,]*+,{_FIELDS}'

# A text: whether it is a whole record, and the line that opened the record that it is in
# or begins (null: an earlier block's), if its block begins outside or inside.
# A block (text is null): whether it ends inside, and the line that opened its last record.
_PARTS = (
    "uri string, source_block bigint, row_pos bigint, text string,"
    " from_outside boolean, from_inside boolean, opened_outside bigint, opened_inside bigint"
)
_NONE = -1


def _ends_inside(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted text: where it begins outside, and where it begins inside."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    quoted = F.contains(line, F.lit('"'))  # most lines: one search
    outside = F.when(quoted, single.rlike(_OPENS)).otherwise(False)
    inside = F.when(quoted, ~F.contains(single, F.lit('"')) | single.rlike(_OPENS_AGAIN)).otherwise(True)
    return outside, inside


def _turned(inside: Column, turns: Column) -> Column:
    """A state after a number of turns."""
    return inside != (turns % 2 == 1)


def _state(fixed: Column, turns: Column, start: Column) -> Column:
    """The state behind a run of lines that begins at ``start``.

    ``fixed`` is what the last line that ends the same way whatever came before ended
    as, with the turns up to it; ``turns`` are those of the whole run.
    """
    return F.when(fixed.isNull(), _turned(start, turns)).otherwise(_turned(fixed["inside"], turns - fixed["turns"]))


class Records(NamedTuple):
    """``rows`` (uri, source_block, row_pos, record), headers included, and the ``unended`` files (uri)."""

    rows: DataFrame
    unended: DataFrame


def _joined(lines: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The lines between each two bounds as one text."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines), "\n")


class _Block:
    """The lines of a block as they come, and what is known of them so far."""

    def __init__(self, uri: str, start: int) -> None:
        self.key = uri, start
        self.inside = None if start else False  # None: depends on how the block begins
        self.turned = False  # as long as it does: whether the lines so far turn the state over
        self.opened = [_NONE, _NONE]  # the record that is open if the block begins outside, inside
        self.first, self.pending = _NONE, []  # the record that is open in any case, and its lines

    def _parts(self, places, texts, whole=(True, True), opened=(_NONE, _NONE)) -> pa.RecordBatch:
        many = len(texts)
        opened = [np.broadcast_to(np.asarray(o, np.int64), many) for o in opened]
        columns = [
            pa.repeat(self.key[0], many),
            pa.repeat(pa.scalar(self.key[1], pa.int64()), many),
            pa.array(places, pa.int64()),
            texts,
            *[pa.array(np.broadcast_to(np.asarray(w, bool), many)) for w in whole],
            *[pa.array(o, mask=o == _NONE) for o in opened],
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PARTS.split(", ")])

    def take(self, places: np.ndarray, texts: pa.Array, outside: np.ndarray, inside: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Lines with their places and whether they end inside if they begin outside, inside."""
        unknown = 0
        if self.inside is None:
            fixed = np.flatnonzero(outside == inside)
            unknown = fixed[0] + 1 if len(fixed) else len(places)
            yield self._unsettled(places[:unknown], texts[:unknown], outside[:unknown], inside[:unknown])
        if unknown < len(places):
            yield from self._settled(places[unknown:], texts[unknown:], outside[unknown:], inside[unknown:])

    def _unsettled(self, places, texts, outside, inside) -> pa.RecordBatch:
        turns = outside & ~inside
        turned = (self.turned + np.cumsum(turns)) % 2 == 1
        before = turned ^ turns
        whole, opened = [], []
        for state in (False, True):
            within = before ^ state
            whole.append(~within & ~np.where(within, inside, outside))
            begun = np.where(within, _NONE, places)
            opened.append(np.maximum(np.maximum.accumulate(begun), self.opened[state]))
        self.opened, self.turned = [o[-1] for o in opened], bool(turned[-1])
        if outside[-1] == inside[-1]:
            self.inside = bool(outside[-1])
        return self._parts(places, texts, whole, opened)

    def _settled(self, places, texts, outside, inside) -> Iterator[pa.RecordBatch]:
        many = len(places)
        turns = np.cumsum(outside & ~inside)
        fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(many), _NONE))
        known = np.where(fixed == _NONE, self.inside, outside[fixed])
        after = known ^ ((turns - np.where(fixed == _NONE, 0, turns[fixed])) % 2 == 1)
        starts = np.flatnonzero(~np.concatenate([[self.inside], after[:-1]]))
        self.inside = bool(after[-1])
        going_on = starts[0] if len(starts) else many
        if going_on and self.first == _NONE:
            yield self._parts(places[:going_on], texts[:going_on], (False, False), self.opened)
        elif going_on:
            self.pending.append(texts[:going_on])
        if self.first != _NONE and (len(starts) or not self.inside):
            yield self._parts([self.first], self._open_text())
            self.first, self.pending = _NONE, []
        if len(starts) and self.inside:
            self.first, self.pending = places[starts[-1]], [texts[starts[-1] :]]
        elif len(starts):
            starts = np.append(starts, many)
        if len(starts) > 1:
            yield self._parts(places[starts[:-1]], _joined(texts, starts))

    def _open_text(self) -> pa.Array:
        lines = pa.concat_arrays(self.pending)
        return _joined(lines, np.array([0, len(lines)]))

    def close(self) -> Iterator[pa.RecordBatch]:
        """What the block's end leaves open, and what the block does as a whole."""
        opened = self.opened
        if self.first != _NONE:
            opened = [self.first, self.first]
            yield self._parts([self.first], self._open_text(), (False, False), opened)
        ends = (self.turned, not self.turned) if self.inside is None else (self.inside, self.inside)
        yield self._parts([None], pa.nulls(1, pa.string()), ends, opened)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of blocks whose lines come one behind the other."""
    block = None
    for batch in batches:
        uris, starts, places = batch["uri"], batch["source_block"].to_numpy(), batch["row_pos"].to_numpy()
        texts = batch["value"].cast(pa.string())
        outside, inside = (batch[c].to_numpy(zero_copy_only=False) for c in ("from_outside", "from_inside"))
        other = pc.not_equal(uris[1:], uris[:-1]).to_numpy(zero_copy_only=False) | (starts[1:] != starts[:-1])
        bounds = [0, *(np.flatnonzero(other) + 1), len(starts)]
        for low, high in zip(bounds, bounds[1:]):
            if low == high:
                continue
            key = uris[low].as_py(), int(starts[low])
            if block is None or block.key != key:
                if block is not None:
                    yield from block.close()
                block = _Block(*key)
            yield from block.take(places[low:high], texts[low:high], outside[low:high], inside[low:high])
    if block is not None:
        yield from block.close()


def read_records(lines: DataFrame) -> Records:
    """The records of ``lines``: uri, source_block (a file's blocks in order), row_pos (order within the block), value.

    A task must have a block's lines one behind the other in their order, as a scan of
    the files has them. A record stands where its first line does. Records of blanks
    only are left out.
    """
    outside, inside = _ends_inside(F.col("value"))
    lines = lines.select("uri", "source_block", "row_pos", "value", outside.alias("from_outside"), inside.alias("from_inside"))
    parts = stage(lines.mapInArrow(_read_blocks, _PARTS), "quoted-parts")

    # The state that each block begins in, and the last record begun before it, block after block.
    file = Window.partitionBy("uri").orderBy("source_block")
    so_far = file.rowsBetween(Window.unboundedPreceding, 0)
    turn = F.col("from_outside") & ~F.col("from_inside")
    fixed = F.col("from_outside") == F.col("from_inside")
    blocks = parts.where(F.col("text").isNull()).drop("row_pos", "text")
    blocks = blocks.withColumn("turns", F.sum(F.when(turn, 1).otherwise(0)).over(so_far))
    end = F.struct(F.col("from_outside").alias("inside"), "turns")
    blocks = blocks.withColumn("fixed", F.last(F.when(fixed, end), ignorenulls=True).over(so_far))
    blocks = blocks.withColumn("ends", _state(F.col("fixed"), F.col("turns"), F.lit(False)))
    blocks = blocks.withColumn("begins", F.coalesce(F.lag("ends").over(file), F.lit(False)))
    opened = F.when(F.col("begins"), F.col("opened_inside")).otherwise(F.col("opened_outside"))
    own = F.when(opened.isNotNull(), F.struct("source_block", opened.alias("row_pos")))
    opener = F.last(own, ignorenulls=True).over(file.rowsBetween(Window.unboundedPreceding, -1))
    blocks = stage(blocks.select("uri", "source_block", "begins", "ends", opener.alias("opener")), "quoted-blocks")
    unended = blocks.groupBy("uri").agg(F.max_by("ends", "source_block").alias("inside")).where("inside").select("uri")

    place, certain = ("uri", "source_block", "row_pos"), F.col("from_outside") & F.col("from_inside")
    texts = parts.where(F.col("text").isNotNull())
    noted = texts.where(~certain).join(broadcast_if_small(blocks), ["uri", "source_block"])
    whole = F.when(F.col("begins"), F.col("from_inside")).otherwise(F.col("from_outside"))
    noted = noted.select(*place, "text", whole.alias("whole"), F.coalesce(own, F.col("opener")).alias("first"))
    piece = F.struct("source_block", "row_pos", "text")
    joined = noted.where(~F.col("whole")).groupBy("uri", "first").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda x: x["text"]), "\n")
    joined = joined.select("uri", "first.source_block", "first.row_pos", text.alias("text"))

    rows = texts.where(certain).select(*place, "text").unionByName(noted.where("whole").select(*place, "text")).unionByName(joined)
    record = F.when(F.contains("text", F.lit("\r")), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    rows = rows.select(*place, record.alias("record")).where(F.trim("record") != "")
    return Records(rows, stage(unended, "unended"))


def without_headers(rows: DataFrame) -> DataFrame:
    """All records but the first of each file."""
    place = F.struct("source_block", "row_pos")
    first = stage(rows.groupBy("uri").agg(F.min(place).alias("header")), "quoted-headers")
    return rows.join(broadcast_if_small(first), "uri").where(place != F.col("header")).drop("header")


def fields(record: Column, width: int, surplus: str) -> Column:
    """A record's fields _0, _1, … as a struct of texts; what is beyond them in ``surplus``."""
    names = [*[f"_{i}" for i in range(width)], surplus]
    return F.from_csv(record, F.lit(", ".join(f"{n} string" for n in names)), {"escape": '"'})
