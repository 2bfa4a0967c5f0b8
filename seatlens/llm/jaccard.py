"""N-gram Jaccard join by parity sketches.

A text is the set of its distinct word shingles, as 64-bit hashes. Two texts link
when ``100 * intersection >= percent * union``.

*Sketch.* A set's shingles are dealt by hash over k segments; every segment keeps
the XOR of its shingles' hashes, that is the parities of a very wide, sparse bit
row. One shingle more or less flips bits of one segment, so the number of
segments in which two sketches differ never exceeds the sets' symmetric
difference.

*Size bands.* A pair belongs to the band of its smaller set, sizes 2^j up to
2^(j+1). If it links, its symmetric difference is at most
``d = (100 - percent) * smaller / percent``. k is a fixed multiple of the band's
largest d, so at least k - d segments agree. A set is entered in its own band and,
if it can be the larger set of a pair, in the band below.

*Pigeonhole.* Of any ordered k segments of which k - d agree, the first d + 1 of
either side share one. Segments are ordered by the number of their shingles, most
first, so the d + 1 that are joined on are the selective ones and a passage that
many texts share hardly ever stands alone in one.

*Verify.* Sets that share a segment are compared in blocks, inside tasks: size
and a 256-bit parity sketch (whose Hamming distance bounds the symmetric
difference from below as well) leave few pairs, and these are compared shingle by
shingle. Equal sets are one node from the start. Links are looked for in two
rounds: the first tries, per segment, each set's closest earlier set; the second
tries every remaining pair of sets that still lie in different components, by a
sketch of 1,024 bits that tells hardly any other pair from a link. So no link
between components is lost, and pairs inside a group of near copies are not
written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatlens.llm import words as W
from seatlens.llm.graph import components
from seatlens.session import BROADCAST_ROWS, broadcast_if_small, stage

#: Segments per band, as a multiple of the d + 1 that have to be joined on.
SLACK = 1.3
#: Sets of one segment that are compared with each other in one go.
BLOCK = 2048
#: Compared pairs per step within a task.
TILE = 256

#: Bits of the sketches that the first and the second round compare.
_SKETCH_BITS, _WIDE_BITS = 256, 1024
#: Rows of one text, or of one component, beyond which its label is broadcast to them.
HOT_ROWS = 1000
_U = np.uint64


def most_apart(size: int, percent: int) -> int:
    """The largest symmetric difference of a linked pair whose smaller set has ``size`` members."""
    return (100 - percent) * size // percent


def _segments(members: np.ndarray, band: int, count: int, percent: int) -> np.ndarray:
    """Join keys of the ``count`` heaviest segments of a set's sketch in a band."""
    k = int(np.ceil(SLACK * (most_apart((2 << band) - 1, percent) + 1)))
    segment = ((members >> _U(20)) % _U(k)).astype(np.int64)
    weight = np.bincount(segment, minlength=k)
    parity = np.zeros(k, dtype=_U)
    np.bitwise_xor.at(parity, segment, members)
    heaviest = np.argsort(-weight, kind="stable")[:count]
    place = (_U(band) << _U(56)) + (heaviest.astype(_U) << _U(24)) + weight[heaviest].astype(_U)
    return W.mix(parity[heaviest] ^ W.mix(place + _U(1)))


def segment_keys(members: np.ndarray, percent: int) -> np.ndarray:
    """All join keys of one set, which is a sorted array of distinct hashes."""
    size = len(members)
    band = size.bit_length() - 1
    keys = [_segments(members, band, most_apart(size, percent) + 1, percent)]
    below = (1 << band) - 1  # the largest size of the band below
    if below and -(-percent * size // 100) <= below:
        keys.append(_segments(members, band - 1, most_apart(below, percent) + 1, percent))
    return np.concatenate(keys)


def parity_sketch(members: np.ndarray, bits: int = _SKETCH_BITS) -> bytes:
    parity = np.bincount((members & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[np.ndarray]:
    for texts in W.slices(batch):
        spans = W.words(texts)
        hashed = W.hashes(texts.data, spans.start, spans.end, lower=True)
        for i in range(len(texts)):
            yield np.unique(W.shingles(hashed[spans.first[i] : spans.first[i + 1]], shingle))


def _node(members: np.ndarray) -> int:
    """One value that stands for a set, from its size and two independent sums of its members."""
    with np.errstate(over="ignore"):
        sums = W.mix(members).sum(dtype=_U) ^ W.mix(W.mix(members ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U))
    return int(W.mix(sums + _U(len(members))).astype(np.int64))


def _digest(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, keys, sketches = [], [], [], []
        for members in _sets(batch, shingle):
            empty = not len(members)
            sizes.append(len(members))
            nodes.append(None if empty else _node(members))
            keys.append(np.empty(0, np.int64) if empty else segment_keys(members, percent).view(np.int64))
            sketches.append(b"" if empty else parity_sketch(members))
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("id")),
                batch.column(batch.schema.get_field_index("text_hash")),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(flat)),
                pa.array(sketches, pa.binary()),
            ],
            names=["id", "text_hash", "size", "node", "keys", "sketch"],
        )


def _members(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = batch.column(batch.schema.get_field_index("node"))
        at = 0
        for texts in W.slices(batch):  # a batch of sets is cut as its texts are
            sub = batch.slice(texts.first, len(texts))
            packed = [m.tobytes() for m in _sets(sub, shingle)]
            yield pa.RecordBatch.from_arrays(
                [node.slice(at, len(texts)), pa.array(packed, pa.binary())], names=["node", "members"]
            )
            at += len(texts)


def _wide_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = batch.column(batch.schema.get_field_index("members"))
        sets = [np.frombuffer(m.as_buffer(), _U) for m in packed]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("node")),
                pa.array([len(m) for m in sets], pa.int64()),
                pa.array([parity_sketch(m, _WIDE_BITS) for m in sets], pa.binary()),
            ],
            names=["node", "size", "sketch"],
        )


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose sets link."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            x, y = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by (key, i, j) as one dict of arrays per cell with two rows or more.

    A cell holds at most a few thousand rows, so what is carried from one batch
    to the next is small.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        yield from _take(held, last=False)
        held = held.slice(_tail(held))
    if held is not None and held.num_rows:
        yield from _take(held, last=True)


def _borders(table: pa.Table) -> np.ndarray:
    cell = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
    return np.concatenate([[0], np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1])


def _tail(table: pa.Table) -> int:
    return int(_borders(table)[-1])


def _take(table: pa.Table, last: bool) -> Iterator[dict[str, np.ndarray]]:
    borders = _borders(table)
    ends = np.append(borders[1:], table.num_rows)
    whole = slice(None) if last else slice(0, -1)
    columns = {c: table.column(c).to_numpy() for c in table.column_names if c != "sketch"}
    packed = table.column("sketch").combine_chunks()
    packed = pa.concat_arrays(packed.chunks) if isinstance(packed, pa.ChunkedArray) else packed
    sketch = np.frombuffer(packed.buffers()[2], np.uint8)
    at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset]
    width = len(packed[0].as_py())
    sketch = sketch[at : at + len(packed) * width].view(_U).reshape(len(packed), -1)
    for lo, hi in zip(borders[whole], ends[whole], strict=True):
        if hi - lo > 1:
            yield {c: v[lo:hi] for c, v in columns.items()} | {"sketch": sketch[lo:hi]}


def _close(cell: dict[str, np.ndarray], rows: slice, percent: int) -> np.ndarray:
    """Hamming distance of some rows to all rows of a cell; a huge value where no link is possible."""
    size, sketch = cell["size"], cell["sketch"]
    apart = np.bitwise_count(sketch[rows, None, :] ^ sketch[None, :, :]).sum(axis=2, dtype=np.int32)
    a, b = size[rows, None], size[None, :]
    # 100 I >= p U with I = (a + b - d) / 2 and U = (a + b + d) / 2
    possible = (100 + percent) * apart.astype(np.int64) <= (100 - percent) * (a + b)
    possible &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    if cell["i"][0] != cell["j"][0]:  # two blocks of one large bucket: only pairs across
        possible &= cell["block"][rows, None] != cell["block"][None, :]
    return np.where(possible, apart, np.int32(1 << 30))


def _tiles(cell: dict[str, np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each tile's first row, and distances to the rows before each of its rows."""
    n = len(cell["node"])
    tile = TILE * _SKETCH_BITS // (64 * cell["sketch"].shape[1])  # wider sketches, fewer rows
    for lo in range(0, n, tile):
        hi = min(n, lo + tile)
        apart = _close({c: v[:hi] if c not in "ij" else v for c, v in cell.items()}, slice(lo, hi), percent)
        apart[np.arange(hi)[None, :] >= np.arange(lo, hi)[:, None]] = 1 << 30
        yield lo, apart


def _pairs(u: list[np.ndarray], v: list[np.ndarray]) -> pa.RecordBatch:
    x = np.concatenate(u) if u else np.empty(0, np.int64)
    y = np.concatenate(v) if v else np.empty(0, np.int64)
    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])


_PAIRS_HELD = 200_000


def _candidates(batches: Iterator[pa.RecordBatch], percent: int, across: bool) -> Iterator[pa.RecordBatch]:
    """Pairs worth comparing: each row's closest earlier row, or all rows of other components."""
    u: list[np.ndarray] = []
    v: list[np.ndarray] = []
    held = 0
    for cell in _cells(batches):
        node = cell["node"]
        if across and (cell["label"] == cell["label"][0]).all():
            continue
        for lo, apart in _tiles(cell, percent):
            if across:
                hi = lo + len(apart)
                apart[cell["label"][lo:hi, None] == cell["label"][None, : apart.shape[1]]] = 1 << 30
                mine, other = np.nonzero(apart < 1 << 30)
            else:
                other = apart.argmin(axis=1)
                mine = np.flatnonzero(apart[np.arange(len(apart)), other] < 1 << 30)
                other = other[mine]
            u.append(node[lo + mine])
            v.append(node[other])
            held += len(mine)
        if held > _PAIRS_HELD:
            yield _pairs(u, v)
            u, v, held = [], [], 0
    yield _pairs(u, v)


def _bucketed(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of buckets, large buckets cut into blocks, one cell for each two blocks.

    A bucket of n blocks is entered n times per row and not as pairs; every cell
    has a bounded number of rows and can go to another task.
    """
    counts = shared.groupBy("key").agg(F.count("*").alias("rows"))
    large = counts.where(F.col("rows") > BLOCK).withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    rows = shared.join(large.select("key", "blocks"), "key", "left").join(nodes, "node")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1, F.lit(1)))
    )
    cell = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return cell.drop("blocks", "other").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("b"))
    both = pairs.distinct().join(left, "u").join(right, "v")
    return both.mapInArrow(partial(_linked, percent=percent), "u long, v long")


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Per row: id, text_hash, size, node and label, the smallest node of its component; null without a word."""
    text = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    id_type = text.schema["id"].dataType.simpleString()
    digest = f"id {id_type}, text_hash long, size long, node long, keys array<long>, sketch binary"
    rows = stage(text.mapInArrow(partial(_digest, shingle=shingle, percent=percent), digest), "digests")
    filled = rows.where("node is not null")

    entries = filled.select("node", F.explode("keys").alias("key"))
    several = entries.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    shared = stage(entries.join(several.select("key"), "key").distinct(), "shared")

    nodes = shared.select("node").distinct()
    facts = filled.groupBy("node").agg(
        F.any_value("size").alias("size"),
        F.any_value("sketch").alias("sketch"),
        F.min("text_hash").alias("text_hash"),
        F.count("*").alias("rows"),
    )
    facts = stage(facts.join(nodes, "node"), "facts")
    wanted = broadcast_if_small(facts.select("node", "text_hash"))
    sets = text.select("text_hash", "text").join(wanted, "text_hash").select("node", "text")
    sets = sets.mapInArrow(partial(_members, shingle=shingle), "node long, members binary")
    sets = stage(sets.dropDuplicates(["node"]), "sets")

    sketches = facts.select("node", "size", "sketch")
    pair = "u long, v long"
    first = _bucketed(shared, sketches).mapInArrow(partial(_candidates, percent=percent, across=False), pair)
    links = stage(_verified(first, sets, percent), "links")
    groups = components(links)

    label = F.coalesce("label", "node")
    placed = shared.join(groups, "node", "left").select("key", "node", label.alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b")
    rest = stage(placed.join(mixed.select("key"), "key"), "mixed")
    wide = sets.join(rest.select("node").distinct(), "node").mapInArrow(_wide_sketches, "node long, size long, sketch binary")
    second = _bucketed(rest, stage(wide, "wide")).mapInArrow(partial(_candidates, percent=percent, across=True), pair)
    more = _verified(second, sets, percent)
    groups = components(stage(more.union(groups.select(F.col("node").alias("u"), F.col("label").alias("v"))), "links"))

    hot = facts.where(F.col("rows") > HOT_ROWS).join(groups, "node").select("node", "label", "rows")
    nodes = rows.select("id", "text_hash", "size", "node")
    found = _met(nodes.where("node IS NOT NULL"), groups, "node", hot).withColumn("label", label)
    return stage(found.unionByName(nodes.where("node IS NULL").withColumn("label", F.lit(None).cast("long"))), "labelled")


def _met(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``rows`` left-joined to ``facts``, one per key. ``hot`` has those of keys with many rows, with their ``rows``.

    As many of these as may be broadcast are, the most frequent first; no task gets all rows of one.
    """
    most = stage(hot.orderBy(F.desc("rows"), key).limit(BROADCAST_ROWS).drop("rows"), "hot")
    near = rows.join(F.broadcast(most), key)
    rest = rows.join(F.broadcast(most.select(key)), key, "left_anti").join(facts, key, "left")
    return near.unionByName(rest)


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.
    ``component_id`` is the smallest id that links lead to, the row's own
    included. Texts link when their sets of ``shingle``-word shingles have a
    Jaccard similarity of ``percent`` / 100 or more. A text of fewer words is one
    shingle; a text that is null or has no word has none and is linked with
    nothing, its component is its own id.

    Rows with equal texts are linked. Rows that share an id stay separate rows.
    A null id never names a component unless all of its ids are null. Other
    columns are ignored, whatever their names. An empty table gives an empty one.
    """
    labelled = _labelled(docs, id_col, text_col, shingle, percent)
    alone, linked = labelled.where("label IS NULL"), labelled.where("label IS NOT NULL")
    smallest = stage(linked.groupBy("label").agg(F.min("id").alias("smallest"), F.count("*").alias("rows")), "smallest")
    found = _met(linked, smallest.drop("rows"), "label", smallest.where(F.col("rows") > HOT_ROWS))
    found = found.unionByName(alone, allowMissingColumns=True)
    return found.select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with one row of each group of linked texts: the smallest id, then the smallest hash of the text.

    Rows whose text is null or has no word are in no group and stay, though a row
    that is there twice stays once. A null id is larger than all others. All
    columns are kept.
    """
    labelled = _labelled(docs, id_col, text_col, shingle, percent)
    row = F.struct(F.xxhash64("id").alias("id_hash__"), F.col("text_hash").alias("text_hash__"))
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("text_hash").alias("c"))
    first = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min_by(row, order).alias("row"))
    alone = labelled.where("label IS NULL").select(row.alias("row"))
    chosen = stage(first.select("row").union(alone).distinct().select("row.*"), "chosen")
    keys = ["id_hash__", "text_hash__"]
    hashed = docs.withColumn(keys[0], F.xxhash64(id_col)).withColumn(keys[1], F.xxhash64(text_col))
    once = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return hashed.join(chosen, keys).withColumn("once__", once).where("once__ = 1").select(*docs.columns)
