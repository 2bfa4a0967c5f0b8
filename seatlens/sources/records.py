"""Python records as Arrow batches, for sources decoded inside tasks."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa

_ROWS_PER_BATCH = 10_000


def to_batches(records: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size, made as the records come."""
    pending = iter(records)
    while chunk := list(itertools.islice(pending, _ROWS_PER_BATCH)):
        columns = zip(*chunk, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)
