"""Rows to and from Arrow batches in Python workers: few documents are Python objects at a time, and many leave in one batch."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterable, Iterator

import pyarrow as pa

TYPES = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}
#: A batch that leaves has at most so many rows, or about so many characters; of one that comes, so many rows are taken at a time.
BATCH_ROWS, BATCH_CHARS, TAKEN_ROWS = 10_000, 1 << 22, 64


def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows by name."""
    for batch in batches:
        row = namedtuple("row", batch.schema.names)
        for at in range(0, batch.num_rows, TAKEN_ROWS):
            yield from map(row._make, zip(*(c.to_pylist() for c in batch.slice(at, TAKEN_ROWS).columns), strict=True))


def batched(rows: Iterable, columns: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows, whatever document they are of. columns is a schema as Spark writes it."""
    names, types = zip(*(c.split(" ", 1) for c in columns.split(", ")), strict=True)

    def made(kept: list) -> pa.RecordBatch:
        parts = zip(*kept, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([list(v.items()) for v in p] if t.startswith("map") else p, TYPES[t]) for p, t in zip(parts, types, strict=True)], names=list(names))

    kept, size = [], 0
    for r in rows:
        kept.append(r)
        size += sum([len(v) for v in r if type(v) is str])
        if len(kept) >= BATCH_ROWS or size >= BATCH_CHARS:
            yield made(kept)
            kept, size = [], 0
    if kept:
        yield made(kept)
