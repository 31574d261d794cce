"""Arrow helpers shared by the text operators: bounded slices, words, lines, per-document sums."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose texts add up to about ``limit`` bytes.

    A piece has one row at least, so only a single very long text goes beyond.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def unused(columns: Iterable[str], name: str) -> str:
    """A column name like ``name`` that is not among the columns, whatever their case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def filled(column: pa.Array) -> pa.Array:
    """Strings with the empty text for null."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts, and where each text's words start and end."""
    split = pc.ascii_split_whitespace(filled(column))
    flat = split.flatten()
    offsets = split.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return flat.filter(full), kept[offsets - offsets[0]]


def coded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each string, and the distinct strings by that number."""
    if not len(flat):
        return np.empty(0, np.int64), pa.array([], pa.large_string())
    encoded = flat.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings one after the other, and where each starts and ends."""
    raw = column.cast(pa.large_binary())
    if not len(raw):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
