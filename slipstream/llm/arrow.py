"""Text columns as flat byte arrays, and hashes of byte and word windows over them."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECE = 1 << 19  # bytes of text that are worked on at a time; a longer text is a piece by itself

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@functools.cache
def _libc():
    try:
        library = ctypes.CDLL("libc.so.6")
        library.malloc_trim(0)
        return library
    except (OSError, AttributeError):  # another C library
        return None


def release() -> None:
    """Give free memory back to the system; a worker process lives on after its task."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def lean(function: Callable) -> Callable:
    """A function over batches, for mapInArrow, that leaves no memory behind when its task has ended."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return run


def extended(docs: DataFrame, columns: dict[str, T.DataType], begin: Callable, *inputs: str) -> DataFrame:
    """Rows with more columns, which replace columns of their names.

    ``begin()`` is called once for each task and gives a function from the arrays of the inputs to those of the new columns. Unlike an
    Arrow UDF it keeps nothing in the worker from task to task and loads no data frame library there.
    """
    kept = [f for f in docs.schema.fields if f.name not in columns]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in columns.items())])

    def run(batches):
        function = None
        for batch in batches:
            if batch.num_rows:
                function = function or begin()
                new = function(*[batch.column(i) for i in inputs])
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *new], schema.names)

    return docs.mapInArrow(lean(run), schema)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``limit`` bytes, or one row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield start, stop
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole number (in place where it can)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes; the order matters."""
    h = left * _ODD
    h += right
    h ^= h >> np.uint64(29)
    return h


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive entries at every place where they fit, by doubling."""
    if len(first) < size:
        return first[:0]
    return several(first, size)[0]


def several(first: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """`windows` of several sizes, none above twice the smallest, from the same doublings."""
    h, width = first, 1
    while width * 2 <= min(sizes):
        h = join(h[:-width], h[width:])
        width *= 2
    return [h if size == width else join(h[: max(0, len(h) - (size - width))], h[size - width :]) for size in sizes]


@functools.lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 2**64)):
        powers = np.full(1 << bits, b, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, by differences of one running sum."""
    up, down = _powers(_BASES[which], max(16, int(len(data)).bit_length()))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=running[1:])
    h = (running[ends] - running[starts]) * down[starts]
    h += (ends - starts).astype(np.uint64) * _ODD
    return mix(h)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of bytes other than ASCII white space; no word crosses rows."""
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = offsets[:-1][np.diff(offsets) > 0]
        before[edge] = False
        after[edge[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)
