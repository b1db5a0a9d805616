"""Packed exchanges: many small numbers go through a shuffle as few rows of byte arrays, one for each bucket and chunk.

A mapper gathers the numbers of many documents (a chunk), sorts them by bucket and emits one row for each bucket. A reducer
sees the rows of a bucket one after another and works on them with array operations. Buckets are cut from the top bits of a
hash, so their number follows the number of shuffle partitions and a bucket's size follows that of a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import arrow

NULL_ID = np.int64(2**63 - 1)  # order of a null id: behind all others
NAMELESS = 2**62  # ids from here on are names of texts without a key


def buckets(spark: SparkSession) -> int:
    """One for each shuffle partition, so a bucket is as large as a partition is meant to be."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack_ids(ids: np.ndarray) -> bytes:
    """64-bit numbers as the first one and the differences in as few bytes as the largest one needs."""
    if not len(ids):
        return b""
    steps = np.diff(ids)
    for kind in (np.int8, np.int16, np.int32):
        if not len(steps) or (steps.min() >= np.iinfo(kind).min and steps.max() <= np.iinfo(kind).max):
            steps = steps.astype(kind)
            break
    return ids[:1].astype("<i8").tobytes() + steps.tobytes()


def unpack_ids(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    out[0] = np.frombuffer(data, "<i8", 1)[0]
    if n > 1:
        width = (len(data) - 8) // (n - 1)
        out[1:] = np.frombuffer(data, f"<i{width}", n - 1, 8)
        np.cumsum(out, out=out)
    return out


def bucket_of(codes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each 64-bit hash, by its top bits."""
    return ((codes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def blocks(spark: SparkSession) -> int:
    """Blocks of documents: an odd number, so that ids with a common stride do not share a block."""
    return buckets(spark) + 1


def block_of(ids: np.ndarray, n: int) -> np.ndarray:
    """The block of documents that an id belongs to; `block_column` is the same as a column."""
    h = ids.astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(17)) ^ (h >> np.uint64(34))) & np.uint64(2**62 - 1)
    return (h % np.uint64(n)).astype(np.int32)


def order_column(key: str):
    """The id as a 64-bit number; a null id comes behind all others."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit(int(NULL_ID)))


def named_column(key: str, text: str):
    """The id as a 64-bit number. A row without one is named by its text, from `NAMELESS` on, so that such rows are told apart and
    dealt out like all others; `rank` brings their order back. Keys themselves are smaller."""
    own = F.col(f"`{key}`").cast("bigint")
    name = F.lit(NAMELESS) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), 2)
    small = F.when(own < NAMELESS, own).otherwise(F.raise_error(F.lit("keys of 2^62 and more are not read")).cast("bigint"))
    return F.when(own.isNull(), name).otherwise(small)


def rank(ids: np.ndarray) -> np.ndarray:
    """The order of ids made by `named_column`: rows without a key come behind all others, and none before another."""
    return np.minimum(ids, NAMELESS)


def block_column(key: str, n: int):
    """The block of an id made by `named_column`."""
    return F.expr(f"CAST(((`{key}` ^ shiftrightunsigned(`{key}`, 17) ^ shiftrightunsigned(`{key}`, 34)) & {2**62 - 1}L) % {n} AS INT)")


def cut(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(number, rows) of every run of equal numbers in a sorted array."""
    if len(part):
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip(np.concatenate([[0], edges]).tolist(), np.concatenate([edges, [len(part)]]).tolist()):
            yield int(part[a]), slice(a, b)


def grouped(batches, key: int = 0) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of rows with one value of a column, from batches sorted by it."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        for value, rows in cut(batch.column(key).to_numpy(zero_copy_only=False)):
            if value != current and held:
                yield current, held
                held = []
            current = value
            held.append(batch.slice(rows.start, rows.stop - rows.start))
    if held:
        yield current, held


def dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows dealt out by their first column, each task's rows in the given order."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, order[0]).sortWithinPartitions(*order)


#: Rows of an exchange. ``kind`` 0: numbers for the reducer of bucket ``part``; 1: notes for the documents of block ``part``.
#: ``ids`` are packed, the other columns are plain arrays with one entry for each id.
SCHEMA = "kind int, part int, n int, ids binary, codes binary, checks binary, places binary"
_ARROW = pa.schema(
    [("kind", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "codes", "checks", "places"))]
)


def rows_of(kind: int, part: np.ndarray, ids: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket or block with its numbers; ids of one part in ascending order, so that they pack well."""
    order = np.argsort(ids, kind="stable")
    few = len(part) and int(part.max()) < 1 << 16  # sorted by digits
    order = order[np.argsort((part.astype(np.uint16) if few else part)[order], kind="stable")]
    part, ids = part[order], ids[order]
    columns = {k: v[order] for k, v in columns.items()}
    out = {c: [] for c in _ARROW.names}
    for value, rows in cut(part):
        out["kind"].append(kind)
        out["part"].append(value)
        out["n"].append(rows.stop - rows.start)
        out["ids"].append(pack_ids(ids[rows]))
        for c in ("codes", "checks", "places"):
            out[c].append(columns[c][rows].tobytes() if c in columns else None)
    if out["part"]:
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _ARROW], schema=_ARROW)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    """Exchange rows (kind, part, n, ids, codes, checks, places) as a batch."""
    columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def numbers(batches: list[pa.RecordBatch], **kinds: type) -> dict[str, np.ndarray]:
    """The numbers of exchange rows as flat arrays: ids and the columns named with their types."""
    rows = [r for b in batches for r in b.to_pylist()]
    out = {"ids": np.concatenate([np.zeros(0, np.int64), *(unpack_ids(r["ids"], r["n"]) for r in rows)])}
    for c, kind in kinds.items():
        out[c] = np.frombuffer(b"".join(r[c] for r in rows), kind)
    return out


def reduced(rows: DataFrame, function: Callable) -> DataFrame:
    """``function(batches of one bucket)`` yields notes; notes among the rows pass unchanged."""

    def reduce_buckets(batches):
        for _, held in grouped(batches, 1):
            found = []
            for batch in held:
                kind = batch.column(0).to_numpy(zero_copy_only=False)
                if (kind == 1).any():
                    yield batch.filter(pa.array(kind == 1))
                if (kind == 0).any():
                    found.append(batch.filter(pa.array(kind == 0)))
            if found:
                yield from function(found)

    return dealt(rows.select("kind", "part", "n", "ids", "codes", "checks", "places"), "part", "kind").mapInArrow(arrow.lean(reduce_buckets), SCHEMA)


def visited(docs: DataFrame, notes: DataFrame, function: Callable, schema: str, key: str, text: str, n: int) -> DataFrame:
    """Documents meet the notes of their block. ``function`` gets an iterator over (batch of id, row and text; the notes of
    the block as exchange rows) and yields record batches; ``row`` holds all columns but the text."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    ours = docs.select(named_column(key, text).alias("id"), row.alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ours = ours.withColumn("part", block_column("id", n)).withColumn("kind", F.lit(2))
    both = ours.select("part", "kind", "id", "row", "text").unionByName(notes.select("part", "kind", "n", "ids", "codes", "checks", "places"), True)

    def visit(batches):
        def blocks_of_documents():
            for _, held in grouped_stream(batches):
                yield held

        yield from function(blocks_of_documents())

    return dealt(both, "part", "kind").mapInArrow(arrow.lean(visit), schema)


def row_type(docs: DataFrame, text: str) -> str:
    """The type of ``row`` in `visited`."""
    return docs.drop(text).schema.simpleString()


def unpacked(found: DataFrame, docs: DataFrame, text: str, *names: str) -> DataFrame:
    """The columns of ``docs`` but the text out of ``row``, then the new ones, which replace any of their names."""
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != text and c not in names]
    return found.select(*kept, *names)


def grouped_stream(batches) -> Iterator[tuple[int, tuple[pa.RecordBatch, list[pa.RecordBatch]]]]:
    """(block, (documents, notes of the block)) in pieces; the notes of a block come before its documents."""
    current, notes = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        for value, rows in cut(batch.column(0).to_numpy(zero_copy_only=False)):
            if value != current:
                current, notes = value, []
            piece = batch.slice(rows.start, rows.stop - rows.start)
            kind = piece.column(1).to_numpy(zero_copy_only=False)
            split = int(np.searchsorted(kind, 2))
            if split:
                notes = [*notes, piece.slice(0, split).select(["n", "ids", "codes", "checks", "places"])]
            if split < piece.num_rows:
                yield value, (piece.slice(split).select(["id", "row", "text"]), notes)
