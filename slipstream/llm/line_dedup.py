"""Line dedup that can be taken back: sharded cuckoo filters backed by exact reference counts.

A `LineIndex` holds, in shards by the top bits of a line's key,

* the exact table: how many documents hold each key, as a list of runs (shard, key, docs). Adding documents writes one run of
  positive counts, deleting documents one of negative counts; a key's count is the sum over all runs.
* one cuckoo filter a shard with the keys whose count has reached the threshold. A key that crosses it is put in, one that
  falls under it is taken out again, so after a deletion the index answers as if the documents had never been there.

Documents ask the filters, which are small, for their keys; what the filters let through is looked up in the exact table. A
line that a third of all documents hold is counted once for each chunk of a task, and asked for once for each block.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import packed
from slipstream.session import staged

SLOTS = 4  # fingerprints in a bucket of a filter
ROUNDS = 200  # rounds of eviction until a filter counts as full
CHUNK = 1 << 17  # keys that a task gathers before it sends them
_KEY = 16  # bytes of a key
_SHARDED = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])
_SHARDED_SQL = "shard int, kind int, keys binary, more binary"
_FILTER, _KEYS = 0, 1  # kinds of rows in an exchange by shard


def line_key(line: bytes) -> bytes | None:
    """128 bits of a line without white space at its ends, A-Z lower-cased; None if nothing is left."""
    line = line.strip(b" \t\n\v\f\r").lower()
    return hashlib.blake2b(line, digest_size=_KEY).digest() if line else None


def _halves(keys: bytes | list[bytes]) -> np.ndarray:
    """Keys as rows of two 64-bit numbers, which sort as the keys do."""
    return np.frombuffer(keys if isinstance(keys, bytes) else b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)


def _bytes(keys: np.ndarray) -> bytes:
    return keys.astype(">u8").tobytes()


class CuckooFilter:
    """16-bit fingerprints of keys in either of two buckets; arrays of keys are put in, taken out and looked up at once.

    A filter without buckets lets every key through.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for twice so many keys."""
        buckets = 1 << max(2, (2 * max(keys, 1) // SLOTS).bit_length())
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def holding(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of distinct keys; one without buckets if they have too many fingerprints in common."""
        for size in (len(keys), 4 * len(keys), 16 * len(keys)):
            own = cls.sized(size)
            if own.insert(keys):
                return own
        return cls(np.zeros((0, SLOTS), np.uint16))

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def written(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (keys[:, 1] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1  # 0 is an empty slot
        return prints, (keys[:, 1] & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The second bucket of a fingerprint, from either one."""
        spread = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ (spread & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Never False for a key that is held; True by chance for few others."""
        if not len(self.table):
            return np.ones(len(keys), bool)
        prints, first = self._places(keys)
        second = self._other(prints, first)
        return (self.table[first] == prints[:, None]).any(1) | (self.table[second] == prints[:, None]).any(1)

    def _fill(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; which ones found none."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)  # the how-manieth of its bucket
        free = self.table[at] == 0
        turn = np.cumsum(free, axis=1) * free  # free slots are numbered from 1
        hit = turn == (rank + 1)[:, None]
        some = hit.any(1)
        self.table[at[some], hit[some].argmax(1)] = prints[order[some]]
        left = np.ones(len(prints), bool)
        left[order[some]] = False
        return left

    def insert(self, keys: np.ndarray) -> bool:
        """Put in distinct keys that are not held; False if they do not fit (the filter is then of no use)."""
        if not len(self.table):
            return True
        prints, bucket = self._places(keys)
        for move in range(ROUNDS):
            left = self._fill(prints, bucket)
            prints, bucket = prints[left], bucket[left]
            if not len(prints):
                return True
            if move:  # one fingerprint of each full bucket makes room and waits in its stead
                _, first = np.unique(bucket, return_index=True)
                slot = (prints[first].astype(np.int64) + move) % SLOTS
                out = self.table[bucket[first], slot]
                self.table[bucket[first], slot] = prints[first]
                prints[first] = out
            bucket = self._other(prints, bucket)
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Take out distinct keys that are held."""
        if not len(self.table):
            return
        prints, first = self._places(keys)
        second = self._other(prints, first)
        for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            for bucket in (a, b):
                slot = np.flatnonzero(self.table[bucket] == p)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break


def _by_shard(keys: np.ndarray, shards: int, more: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of an exchange: one for each shard with its keys and what belongs to them."""
    part = packed.bucket_of(keys[:, 0], shards)
    order = np.argsort(part, kind="stable")
    rows = [(value, order[rows]) for value, rows in packed.cut(part[order])]
    if rows:
        columns = [
            pa.array([v for v, _ in rows], pa.int32()),
            pa.array([_KEYS] * len(rows), pa.int32()),
            pa.array([_bytes(keys[o]) for _, o in rows], pa.binary()),
            pa.array([None if more is None else more[o].tobytes() for _, o in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_SHARDED)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the counts of each."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    first = np.flatnonzero(new)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _keys_of(text: str | None) -> set[bytes]:
    found = {line_key(line) for line in (text or "").encode().split(b"\n")}
    found.discard(None)
    return found


def count_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(shard, key, docs) of every line key: how many rows of ``docs`` hold it. Keys of a chunk are counted before they are sent."""
    shards = packed.buckets(docs.sparkSession)

    def chunks(batches):
        held: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.update(_keys_of(value))
                if len(held) >= CHUNK:
                    yield from _by_shard(_halves(list(held)), shards, np.fromiter(held.values(), np.int64))
                    held = Counter()
        yield from _by_shard(_halves(list(held)), shards, np.fromiter(held.values(), np.int64, len(held)))

    def merge(batches):
        for shard, rows in packed.grouped(batches):
            keys, counts = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
            for batch in rows:  # chunk by chunk: only distinct keys are held
                new = _halves(batch.column("keys").to_pylist())
                more = np.frombuffer(b"".join(batch.column("more").to_pylist()), np.int64)
                keys, counts = _summed(np.concatenate([keys, new]), np.concatenate([counts, more]))
            data = _bytes(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), shard, np.int32)), pa.array([data[i : i + _KEY] for i in range(0, len(data), _KEY)], pa.binary()), pa.array(counts)],
                ["shard", "key", "docs"],
            )

    sent = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(chunks, _SHARDED_SQL)
    return packed.dealt(sent, "shard", "kind").mapInArrow(merge, "shard int, key binary, docs bigint")


def _changed_filters(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """The filters after the changes (shard, key, up); a filter that its keys no longer fit into comes out as null."""
    old = filters.select("shard", F.lit(_FILTER).alias("kind"), F.col("filter").alias("keys"), F.lit(None).cast("binary").alias("more"))
    flag = F.when(F.col("up"), F.lit(b"\x01")).otherwise(F.lit(b"\x00"))
    new = changes.select("shard", F.lit(_KEYS).alias("kind"), F.col("key").alias("keys"), flag.alias("more"))

    def change(batches):
        for shard, rows in packed.grouped(batches):
            own = None
            keys, up = [], []
            for batch in rows:
                kinds, data, more = (batch.column(c).to_pylist() for c in ("kind", "keys", "more"))
                for kind, value, flag_ in zip(kinds, data, more):
                    if kind == _FILTER:
                        own = CuckooFilter.read(value)
                    else:
                        keys.append(value)
                        up.append(flag_ == b"\x01")
            halves, up = _halves(keys), np.array(up, bool)
            fits = True
            if own is None:
                own = CuckooFilter.holding(halves[up])
            else:
                own.remove(halves[~up])
                fits = own.insert(halves[up])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([own.written() if fits else None], pa.binary())], ["shard", "filter"])

    return packed.dealt(old.unionByName(new), "shard", "kind").mapInArrow(change, "shard int, filter binary")


@dataclass(frozen=True)
class LineIndex:
    """Line counts and filters at one moment. `insert` and `delete` return the next one; earlier ones stay valid.

    ``least``: the number of documents from which on a key is common. Every row is a document of its own.
    """

    spark: SparkSession
    least: int
    runs: tuple[DataFrame, ...] = ()
    filters: DataFrame | None = None

    def counts(self) -> DataFrame:
        """(shard, key, docs) of every key that a document holds."""
        if not self.runs:
            return self.spark.createDataFrame([], "shard int, key binary, docs bigint")
        rows = self.runs[0]
        for run in self.runs[1:]:
            rows = rows.unionByName(run)
        return rows if len(self.runs) == 1 else rows.groupBy("shard", "key").agg(F.sum("docs").alias("docs")).where("docs <> 0")

    def common(self) -> DataFrame:
        """(shard, key, docs) of the common keys, from the exact table."""
        return self.counts().where(F.col("docs") >= self.least)

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index with these documents added."""
        return self._changed(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index without these documents, which must have been added before: a count below 0 raises ValueError."""
        return self._changed(docs, text, -1)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        run = staged(count_lines(docs, text).withColumn("docs", F.col("docs") * sign), "line-run")
        if self.runs:  # counts before, of the keys of this run only
            before = self.counts().select("key", F.col("docs").alias("before"))
            steps = staged(run.join(before, "key", "left").withColumn("before", F.coalesce("before", F.lit(0))), "line-steps")
        else:
            steps = run.withColumn("before", F.lit(0).cast("bigint"))
        after = F.col("before") + F.col("docs")
        if sign < 0 and steps.where(after < 0).limit(1).count():
            raise ValueError("documents that were never added cannot be deleted")
        crossing = steps.where((F.col("before") >= self.least) != (after >= self.least))
        changes = crossing.select("shard", "key", (after >= self.least).alias("up"))
        known = self.filters if self.filters is not None else self.spark.createDataFrame([], "shard int, filter binary")
        filters = staged(_changed_filters(known, changes), "line-filters")
        index = LineIndex(self.spark, self.least, (*self.runs, run), filters)
        full = filters.where("filter IS NULL").select("shard")
        if self.filters is not None and full.limit(1).count():  # such shards are built anew from the exact table
            again = index.common().join(full, "shard", "left_semi").select("shard", "key", F.lit(True).alias("up"))
            whole = _changed_filters(filters.limit(0), again).unionByName(filters.where("filter IS NOT NULL"))
            index = LineIndex(self.spark, self.least, index.runs, staged(whole, "line-filters"))
        return index

    def compacted(self) -> LineIndex:
        """The same index with all runs in one."""
        return LineIndex(self.spark, self.least, (staged(self.counts(), "line-run"),), self.filters)


def _asked(docs: DataFrame, index: LineIndex) -> DataFrame:
    """(key, block): keys that the filters of ``index`` let through, of the documents (block, text)."""
    shards = packed.buckets(docs.sparkSession)

    def ask(batches):
        held: set[tuple[bytes, int]] = set()
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update((k, block) for k in _keys_of(value))
                if len(held) >= CHUNK:
                    yield from send(held)
                    held = set()
        yield from send(held)

    def send(held):
        yield from _by_shard(_halves([k for k, _ in held]), shards, np.fromiter((b for _, b in held), np.int32, len(held)))

    def answer(batches):
        for _, rows in packed.grouped(batches):
            own, seen = None, set()
            for batch in rows:
                for kind, keys, more in zip(*(batch.column(c).to_pylist() for c in ("kind", "keys", "more"))):
                    if kind == _FILTER:
                        own = CuckooFilter.read(keys)
                    elif own is not None:
                        asked = _halves(keys)
                        hit = np.flatnonzero(own.contains(asked))
                        blocks = np.frombuffer(more, np.int32)[hit].tolist()
                        new = {(keys[_KEY * i : _KEY * i + _KEY], b) for i, b in zip(hit.tolist(), blocks)} - seen
                        seen |= new
                        if new:
                            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in new], pa.binary()), pa.array([b for _, b in new], pa.int32())], ["key", "block"])

    filters = index.filters.select("shard", F.lit(_FILTER).alias("kind"), F.col("filter").alias("keys"), F.lit(None).cast("binary").alias("more"))
    sent = docs.mapInArrow(ask, _SHARDED_SQL)
    return packed.dealt(filters.unionByName(sent), "shard", "kind").mapInArrow(answer, "key binary, block int")


def drop_common(docs: DataFrame, index: LineIndex, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines of every document whose keys are not common in the index.

    A text is split at line feeds; a null or empty one is one empty line. A line's key is the line without space and U+0009 to
    U+000D at its ends, A-Z lower-cased; lines without a key stay. ``key`` only spreads the documents over blocks: null and
    repeated keys do no harm, every row is judged by itself.
    Result: all columns but the text, and n_lines, n_dropped, kept (the other lines joined by line feeds), which replace columns
    of their names; one row for each row.
    """
    n = packed.blocks(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    ours = docs.select(F.pmod(F.xxhash64(docs[key], value), F.lit(n)).cast("int").alias("block"), value.alias("text"), row.alias("row"))
    asked = _asked(ours.select("block", "text"), index)
    notes = asked.join(index.common().select("key"), "key", "left_semi").select("block", F.lit(0).alias("kind"), "key")
    both = notes.unionByName(ours.select("block", F.lit(1).alias("kind"), "row", "text"), True).select("block", "kind", "key", "row", "text")

    def keep(batches):
        block, common = None, set()
        for batch in batches:
            for value_, rows in packed.cut(batch.column(0).to_numpy(zero_copy_only=False)):
                piece = batch.slice(rows.start, rows.stop - rows.start)
                if value_ != block:
                    block, common = value_, set()
                split = int(np.searchsorted(piece.column(1).to_numpy(zero_copy_only=False), 1))
                common.update(piece.column(2).slice(0, split).to_pylist())
                piece = piece.slice(split)
                if not piece.num_rows:
                    continue
                n_lines, n_dropped, kept = [], [], []
                for text_ in piece.column(4).to_pylist():
                    lines = text_.encode().split(b"\n")
                    stay = [line for line in lines if line_key(line) not in common] if common else lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(text_ if len(stay) == len(lines) else b"\n".join(stay).decode())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(3), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                    ["row", "n_lines", "n_dropped", "kept"],
                )

    schema = f"row {packed.row_type(docs, text)}, n_lines bigint, n_dropped bigint, kept string"
    found = packed.dealt(both, "block", "kind").mapInArrow(keep, schema)
    return packed.unpacked(found, docs, text, "n_lines", "n_dropped", "kept")
