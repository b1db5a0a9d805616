"""Substring dedup: words of windows that also start in an earlier document go.

Difference-cover anchors. Of a window of `w` words only shorter anchors of `w - v + 1` words are hashed, and only where they
start at positions whose remainder modulo the period `v` is in a difference cover. Wherever two documents share a window,
some shift below `v` brings both to cover positions, so they share an anchor there. Anchors that occur once are dropped;
around the others the windows are extended to their whole length and compared by 96-bit hashes, which finds every repeated
window whatever lies around it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slipstream.llm import arrow, packed
from slipstream.session import staged

#: Perfect difference sets: every remainder modulo the period is a difference of two members. Fixed values.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}
CHUNK = 1_000_000  # numbers that a task gathers before it packs them


def period(window: int) -> int:
    """The longest known period that leaves anchors of at least two fifths of the window."""
    return max(v for v in COVERS if v == 1 or window - v + 1 >= 0.4 * window)


def cover(v: int) -> np.ndarray:
    """For each remainder whether it is in the cover."""
    inside = np.zeros(v, bool)
    inside[list(COVERS[v])] = True
    return inside


class Chunk:
    """Arrays of numbers gathered over documents until there are enough of them to pack."""

    def __init__(self, limit: int = CHUNK):
        self.limit, self.held, self.size = limit, [], 0

    def add(self, *arrays: np.ndarray) -> bool:
        """Take arrays of one length; True once the chunk is full."""
        if len(arrays[0]):
            self.held.append(arrays)
            self.size += len(arrays[0])
        return self.size >= self.limit

    def take(self) -> list[np.ndarray]:
        out = [np.concatenate(a) for a in zip(*self.held)]
        self.held, self.size = [], 0
        return out


def same_as_before(*columns: np.ndarray) -> np.ndarray:
    """Whether each row equals the one before in all columns."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


def pack_anchors(codes: np.ndarray, ids: np.ndarray, buckets: int, blocks: int, within: bool):
    """Rows of anchors. An anchor that already repeats in the chunk needs no reducer to say so: its documents get a note, and
    one copy goes on, so a very common anchor sends one number from each chunk.

    ``within``: repeats inside one document count as well."""
    order = np.argsort(codes, kind="stable")  # the anchors of a document stay together
    codes, ids = codes[order], ids[order]
    same = same_as_before(codes)
    again = same_as_before(codes, ids)
    first = np.flatnonzero(~same)
    group = np.cumsum(~same) - 1
    repeats = np.bincount(group[same if within else same & ~again], minlength=len(first)) > 0
    noted = repeats[group] & ~again
    low = codes.astype(np.uint32)
    yield from packed.rows_of(1, packed.block_of(ids[noted], blocks), ids[noted], codes=low[noted])
    yield from packed.rows_of(0, packed.bucket_of(codes[first], buckets), ids[first], codes=low[first])


def reduce_anchors(blocks: int):
    """Notes for the documents of every anchor that came from more than one chunk or document."""

    def run(batches):
        found = packed.numbers(batches, codes=np.uint32)
        order = np.argsort(found["codes"], kind="stable")
        codes, ids = found["codes"][order], found["ids"][order]
        same = same_as_before(codes)
        shared = same.copy()
        shared[:-1] |= same[1:]
        yield from packed.rows_of(1, packed.block_of(ids[shared], blocks), ids[shared], codes=codes[shared])

    return run


def noted(notes: list[pa.RecordBatch], **kinds: type) -> dict[str, np.ndarray]:
    """The notes of a block, sorted by id."""
    found = packed.numbers(notes, **kinds)
    order = np.argsort(found["ids"], kind="stable")
    return {k: v[order] for k, v in found.items()}


def for_id(found: dict[str, np.ndarray], name: str, key: int) -> np.ndarray:
    a, b = np.searchsorted(found["ids"], [key, key], side="left")[0], np.searchsorted(found["ids"], key, side="right")
    return found[name][a:b]


def _word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, second hash, row) of every word."""
    starts, ends, row = arrow.words(data, offsets)
    return arrow.spans_hash(data, starts, ends, 0), arrow.spans_hash(data, starts, ends, 1), row


def _anchors(word: np.ndarray, row: np.ndarray, rows: int, window: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, position) of the anchors of documents that hold a window."""
    size = window - v + 1
    codes = arrow.windows(word, size)
    count = np.bincount(row, minlength=rows)
    place = np.arange(len(word)) - np.concatenate([[0], np.cumsum(count)])[row]
    at = row[: len(codes)]
    take = (at == row[size - 1 :]) & cover(v)[place[: len(codes)] % v] & (count[at] >= window) if len(codes) else np.zeros(0, bool)
    return codes[take], at[take], place[: len(codes)][take]


def repeated_windows(docs: DataFrame, window: int, key: str, text: str) -> DataFrame:
    """Notes (place, part of the hash) of all windows that also start in a document with a smaller id."""
    spark = docs.sparkSession
    buckets, blocks, v = packed.buckets(spark), packed.blocks(spark), period(window)
    size = window - v + 1

    def sample(batches):
        chunk = Chunk()
        for batch in batches:
            data, offsets = arrow.flat(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in arrow.pieces(offsets):
                word, _, row = _word_codes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                codes, at, _ = _anchors(word, row, j - i, window, v)
                if chunk.add(codes, ids[i:j][at]):
                    yield from pack_anchors(*chunk.take(), buckets, blocks, False)
        if chunk.size:
            yield from pack_anchors(*chunk.take(), buckets, blocks, False)

    def extend(pieces):
        chunk = Chunk(CHUNK // 2)
        known, found = None, None
        for docs_, notes in pieces:
            if not notes:
                continue
            if notes is not known:
                known, found = notes, noted(notes, codes=np.uint32)
            data, offsets = arrow.flat(docs_.column(2))
            ids = docs_.column(0).to_numpy(zero_copy_only=False)
            for i, j in arrow.pieces(offsets):
                word, other, row = _word_codes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                codes, at, place = _anchors(word, row, j - i, window, v)
                count = np.bincount(row, minlength=j - i)
                start = np.concatenate([[0], np.cumsum(count)])
                edge = np.zeros(len(word) + 1, np.int64)  # windows that hold a shared anchor
                bounds = np.searchsorted(at, np.arange(j - i + 1))
                for k in range(j - i):
                    a, b = bounds[k], bounds[k + 1]
                    if a < b:
                        hit = np.isin(codes[a:b].astype(np.uint32), for_id(found, "codes", ids[i + k]))
                        p = place[a:b][hit]
                        np.add.at(edge, start[k] + np.maximum(p - (v - 1), 0), 1)
                        np.add.at(edge, start[k] + p + 1, -1)
                whole, check = arrow.windows(word, window), arrow.windows(other, window)
                at = row[: len(whole)]
                take = (np.cumsum(edge)[: len(whole)] > 0) & (at == row[window - 1 :]) if len(whole) else np.zeros(0, bool)
                where = (np.arange(len(whole)) - start[at])[take] if len(whole) else np.zeros(0, np.int64)
                if chunk.add(whole[take], check[take].astype(np.uint32), ids[i:j][at[take]], where.astype(np.uint32)):
                    yield from settle_rows(*chunk.take())
        if chunk.size:
            yield from settle_rows(*chunk.take())

    def settle_rows(codes, checks, ids, places):
        order = np.lexsort((ids, checks, codes))
        codes, checks, ids, places = codes[order], checks[order], ids[order], places[order]
        later = _later(codes, checks, packed.rank(ids))
        yield from packed.rows_of(1, packed.block_of(ids[later], blocks), ids[later], codes=codes[later].astype(np.uint32), places=places[later])
        here = ~later
        yield from packed.rows_of(0, packed.bucket_of(codes[here], buckets), ids[here], codes=codes[here], checks=checks[here], places=places[here])

    def settle(batches):
        found = packed.numbers(batches, codes=np.uint64, checks=np.uint32, places=np.uint32)
        order = np.lexsort((found["ids"], found["checks"], found["codes"]))
        codes, checks, ids, places = (found[c][order] for c in ("codes", "checks", "ids", "places"))
        later = _later(codes, checks, packed.rank(ids))
        yield from packed.rows_of(1, packed.block_of(ids[later], blocks), ids[later], codes=codes[later].astype(np.uint32), places=places[later])

    rows = docs.select(packed.named_column(key, text).alias("id"), docs[text].cast("string").alias("text"))
    shared = packed.reduced(rows.mapInArrow(arrow.lean(sample), packed.SCHEMA), reduce_anchors(blocks))
    # written once: the exchanges before it are released, and both kinds of its rows are read
    extended = staged(packed.visited(docs, shared, extend, packed.SCHEMA, key, text, blocks), "windows")
    return packed.reduced(extended, settle)


def _later(codes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of windows sorted by hash and id: whether one with a smaller id comes before."""
    same = same_as_before(codes, checks)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids)))) if len(ids) else np.zeros(0, np.int64)
    return ids > ids[first]


def remove_repeats(docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of every document without those that a repeated window covers.

    Words are runs of anything but space and U+0009 to U+000D. A window is ``window`` consecutive words of one document; it is
    repeated if the same words in sequence also start in a document with a smaller key. Windows are judged on the input. A null
    text has no words. A null key comes behind all others; rows of one key are no earlier than each other. Keys are integers.
    Result: all columns but the text, and n_words, n_removed, kept (the other words, joined by one space), which replace
    columns of their names; one row for each row.
    """
    spark = docs.sparkSession
    blocks = packed.blocks(spark)
    flagged = repeated_windows(docs, window, key, text)

    def keep(pieces):
        known, found = None, None
        for docs_, notes in pieces:
            if notes and notes is not known:
                known, found = notes, noted(notes, codes=np.uint32, places=np.uint32)
            n_words, n_removed, kept = [], [], []
            for key_, value in zip(docs_.column(0).to_pylist(), docs_.column(2).to_pylist()):
                words = value.encode().split()
                starts = for_id(found, "places", key_) if notes else ()
                n_words.append(len(words))
                if len(starts):
                    # another text under the same key has its own notes: the windows must be the same
                    data = np.frombuffer(b" ".join(words), np.uint8)
                    here = arrow.windows(_word_codes(data, np.array([0, len(data)]))[0], window).astype(np.uint32)
                    starts, codes = starts.astype(np.int64), for_id(found, "codes", key_)[starts < len(here)]
                    starts = starts[starts < len(here)]
                    starts = starts[here[starts] == codes]
                    edge = np.zeros(len(words) + window + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    stays = np.cumsum(edge)[: len(words)] == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [docs_.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    schema = f"row {packed.row_type(docs, text)}, n_words bigint, n_removed bigint, kept string"
    return packed.unpacked(packed.visited(docs, flagged, keep, schema, key, text, blocks), docs, text, "n_words", "n_removed", "kept")
