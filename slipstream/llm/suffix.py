"""Repeated byte strings over the suffixes of all documents, by a distributed difference-cover algorithm.

The order of suffixes is needed only up to their first `length` bytes, which shapes every step:

1. Sample the suffixes at difference-cover positions modulo a period. Each is keyed by a triple: the names (hashes) of three
   consecutive blocks of bytes. The triples are sorted in buckets; equal neighbours get the same name, and a sampled suffix
   whose triple is the only one is discarded, as no other text can continue like it.
2. One level of recursion is left: a repeated string of `length` bytes covers, at some shift below the period, a sampled
   suffix with the same name in each copy. Only suffixes around such samples can be equal in their first `length` bytes.
3. Merge those remaining suffixes, sampled or not. Runs of them that share the smallest block name among their first bytes go
   to one bucket as one stretch of text. There the suffixes are sorted by the name of their first `length` bytes, and
   adjacent ones are compared, byte by byte: in every run of equal prefixes all but the earliest are repeats.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slipstream.llm import arrow, packed
from slipstream.llm.substring import Chunk, cover, for_id, noted, pack_anchors, period, reduce_anchors, same_as_before
from slipstream.session import staged

BLOCK = 24  # bytes of the blocks whose smallest name decides where a suffix is merged
KEPT = 6_000_000  # suffixes whose names a task holds at a time; a bucket of more is hashed several times
SORTED = 1_000_000  # suffixes that are sorted at a time
COMPARED = 1_000_000  # bytes that are compared at a time


@functools.lru_cache(maxsize=4)
def _cover_places(v: int, upto: int) -> np.ndarray:
    """The cover positions below a power of two."""
    return np.flatnonzero(np.tile(cover(v), -(-upto // v))[:upto])


def _samples(data: np.ndarray, offsets: np.ndarray, length: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(triple name, row, position) of the sampled suffixes of documents that hold a string of ``length`` bytes."""
    size = length - v + 1
    third = -(-size // 3)
    sizes = np.diff(offsets)
    known = _cover_places(v, 1 << int(sizes.max(initial=1)).bit_length())
    count = np.where(sizes >= length, np.searchsorted(known, sizes - size, side="right"), 0)
    row = np.repeat(np.arange(len(sizes)), count)
    place = known[np.arange(len(row)) - (np.cumsum(count) - count)[row]] if len(row) else np.zeros(0, np.int64)
    if not len(row):
        return np.zeros(0, np.uint64), row, place
    first, last = arrow.several(data, third, size - 2 * third)
    take = offsets[:-1][row] + place
    return arrow.mix(arrow.join(arrow.join(first[take], first[take + third]), last[take + 2 * third])), row, place


def _smallest(names: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` consecutive names at every place."""
    done = 1
    while done * 2 <= width:
        names = np.minimum(names[:-done], names[done:])
        done *= 2
    return np.minimum(names[: len(names) - (width - done)], names[width - done :]) if done < width else names


def _name(text: np.ndarray) -> int:
    """64 bits of a text's digest: rows of one key are told apart by them."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, one after another."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _same_bytes(data: np.ndarray, at: np.ndarray, source: np.ndarray, length: int) -> np.ndarray:
    """Whether the bytes themselves are equal where the names are, run by run of neighbouring places."""
    first, count = _runs(at, at - source)
    out = [np.zeros(0, bool)]
    offsets = np.concatenate([[0], np.cumsum(count + length - 1)])
    for i, j in arrow.pieces(offsets, COMPARED):
        some, sizes, n = first[i:j], count[i:j] + length - 1, count[i:j]
        equal = _gather(data, at[some], sizes) == _gather(data, source[some], sizes)
        wrong = np.concatenate([[0], np.cumsum(~equal)])
        begin = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(wrong[begin + length] == wrong[begin])
    return np.concatenate(out)


def _runs(places: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first entry, length) of the runs of consecutive places with equal columns."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.diff(places) != 1
    for c in columns:
        breaks |= c[1:] != c[:-1]
    first = np.concatenate([[0], np.flatnonzero(breaks) + 1])
    return first, np.diff(np.concatenate([first, [len(places)]]))


def repeated_strings(docs: DataFrame, length: int, key: str, text: str) -> DataFrame:
    """Notes (the text's checksum, place, how many) of the starts of all strings of ``length`` bytes that also start earlier."""
    spark = docs.sparkSession
    buckets, blocks, v = packed.buckets(spark), packed.blocks(spark), period(length)
    size = length - v + 1
    block = min(BLOCK, length)

    def sample(batches):
        chunk = Chunk()
        for batch in batches:
            data, offsets = arrow.flat(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in arrow.pieces(offsets):
                names, at, _ = _samples(data[offsets[i] : offsets[j]].astype(np.uint64), offsets[i : j + 1] - offsets[i], length, v)
                if chunk.add(names, ids[i:j][at]):
                    yield from pack_anchors(*chunk.take(), buckets, blocks, True)
        if chunk.size:
            yield from pack_anchors(*chunk.take(), buckets, blocks, True)

    def around(part, offsets, ids, found):
        """The stretches of remaining suffixes in some documents: (smallest name, id, place, suffixes, the text's checksum,
        two hashes, first byte, bytes)."""
        wide = part.astype(np.uint64)
        names, at, place = _samples(wide, offsets, length, v)
        edge = np.zeros(len(part) + 1, np.int64)
        bounds = np.searchsorted(at, np.arange(len(ids) + 1))
        for k in range(len(ids)):
            a, b = bounds[k], bounds[k + 1]
            if a < b:
                p = place[a:b][np.isin(names[a:b].astype(np.uint32), for_id(found, "codes", ids[k]))]
                last = offsets[k + 1] - length  # the last start in the document
                np.add.at(edge, offsets[k] + np.maximum(p - (v - 1), 0), 1)
                np.add.at(edge, np.minimum(offsets[k] + p, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge)[: max(0, len(part) - length + 1)] > 0)
        if not len(starts):
            return None
        # the names of blocks are needed only where suffixes remain: their bytes are put together first
        first, count = _runs(starts)
        begin, sizes = starts[first], count + length - 1
        near = _gather(wide, begin, sizes)
        inner = np.repeat(np.cumsum(sizes) - sizes, count) + np.arange(len(starts)) - np.repeat(first, count)
        smallest = _smallest(arrow.mix(arrow.windows(near, block)), length - block + 1)[inner]
        first, count = _runs(starts, smallest)
        begin, sizes = starts[first], count + length - 1
        row = np.searchsorted(offsets, begin, side="right") - 1
        hashes = [arrow.spans_hash(part, begin, begin + sizes, w) for w in (0, 1)]
        tags = np.zeros(len(ids), np.uint64)
        for k in np.unique(row).tolist():
            tags[k] = _name(part[offsets[k] : offsets[k + 1]])
        return smallest[first], ids[row], begin - offsets[row], count, tags[row], *hashes, begin, sizes

    def extend(pieces):
        held, total = [], 0
        known, found = None, None
        for docs_, notes in pieces:
            if not notes:
                continue
            if notes is not known:
                known, found = notes, noted(notes, codes=np.uint32)
            data, offsets = arrow.flat(docs_.column(2))
            ids = docs_.column(0).to_numpy(zero_copy_only=False)
            for i, j in arrow.pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                got = around(part, offsets[i : j + 1] - offsets[i], ids[i:j], found)
                if got is not None:
                    *numbers, begin, sizes = got
                    held.append((*numbers, sizes, _gather(part, begin, sizes)))
                    total += int(sizes.sum())
                if total >= 4 << 20:
                    yield from pack_stretches(held)
                    held, total = [], 0
        if held:
            yield from pack_stretches(held)

    def pack_stretches(held):
        """Of equal stretches in the chunk only the earliest goes on; all suffixes of the others are repeats."""
        route, ids, places, count, tags, h1, h2, sizes, data = (np.concatenate(c) for c in zip(*held))
        begin = np.cumsum(sizes) - sizes
        rank = packed.rank(ids)
        order = np.lexsort((places, rank, sizes, h2, h1))
        again = np.zeros(len(order), bool)
        h1, h2, sizes_, ids_, places_ = h1[order], h2[order], sizes[order], rank[order], places[order]
        same = same_as_before(h1, h2, sizes_)
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        again[order] = same & ((ids_ > ids_[first]) | (places_ > places_[first]))
        some = np.flatnonzero(again)
        yield from packed.rows_of(
            1, packed.block_of(ids[some], blocks), ids[some],
            codes=tags[some], places=places[some].astype(np.uint32), checks=count[some].astype(np.uint32),
        )
        rest = np.flatnonzero(~again)
        part = packed.bucket_of(arrow.mix(route[rest].copy()), 2 * buckets)  # stretches are longer than names
        order = np.lexsort((places[rest], ids[rest], part))
        part, rest = part[order], rest[order]
        out = []
        for value, rows in packed.cut(part):
            r = rest[rows]
            out.append(
                (0, value, len(r), packed.pack_ids(ids[r]), tags[r].tobytes() + _gather(data, begin[r], sizes[r]).tobytes(),
                 sizes[r].astype(np.uint32).tobytes(), places[r].astype(np.uint32).tobytes())
            )
        yield packed.batch_of(out)

    def named(data, offsets, sizes):
        """(name of the first bytes, place) of all suffixes, in parts by the name that can be sorted."""
        total = int((sizes - length + 1).sum())
        passes = 1 + total // KEPT
        for turn in range(passes):
            names, places = [], []
            for i, j in arrow.pieces(offsets):
                name = arrow.mix(arrow.windows(data[offsets[i] : offsets[j]].astype(np.uint64), length))
                last = np.repeat(offsets[i + 1 : j + 1] - length, sizes[i:j])[: len(name)]
                take = np.arange(len(name)) + offsets[i] <= last
                if passes > 1:
                    take &= (name % np.uint64(passes)) == turn
                places.append((np.flatnonzero(take) + offsets[i]).astype(np.uint32 if len(data) < 1 << 32 else np.int64))
                names.append(name[take])
            parts = np.uint64(1 + sum(map(len, names)) // SORTED)
            for part in range(int(parts)):
                some = [(n >> np.uint64(32)) % parts == part for n in names] if parts > 1 else [slice(None)] * len(names)
                yield np.concatenate([n[k] for n, k in zip(names, some)]), np.concatenate([p[k] for p, k in zip(places, some)]).astype(np.int64)

    def merge(batches):
        found = packed.numbers(batches, checks=np.uint32, places=np.uint32)
        rows = [(n, c) for b in batches for n, c in zip(b.column("n").to_pylist(), b.column("codes").to_pylist())]
        tags = np.concatenate([np.frombuffer(c, np.uint64, n) for n, c in rows])
        texts = np.frombuffer(b"".join([c[8 * n :] for n, c in rows]), np.uint8)
        # in the order of documents and places, so that of equal prefixes the earliest comes first
        sizes, order = found["checks"].astype(np.int64), np.lexsort((found["places"], packed.rank(found["ids"])))
        data = _gather(texts, (np.cumsum(sizes) - sizes)[order], sizes[order])
        sizes, ids, tags, places = sizes[order], found["ids"][order], tags[order], found["places"].astype(np.int64)[order]
        rank = packed.rank(ids)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        repeated = np.zeros(len(data), bool)  # where a repeat starts
        for name, at in named(data, offsets, sizes):
            order = np.argsort(name, kind="stable")
            name, at = name[order], at[order]
            same = same_as_before(name)
            source = at[np.maximum.accumulate(np.where(same, 0, np.arange(len(name))))] if len(name) else at
            at, source = at[same], source[same]
            order = np.argsort(at)
            at, source = at[order], source[order]
            same = _same_bytes(data, at, source, length)
            at, source = at[same], source[same]
            row, before = (np.searchsorted(offsets, x, side="right") - 1 for x in (at, source))
            where, there = places[row] + at - offsets[row], places[before] + source - offsets[before]
            repeated[at[(rank[row] > rank[before]) | (where > there)]] = True  # rows of one key are no earlier at the same byte
        at = np.flatnonzero(repeated)
        row = np.searchsorted(offsets, at, side="right") - 1
        who, tag, where = ids[row], tags[row], places[row] + at - offsets[row]
        first, count = _runs(where, who, tag)
        yield from packed.rows_of(
            1, packed.block_of(who[first], blocks), who[first],
            codes=tag[first], places=where[first].astype(np.uint32), checks=count.astype(np.uint32),
        )

    rows = docs.select(packed.named_column(key, text).alias("id"), docs[text].cast("string").alias("text"))
    names = packed.reduced(rows.mapInArrow(arrow.lean(sample), packed.SCHEMA), reduce_anchors(blocks))
    # written once: the exchanges before it are released, and both kinds of its rows are read
    stretches = staged(packed.visited(docs, names, extend, packed.SCHEMA, key, text, blocks), "stretches")
    return packed.reduced(stretches, merge)


def remove_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The UTF-8 bytes of every document without those that a repeated string covers.

    A string of ``length`` bytes of one document is repeated if it also starts earlier: in a document with a smaller key, or
    in the same one at an earlier byte. Overlaps count; strings are judged on the input. A null text has no bytes. A null key
    comes behind all others; rows of one key are no earlier than each other at the same byte. Keys are integers.
    Result: all columns but the text, and n_bytes, n_removed, n_spans (maximal removed runs), kept (binary), which replace
    columns of their names; one row for each row.
    """
    blocks = packed.blocks(docs.sparkSession)
    flagged = repeated_strings(docs, length, key, text)

    def keep(pieces):
        known, found = None, None
        for docs_, notes in pieces:
            if notes and notes is not known:
                known, found = notes, noted(notes, codes=np.uint64, places=np.uint32, checks=np.uint32)
            data, offsets = arrow.flat(docs_.column(2))
            n_removed, n_spans, kept = [], [], []
            for k, key_ in enumerate(docs_.column(0).to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                starts, own_notes = (), ()
                if notes and len(for_id(found, "codes", key_)):  # another text under the same key has its own notes
                    own_notes = for_id(found, "codes", key_) == np.uint64(_name(own))
                    starts = for_id(found, "places", key_)[own_notes].astype(np.int64)
                if not len(starts):
                    n_removed.append(0)
                    n_spans.append(0)
                    kept.append(own.tobytes())
                    continue
                count = for_id(found, "checks", key_)[own_notes].astype(np.int64)
                edge = np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, np.minimum(starts, len(own)), 1)
                np.add.at(edge, np.minimum(starts + count + length - 1, len(own)), -1)
                gone = np.cumsum(edge)[:-1] > 0
                n_removed.append(int(gone.sum()))
                n_spans.append(int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum()))
                kept.append(own[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [docs_.column(1), pa.array(np.diff(offsets), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = f"row {packed.row_type(docs, text)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    found = packed.visited(docs, flagged, keep, schema, key, text, blocks)
    return packed.unpacked(found, docs, text, "n_bytes", "n_removed", "n_spans", "kept")
