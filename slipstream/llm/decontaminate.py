"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of m characters that occurs in a text with at most e edits shares at least m - q + 1 - q * e of its q-grams with it,
and all of them on e + 1 neighbouring diagonals (place in the text less place in the item). Shared q-grams are counted in
overlapping diagonal bands twice that wide, half a band apart. Regions whose count reaches the bound are held against it a second time
with shorter q-grams, of which an edit spoils fewer, and those that remain are aligned within their band. Items take the longest q-grams
for which the bound is positive, eight bytes at most, so the same share of edits holds for items of every length. Case and the length
of white space do not count; the alignment is over UTF-8 bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm import arrow
from slipstream.session import staged

Q = 8  # bytes of a q-gram at most; they fill one 64-bit number
FINE = 4  # bytes of the q-grams that a region is held against before it is aligned
MAX_ERROR = 0.1  # edits for each byte of an item
BLOCK = 1 << 20  # bytes of benchmark text that are broadcast at a time; their index takes some thirty times as many
ENTRIES = 1 << 21  # shared q-grams of texts and items that are unfolded at a time
_SIEVE = 22  # log2 of the bits, at most, that sort out most q-grams of a text


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place of each byte in the input) in lower case, every run of white space one space, none at the ends."""
    low = arrow.fold_ascii(data).copy()
    if len(low) > 1:  # À to Þ but the sign ×
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][second] += 32
    starts, ends, row = arrow.words(low, offsets)
    keep = np.zeros(len(low) + 1, np.int8)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    inside = np.cumsum(keep)[:-1] > 0
    joint = ends[:-1][row[1:] == row[:-1]]  # the byte after a word that another one follows
    low[joint] = 32
    inside[joint] = True
    place = np.flatnonzero(inside)
    return low[place], np.searchsorted(place, offsets), place


def qgrams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, the first one lowest; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(Q - 1, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, Q)).view("<u8").ravel()[: len(data)]


def _mask(q: int) -> np.uint64:
    """What leaves the first bytes of a q-gram."""
    return np.uint64((1 << 8 * q) - 1)


@dataclass
class Grams:
    """The q-grams of some items: sorted keys, and for each the items and places that hold it."""

    q: int
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    sieve: np.ndarray

    @classmethod
    def of(cls, q: int, numbers: list[int], texts: list[bytes]) -> Grams:
        grams = [(qgrams(np.frombuffer(texts[k], np.uint8)) & _mask(q))[: len(texts[k]) - q + 1] for k in numbers]
        every = np.concatenate(grams)
        item = np.repeat(np.array(numbers, np.int64), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(every, kind="stable")
        keys, first = np.unique(every[order], return_index=True)
        sieve = np.zeros(1 << min(_SIEVE, max(10, (32 * len(keys)).bit_length())), bool)
        sieve[cls.slots(keys, len(sieve))] = True
        return cls(q, keys, np.append(first, len(every)), item[order], offset[order], np.packbits(sieve))

    @staticmethod
    def slots(grams: np.ndarray, size: int) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the key) of the q-grams of a text that some item holds."""
        grams = grams & _mask(self.q)
        slot = self.slots(grams, 8 * len(self.sieve))
        maybe = np.flatnonzero((self.sieve[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
        at = np.searchsorted(self.keys, grams[maybe])
        hit = self.keys[np.minimum(at, len(self.keys) - 1)] == grams[maybe]
        return maybe[hit], at[hit]


@dataclass
class Block:
    """Some benchmark items with indexes of their q-grams, by the length of these."""

    ids: list
    texts: list[bytes]
    edits: np.ndarray
    least: np.ndarray  # shared q-grams that an occurrence needs
    groups: list[Grams]
    fine: Grams | None  # short q-grams of all items that have some
    fine_least: np.ndarray  # shared places that an occurrence needs; none if not positive


def allowed(size: int, max_error: float = MAX_ERROR) -> int:
    """Edits that an occurrence of an item of ``size`` bytes may have."""
    return int(size * max_error)


def index(ids: list, texts: list[str | None], max_error: float = MAX_ERROR) -> Block:
    """Items without a text, or of white space only, are left out."""
    data, offsets, _ = folded(*arrow.flat(pa.array(texts, pa.string())))
    found = [(i, data[a:b].tobytes()) for i, a, b in zip(ids, offsets[:-1], offsets[1:]) if b > a]
    sizes = np.array([len(t) for _, t in found], np.int64)
    edits = np.array([allowed(len(t), max_error) for _, t in found], np.int64)
    q = np.minimum(Q, sizes // (edits + 1))
    words = [t for _, t in found]
    groups = [Grams.of(size, np.flatnonzero(q == size).tolist(), words) for size in np.unique(q).tolist()]
    least = sizes - FINE + 1 - FINE * edits
    some = np.flatnonzero(least > 0).tolist()
    return Block([i for i, _ in found], words, edits, sizes - q + 1 - q * edits, groups, Grams.of(FINE, some, words) if some else None, least)


def align(item: bytes, region: bytes, first: int, width: int, limit: int) -> tuple[int, int, int] | None:
    """(edits, start, stop) of the best occurrence of an item in a region, along diagonals ``first`` to ``first + width - 1``.

    Any start and end in the region is free. The first end of the fewest edits is taken; None beyond the limit.
    """
    exact = region.find(item)
    if exact >= 0:
        return 0, exact, exact + len(item)
    text = np.frombuffer(region, np.uint8)
    m, n = len(item), len(text)
    big = 1 << 20
    step = np.arange(width)
    column = first + step  # places of the text before which row 0 stands
    cost = np.where((column >= 0) & (column <= n), 0, big)
    start = column.copy()
    for i in range(m):
        at = column + i  # the byte of the text on each diagonal
        inside = (at >= 0) & (at < n)
        differs = np.where(inside, text[np.clip(at, 0, max(n - 1, 0))] != item[i], True) if n else np.ones(width, bool)
        new, origin = np.where(inside, cost + differs, big), start.copy()
        drop = np.append(cost[1:] + 1, big)  # a byte of the item that the text lacks
        better = (drop < new) & (at + 1 <= n) & (at + 1 >= 0)
        new, origin = np.where(better, drop, new), np.where(better, np.append(start[1:], 0), origin)
        # a byte of the text that the item lacks, any number in a row: running minimum along the diagonals
        run = new - step
        low = np.minimum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == low, step, 0))
        new, origin = low + step, origin[source]
        outside = (at + 1 < 0) | (at + 1 > n)
        cost, start = np.where(outside, big, new), origin
        if i % 8 == 7 and cost.min() > limit:  # the fewest edits never fall from row to row
            return None
    best = int(cost.argmin())
    if cost[best] > limit:
        return None
    return int(cost[best]), int(start[best]), int(column[best] + m)


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each is there or the sum of its counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    edge = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[edge], np.diff(np.append(edge, len(keys)))
    return keys[edge], np.add.reduceat(counts, edge) if len(edge) else counts


def _bands(grams: np.ndarray, ends: np.ndarray, group: Grams, block: Block, low: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Every band in which a text and an item share q-grams, as the number ((row, item), band - low), and how many they share."""
    where, at = group.shared(grams)
    row = row_of(ends, where)
    fits = where + group.q <= ends[row + 1]
    where, at, row = where[fits], at[fits], row[fits]
    total = np.cumsum(group.first[at + 1] - group.first[at])
    held, waiting, begin = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0, 0
    while begin < len(where):  # a common phrase of many items unfolds to very many entries
        upto = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, upto + ENTRIES, side="right")))
        w, k, r = where[begin:end], at[begin:end], row[begin:end]
        count = group.first[k + 1] - group.first[k]
        entry = np.arange(total[end - 1] - upto) + np.repeat(group.first[k] - (total[begin:end] - upto - count), count)
        item = group.item[entry]
        diagonal = np.repeat(w - ends[r], count) - group.offset[entry]
        # each diagonal lies in two bands: the one that begins at its half and the one before
        band = np.floor_divide(diagonal, block.edits[item] + 1)
        key = (np.repeat(r, count) * len(block.ids) + item) * span + (band - low)
        held.append(_counted(np.concatenate([key, key - 1])))
        waiting += len(held[-1][0])
        begin = end
        if waiting > max(2 * ENTRIES, len(held[0][0])) or begin == len(where):
            held, waiting = [_counted(*(np.concatenate(x) for x in zip(*held)))], 0
    return held[0]


def _plausible(item: np.ndarray, start: np.ndarray, stop: np.ndarray, fine: np.ndarray, block: Block) -> np.ndarray:
    """Which regions (bytes of the texts) share as many short q-grams with their item as an occurrence needs.

    Regions of alike length that begin near each other are looked at together: all items at once are held against the q-grams
    of their common span."""
    need = block.fine_least[item]
    out = need <= 0
    size = np.log2(np.maximum(stop - start, 1)).astype(np.int64)
    some = np.flatnonzero(~out)
    some = some[np.lexsort((start[some], size[some]))]
    index, begin = block.fine, 0
    while begin < len(some):
        first = some[begin]
        same = begin + int(np.searchsorted(size[some[begin:]], size[first], side="right"))
        end = begin + max(1, int(np.searchsorted(start[some[begin:same]], start[first] + max(1, (stop[first] - start[first]) // 2), side="left")))
        cluster = some[begin:end]
        grams = np.unique(fine[start[first] : max(start[first], stop[cluster].max() - FINE + 1)])
        _, at = index.shared(grams)
        count = index.first[at + 1] - index.first[at]
        entry = np.arange(count.sum()) + np.repeat(index.first[at] - (np.cumsum(count) - count), count)
        held = np.bincount(index.item[entry], minlength=len(block.ids))
        out[cluster] = held[item[cluster]] >= need[cluster]
        begin = end
    return out


def find(data: np.ndarray, offsets: np.ndarray, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item number, start, stop, edits) of the occurrences of items; places are bytes of the row's own text.

    Regions of one item that overlap count as one, with its best alignment. Items of fewer than `Q` bytes occur as whole words.
    """
    low, ends, place = folded(data, offsets)
    if not len(low) or not block.ids:
        return
    grams = qgrams(low)
    longest = max(map(len, block.texts))
    lowest, span = -longest - 2, longest + int(np.diff(ends).max()) + 4  # bounds of the bands
    keys, shared = (np.concatenate(x) for x in zip(*(_bands(grams, ends, g, block, lowest, span) for g in block.groups)))
    pair, band = keys // span, keys % span + lowest
    enough = np.flatnonzero(shared >= block.least[pair % len(block.ids)])
    enough = enough[np.lexsort((band[enough], pair[enough]))]
    pair, band = pair[enough], band[enough]
    row, item = pair // len(block.ids), pair % len(block.ids)
    e = block.edits[item]
    first, last = band * (e + 1), (band + 2) * (e + 1) - 1
    if not len(first):
        return
    edge = np.concatenate([[True], (pair[1:] != pair[:-1]) | (first[1:] > last[:-1] + 1)])  # overlapping bands are one region
    begins = np.flatnonzero(edge)
    row, item, e, first, last = row[begins], item[begins], e[begins], first[begins], last[np.append(begins[1:], len(edge)) - 1]
    sizes = np.array([len(t) for t in block.texts])[item]
    around = e + (sizes < Q)  # short items need the bytes beside them
    begin = np.maximum(0, first - around)
    stop = np.minimum(ends[row + 1] - ends[row], last + sizes + around + 1)
    keep = _plausible(item, ends[row] + begin, ends[row] + np.maximum(begin, stop), grams & _mask(FINE), block)
    for r, i, e, first, last, begin, stop in zip(*(x[keep].tolist() for x in (row, item, e, first, last, begin, stop))):
        text, a, size = block.texts[i], int(ends[r]), int(ends[r + 1] - ends[r])
        region = low[a + begin : a + stop].tobytes()
        if len(text) < Q:
            got = _whole_word(text, b" " * (begin == 0) + region + b" " * (stop == size), begin == 0)
        else:
            got = align(text, region, first - e - begin, last - first + 1 + 2 * e, e)
        if got is not None and got[2] > got[1]:
            edits, s, t = got
            yield r, i, int(place[a + begin + s] - offsets[r]), int(place[a + begin + t - 1] + 1 - offsets[r]), edits


def _whole_word(item: bytes, region: bytes, led: bool) -> tuple[int, int, int] | None:
    """The first place where a short item stands between spaces; ``led``: a space has been put before the region."""
    at = region.find(b" " + item + b" ")
    return None if at < 0 else (0, at + 1 - led, at + 1 - led + len(item))


def row_of(ends: np.ndarray, where: np.ndarray) -> np.ndarray:
    return np.searchsorted(ends, where, side="right") - 1


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = BLOCK, max_error: float = MAX_ERROR) -> Iterator[Block]:
    """The benchmark as blocks of at most ``size`` bytes (or one item), read as a stream."""
    ids, texts, held = [], [], 0
    for r in benchmark.select(item, text).where(F.col(text).isNotNull()).toLocalIterator():
        if ids and held + len(r[1]) > size:
            yield index(ids, texts, max_error)
            ids, texts, held = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        held += len(r[1].encode())
    if ids:
        yield index(ids, texts, max_error)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", max_error: float = MAX_ERROR) -> DataFrame:
    """One row for every place of a document where a benchmark item occurs with at most ``max_error`` edits a byte.

    Result: the key, the item's id, start and stop (bytes of the document's UTF-8 text), edits. The benchmark is a set of
    queries: it is broadcast in blocks of bounded size, each against all documents. Null or empty texts hold nothing, items
    that are null or blank are not searched; one shorter than `Q` bytes occurs where it stands as whole words. Repeated rows and items give a row each; an empty benchmark or
    table gives no rows.
    """
    spark = docs.sparkSession
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t <> ''")

    def search(shared) -> DataFrame:
        return rows.mapInArrow(arrow.lean(_search(shared, benchmark.schema[item].dataType)), f"k {kinds[0]}, i {kinds[1]}, start bigint, stop bigint, edits int")

    out = _by_block(spark, blocks(benchmark, item, max_error=max_error), search, "leaks")
    if out is None:
        return spark.createDataFrame([], f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, start bigint, stop bigint, edits int")
    return out.withColumnsRenamed({"k": key, "i": item})


def _by_block(spark, found: Iterator[Block], search, name: str) -> DataFrame | None:
    """The rows of ``search(broadcast block)`` of all blocks. A single one is searched when the rows are asked for; several are
    broadcast and searched one after another, each given up before the next, and their rows are stored."""
    block, following = next(found, None), next(found, None)
    if block is None:
        return None
    if following is None:
        return search(spark.sparkContext.broadcast(block))
    out = None
    while block is not None:
        shared = spark.sparkContext.broadcast(block)
        rows = staged(search(shared), name)
        shared.destroy()
        out = rows if out is None else out.unionByName(rows)
        block, following = following, next(found, None)
    return out


def _search(shared, kind):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(kind)

    def run(batches):
        block = shared.value
        for batch in batches:
            data, offsets = arrow.flat(batch.column(1))
            got = []
            for i, j in arrow.pieces(offsets):
                part = find(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], block)
                got += [(i + r, *rest) for r, *rest in part]
            if got:
                r, i, start, stop, edits = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(r)),
                        pa.array([block.ids[k] for k in i], kind),
                        pa.array(start, pa.int64()),
                        pa.array(stop, pa.int64()),
                        pa.array(edits, pa.int32()),
                    ],
                    ["k", "i", "start", "stop", "edits"],
                )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", max_error: float = MAX_ERROR) -> DataFrame:
    """The documents in which no benchmark item occurs, with all their columns; null and empty texts stay."""
    spark = docs.sparkSession
    found = blocks(benchmark, item, max_error=max_error)
    block, following = next(found, None), next(found, None)
    if block is None:
        return docs
    if following is None:
        shared = spark.sparkContext.broadcast(block)
        return arrow.extended(docs, {"_leaks": T.BooleanType()}, lambda: lambda column: [_holds(column, shared.value)], text).where("NOT _leaks").drop("_leaks")
    # whether a document goes depends on its text alone, so the texts that go are named by a hash
    name = F.md5(F.col(f"`{text}`").cast("string"))
    texts = docs.select(name.alias("name"), F.col(f"`{text}`").cast("string").alias("t")).where("t <> ''")

    def search(shared) -> DataFrame:
        held = arrow.extended(texts, {"leaks": T.BooleanType()}, lambda: lambda column: [_holds(column, shared.value)], "t")
        return held.where("leaks").select("name").distinct()

    gone = _by_block(spark, itertools.chain([block, following], found), search, "leaking")
    return docs.withColumn("_name", name).join(gone.withColumnRenamed("name", "_gone").distinct(), F.col("_name") == F.col("_gone"), "left_anti").drop("_name")


def _holds(column: pa.Array, block: Block) -> pa.Array:
    data, offsets = arrow.flat(column)
    out = np.zeros(len(column), bool)
    for i, j in arrow.pieces(offsets):
        for r, *_ in find(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], block):
            out[i + r] = True
    return pa.array(out)
