"""Exact Jaccard self-join of word shingle sets by signature trees.

Top of the tree. Sets that reach the threshold differ in at most d shingles (a bound from their sizes). Within each window of
sizes the shingles are dealt into more than d segments, so two such sets agree wholly on some segment that is not empty: tree
nodes at the top are (window, segment, its content), and node pairs with other content cannot reach the overlap. Small sets,
whose segments hold a shingle or two, are dealt into d + 4 segments and agree on two, so their nodes are named by two segments and one
common shingle brings nobody together. Equal sets form one class beforehand, equal nodes are kept once, and a large node is split
into blocks.

Inside. The members of a node carry bitmaps of their shingles. They are ordered by size and packed into leaves and inner
nodes, which hold the OR and the AND of the bitmaps below and the range of sizes. Two nodes are traversed together; a pair is
dropped when the largest overlap that the bitmaps and sizes allow is too small, or when all below is already joined. Pairs
that are left at the bottom are verified on their shingles.

Rounds. The first traversal takes the node's first member against all others and then the rest of each block, and keeps only
pairs that join something new; with those verified, the second one goes over all block pairs of the nodes whose members are
not all in one component yet. Sets travel under 64-bit names; a second hash of every set shows whether two share one, and then all
are named anew.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import arrow, packed
from slipstream.llm.components import components
from slipstream.llm.substring import Chunk, same_as_before
from slipstream.session import discard, staged

RATIO = 1.25  # between the sizes that begin neighbouring windows
SEEDS = 4  # dealings that are tried for a set whose shingles fall into too few segments
MEMBERS = 1024  # sets in one block of a node
LEAF = 16  # sets in a leaf, and nodes below an inner node
BITS = (64, 1 << 14)  # least and most bits of a bitmap; in between four for each shingle


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of every row, by row and hash.

    A-Z are lower-cased; words are runs of anything but space and U+0009 to U+000D. A row of fewer words than a shingle has
    its whole sequence as the only one, a row without words has none.
    """
    low = arrow.fold_ascii(data)
    starts, ends, row = arrow.words(low, offsets)
    word = arrow.spans_hash(low, starts, ends)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    found, rows = [], []
    for n in range(1, words + 1):
        h = arrow.windows(word, n)
        if n == words:
            take = np.flatnonzero(row[: len(h)] == row[n - 1 :]) if len(h) else np.zeros(0, np.int64)
        else:
            take = first[count == n]
        found.append(arrow.mix(h[take] ^ np.uint64(n)))
        rows.append(row[take])
    h, r = np.concatenate(found), np.concatenate(rows)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    keep = ~same_as_before(h, r)
    return h[keep], r[keep]


class Windows:
    """Windows of set sizes for a threshold, with the segments of each."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.gap = (1 - threshold) / (1 + threshold)  # of the two sizes' sum, the most that two sets can differ
        self.begins = [1]

    def _until(self, size: int) -> None:
        while self.begins[-1] <= size:
            self.begins.append(max(self.begins[-1] + 1, int(self.begins[-1] * RATIO)))

    def of(self, size: int) -> list[tuple[int, int, int, bool]]:
        """(window, d, segments, whether names are of two segments) for each window of a set of this size; a linked pair shares
        the smaller one's own window."""
        self._until(size)
        own = int(np.searchsorted(self.begins, size, side="right")) - 1
        out = []
        for g in range(own, -1, -1):
            most = self.begins[g + 1] - 1  # the largest smaller one
            largest = int(most / self.t)
            if largest < size:
                break
            d = int(self.gap * (most + largest))
            if d:  # else only equal sets are linked, which are one class
                # few shingles make poor names: where a segment holds one or two, nodes are named by two segments
                pairs = d <= 4 and self.begins[g] >= d + 3
                out.append((g, d, d + 4 if pairs else 4 * d + 8 if d <= 4 else d + 1 + max(4, d // 3), pairs))
        return out


def keys(own: np.ndarray, windows: Windows) -> np.ndarray:
    """The names of the top nodes that a set belongs to."""
    out = []
    for g, d, segments, pairs in windows.of(len(own)):
        for seed in range(SEEDS + 1):
            salt = np.uint64(((g * 16 + seed) << 32) + 1)
            if seed == SEEDS:  # in too few segments under every seed
                out.append(arrow.mix(np.array([salt], np.uint64)))
                break
            spread = arrow.mix(own ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) if seed else own
            segment = ((spread >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
            content = np.zeros(segments, np.uint64)
            np.add.at(content, segment, arrow.mix(own * np.uint64(0x9E3779B97F4A7C15)))
            some = np.flatnonzero(np.bincount(segment, minlength=segments))
            names = arrow.join(arrow.mix(content[some] ^ salt), some.astype(np.uint64))
            if pairs:
                i, j = np.triu_indices(len(names), 1)
                names = arrow.mix(arrow.join(names[i], names[j]))
            out.append(names)
            if len(some) > d + pairs:  # two sets that reach the threshold agree on one segment, or two, that are not empty
                break
    return np.concatenate([np.zeros(0, np.uint64), *out])


def bitmap(own: np.ndarray) -> np.ndarray:
    """One bit for each shingle, by the lowest bits of its hash."""
    size = int(min(BITS[1], max(BITS[0], 1 << int(np.ceil(np.log2(4 * max(1, len(own))))))))
    bits = np.zeros(size, bool)
    bits[(own & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of different length as rows of the shortest: the lowest bits of the hash stay."""
    least = min(len(m) for m in maps)
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, least), axis=0) for m in maps])


class Tree:
    """A signature tree over some sets: levels from the leaves up; a node knows its rows, bitmaps, sizes and components."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, roots: np.ndarray):
        self.order = np.lexsort((*(maps[:, k] for k in range(min(4, maps.shape[1]))), sizes))
        self.sizes, self.maps, self.roots = sizes[self.order], maps[self.order], roots[self.order]
        at = np.arange(0, len(sizes), LEAF)
        self.levels = []
        some, every, low, high = self.maps, self.maps, self.sizes, self.sizes
        first, last = self.roots, self.roots
        while True:
            some, every = np.bitwise_or.reduceat(some, at, axis=0), np.bitwise_and.reduceat(every, at, axis=0)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((some, every, low, high, first, last))
            if len(low) == 1:
                break
            at = np.arange(0, len(low), LEAF)

    def below(self, level: int, node: int) -> range:
        n = len(self.sizes) if level == 0 else len(self.levels[level - 1][2])
        return range(node * LEAF, min(n, (node + 1) * LEAF))


def _reach(a_size, a_map, a_other, b_size, b_map, b_other):
    """The largest overlap that sizes and bitmaps allow; ``other`` is what the opposite side may hold at most."""
    left = a_size - np.bitwise_count(a_map & ~b_other).sum(axis=-1).astype(np.int64)
    right = b_size - np.bitwise_count(b_map & ~a_other).sum(axis=-1).astype(np.int64)
    return np.minimum(left, right)


def traverse(a: Tree, b: Tree, t: Fraction):
    """Dual traversal: (rows of a, rows of b) of the pairs at the bottom that may reach the threshold and are in different
    components, leaf pair by leaf pair. Of one tree with itself each pair comes once."""
    itself = a is b
    p, q = t.numerator, t.numerator + t.denominator
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        some, every, low, high, first, last = (x[i] for x in a.levels[la])
        some_, every_, low_, high_, first_, last_ = (x[j] for x in b.levels[lb])
        if first == last == first_ == last_:
            continue
        if q * int(_reach(high, every, some, high_, every_, some_)) < p * int(low + low_):
            continue
        if la or lb:
            if la >= lb:
                todo += [(la - 1, c, lb, j) for c in a.below(la, i)]
            else:
                todo += [(la, i, lb - 1, c) for c in b.below(lb, j)]
            continue
        if itself and i > j:
            continue
        ra, rb = np.array(a.below(0, i)), np.array(b.below(0, j))
        x, y = a.maps[ra][:, None], b.maps[rb][None]
        n, m = a.sizes[ra][:, None], b.sizes[rb][None]
        good = (q * _reach(n, x, x, m, y, y) >= p * (n + m)) & (a.roots[ra][:, None] != b.roots[rb][None])
        if itself and i == j:
            good &= ra[:, None] < rb[None]
        k, l = np.nonzero(good)
        if len(k):
            yield a.order[ra[k]], b.order[rb[l]]


class _Joined:
    """Which sets of a block are joined by the pairs kept so far."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _first_round(nodes: np.ndarray, sizes: np.ndarray, maps: np.ndarray, center: int, t: Fraction):
    """Pairs of a block that may be linked and join something new: the node's first member against all, then the rest."""
    p, q = t.numerator, t.numerator + t.denominator
    joined, at = _Joined(len(nodes)), np.flatnonzero(nodes == center)
    if len(at):
        c = int(at[0])
        good = q * _reach(sizes[c], maps[c][None], maps[c][None], sizes, maps, maps) >= p * (sizes[c] + sizes)
        for k in np.flatnonzero(good).tolist():
            if k != c and joined.join(c, k):
                yield c, k
    roots = np.array([joined.root(k) for k in range(len(nodes))])
    if (roots == roots[0]).all():
        return
    tree = Tree(sizes, maps, roots)
    for left, right in traverse(tree, tree, t):
        for i, j in zip(left.tolist(), right.tolist()):
            if joined.join(i, j):
                yield i, j


def _describe(docs: DataFrame, words: int, t: Fraction, key: str, text: str, salt: int) -> DataFrame:
    """Exchange rows of top node names (kind 0) and one row for each document with its set's size and name and its text's hash (kind 2)."""
    spark = docs.sparkSession
    buckets = packed.buckets(spark)
    names = ["kind", "part", "n", "ids", "codes", "checks", "places", "id", "row", "size", "h1", "h2", "hash"]

    def run(batches):
        windows, chunk = Windows(t), Chunk()

        def flush():
            codes, h1 = chunk.take()
            order = np.lexsort((h1, codes))
            codes, h1 = codes[order], h1[order]
            own = np.flatnonzero(~same_as_before(codes, h1))  # equal sets of the chunk go as one
            for out in packed.rows_of(0, packed.bucket_of(codes[own], buckets), h1[own].view(np.int64), codes=codes[own].astype(np.uint32)):
                nothing = [pa.nulls(out.num_rows, x) for x in (pa.int64(), row_type, pa.int64(), pa.int64(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*out.columns, *nothing], names)

        for batch in batches:
            data, offsets = arrow.flat(batch.column(2))
            n, row_type = batch.num_rows, batch.column(1).type
            sizes, first, second = (np.zeros(n, k) for k in (np.int64, np.uint64, np.uint64))
            for i, j in arrow.pieces(offsets):
                h, row = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                for k in range(j - i):
                    own = h[cut[k] : cut[k + 1]]
                    if not len(own):
                        continue
                    sizes[i + k] = len(own)
                    first[i + k], second[i + k] = _name(own, salt)[0], _check(own)[0]
                    codes = keys(own, windows)
                    if chunk.add(codes, np.full(len(codes), first[i + k])):
                        yield from flush()
            nothing = [pa.nulls(n, x) for x in (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([2] * n, pa.int32()), *nothing, batch.column(0), batch.column(1), pa.array(sizes), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), batch.column(3)],
                names,
            )
        if chunk.size:
            yield from flush()

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(packed.order_column(key).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), whole.alias("text"), F.xxhash64(whole).alias("hash"))
    return rows.mapInArrow(arrow.lean(run), f"{packed.SCHEMA}, id bigint, row {packed.row_type(docs, text)}, size bigint, h1 bigint, h2 bigint, hash bigint")


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, set) of the top nodes of at least two different sets; nodes of the same sets in one bucket once."""

    def run(batches):
        for _, held in packed.grouped(batches, 1):
            found = packed.numbers(held, codes=np.uint32)
            order = np.lexsort((found["ids"], found["codes"]))
            codes, sets = found["codes"][order], found["ids"][order]
            keep = ~same_as_before(codes, sets)
            codes, sets = codes[keep], sets[keep]
            start = np.flatnonzero(~same_as_before(codes))
            size = np.diff(np.append(start, len(codes)))
            whole = np.add.reduceat(arrow.mix(sets.view(np.uint64) + np.uint64(1)), start) if len(start) else np.zeros(0, np.uint64)
            name = arrow.join(whole, size.astype(np.uint64))  # by its sets
            _, some = np.unique(name, return_index=True)
            some = some[size[some] > 1]
            at = np.repeat(start[some] - (np.cumsum(size[some]) - size[some]), size[some]) + np.arange(size[some].sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name[some], size[some]).view(np.int64)), pa.array(sets[at])], ["node", "set"])

    columns = ("kind", "part", "n", "ids", "codes", "checks", "places")
    return packed.dealt(rows.where("kind = 0").select(*columns), "part").mapInArrow(arrow.lean(run), "node bigint, set bigint").distinct()


def _members(rows: DataFrame) -> DataFrame:
    """(node, members, center, set) of the top nodes of at least two different sets; nodes of the same sets once."""
    by_set = _nodes(rows)
    facts = by_set.groupBy("node").agg(F.count("*").alias("members"), F.min("set").alias("center"), F.max("set").alias("z"), F.expr("bit_xor(xxhash64(set))").alias("x"))
    once = facts.where("members > 1").groupBy("members", "center", "z", "x").agg(F.min("node").alias("node"))
    return by_set.join(once.select("node", "members", "center"), "node")


def _with_text(docs: DataFrame, wanted: DataFrame, reps: DataFrame, key: str, text: str) -> DataFrame:
    """``wanted`` (set, ...) with the text of each set's representative."""
    plain = F.col(text).cast("string")
    texts = docs.select(packed.order_column(key).alias("rep"), F.xxhash64(plain).alias("hash"), plain.alias("text")).where("text <> ''")
    again = reps.where("copies > 1").select("rep", "hash")
    if not again.isEmpty():  # equal texts under one key, of which one is enough
        one = texts.join(again, ["rep", "hash"], "left_semi").dropDuplicates(["rep", "hash"])
        texts = texts.join(again, ["rep", "hash"], "left_anti").unionByName(one)
    return wanted.join(reps.select("set", "rep", "hash"), "set").join(texts, ["rep", "hash"])


def _representatives(described: DataFrame) -> DataFrame:
    """(set, rep, hash, copies, clash): the smallest key of each set and its text's hash, how many rows have both, and whether other
    sets have the same name."""
    own = F.struct("size", "h2")
    rows = described.where("size > 0").groupBy(F.col("h1").alias("set"), F.col("id").alias("rep"), "hash").agg(F.count("*").alias("copies"), F.min(own).alias("p"), F.max(own).alias("q"))
    sets = rows.groupBy("set").agg(F.min(F.struct("rep", "hash", "copies")).alias("f"), (F.min("p") != F.max("q")).alias("clash"))
    return sets.select("set", "f.*", "clash")


def _name(own: np.ndarray, salt: int) -> np.ndarray:
    """The name of a set of shingles."""
    return arrow.mix(arrow.mix(own ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)).sum(keepdims=True) + np.uint64(len(own))) if salt else arrow.mix(own.sum(keepdims=True) + np.uint64(len(own)))


def _check(own: np.ndarray) -> np.ndarray:
    """A second hash of a set, of other functions of its shingles."""
    return arrow.mix(arrow.mix(own * np.uint64(0xD1342543DE82EF95)).sum(keepdims=True))


def _sets(column: pa.Array, words: int, salt: int):
    """(set name, shingles) of every text."""
    data, offsets = arrow.flat(column)
    for i, j in arrow.pieces(offsets):
        h, row = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
        cut = np.searchsorted(row, np.arange(j - i + 1))
        for k in range(j - i):
            own = h[cut[k] : cut[k + 1]]
            yield int(_name(own, salt).view(np.int64)[0]), own


def _signed(docs: DataFrame, members: DataFrame, reps: DataFrame, words: int, salt: int, key: str, text: str) -> DataFrame:
    """Members with their block, size and bitmap; the first member of a node goes to all blocks."""
    block = F.pmod(F.xxhash64("set"), F.expr(f"1 + (members - 1) div {MEMBERS}")).cast("int")
    placed = members.withColumn("blocks", F.expr(f"CAST(1 + (members - 1) div {MEMBERS} AS INT)")).withColumn("block", block)
    notes = placed.groupBy("set").agg(F.collect_list(F.struct("node", "center", "blocks", "block")).alias("notes"))  # at most one for each segment

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for name, notes_, (found, own) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _sets(batch.column(2), words, salt)):
                if found != name:  # another text of the same hash under the same key
                    continue
                bits = bitmap(own).tobytes()
                for note in notes_:
                    for b in range(note["blocks"]) if name == note["center"] else (note["block"],):
                        for column, value in zip(out, (note["node"], b, note["blocks"], note["center"], name, len(own), bits)):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["node", "block", "blocks", "center", "set", "size", "bits"])

    joined = _with_text(docs, notes, reps, key, text).select("set", "notes", "text")
    return joined.mapInArrow(arrow.lean(run), "node bigint, block int, blocks int, center bigint, set bigint, size bigint, bits binary")


def _by_node(rows: DataFrame, order: list[str], function) -> DataFrame:
    """Pairs (a, b) that ``function`` yields for the rows of each node and block, given as columns."""

    def run(batches):
        held, current = [], None

        def out():
            table = pa.Table.from_batches(held)
            got = list(function({c: table.column(c) for c in table.column_names}))
            if got:
                a, b = np.array(got, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in order]
            edges = np.flatnonzero(~same_as_before(*columns)).tolist() + [batch.num_rows]
            for i, j in zip(edges, edges[1:]):
                name = tuple(int(c[i]) for c in columns)
                if name != current and held:
                    yield from out()
                    held = []
                current = name
                held.append(batch.slice(i, j - i))
        if held:
            yield from out()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *order).sortWithinPartitions(*order).mapInArrow(arrow.lean(run), "a bigint, b bigint").distinct()


def _unique(columns: dict, *names: str) -> tuple[np.ndarray, ...]:
    """Columns as arrays, one entry for each set; bitmaps of one length."""
    _, at = np.unique(columns["set"].to_numpy(), return_index=True)
    maps = columns["bits"].to_pylist()
    return *(columns[c].to_numpy()[at] for c in names), _folded([np.frombuffer(maps[k], np.uint64) for k in at])


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, words: int, salt: int, t: Fraction, key: str, text: str) -> DataFrame:
    """The pairs of sets (a, b) whose shingles reach the threshold."""
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("set"))

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            seen = {}
            for i in range(batch.num_rows):
                a, b, name = (batch.column(c)[i].as_py() for c in range(3))
                if name not in seen:
                    found, own = next(_sets(batch.column(3).slice(i, 1), words, salt))
                    if found != name:  # another text of the same hash under the same key
                        continue
                    seen.clear()  # rows of one set often follow each other
                    seen[name] = own
                for column, value in zip(out, (a, b, name, seen[name].view(np.int64))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.list_(pa.int64()))], ["a", "b", "set", "own"])

    joined = _with_text(docs, sides, reps, key, text).select("a", "b", "set", "text")
    held = joined.mapInArrow(arrow.lean(run), "a bigint, b bigint, set bigint, own array<bigint>")
    both = held.groupBy("a", "b").agg(
        F.first(F.when(F.col("set") == F.col("a"), F.col("own")), True).alias("x"), F.first(F.when(F.col("set") == F.col("b"), F.col("own")), True).alias("y")
    )
    shared = F.size(F.array_intersect("x", "y"))
    return both.withColumn("n", shared).where(
        F.col("n") * t.denominator >= (F.size("x") + F.size("y") - F.col("n")) * t.numerator
    ).select("a", "b")


def link(docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(4, 5), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shingle set sizes and components of linked documents.

    Two documents link when the Jaccard similarity of their shingle sets is at least ``threshold``. A null or empty text has
    no shingles and is linked with nothing. A null key comes behind all others and is never the smallest of a component with
    another one. Keys are integers. Result: all columns but the text, and n_shingles, component_id (the smallest key that the
    document reaches by links, itself included) and component (a number that the documents of one component share; null
    without shingles), which replace columns of their names; one row for each row.
    """
    t, salt = Fraction(threshold), 0
    while True:
        rows = staged(_describe(docs, words, t, key, text, salt), "shingles")
        reps = staged(_representatives(rows.where("kind = 2")), "representatives")
        if reps.where("clash").isEmpty():
            break
        salt += 1  # two sets have one name
    described = staged(rows.where("kind = 2").select("id", "row", "size", "h1"), "described")
    signed = staged(_signed(docs, _members(rows), reps, words, salt, key, text), "signed")
    discard(rows)

    def first(columns):
        nodes, sizes, centers, maps = _unique(columns, "set", "size", "center")
        for i, j in _first_round(nodes, sizes, maps, int(centers[0]), t):
            yield nodes[i], nodes[j]

    tried = staged(_by_node(signed, ["node", "block"], first), "pairs")
    links = staged(_verified(docs, tried, reps, words, salt, t, key, text), "links")
    roots = components(links).select(F.col("node").alias("set"), "root")
    placed = signed.select("node", "set").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    undone = placed.groupBy("node").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("node")
    # bitmaps are moved only of nodes whose members are not all in one component
    rooted = signed.join(staged(undone, "undone"), "node").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))

    def second(columns):
        sides = []
        block = columns["block"].to_numpy()
        for value in np.unique(block):
            mine = pa.array(block == value)
            part = {c: v.filter(mine) for c, v in columns.items()}
            sides.append(_unique(part, "set", "size", "root"))
        maps = _folded([m for side in sides for m in side[3]])
        trees, at = [], 0
        for nodes, sizes, roots, own in sides:
            trees.append((nodes, Tree(sizes, maps[at : at + len(own)], roots)))
            at += len(own)
        one, other = trees[0], trees[-1]
        for left, right in traverse(one[1], other[1], t):
            yield from zip(one[0][left].tolist(), other[0][right].tolist())

    rest = rooted.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")})
    more = _by_node(rest, ["node", "low", "high"], second).join(tried, ["a", "b"], "left_anti")
    every = staged(links.unionByName(_verified(docs, more, reps, words, salt, t, key, text)), "links")
    discard(signed)
    found = components(every)
    least = found.join(reps, F.col("node") == F.col("set")).groupBy("root").agg(F.min("rep").alias("least"))
    of_set = reps.join(found, F.col("set") == F.col("node"), "left").join(least, "root", "left")
    named = of_set.select(F.col("set").alias("h1"), F.coalesce("least", "rep").alias("least"), F.coalesce("root", "set").alias("component"))
    # a text without shingles has no set, so no name to be joined by
    out = described.withColumn("h1", F.when(F.col("size") > 0, F.col("h1"))).join(named, "h1", "left")
    smallest = F.coalesce("least", "id")
    out = out.withColumns({"n_shingles": F.col("size"), "component_id": F.when(smallest != F.lit(int(packed.NULL_ID)), smallest)})
    return packed.unpacked(out, docs, text, "n_shingles", "component_id", "component")
