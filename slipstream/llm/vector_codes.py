"""Vector code compression: product codes whose nearest entries are found in a GNAT over the entries of each codebook.

Components become integers, a vector is cut into equal parts, and each part is coded by the nearest of at most 256 entries of
its position's codebook. A GNAT (geometric near-neighbour access tree) holds the distinct entries of a codebook: a node has
split points, every other entry belongs to the child of its nearest split point, and for each split point and child the
node stores the range of distances between them. A query measures its distances to the split points; a child whose range lies
strictly outside (distance - radius, distance + radius) of any split point holds no entry as near as the best one so far and
is left out with its whole subtree. Square roots are rounded outwards, so rounding never removes an entry, and what remains is
compared by integer squared distances, equal ones by index: the result is exact.

Every pass reads the vectors once where they lie. Only sums and counts of entries (a fixed number for each task) are shuffled,
and only codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import packed
from slipstream.session import staged

DEGREE = 8  # split points of a node
LEAF = 8  # a node of so few entries is not split
LABELS = 10_000  # so few different labels are broadcast, more are joined by a shuffle
MOST = 2**63 - 1
_NEVER = np.iinfo(np.int64).max
_DOWN, _UP = 1 - 2.0**-40, 1 + 2.0**-40  # more than a square root and its conversions can be off


def _squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Integer squared distances of every point (rows) to every entry (columns)."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for c in range(points.shape[1]):
        step = points[:, c, None] - entries[None, :, c]
        out += step * step
    return out


class Gnat:
    """Tree over the distinct entries of one codebook; of equal entries the one with the lowest index counts."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf = entries, degree, leaf
        _, first = np.unique(entries, axis=0, return_index=True)
        self.root = self._node(np.sort(first))
        self.measured = 0  # distances to entries that queries have computed

    def _node(self, ids: np.ndarray) -> dict:
        if len(ids) <= max(self.leaf, self.degree):
            return {"ids": ids, "children": []}
        entries = self.entries[ids]
        splits = [0]  # each next split point is the one farthest from those before
        nearest = _squared(entries, entries[:1])[:, 0]
        while len(splits) < self.degree:
            splits.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _squared(entries, entries[splits[-1:]])[:, 0])
        splits = np.sort(splits)
        far = _squared(entries, entries[splits])
        owner = far.argmin(1)
        owner[splits] = -1
        children = []
        for j in range(self.degree):
            own = np.flatnonzero(owner == j)
            if len(own):
                root = np.sqrt(far[own].astype(np.float64))
                children.append((root.min(0) * _DOWN, root.max(0) * _UP, self._node(ids[own])))
        return {"ids": ids[splits], "children": children}

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every point; ties go to the lower index."""
        at, best = np.full(len(points), -1, np.int64), np.full(len(points), _NEVER, np.int64)
        if len(self.entries):
            self._visit(self.root, np.arange(len(points)), points, at, best)
        return at, best

    def _visit(self, node: dict, rows: np.ndarray, points: np.ndarray, at: np.ndarray, best: np.ndarray) -> None:
        ids = node["ids"]
        squared = _squared(points[rows], self.entries[ids])
        self.measured += squared.size
        first = squared.argmin(1)  # ids ascend, so the first of equal ones has the lowest index
        least, index = squared[np.arange(len(rows)), first], ids[first]
        better = (least < best[rows]) | ((least == best[rows]) & (index < at[rows]))
        at[rows[better]], best[rows[better]] = index[better], least[better]
        if not node["children"]:
            return
        root = np.sqrt(squared.astype(np.float64))
        low, high = root * _DOWN, root * _UP
        for nearest, farthest, child in node["children"]:
            radius = np.sqrt(best[rows].astype(np.float64))[:, None] * _UP
            out = ((low - radius) * _out(low - radius) > farthest) | ((high + radius) * _UP < nearest)
            alive = rows[~out.any(1)]
            if len(alive):
                self._visit(child, alive, points, at, best)


def _out(x: np.ndarray) -> np.ndarray:
    """The factor that makes a number smaller, whatever its sign."""
    return np.where(x > 0, _DOWN, _UP)


@dataclass(frozen=True)
class Codebooks:
    """Entries as Python integers: ``entries[part][index][position]``."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def sha256(self) -> str:
        flat = ",".join(str(c) for part in self.entries for entry in part for c in entry)
        return hashlib.sha256(flat.encode()).hexdigest()

    @property
    def dimension(self) -> int:
        return sum(len(part[0]) for part in self.entries) if self.entries and self.entries[0] else 0

    def limit(self) -> int:
        """Below this size of all components every sum of squares fits in 62 bits."""
        return int(2**30 / math.sqrt(max(1, self.dimension)))


def _integers(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(floor(256 x) as 64-bit numbers, whether all of a row are below the limit); rows that are not come out as zeros."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * 256.0)
    small = (np.abs(scaled) < limit).all(1)
    return np.where(small[:, None], scaled, 0).astype(np.int64), small


def _exact(row: np.ndarray) -> list[int]:
    """floor(256 x) of components of any size; beyond 2^53 a number has no fraction."""
    return [int(x) * 256 if abs(x) > 2.0**60 else math.floor(x * 256) for x in row.tolist()]


class Assigner:
    """Nearest entries of batches of vectors; one for each task."""

    def __init__(self, books: Codebooks):
        self.books, self.limit = books, books.limit()
        self.small = all(abs(c) < self.limit for part in books.entries for e in part for c in e)
        self.trees = [Gnat(np.array(part, np.int64)) for part in books.entries] if self.small else []

    def batch(self, values: np.ndarray):
        """(integers, indexes by part, squared distances by part, rows with large numbers as a list of (row, integers,
        indexes, distances)); the arrays hold no meaning at rows with large numbers."""
        own, small = _integers(values, self.limit)
        if not self.small:
            small[:] = False
        codes = np.zeros((len(own), len(self.books.entries)), np.int64)
        error = np.zeros_like(codes)
        width = own.shape[1] // len(self.books.entries)
        for k, tree in enumerate(self.trees):
            codes[:, k], error[:, k] = tree.nearest(own[:, k * width : (k + 1) * width])
        large = [(r, *self._one_by_one(_exact(values[r]), width)) for r in np.flatnonzero(~small).tolist()]
        return own, small, codes, error, large

    def _one_by_one(self, row: list[int], width: int):
        """Numbers beyond 62-bit sums are compared entry by entry in Python's integers."""
        found = []
        for k, part in enumerate(self.books.entries):
            x = row[k * width : (k + 1) * width]
            found.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(part)))
        return row, [i for _, i in found], [d for d, _ in found]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and holds finite numbers only."""
    finite = F.forall(F.col("_v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vectors.withColumn("_v", F.col(f"`{vector}`").cast("array<double>")).where(F.col("_v").isNotNull() & finite)


def train(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, key: str = "vec_id", vector: str = "embedding") -> Codebooks:
    """Codebooks after some rounds over all vectors. They start from the ``size`` smallest keys (null keys last, equal keys by
    components). A round assigns every part to the nearest entry and then replaces each entry by the componentwise
    floor(sum / count) of its parts; entries without parts stay. Vectors that are null, hold null or non-finite components, or do not
    have the dimension of the first one whose length the parts divide are left out. Without vectors the codebooks are empty."""
    if not 0 < size <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    whole = _kept(vectors, vector).where(f"size(_v) > 0 AND size(_v) % {parts} = 0")
    order = [F.col(f"`{key}`").asc_nulls_last(), F.col("_v")]
    found = whole.orderBy(*order).limit(1).select("_v").collect()
    if not found:
        return Codebooks(((),) * parts)
    dimension = len(found[0][0])
    whole = whole.where(F.size("_v") == dimension)
    start = [_exact(np.array(r[0], np.float64)) for r in whole.orderBy(*order).limit(size).select("_v").collect()]
    width = dimension // parts
    books = Codebooks(tuple(tuple(tuple(row[k * width : (k + 1) * width]) for row in start) for k in range(parts)))
    for _ in range(rounds):
        books = _moved(whole.select("_v"), books)
    return books


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: the means of what each entry has been assigned."""
    parts, size, dimension = len(books.entries), len(books.entries[0]), books.dimension
    width = dimension // parts

    def add_up(batches):
        assigner = None
        counts, sums = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        big: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            assigner = assigner or Assigner(books)
            own, small, codes, _, large = assigner.batch(_matrix(batch.column(0), dimension))
            for k in range(parts):
                np.add.at(counts[k], codes[small, k], 1)
                np.add.at(sums[k], codes[small, k], own[small, k * width : (k + 1) * width])
            for _, row, index, _ in large:
                for k, i in enumerate(index):
                    counts[k, i] += 1
                    held = big.setdefault((k, i), [0] * width)
                    big[k, i] = [a + b for a, b in zip(held, row[k * width : (k + 1) * width])]
        if counts.any():
            some = [json.dumps([[i, list(map(str, v))] for (p, i), v in big.items() if p == k]) if big else None for k in range(parts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(parts), pa.int32()),
                    pa.array([c.tobytes() for c in counts], pa.binary()),
                    pa.array([s.tobytes() for s in sums], pa.binary()),
                    pa.array(some, pa.string()),
                ],
                ["part", "counts", "sums", "big"],
            )

    def merge(batches):
        for part, held in packed.grouped(batches):
            counts, sums = np.zeros(size, object), np.zeros((size, width), object)  # Python's integers do not overflow
            for batch in held:
                for c, s, big in zip(*(batch.column(n).to_pylist() for n in ("counts", "sums", "big"))):
                    counts += np.frombuffer(c, np.int64).astype(object)
                    sums += np.frombuffer(s, np.int64).reshape(size, width).astype(object)
                    for i, v in json.loads(big) if big else ():
                        sums[i] += np.array([int(x) for x in v], object)
            means = [[str(x // n) for x in s] if n else None for n, s in zip(counts.tolist(), sums.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([json.dumps(means)])], ["part", "means"])

    summed = rows.mapInArrow(add_up, "part int, counts binary, sums binary, big string")
    # a row for each part: entries times components numbers, whatever the input
    found = {r.part: json.loads(r.means) for r in packed.dealt(summed, "part").mapInArrow(merge, "part int, means string").collect()}
    return Codebooks(
        tuple(
            tuple(entry if mean is None else tuple(map(int, mean)) for entry, mean in zip(part, found.get(k, [None] * size)))
            for k, part in enumerate(books.entries)
        )
    )


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding", label: str | None = "label") -> DataFrame:
    """Codes of all vectors that `train` would not leave out.

    Result: all columns but the vector, and code (the parts' indexes, two hexadecimal digits each), error (squared distances summed
    over the parts; 2^63 - 1 if it is larger), with a label column label_error (error summed over rows of one label, null labels
    together, same bound) and codebooks_sha256, which replace columns of their names.
    """
    dimension, parts = books.dimension, len(books.entries)
    names = ["code", "error", "codebooks_sha256"] + (["label_error"] if label else [])
    rest = [c for c in vectors.columns if c != vector and c not in names]

    def run(batches):
        assigner = None
        digits = np.array([f"{i:02x}" for i in range(256)])
        for batch in batches:
            if not batch.num_rows:
                continue
            assigner = assigner or Assigner(books)
            _, _, codes, error, large = assigner.batch(_matrix(batch.column(1), dimension))
            total = error.sum(1).tolist()
            for r, _, index, distances in large:
                codes[r], total[r] = index, min(sum(distances), MOST)
            written = ["".join(row) for row in digits[codes].tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(written, pa.string()), pa.array(total, pa.int64())], ["row", "code", "error"])

    row = F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_"))
    sized = _kept(vectors, vector).where(F.size("_v") == dimension).where(F.lit(dimension > 0)).select(row.alias("row"), "_v")
    found = sized.mapInArrow(run, f"row {sized.schema['row'].dataType.simpleString()}, code string, error bigint")
    found = found.select(*[F.col(f"row.`{c}`") for c in rest], "code", "error")
    if label:
        found = staged(found, "codes")  # read by the sums and by the result
        sums = found.groupBy(F.col(f"`{label}`").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
        sums = staged(sums.select("_label", F.least("_sum", F.lit(MOST).cast("decimal(38,0)")).cast("bigint").alias("label_error")), "label-sums")
        if sums.limit(LABELS + 1).count() <= LABELS:
            sums = F.broadcast(sums)
        found = found.join(sums, F.col(f"`{label}`").eqNullSafe(F.col("_label")), "left").drop("_label")
    return found.withColumn("codebooks_sha256", F.lit(books.sha256))


def decode(codes: DataFrame, books: Codebooks, code: str = "code", vector: str = "embedding") -> DataFrame:
    """Vectors of doubles from their codes: the entries divided by 256. A null code gives a null vector."""

    def run(column: pa.Array) -> pa.Array:
        out = []
        for value in column.to_pylist():
            index = [] if value is None else [int(value[i : i + 2], 16) for i in range(0, len(value), 2)]
            out.append(None if value is None else [c / 256 for part, i in zip(books.entries, index) for c in part[i]])
        return pa.array(out, pa.list_(pa.float64()))

    return codes.withColumn(vector, F.arrow_udf(run, "array<double>")(code))


def compress(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, key: str = "vec_id", vector: str = "embedding", label: str | None = "label") -> DataFrame:
    """`train` and `encode` over the same vectors."""
    return encode(vectors, train(vectors, parts, size, rounds, key, vector), vector, label)


def twin(n: int = 16, size: int = 64, rounds: int = 2) -> str:
    """The same as SQL over ``embeddings``: each of ``n`` parts against every entry."""
    distance = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS (SELECT vec_id, part, min([d, entry]) AS best FROM
            (SELECT p.vec_id, p.part, b.entry, CAST({distance} AS BIGINT) AS d FROM p JOIN b{r} AS b ON p.part = b.part) AS s GROUP BY vec_id, part)"""
        )
        if r < rounds:
            steps.append(
                f"""b{r + 1} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} AS b LEFT JOIN
                (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM
                (SELECT part, entry, pos, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM
                (SELECT p.part, a.best[2] AS entry, unnest(p.x) AS c, generate_subscripts(p.x, 1) AS pos
                FROM p JOIN a{r} AS a ON p.vec_id = a.vec_id AND p.part = a.part) AS u GROUP BY part, entry, pos) AS g GROUP BY part, entry) AS m
                ON b.part = m.part AND b.entry = m.entry)"""
            )
    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT vec_id, label, k AS part, list_slice(v, k * len(v) // {n} + 1, (k + 1) * len(v) // {n}) AS x FROM kept, range({n}) AS t(k)),
    b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
      WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {size})),
    {", ".join(steps)},
    f AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
    h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
    SELECT f.vec_id, f.code, f.error, CAST(sum(f.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256
    FROM f JOIN kept AS k ON f.vec_id = k.vec_id, h"""
