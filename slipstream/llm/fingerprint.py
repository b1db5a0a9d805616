"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every window of five bytes gives six triplets that hold its last byte. Each is hashed into one of `BUCKETS` counters, and a
counter is coded in two bits by the quartile of all counters that it lies in. A digest is one byte for the length on a
logarithmic scale, one for how far apart the quartiles are, and the codes. Two digests are compared by a bounded score.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import arrow
from slipstream.session import staged

BUCKETS = 256
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))  # bytes back from the last one
HEADER = 2
WORST = 1.625 * BUCKETS  # summed code differences at which two digests are as unlike as random ones
ROWS = 400  # documents that are worked on at a time


def counters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triplet counts of each row, one column for each bucket. A text shorter than five bytes is padded with zeros in front."""
    rows = len(offsets) - 1
    out = np.zeros(rows * BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for i, j in arrow.pieces(offsets):
        part = data[offsets[i] : offsets[j]].astype(np.uint32)
        if not len(part):
            continue
        ends = offsets[i : j + 1] - offsets[i]
        sizes = np.diff(ends)
        base = np.repeat(np.arange(j - i, dtype=np.int64) * BUCKETS, sizes)
        place = np.arange(len(part)) - np.repeat(ends[:-1], sizes)
        whole = (place >= 4) | np.repeat((sizes < 5) & (sizes > 0), sizes)
        back = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint32), part[: len(part) - k]])[: len(part)], 0).astype(np.uint32) for k in range(5)]
        base = base[whole]
        back = [b[whole] for b in back]
        found = np.zeros((j - i) * BUCKETS, np.int64)
        for k, (a, b, c) in enumerate(TRIPLETS):
            h = back[a] + (back[b] << np.uint32(8)) + (back[c] << np.uint32(16)) + np.uint32((k + 1) << 24)
            h *= np.uint32(2654435761)
            h ^= h >> np.uint32(15)
            h *= np.uint32(2246822519)
            found += np.bincount(base + (h >> shift), minlength=len(found))
        out[i * BUCKETS : j * BUCKETS] = found
    return out.reshape(rows, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The digest of each row as bytes. An empty text has only zeros."""
    counts = counters(data, offsets)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8)
    packed = codes[:, 0::4] | codes[:, 1::4] << 2 | codes[:, 2::4] << 4 | codes[:, 3::4] << 6
    size = np.diff(offsets)
    length = np.minimum(255, np.round(8 * np.log2(1 + size))).astype(np.uint8)
    top = np.maximum(q3[:, 0], 1)
    spread = ((q1[:, 0] * 15 // top).astype(np.uint8) << 4) | np.minimum(15, q2[:, 0] * 15 // top).astype(np.uint8)
    return np.column_stack([length, spread, packed])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bounded score of pairs of digests: 1 for equal ones, 0 from a summed difference of `WORST` on.

    A code differs by up to three steps, the last of which counts double; the header counts a fourth of its steps. Two
    digests of empty texts are equal, one of an empty text is unlike any other.
    """
    steps = np.zeros(len(a))
    for shift in (0, 2, 4, 6):
        d = np.abs((a[:, HEADER:] >> shift & 3).astype(np.int16) - (b[:, HEADER:] >> shift & 3))
        steps += np.where(d == 3, 6, d).sum(axis=1)
    length = np.abs(a[:, 0].astype(np.int16) - b[:, 0])
    spread = np.abs((a[:, 1] >> 4).astype(np.int16) - (b[:, 1] >> 4)) + np.abs((a[:, 1] & 15).astype(np.int16) - (b[:, 1] & 15))
    total = np.where((a[:, 0] == 0) != (b[:, 0] == 0), WORST, steps + (length + spread) / 4)
    return 1 - np.minimum(total, WORST) / WORST


def _of(texts: list[str]) -> np.ndarray:
    return digests(*arrow.flat(pa.array(texts, pa.string())))


def _pairs(texts: list[str]) -> tuple[list, list, np.ndarray, np.ndarray]:
    """For all texts but the last: code points, edited texts' hashes, digests (of all), digests of the edited texts."""
    edited = []
    for own, following in zip(texts, texts[1:]):
        cut = len(own) // 3
        edited.append(own[: len(own) - cut] + following[:cut])
    return [len(t) for t in texts[:-1]], [hashlib.sha256(e.encode()).digest() for e in edited], _of(texts), _of(edited)


_FIELDS = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _fields(texts: list[str]) -> list[pa.Array]:
    sizes, hashes, own, edited = _pairs(texts)
    return [
        pa.array(sizes, pa.int64()),
        pa.array(hashes, pa.binary()),
        pa.array([d.tobytes() for d in own[:-1]], pa.binary()),
        pa.array([d.tobytes() for d in edited], pa.binary()),
        pa.array(likeness(own[:-1], edited), pa.float64()),
        pa.array(likeness(own[:-1], own[1:]), pa.float64()),
    ]


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` (binary digest of the whole text) to every document; a null text counts as empty.

    Equal texts have equal fingerprints. A column of the same name is replaced, all others are kept.
    """

    @F.arrow_udf("binary")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([d.tobytes() for d in digests(*arrow.flat(column))], pa.binary())

    return docs.withColumn("fingerprint", of(F.col(text)))


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike it is to that and to the next document.

    The next document is the one with the next smaller key; the first one follows the last. Null keys come last, rows of one
    key in the order of their text's hash; a table of one row is its own next. The edited text has its last third replaced by
    as many code points (or all) of the next text. Null texts count as empty. Result: key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint (binary), near_edited, near_next; one row for each row.

    Texts are dealt out by ranges of the key once. A task sees its range in order and leaves only its last row open, which
    needs the first row of the next range; those few rows meet in a join.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    order = [F.desc_nulls_last("k"), F.asc("h")]
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")

    def walk(batches):
        part, carried, first = TaskContext.get().partitionId(), None, True

        def out(keys, texts, first, last):
            n = len(keys)
            fields = _fields(texts) if not last else [pa.nulls(n, f.type) for f in _fields(["", ""])]
            edge = [texts[0] if first else None] + [None] * (n - 1)
            end = [None] * (n - 1) + [texts[-1] if last else None]
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), keys, *fields, pa.array(edge, pa.string()), pa.array(end, pa.string())],
                ["part", "k", *_NAMES, "first_text", "last_text"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                keys, texts = piece.column(0), piece.column(1).to_pylist()
                if carried is not None:
                    keys, texts = pa.concat_arrays([carried[0], keys]), [carried[1], *texts]
                if len(texts) > 1:
                    yield out(keys[:-1], texts, first, False)
                    first = False
                carried = (keys[-1:], texts[-1])
        if carried is not None:
            yield out(carried[0], [carried[1]], first, True)

    walked = staged(dealt.mapInArrow(walk, f"part int, k {kind}, {_FIELDS}, first_text string, last_text string"), "neighbours")
    parts = sorted(r.part for r in walked.where("last_text IS NOT NULL").select("part").collect())  # one number for each task
    follows = spark.createDataFrame([(a, b) for a, b in zip(parts, parts[1:] + parts[:1])], "part int, next int")
    firsts = walked.where("first_text IS NOT NULL").select(F.col("part").alias("next"), F.col("first_text").alias("following"))
    opened = walked.where("last_text IS NOT NULL").select("part", "k", "last_text").join(F.broadcast(follows), "part")
    met = opened.join(firsts, "next").select("k", "last_text", "following")

    def close(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own, following = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], *_fields([own, following])], ["k", *_NAMES])

    closed = met.mapInArrow(close, f"k {kind}, {_FIELDS}")
    done = walked.where("last_text IS NULL").select("k", *_NAMES)
    return done.unionByName(closed).withColumnRenamed("k", key)
