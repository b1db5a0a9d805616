"""Language identification with string kernels.

The kernel of two texts is their blended-spectrum presence kernel: how many byte n-grams of one to three bytes (lower-cased,
everything but letters as a space) occur in both, over the root of the product of their own numbers. N-grams are told apart
by a hash into `BUCKETS` buckets. Landmark texts of each language give the Nyström approximation, and one-versus-rest kernel
ridge regression on it gives a value per language. A batch is scored by two matrix products: presence by landmarks, then
landmarks by languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm import arrow

BUCKETS = 1 << 14
SPECTRUM = (1, 2, 3)
TRAIN_ROWS = 400  # distinct texts of each language that training takes at most, by the hash of the text
LANDMARKS = 32  # of each language, out of those
SALTS = 64  # parts that the texts of a language are ranked in
RIDGE = 1e-2
GROUP = 256  # texts in one matrix product

_ASCII = np.zeros(256, np.uint8)  # letters as they are, other ASCII signs as a space, bytes beyond as they are
_ASCII[:128] = 32
_ASCII[128:] = np.arange(128, 256)
_ASCII[97:123] = np.arange(97, 123)


def presence(column: pa.Array) -> np.ndarray:
    """One row of 0 and 1 for each text: which buckets its n-grams fall into."""
    data, offsets = arrow.flat(pc.utf8_lower(column))
    out = np.zeros((len(offsets) - 1) * BUCKETS, np.float32)
    for i, j in arrow.pieces(offsets):
        part, ends = _ASCII[data[offsets[i] : offsets[j]]].astype(np.uint32), offsets[i : j + 1] - offsets[i]
        row = np.repeat(np.arange(i, j, dtype=np.int64) * BUCKETS, np.diff(ends))
        value = part.copy()
        for n in range(1, max(SPECTRUM) + 1):
            if n > 1:
                value = value[:-1] | (part[n - 1 :] << np.uint32(8 * (n - 1)))
            if n in SPECTRUM and len(value):
                fits = row[: len(value)] == row[n - 1 :]
                bucket = ((value + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - 14)
                out[(row[: len(value)] + bucket)[fits]] = 1
    return out.reshape(-1, BUCKETS)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed bits, one row for each landmark
    weights: np.ndarray  # landmarks by languages

    def values(self, texts: np.ndarray) -> np.ndarray:
        """The ridge value of each language for each row of presences."""
        marks = self._unpacked()
        own, theirs = np.sqrt(np.maximum(texts.sum(axis=1), 1)), np.sqrt(np.maximum(marks.sum(axis=1), 1))
        return (texts @ marks.T) / own[:, None] / theirs @ self.weights

    def claims(self, texts: np.ndarray) -> np.ndarray:
        """How far the languages claim each row of presences: its best ridge value plus its kernel with the nearest landmark."""
        likeness = kernel(texts, self._unpacked())
        return (likeness @ self.weights).max(axis=1) + likeness.max(axis=1)

    def _unpacked(self) -> np.ndarray:
        if not hasattr(self, "_marks"):
            self._marks = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return self._marks


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of two sets of rows."""
    return (a @ b.T) / np.sqrt(np.maximum(a.sum(axis=1), 1))[:, None] / np.sqrt(np.maximum(b.sum(axis=1), 1))


def fit(languages: list[str], label: np.ndarray, rows: np.ndarray, marks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström features from the first rows of each language, and ridge weights for them; languages weigh the same."""
    chosen = np.sort(np.concatenate([np.flatnonzero(label == k)[:marks] for k in range(len(languages))]))
    landmarks = rows[chosen]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    x = kernel(rows, landmarks).astype(np.float64) @ root
    y = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(label, minlength=len(languages))[label] / len(languages)
    inner = (x * weight[:, None]).T @ x
    found = np.linalg.solve(inner + ridge * np.trace(inner) / len(inner) * np.eye(len(inner)), (x * weight[:, None]).T @ y)
    return Model(languages, np.packbits(landmarks.astype(np.uint8), axis=1), (root @ found).astype(np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model | None:
    """Learn from ``docs``: at most ``rows`` distinct texts of each language, which are all that reaches the driver.

    Rows without a text or a language teach nothing; copies of a text count once. None if nothing can be learnt.
    """
    known = docs.select(F.col(lang).alias("l"), F.col(text).alias("t")).where("l IS NOT NULL AND t IS NOT NULL AND t <> ''")
    distinct = known.select("l", F.xxhash64("t").alias("h")).groupBy("l", "h").agg(F.lit(1).alias("one"))
    # the first of each of many parts, then the first of those: a frequent language is ranked in as many tasks as a rare one
    parts = distinct.withColumn("p", F.pmod("h", F.lit(SALTS)))
    first = parts.withColumn("k", F.row_number().over(Window.partitionBy("l", "p").orderBy("h"))).where(F.col("k") <= rows)
    chosen = first.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("k") <= rows).select("l", "h")
    picked = known.withColumn("h", F.xxhash64("t")).join(F.broadcast(chosen), ["l", "h"]).select("l", "h", "t")  # `rows` of each language

    def bits(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                packed = np.packbits(presence(part.column(2)).astype(np.uint8), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([p.tobytes() for p in packed], pa.binary())], ["l", "h", "p"])

    found = picked.mapInArrow(arrow.lean(bits), "l string, h bigint, p binary").groupBy("l", "h").agg(F.min("p").alias("p")).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.l, r.h))
    languages = sorted({r.l for r in found})
    label = np.array([languages.index(r.l) for r in found])
    packed = np.frombuffer(b"".join(r.p for r in found), np.uint8).reshape(len(found), -1)
    return fit(languages, label, np.unpackbits(packed, axis=1).astype(np.float32))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1, the ridge value of that language) to every document.

    The whole text counts. ``und`` with score 0 if the text is null or has no letter, or if nothing was learnt. Equal values
    go to the language that sorts first. Columns of the same names are replaced, all others are kept, rows are neither merged
    nor dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks of fixed number and size for each language

    @F.arrow_udf("struct<lang: string, score: double>")
    def of(column: pa.Array) -> pa.Array:
        found, names, scores = shared.value, [], []
        for at in range(0, len(column), GROUP):
            part = column.slice(at, GROUP).fill_null("")
            letters = pc.fill_null(pc.match_substring_regex(part, r"\pL"), False).to_numpy(zero_copy_only=False)
            if found is None or not letters.any():
                names += ["und"] * len(part)
                scores += [0.0] * len(part)
                continue
            values = found.values(presence(part))
            best = values.argmax(axis=1)
            top = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
            names += [found.languages[b] if ok else "und" for b, ok in zip(best, letters)]
            scores += np.where(letters, top, 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return (
        docs.withColumn("_language", of(F.col(text)))
        .withColumn("lang_pred", F.col("_language.lang"))
        .withColumn("score", F.col("_language.score"))
        .drop("_language")
    )


def claim(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """Add a column with `Model.claims` of every document; null if the text is null or has no letter.

    The ridge values alone do not tell a foreign text: with a few languages the best one is at least about the values' mean,
    and a script that no landmark holds has values near 0. Such texts are like no landmark, though.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        def of(column: pa.Array) -> list[pa.Array]:
            out = []
            for at in range(0, len(column), GROUP):
                part = column.slice(at, GROUP).fill_null("")
                letters = pc.match_substring_regex(part, r"\pL").to_numpy(zero_copy_only=False)
                out += [float(c) if ok else None for c, ok in zip(shared.value.claims(presence(part)), letters)]
            return [pa.array(out, pa.float64())]

        return of

    return arrow.extended(docs, {name: T.DoubleType()}, begin, text)
