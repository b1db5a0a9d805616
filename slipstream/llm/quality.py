"""Quality scores: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is the bag of its hashed n-grams: one and two words (runs of letters and digits, or of other signs, lower-cased), and
one to three word shapes (case, length class, digits, the sign, whether a word repeats the one before). Each kind of n-gram
weighs the same in a text of any length. A score is the sparse dot product of the bag with one broadcast weight vector of
fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import arrow

BITS = 18  # log2 of the number of weights
TRAIN_ROWS = 8_192  # labelled rows that training takes at most, by the hash of their id
SHARD_ROWS = 2_048  # rows of one learner; the learners' weights are averaged
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-6
SCALE = 4.0  # of the bag, so that steps of this size suit it

_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters and digits, 2 other signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def grams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram (weight number, row) of all n-grams of the rows."""
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if len(data):
        edge[1:-1] |= kind[1:] != kind[:-1]
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    real = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    row = np.searchsorted(offsets, starts, side="right") - 1
    small = arrow.fold_ascii(data)
    word = arrow.spans_hash(small, starts, ends)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends] - total[starts]

    size, upper, digits = ends - starts, count((data >= 65) & (data <= 90)), count((data >= 48) & (data <= 57))
    upper_first = (data[starts] >= 65) & (data[starts] <= 90)
    length = np.searchsorted([1, 2, 4, 8, 12, 20, 40], size).astype(np.uint64)
    case = np.where(upper == 0, 0, np.where(upper == size, 3, np.where(upper_first & (upper == 1), 1, 2)))
    is_word = kind[starts] == 1 if len(starts) else real
    last = np.where(is_word, np.arange(len(word)), -1)  # the word before, other signs skipped
    last = np.concatenate([[-1], np.maximum.accumulate(last)[:-1]]) if len(word) else last
    repeats = is_word & (last >= 0) & (word == word[last]) & (row == row[last])
    shape = (length * np.uint64(4) + case.astype(np.uint64)) * np.uint64(4) + (digits > 0) + np.uint64(2) * repeats
    shape = np.where(is_word, shape, data[starts].astype(np.uint64) * np.uint64(8) + np.minimum(size, 7).astype(np.uint64) + np.uint64(1 << 20))
    shape = arrow.mix(shape + np.uint64(1))
    shift = np.uint64(64 - bits)
    for salt, (units, n) in enumerate([(word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3)]):
        h = arrow.windows(units, n)
        fits = row[: len(h)] == row[n - 1 :] if len(h) else np.zeros(0, bool)
        yield (arrow.mix(h[fits] ^ np.uint64(0x1000003D * (salt + 1))) >> shift).astype(np.int64), row[: len(h)][fits]


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The probability of a good text for each row."""
    rows = len(offsets) - 1
    total = np.full(rows, bias)
    for index, row in grams(data, offsets, int(len(weights)).bit_length() - 1):
        sums, n = np.bincount(row, weights[index], rows), np.bincount(row, minlength=rows)
        total += SCALE * sums / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def bags(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weight numbers, values) of each row."""
    rows = len(offsets) - 1
    keys, values = [], []
    for index, row in grams(data, offsets):
        key, n = np.unique((row.astype(np.int64) << BITS) | index, return_counts=True)
        of = key >> BITS
        keys.append(key)
        values.append(SCALE * n / np.maximum(np.bincount(row, minlength=rows), 1)[of])
    key, value = np.concatenate(keys), np.concatenate(values)
    key, back = np.unique(key, return_inverse=True)
    value = np.bincount(back, value, len(key)).astype(np.float32)
    cut = np.searchsorted(key >> BITS, np.arange(rows + 1))
    index = (key & ((1 << BITS) - 1)).astype(np.int32)
    return [(index[a:b], value[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def learn(rows: list[tuple[float, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of one learner; every row updates the weights that it touches."""
    size = (1 << BITS) + 1  # the last one is the bias
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    order = np.random.default_rng(3)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            label, index, value = rows[k]
            at, x = np.append(index, size - 1), np.append(value, 1.0)
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
            p = 1 / (1 + np.exp(-np.clip(wi @ x, -35, 35)))
            g = (p - label) * x
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * wi
            n[at] = grown
    w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    return w[:-1].astype(np.float32), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias from at most ``rows`` rows of ``labels`` (doc_id, label), the texts taken from ``docs`` (doc_id, text).

    Several labels of one id count by their mean. Learners on several executors see ``SHARD_ROWS`` rows each; their weights
    are averaged. Without labels every weight is zero.
    """
    chosen = (
        labels.where("label IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # at most `rows` ids, hence the broadcast
    rows_in = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def featurise(batches):
        for batch in batches:
            data, offsets = arrow.flat(batch.column(2))
            for i, j in arrow.pieces(offsets):
                found = bags(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                arrays = [batch.column(0)[i:j], batch.column(1)[i:j], [a.tobytes() for a, _ in found], [v.tobytes() for _, v in found]]
                yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, pa.binary()) for a in arrays], ["doc_id", "label", "i", "v"])

    def fit(batches):
        seen = []
        for batch in batches:
            seen += [(r["doc_id"], r["label"], np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32)) for r in batch.to_pylist()]
        if seen:
            seen.sort(key=lambda r: (r[0], r[2].tobytes()))  # the same order however the rows came
            w, bias = learn([r[1:] for r in seen])
            yield pa.RecordBatch.from_arrays([pa.array([len(seen)]), pa.array([w.tobytes()], pa.binary()), pa.array([bias])], ["n", "w", "b"])

    count = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").limit(rows).count()
    shards = max(1, -(-count // SHARD_ROWS))
    kind = docs.schema["doc_id"].dataType.simpleString()
    learnt = (
        rows_in.mapInArrow(arrow.lean(featurise), f"doc_id {kind}, label double, i binary, v binary")
        .repartition(shards, F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
        .mapInArrow(arrow.lean(fit), "n bigint, w binary, b double")
        .collect()  # one weight vector of fixed size from each learner
    )
    if not learnt:
        return np.zeros(1 << BITS, np.float32), 0.0
    share = np.array([r.n for r in learnt]) / sum(r.n for r in learnt)
    weights = sum(s * np.frombuffer(r.w, np.float32) for s, r in zip(share, learnt))
    return weights.astype(np.float32), float(sum(s * r.b for s, r in zip(share, learnt)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 where the score is at least ``threshold``) to every document.

    The whole text counts; a null text scores as an empty one, which has no n-grams and so the score of the bias. Columns of
    the same names are replaced, all others are kept, rows are neither merged nor dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        weights, bias = shared.value
        data, offsets = arrow.flat(column)
        out = [scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], weights, bias) for i, j in arrow.pieces(offsets)]
        return pa.array(np.concatenate([np.zeros(0), *out]), pa.float64())

    return docs.withColumn("score", of(F.coalesce(F.col(text), F.lit("")))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
