"""Logistic regressions over text, categories and numbers: many settings and folds in the same passes.

What is fitted before the classifier (vocabularies, inverse document frequencies, scales, levels) comes from counts by fold, once for all
settings: a fold's encoder is what all folds count together, less what it counts itself. An n-gram occurs no more often than each of its
words, so longer ones are counted among words that are frequent enough. Rows are stored once, as counts of
terms, codes and numbers. A pass reads them once and gives the loss and the gradient of every model: models of one
fold and n-gram length share a matrix of the text, and those with a smaller vocabulary use its first columns, as columns are
in the order of frequency. Gradients are a matrix product in each task and one sum by model after that; the steps
(limited-memory quasi-Newton with backtracking) are taken on the driver, on coefficients only. They start from curvatures that
models of one n-gram length share, which bring the passes from hundreds to some dozens and do not move the minimum.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.functions.encoders import INFREQUENT
from slipstream.models.features import tfidf_stages
from slipstream.session import staged

HELD = 8  # pairs of steps and gradient changes that a model keeps
ROUNDS = 300  # passes at most
SHRINK = 0.5  # of a step that does not lower the loss enough
CURVED = (0, 4, 16, 32, 64, 128, 256)  # passes before which curvatures are taken
KNOTS = 3  # sizes of the vocabulary with a curvature of their own, for each n-gram length
TILE = 512  # rows that are worked on at a time
BLOCK = 32  # models that are worked on at a time
PIECE = 1 << 19  # words that are counted at a time; a longer text is a piece by itself
FEW = 20_000  # words that are named to the tasks
_EVERY = -1  # the encoder that is fitted on all rows


@dataclass(frozen=True)
class Linear:
    """``strength``: inverse penalty on the squares of all coefficients but the intercept. ``fold``: rows of this fold are left out."""

    strength: float = 1.0
    max_features: int = 500
    ngrams: int = 1
    fold: int | None = None


@dataclass(frozen=True)
class Encoder:
    """What a fit learns before its classifier: for each n-gram length the terms by frequency and their weights, the scale of each
    number, the levels of each category."""

    terms: dict[int, list[str]]
    weights: dict[int, np.ndarray]
    means: np.ndarray
    deviations: np.ndarray
    levels: dict[str, list[str]]


@dataclass(frozen=True)
class Inputs:
    """The columns of a model. A level with less than its share of ``frequent`` rows is pooled with all others and unseen ones."""

    text: str | None
    numbers: Sequence[str]
    categories: Sequence[str]
    frequent: dict[str, float]
    most_levels: int = 1000

    def names(self, encoder: Encoder, settings: Linear) -> list[str]:
        terms = [f"tfidf_{t}" for t in encoder.terms.get(settings.ngrams, [])[: settings.max_features]]
        return [*terms, *self.numbers, *(f"{c}_{level}" for c in self.categories for level in [*encoder.levels[c], INFREQUENT]), "intercept"]


def _words(df: DataFrame, inputs: Inputs) -> DataFrame:
    """Add `__t_w1`: the words of the text, of which terms are made."""
    transformers = []
    for stage in tfidf_stages(inputs.text, "__t", max_ngram=2):
        transformers.append(stage)
        if stage.getOutputCol() == "__t_w1":
            break
    known = df.withColumn(inputs.text, F.coalesce(F.col(inputs.text), F.lit("")))
    return PipelineModel(transformers).transform(known)


def _pieces(batch: pa.RecordBatch, column: str):
    """Parts of a batch with a bounded number of words: (the part, the words in order, the row of each)."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        part = batch.slice(at, to - at)
        yield part, part.column(column).flatten(), np.repeat(np.arange(to - at), np.diff(ends[at:to], prepend=before))
        at = to


def _counted(words: DataFrame, folds: Sequence[int], first: int, longest: int, among: Sequence[str] | None) -> DataFrame:
    """(n, term, tf and df, and both by fold) of the n-grams of these lengths whose words are all ``among`` these, or of all."""
    slots, named = list(folds) or [0], None if among is None else pa.array(among, pa.string())
    columns = [f"{c}{f}" for c in ("tf", "df") for f in slots]

    def run(batches):
        for batch in batches:
            for part, flat, row in _pieces(batch, "__t_w1"):
                slot = np.searchsorted(slots, part.column("__fold").to_numpy(zero_copy_only=False))
                coded = flat.dictionary_encode()
                word, own = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.string())
                known = np.ones(len(own), bool) if named is None else pc.is_in(own, value_set=named).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(known[word]) if len(own) else np.zeros(0, np.int64)
                node, names = word[at], own
                for n in range(1, longest + 1):
                    if n > 1:
                        go = at < len(word) - n + 1
                        at, node = at[go], node[go]
                        last = word[at + n - 1]
                        go = (row[at] == row[at + n - 1]) & known[last]
                        at, node, last = at[go], node[go], last[go]
                        keys, node = np.unique(node * len(own) + last, return_inverse=True)
                        if not len(keys):
                            break
                        names = pc.binary_join_element_wise(names.take(pa.array(keys // len(own))), own.take(pa.array(keys % len(own))), " ")
                    if n >= first and len(names):
                        k, size = len(slots), len(names) * len(slots)
                        # each occurrence counts in tf and each text once in df, so the work follows the length of a text and not its square
                        tf = np.bincount(node * k + slot[row[at]], minlength=size).reshape(-1, k)
                        once, rows = np.divmod(np.unique(node * part.num_rows + row[at]), part.num_rows)
                        df = np.bincount(once * k + slot[rows], minlength=size).reshape(-1, k)
                        counts = [pa.array(np.ascontiguousarray(c[:, i])) for c in (tf, df) for i in range(k)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), n, np.int32)), names, *counts], ["n", "term", *columns])

    parts = words.select("__fold", "__t_w1").mapInArrow(run, ", ".join(["n int", "term string", *(f"{c} long" for c in columns)]))
    summed = parts.groupBy("n", "term").agg(*[F.sum(c).alias(c) for c in columns])
    every = [sum((F.col(f"{c}{f}") for f in slots), F.lit(0)).alias(c) for c in ("tf", "df")]
    return summed.select("*", *every)


def _most_frequent(counts: DataFrame, f: int, most: int) -> list[tuple[int, str, int]]:
    """(tf, term, df) outside the fold, the most frequent terms first."""
    tf, df = (F.col(c) if f == _EVERY else F.col(c) - F.col(f"{c}{f}") for c in ("tf", "df"))
    top = counts.select(tf.alias("t"), "term", df.alias("d")).where("t > 0").orderBy(F.desc("t"), "term").limit(most)
    return [(r["t"], r["term"], r["d"]) for r in top.collect()]


def _in_long_terms(counts: DataFrame, tops: dict[int, list], most: int) -> list[str] | None:
    """The words that n-grams among the most frequent terms are made of. None: they are too many to name.

    An n-gram occurs no more often than each of its words, so it is none of the most frequent terms if one of them occurs less
    often than the last of as many words.
    """
    enough = F.lit(False)
    for f, top in tops.items():
        tf = F.col("tf") if f == _EVERY else F.col("tf") - F.col(f"tf{f}")
        enough = enough | (tf >= (top[-1][0] if len(top) == most else 1))
    found = [r["term"] for r in counts.where(enough).select("term").limit(FEW + 1).collect()]
    return found if len(found) <= FEW else None


def fit_encoders(df: DataFrame, inputs: Inputs, longest: int, most: int, fold: str | None) -> dict[int, Encoder]:
    """The encoder of all rows, under -1, and that of the rows outside each fold."""
    rows = df.withColumn("__fold", F.lit(0) if fold is None else F.col(fold).cast("int"))
    numbers = [F.col(c).cast("double") for c in inputs.numbers]
    sums = [x.alias(f"s{i}") for i, x in enumerate(map(F.sum, numbers))] + [F.sum(x * x).alias(f"q{i}") for i, x in enumerate(numbers)]
    by_fold = {r["__fold"]: r for r in rows.groupBy("__fold").agg(F.count("*").alias("n"), *sums).collect()}  # a row for each fold
    folds = sorted(by_fold) if fold is not None else []
    every = [_EVERY, *folds]

    def outside(f: int, name: str) -> float:
        return sum(float(r[name] or 0) for k, r in by_fold.items() if k != f or f == _EVERY)

    levels: dict[int, dict[str, list[str]]] = {f: {} for f in every}
    for c in inputs.categories:
        counts = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("level")).agg(
            F.count("*").alias("n"), *[F.count(F.when(F.col("__fold") == f, 1)).alias(f"f{f}") for f in folds]
        )
        counts = staged(counts, "levels") if folds else counts
        for f in every:
            n = F.col("n") if f == _EVERY else F.col("n") - F.col(f"f{f}")
            least = max(1.0, inputs.frequent.get(c, 0.0) * outside(f, "n"))
            kept = counts.where(n >= least).orderBy(n.desc(), "level").limit(inputs.most_levels)
            levels[f][c] = sorted(r["level"] for r in kept.select("level").collect())
    terms: dict[int, dict[int, list[str]]] = {f: {} for f in every}
    weights: dict[int, dict[int, np.ndarray]] = {f: {} for f in every}
    if inputs.text is not None:
        words, tops = _words(rows, inputs), {f: [] for f in every}
        for k in range(1, longest + 1):
            if k == 1:
                own = counts = _counted(words, folds, 1, 1, None)
                own = counts = staged(counts, "terms") if folds or longest > 1 else counts
            elif most:
                if k == 2:
                    grams = staged(_counted(words, folds, 2, longest, _in_long_terms(counts, tops, most)), "terms")
                own = grams.where(F.col("n") == k)
            for f in every:
                tops[f] = sorted([*tops[f], *_most_frequent(own, f, most)], key=lambda r: (-r[0], r[1]))[:most]
                terms[f][k] = [r[1] for r in tops[f]]
                weights[f][k] = np.array([math.log((outside(f, "n") + 1) / (r[2] + 1)) + 1 for r in tops[f]])
    found = {}
    for f in every:
        n = max(outside(f, "n"), 1)
        means = np.array([outside(f, f"s{i}") / n for i in range(len(inputs.numbers))])
        squares = np.array([outside(f, f"q{i}") / n for i in range(len(inputs.numbers))])
        deviations = np.sqrt(np.clip(squares - means**2, 0, None))
        found[f] = Encoder(terms[f], weights[f], means, np.where(deviations > 1e-12 * np.maximum(1, np.abs(means)), deviations, 1.0), levels[f])
    return found


def _tree(terms: Sequence[str]) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """(the words of all terms, for each length the beginnings of terms: a key of the shorter beginning and the word, and the term or -1)."""
    split = [tuple(t.split(" ")) for t in terms]
    words = sorted({w for t in split for w in t})
    code, at = {w: i for i, w in enumerate(words)}, {t: i for i, t in enumerate(split)}
    node, tree = {(w,): i for i, w in enumerate(words)}, [(np.arange(len(words)), np.array([at.get((w,), -1) for w in words], np.int64))]
    for n in range(2, max(map(len, split), default=1) + 1):
        begun = sorted((node[t[: n - 1]] * len(words) + code[t[n - 1]], t[:n]) for t in {t[:n] for t in split if len(t) >= n})
        node = {t: i for i, (_, t) in enumerate(begun)}
        tree.append((np.array([key for key, _ in begun], np.int64), np.array([at.get(t, -1) for _, t in begun], np.int64)))
    return words, tree


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column of the bytes of ``data``, so many for each row."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of a binary column, how many each row has)."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].copy(), np.diff(ends)


class _Rows:
    """How rows are stored, and the matrices of an encoder over a batch of them."""

    def __init__(self, inputs: Inputs, encoders: dict[int, Encoder]):
        self.inputs, self.encoders = inputs, encoders
        self.terms = sorted({t for e in encoders.values() for own in e.terms.values() for t in own})
        self.levels = {c: sorted({lv for e in encoders.values() for lv in e.levels[c]}) for c in inputs.categories}
        self.at = {t: i for i, t in enumerate(self.terms)}
        self.words, self.tree = _tree(self.terms)
        self.places = {(f, k): self.ordered(own) for f, e in encoders.items() for k, own in e.terms.items()}
        self.codes = {}  # of each encoder's levels, by the place among all levels; the last one is for all others
        for f, e in encoders.items():
            for c in inputs.categories:
                own = {lv: i for i, lv in enumerate(e.levels[c])}
                self.codes[f, c] = np.array([own.get(lv, len(own)) for lv in [*self.levels[c], None]])

    def ordered(self, terms: Sequence[str]) -> np.ndarray:
        """The place of each of all terms among these; their number stands for none."""
        places = np.full(len(self.terms), len(terms))
        places[[self.at[t] for t in terms]] = np.arange(len(terms))
        return places

    def coded(self, df: DataFrame, longest: int, label: str | None, weight: str | None, fold: str | None, keep: Sequence[str] = ()) -> DataFrame:
        """(the kept columns as one, y, w, fold, ids, values): pairs of a term and how often it occurs, then the numbers and the levels' places."""
        words = df if self.inputs.text is None else _words(df, self.inputs)
        gram = F.array().cast("array<string>") if self.inputs.text is None else F.col("__t_w1")
        row = F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("__none"))
        y = F.lit(0.0) if label is None else F.col(label).cast("double")
        w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
        f = F.lit(_EVERY) if fold is None else F.col(fold).cast("int")
        numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.inputs.numbers]).cast("array<double>")
        places = [F.coalesce(F.array_position(F.lit(self.levels[c]) if self.levels[c] else F.array().cast("array<string>"), F.col(c).cast("string")), F.lit(0)) for c in self.inputs.categories]
        plain = words.select(row.alias("row"), y.alias("y"), w.alias("w"), f.alias("fold"), gram.alias("words"), numbers.alias("numbers"), F.array(*places).cast("array<int>").alias("places"))

        def run(batches):
            for batch in batches:
                for part, flat, row in _pieces(batch, "words"):
                    n = part.num_rows
                    numbers_, places_ = (part.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("numbers", "places"))
                    values = np.concatenate([numbers_, places_ - 1.0], axis=1)
                    ids, held = self._found(flat, row, n)
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in ("row", "y", "w", "fold")], _binary(ids, held * 8), _binary(values, np.full(n, 8 * values.shape[1]))],
                        ["row", "y", "w", "fold", "ids", "values"],
                    )

        kind = plain.schema["row"].dataType.simpleString()
        return plain.mapInArrow(run, f"row {kind}, y double, w double, fold int, ids binary, values binary")

    def _found(self, flat: pa.Array, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(pairs of a term and how often it occurs, row after row; the number of pairs of each row)."""
        rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if self.terms and len(flat):
            code = pc.fill_null(pc.index_in(flat, value_set=pa.array(self.words, flat.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.flatnonzero(code >= 0)
            node = code[at]
            for k, (keys, term) in enumerate(self.tree):
                if k:
                    go = at < len(code) - k
                    at, node = at[go], node[go]
                    last = code[at + k]
                    go = (row[at] == row[at + k]) & (last >= 0)
                    at, key = at[go], node[go] * len(self.words) + last[go]
                    node = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    go = keys[node] == key
                    at, node = at[go], node[go]
                own = term[node]
                rows.append(row[at][own >= 0])
                terms.append(own[own >= 0])
        size = max(len(self.terms), 1)
        pairs, times = np.unique(np.concatenate(rows) * size + np.concatenate(terms), return_counts=True)
        return np.stack([pairs % size, times], axis=1).astype(np.int32), np.bincount(pairs // size, minlength=n)

    def tiles(self, batches):
        """Parts of the stored batches, each with its matrices."""
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                yield part, *self.read(part)

    def read(self, batch: pa.RecordBatch):
        """(y, w, fold, the row, the term and the number of each count, the numbers and the levels' places)."""
        y, w, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "fold"))
        ids, held = _bytes(batch.column("ids"))
        pairs = ids.view(np.int32).reshape(-1, 2)
        counts = np.repeat(np.arange(len(y)), held // 8), pairs[:, 0], pairs[:, 1]
        return y, w, fold, counts, _bytes(batch.column("values"))[0].view(np.float64).reshape(len(y), -1)

    def dense(self, values: np.ndarray, f: int) -> np.ndarray:
        """Scaled numbers, a column for each level and one for all others, and ones."""
        e, n = self.encoders[f], len(self.inputs.numbers)
        parts = [(values[:, :n] - e.means) / e.deviations]
        for i, c in enumerate(self.inputs.categories):
            code = self.codes[f, c][values[:, n + i].astype(np.int64)]  # -1, no known level, is the last
            hot = np.zeros((len(values), len(e.levels[c]) + 1))
            hot[np.arange(len(values)), code] = 1.0
            parts.append(hot)
        return np.concatenate([*parts, np.ones((len(values), 1))], axis=1)


def _encoder_of(s: Linear) -> int:
    return _EVERY if s.fold is None else s.fold


class _Models:
    """Models whose losses and gradients are computed together. A model's coefficients: its terms by frequency, then the dense columns."""

    def __init__(self, rows: _Rows, settings: Sequence[Linear]):
        self.rows, self.settings = rows, list(settings)
        self.groups: dict[tuple[int, int], list[int]] = {}
        self.vocabulary, self.wide, self._orders = [], [], {}
        for m, s in enumerate(self.settings):
            f = _encoder_of(s)
            self.groups.setdefault((f, s.ngrams), []).append(m)
            self.vocabulary.append(min(s.max_features, len(rows.encoders[f].terms.get(s.ngrams, []))))
            self.wide.append(self._dense_size(f))
        for own in self.groups.values():
            own.sort(key=lambda m: self.vocabulary[m])

    def blocks(self, coefficients: dict[int, np.ndarray]) -> list[tuple[int, int, np.ndarray, list]]:
        """For each group (its fold, its n-gram length, its vocabularies' sizes, its models in blocks of like sizes, with their coefficients)."""
        out = []
        for (f, k), every in sorted(self.groups.items()):
            models, parts = [m for m in every if m in coefficients], []
            sizes = np.unique([self.vocabulary[m] for m in models])
            for i in range(0, len(models), BLOCK):
                own = models[i : i + BLOCK]
                cap = np.array([self.vocabulary[m] for m in own])
                text = np.zeros((cap.max(), len(own)))
                for j, m in enumerate(own):
                    text[: cap[j], j] = coefficients[m][: cap[j]]
                parts.append((own, cap, text, np.stack([coefficients[m][c:] for m, c in zip(own, cap)], axis=1)))
            if parts:
                out.append((f, k, sizes, parts))
        return out

    def margins(self, counts, values, blocks, rows):
        """For each block (its fold and n-gram length, its models, the rows that ``rows`` gives for the fold, their parts, the margins)."""
        last = None
        for f, k, sizes, parts in blocks:
            if f != last:
                last, at = f, rows(f)
                new = np.full(len(values), -1)
                new[at] = np.arange(len(at))
                row = new[counts[0]]
                own_counts = tuple(c[row >= 0] for c in (row, *counts[1:]))
                dense = self.rows.dense(values[at], f)
            if not len(at):
                continue
            x, lengths = _text(own_counts, len(at), self.rows.places[f, k], self.rows.encoders[f].weights[k], sizes) if self.rows.terms else _no_text(len(at), sizes)
            for own, cap, text, others in parts:
                scale = lengths[:, np.searchsorted(sizes, cap)]
                z = x[:, : len(text)] @ text
                z /= scale
                z += dense @ others
                yield f, k, own, cap, at, x[:, : len(text)], scale, dense, z

    def losses(self, stored: DataFrame, points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        """The penalised loss and its gradient at one point for each model: one pass."""

        def run(batches, points):
            part, blocks = TaskContext.get().partitionId(), self.blocks(points)
            loss, slope, sums = dict.fromkeys(points, 0.0), {m: np.zeros_like(p) for m, p in points.items()}, {}
            for _, y, w, fold, counts, values in self.rows.tiles(batches):
                for f, _, own, cap, at, x, scale, dense, z in self.margins(counts, values, blocks, lambda f: np.flatnonzero((fold != f) | (f == _EVERY))):
                    held, known = w[at], y[at][:, None]
                    e = np.exp(-np.abs(z))
                    total = held @ (np.log1p(e) + np.maximum(z, 0) - known * z)
                    rest = (np.where(z >= 0, 1.0, e) / (1 + e) - known) * held[:, None]
                    found = [total, dense.T @ rest, x.T @ (rest / scale)]
                    sums[own[0]] = [a + b for a, b in zip(sums[own[0]], found)] if own[0] in sums else found
            for *_, parts in blocks:
                for own, cap, *_ in parts:
                    if own[0] in sums:
                        total, others, text = sums[own[0]]
                        for j, m in enumerate(own):
                            loss[m], slope[m] = float(total[j]), np.concatenate([text[: cap[j], j], others[:, j]])
            yield _sums(part, loss, slope)

        found = _summed(stored, run, points)
        out = {}
        for m, (loss, slope) in found.items():
            s, at = self.settings[m], points[m].copy()
            at[-1] = 0.0  # the intercept has no penalty
            out[m] = (s.strength * loss + 0.5 * float(at @ at), s.strength * slope + at)
        return out

    def hits(self, stored: DataFrame, points: dict[int, np.ndarray], cut: float = 0.5) -> dict[int, np.ndarray]:
        """(true positives, false positives, false negatives) of each model on the rows of its fold."""

        def run(batches, points):
            part, blocks = TaskContext.get().partitionId(), self.blocks(points)
            none, found = dict.fromkeys(points, 0.0), {m: np.zeros(3) for m in points}
            for _, y, _, fold, counts, values in self.rows.tiles(batches):
                for _, _, own, _, at, *_, z in self.margins(counts, values, blocks, lambda f: np.flatnonzero(fold == f)):
                    true = (y[at] > 0.5)[:, None]
                    said = 1 / (1 + np.exp(-np.clip(z, -500, 500))) >= cut
                    for m, *three in zip(own, (true & said).sum(axis=0), (~true & said).sum(axis=0), (true & ~said).sum(axis=0)):
                        found[m] += three
            yield _sums(part, none, found)

        return {m: v for m, (_, v) in _summed(stored, run, points).items()}

    def shapes(self, stored: DataFrame, points: dict[int, np.ndarray], live: Sequence[int]) -> dict[int, _Shape]:
        """About the inverse curvature of each live model, from one pass: products of the columns, encoded for all rows, for some sizes
        of the vocabulary, with the weights of rows that the models at their points have on average."""
        wide, places, knots = self.rows.encoders[_EVERY], {m: self._places(m) for m in live}, {}
        for k in sorted({self.settings[m].ngrams for m in live}):
            own = sorted((m for m in live if self.settings[m].ngrams == k), key=lambda m: self.vocabulary[m])
            for part in np.array_split(own, min(KNOTS, len(own))):  # the columns and the size that the models of a part share
                cap = min(self.vocabulary[part[-1]], len(wide.terms.get(k, [])))
                knots[k, len(knots)] = (cap, 1 + max((int(places[m][0].max(initial=-1)) for m in part), default=-1), part)
        columns = {k: self._shared(k) for k, _ in knots}

        def run(batches, points):
            part, blocks, sums = TaskContext.get().partitionId(), self.blocks(points), {}
            for _, y, w, fold, counts, values in self.rows.tiles(batches):
                spread, n = {k: np.zeros(len(y)) for k in columns}, {k: np.zeros(len(y)) for k in columns}
                for _, k, own, _, at, *_, z in self.margins(counts, values, blocks, lambda f: np.flatnonzero((fold != f) | (f == _EVERY))):
                    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    spread[k][at] += (p * (1 - p)).sum(axis=1)
                    n[k][at] += len(own)
                dense = self.rows.dense(values, _EVERY)
                for k, (_, places, weights) in columns.items():
                    root = np.sqrt(np.maximum(w, 0) * np.where(n[k] > 0, spread[k] / np.maximum(n[k], 1), 0.25))[:, None]
                    for (of, i), (cap, size, _) in knots.items():
                        if of == k:
                            sizes = np.unique([cap, size])
                            x, lengths = _text(counts, len(y), places, weights, sizes) if self.rows.terms else _no_text(len(y), sizes)
                            a = np.concatenate([x[:, :size] / lengths[:, np.searchsorted(sizes, [cap])], dense], axis=1)
                            a = (a * root).astype(np.float32)
                            sums[i] = sums.get(i, 0) + a.T @ a
            found = {i: g[np.triu_indices(len(g))] for i, g in sums.items()}  # in half the digits: they only guide steps
            yield _sums(part, dict.fromkeys(found, 0.0), found)

        found = _summed(stored, run, points, np.float32)
        others, out = self._dense_size(_EVERY), {}
        for (k, i), (_, size, part) in knots.items():
            products = np.zeros((size + others, size + others))
            if i in found:
                products[np.triu_indices(size + others)] = found.pop(i)[1]
            for cap in sorted({self.vocabulary[m] for m in part}):
                own = [m for m in part if self.vocabulary[m] == cap]
                kept = np.concatenate([np.unique(np.concatenate([places[m][0] for m in own])), np.arange(size, size + others)])
                values, vectors = np.linalg.eigh(products[np.ix_(kept, kept)], "U")
                values, half, usual = np.clip(values, 0, None), vectors.astype(np.float32), float(np.median(np.diag(products)[kept]))
                columns = {}
                for m in own:
                    f, (text, dense) = _encoder_of(self.settings[m]), places[m]
                    if f not in columns:
                        columns[f] = _Columns.of(np.concatenate([np.searchsorted(kept, text), np.where(dense < 0, -1, len(kept) - others + dense)]), len(kept))
                    out[m] = _Shape.of(self.settings[m].strength, values, vectors, half, columns[f], usual)
        return out

    def _dense_size(self, f: int) -> int:
        e = self.rows.encoders[f]
        return len(e.means) + sum(len(lv) + 1 for lv in e.levels.values()) + 1

    def _shared(self, k: int) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """The terms of all encoders in one order, those of the encoder of all rows first: (their places by term, the places of all terms, their weights)."""
        if k not in self._orders:
            weight = {}
            for e in [self.rows.encoders[_EVERY], *self.rows.encoders.values()]:
                for t, v in zip(e.terms.get(k, []), e.weights.get(k, [])):
                    weight.setdefault(t, v)
            self._orders[k] = {t: i for i, t in enumerate(weight)}, self.rows.ordered(list(weight)), np.array(list(weight.values()))
        return self._orders[k]

    def _places(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(the place of each term of a model in the shared order, the place of its other columns in the encoder of all rows or -1)."""
        f, k = _encoder_of(self.settings[m]), self.settings[m].ngrams
        own, every, place = self.rows.encoders[f], self.rows.encoders[_EVERY], self._shared(k)[0]
        dense, end = list(range(len(every.means))), len(every.means)
        for name, levels in every.levels.items():
            at = {lv: end + i for i, lv in enumerate(levels)}
            dense += [at.get(lv, -1) for lv in own.levels[name]] + [end + len(levels)]
            end += len(levels) + 1
        return np.array([place[t] for t in own.terms.get(k, [])[: self.vocabulary[m]]], np.int64), np.array([*dense, end])


def _text(counts: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, places: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weighted counts by the places of the terms, the length of each row for each size of the vocabulary, 1 if it has no terms)."""
    row, term, times = counts
    place = places[term]
    known = place < min(sizes[-1], len(weights))
    row, place = row[known], place[known]
    value = times[known] * weights[place]
    x = np.zeros((n, sizes[-1]))
    x.reshape(-1)[row * sizes[-1] + place] = value
    part = np.searchsorted(sizes, np.arange(sizes[-1]), "right")
    squares = np.bincount(row * len(sizes) + part[place], value * value, n * len(sizes)).reshape(n, -1)
    lengths = np.sqrt(np.cumsum(squares, axis=1))
    lengths[lengths == 0] = 1.0
    return x, lengths


def _no_text(n: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((n, 0)), np.ones((n, len(sizes)))


@dataclass(frozen=True)
class _Columns:
    """Which coefficients of a model have a column in a matrix, these columns, and the columns that the model lacks."""

    known: np.ndarray
    places: np.ndarray
    lacking: np.ndarray

    @staticmethod
    def of(at: np.ndarray, size: int) -> _Columns:
        known = np.flatnonzero(at >= 0)
        return _Columns(known.astype(np.int32), at[known].astype(np.int32), np.setdiff1d(np.arange(size), at).astype(np.int32))


@dataclass(frozen=True)
class _Shape:
    """The inverse of the penalty plus the strength times the products of a model's columns, as a function of a gradient.

    Models of one vocabulary share the vectors of one matrix over the columns that any of them has; what a model lacks of these is
    taken out of the inverse. In half the digits, as it only guides steps."""

    shares: np.ndarray
    vectors: np.ndarray
    columns: _Columns
    lacking: np.ndarray
    usual: float

    @staticmethod
    def of(strength: float, values: np.ndarray, vectors: np.ndarray, half: np.ndarray, columns: _Columns, usual: float) -> _Shape:
        """A coefficient without a column has a ``usual`` curvature."""
        shares, rows = 1 / (1 + strength * values), vectors[columns.lacking]
        return _Shape(shares.astype(np.float32), half, columns, np.linalg.inv((rows * shares) @ rows.T).astype(np.float32), 1 / (1 + strength * usual))

    def _whole(self, own: np.ndarray) -> np.ndarray:
        return self.vectors @ ((own @ self.vectors) * self.shares)

    def __call__(self, slope: np.ndarray) -> np.ndarray:
        largest = np.abs(slope).max(initial=0.0) or 1.0
        own = np.zeros(len(self.shares), np.float32)
        own[self.columns.places] = slope[self.columns.known] / largest
        whole = self._whole(own)
        if len(self.lacking):
            own[self.columns.lacking] = -(self.lacking @ whole[self.columns.lacking])
            whole = self._whole(own)
        out = slope * self.usual
        out[self.columns.known] = largest * whole[self.columns.places].astype(np.float64)
        return out


_SUMS = "part int, model int, loss double, slope binary"


def _sums(part: int, loss: dict[int, float], slope: dict[int, np.ndarray]) -> pa.RecordBatch:
    models = list(loss)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(models), pa.int32()), pa.array(models, pa.int32()), pa.array([loss[m] for m in models], pa.float64()), pa.array([slope[m].tobytes() for m in models], pa.binary())],
        ["part", "model", "loss", "slope"],
    )


def _summed(stored: DataFrame, run: Callable, points: dict[int, np.ndarray], kind: type = np.float64) -> dict[int, tuple[float, np.ndarray]]:
    """The sums of one pass. The points go to each executor once, and nothing of them stays in the JVMs when the pass has ended."""
    sent = stored.sparkSession.sparkContext.broadcast(points)
    try:
        return _added(stored.select("y", "w", "fold", "ids", "values").mapInArrow(lambda batches: run(batches, sent.value), _SUMS), kind)
    finally:
        sent.destroy()


def _added(parts: DataFrame, kind: type = np.float64) -> dict[int, tuple[float, np.ndarray]]:
    """The tasks' sums by model, in the order of the tasks, so that they do not depend on what ends first."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for m, loss, slope in zip(*(batch.column(c).to_pylist() for c in ("model", "loss", "slope"))):
                own = held.setdefault(m, [0.0, 0.0])
                own[0] += loss
                own[1] = own[1] + np.frombuffer(slope, kind)
        yield _sums(0, {m: v[0] for m, v in held.items()}, {m: v[1] for m, v in held.items()})

    summed = parts.repartition("model").sortWithinPartitions("model", "part").mapInArrow(run, _SUMS)
    return {r["model"]: (r["loss"], np.frombuffer(bytes(r["slope"]), kind).copy()) for r in summed.collect()}  # a row for each model


class _Descent:
    """One model's way to its minimum."""

    def __init__(self, size: int, tolerance: float, gain: float):
        self.at, self.tolerance, self.gain = np.zeros(size), tolerance, gain
        self.loss, self.slope = math.inf, None
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []
        self.direction, self.length, self.trial, self.done = None, 1.0, self.at, False
        self.shape = None

    def bend(self, shape: _Shape) -> None:
        """Take steps by this curvature from now on."""
        self.shape = shape
        if self.slope is not None and not self.done:
            self._turn()

    def take(self, loss: float, slope: np.ndarray) -> None:
        """Take in the loss at the trial point and set the next one."""
        if self.slope is not None:
            # the last digits of a sum are no rise
            if not loss <= self.loss + 1e-4 * self.length * float(self.direction @ self.slope) + 1e-12 * abs(self.loss):
                self.length *= SHRINK
                if self.length < 1e-10:
                    return self._end()
                self.trial = self.at + self.length * self.direction
                return
            s, y = self.trial - self.at, slope - self.slope
            if float(s @ y) > 1e-12:
                self.steps = [*self.steps, (s.astype(np.float32), y.astype(np.float32))][-HELD:]  # they only guide steps, too
        small = self.loss - loss <= self.gain * max(1.0, abs(loss))
        self.at, self.loss, self.slope = self.trial, loss, slope
        if np.abs(slope).max(initial=0.0) <= self.tolerance or small and len(self.steps):
            return self._end()
        self._turn()

    def _end(self) -> None:
        """Only the minimum is kept."""
        self.done, self.steps, self.slope, self.direction, self.trial, self.shape = True, [], None, None, None, None

    def _turn(self) -> None:
        """The next direction and the first point to try on it."""
        self.direction, self.length = self._newton(), 1.0
        if float(self.direction @ self.slope) >= 0:
            self.direction, self.steps, self.shape = -self.slope, [], None
        if not self.steps and self.shape is None:
            self.length = min(1.0, 1.0 / max(np.abs(self.slope).sum(), 1e-12))
        self.trial = self.at + self.length * self.direction

    def _newton(self) -> np.ndarray:
        q, used = self.slope.copy(), []
        for s, y in reversed(self.steps):
            a = float(s @ q) / float(y @ s)
            used.append(a)
            q -= a * y
        bent = (lambda v: v) if self.shape is None else self.shape
        q = bent(q)
        if self.steps:
            s, y = self.steps[-1]
            q *= float(s @ y) / float(y @ bent(y))
        for (s, y), a in zip(self.steps, reversed(used)):
            q += s * (a - float(y @ q) / float(y @ s))
        return -q


@dataclass(frozen=True)
class LinearModel:
    """A fitted regression with its encoder."""

    inputs: Inputs
    settings: Linear
    encoder: Encoder
    coefficients: np.ndarray
    loss: float

    @property
    def names(self) -> list[str]:
        return self.inputs.names(self.encoder, self.settings)

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Probability of the label 1 for each row."""
        rows = _Rows(self.inputs, {_EVERY: self.encoder})
        models = _Models(rows, [replace(self.settings, fold=None)])
        point = {0: self.coefficients}
        kept = [c for c in df.columns if c != out]
        stored = rows.coded(df, self.settings.ngrams, None, None, None, kept)

        def run(batches):
            blocks = models.blocks(point)
            for part, y, _, _, counts, values in rows.tiles(batches):
                z = next(models.margins(counts, values, blocks, lambda _: np.arange(len(y))))[-1][:, 0]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], ["row", "p"])

        found = stored.mapInArrow(run, f"row {stored.schema['row'].dataType.simpleString()}, p double")
        return found.select(*[F.col(f"row.`{c}`") for c in kept], F.col("p").alias(out))

    def importance(self, df: DataFrame) -> DataFrame:
        """The coefficient of each feature."""
        rows = [(n, float(c)) for n, c in zip(self.names, self.coefficients) if n != "intercept"]
        return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")

    def size(self) -> dict[str, int]:
        return {"parameters": len(self.coefficients)}


def fit_many(df: DataFrame, settings: Sequence[Linear], inputs: Inputs, label: str = "label", weight: str | None = None, fold: str | None = None, tolerance: float = 1e-3) -> list[LinearModel]:
    """A model for each of the settings. ``tolerance``: the largest entry of the gradient at which a fit ends, for each unit of weight
    and strength."""
    return _fitted(df, settings, inputs, label, weight, fold, tolerance)[0]


def _fitted(df, settings, inputs, label, weight, fold, tolerance):
    longest, most = max(s.ngrams for s in settings), max(s.max_features for s in settings)
    encoders = fit_encoders(df, inputs, longest, most, fold)
    rows = _Rows(inputs, encoders)
    stored = staged(rows.coded(df, longest, label, weight, fold), "coded-rows")
    models = _Models(rows, settings)
    total = stored.agg(F.sum("w")).head()[0] or 1.0
    ways = {m: _Descent(models.vocabulary[m] + models.wide[m], tolerance * max(1.0, s.strength * total / 1000), 1e-4 * tolerance) for m, s in enumerate(settings)}
    for n in range(ROUNDS):
        live = {m: d.trial for m, d in ways.items() if not d.done}
        if not live:
            break
        if n in CURVED:
            for d in ways.values():
                d.shape = None  # two sets of matrices would not be held at a time
            for m, shape in models.shapes(stored, {m: ways[m].at for m in live} if n else {}, list(live)).items():
                ways[m].bend(shape)
            live = {m: ways[m].trial for m in live}
        found = models.losses(stored, live)
        for m in live:
            ways[m].take(*found.get(m, (0.0, live[m] * 0)))
    out = [LinearModel(inputs, s, encoders[_encoder_of(s)], ways[m].at, ways[m].loss) for m, s in enumerate(settings)]
    return out, models, stored


def search(df: DataFrame, drawn: Sequence[Linear], inputs: Inputs, fold: str = "fold", folds: int = 5, label: str = "label", weight: str | None = None) -> tuple[Linear, DataFrame, list[LinearModel]]:
    """Cross-validate drawn settings by F1 of the positive class: the best ones, the table of all, and the best ones' models by fold."""
    every = [replace(s, fold=f) for s in drawn for f in range(folds)]
    fitted, models, stored = _fitted(df, every, inputs, label, weight, fold, 1e-3)
    hits = models.hits(stored, {m: model.coefficients for m, model in enumerate(fitted)})
    rows = []
    for c, s in enumerate(drawn):
        f1 = []
        for k in range(folds):
            tp, fp, fn = hits.get(c * folds + k, np.zeros(3))
            f1.append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
        rows.append((c, "; ".join(f"{k}={v}" for k, v in sorted(asdict(s).items()) if k != "fold"), float(np.mean(f1)), float(np.std(f1))))
    table = df.sparkSession.createDataFrame(rows, "config int, params string, mean_test_score double, std_test_score double")
    best = max(range(len(drawn)), key=lambda c: (rows[c][2], -c))
    ranked = table.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc("mean_test_score"))))  # one row per configuration
    return drawn[best], ranked, fitted[best * folds : (best + 1) * folds]
