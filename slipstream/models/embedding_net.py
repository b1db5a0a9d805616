"""Entity-embedding networks, trained side by side on the partitions of a table.

Numbers are scaled and every category has a vector of its own, learnt with the network; unseen levels share one. In an epoch each
task takes the current weights through mini-batches of its own rows and returns where they ended; the next epoch begins at
their mean, weighted by rows (weights and the optimizer's moments alike). Several settings and folds are trained in the same passes, so the
number of passes follows that of epochs. Loss is weighted by class; boosting the smaller class, dropout, a penalty on
squares, a step that is halved on plateaus and stopping with patience are part of the settings.

The mean over partitions is not the path a single machine takes: results depend on how rows are stored, and are the same for one
stored table and seed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.models.penalty_path import Inputs, _added, _encoder_of, _Rows, _sums, _SUMS, fit_encoders
from slipstream.session import staged

WIDEST = 50  # entries of a category's vector: half the levels, and no more than this
LEAK = 0.01  # slope of the units below 0
_EPSILON = 1e-8


@dataclass(frozen=True)
class Network:
    """``patience``: epochs without a smaller loss on the held rows (those of ``fold``, or those marked) after which training ends;
    the weights of the best one are kept. ``plateau``: epochs without a smaller loss after which the step is halved."""

    hidden: tuple[int, ...] = (64, 32)
    step: float = 1e-3
    optimizer: str = "adam"
    batch: int = 64
    dropout: float = 0.2
    l2: float = 1e-4
    epochs: int = 50
    patience: int = 5
    plateau: int | None = None
    fold: int | None = None
    seed: int = 42


class Shape:
    """Where each matrix lies in the flat weights of a network."""

    def __init__(self, numbers: int, levels: Sequence[int], hidden: Sequence[int]):
        self.numbers, self.levels = numbers, list(levels)
        self.widths = [min(WIDEST, (n + 1) // 2) for n in levels]
        sizes = [numbers + sum(self.widths), *hidden, 1]
        self.parts = [(n, w) for n, w in zip(levels, self.widths)]
        for a, b in zip(sizes, sizes[1:]):
            self.parts += [(a, b), (b,)]
        self.size = sum(math.prod(p) for p in self.parts)

    def views(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for p in self.parts:
            out.append(flat[at : at + math.prod(p)].reshape(p))
            at += math.prod(p)
        return out

    def begin(self, rng: np.random.Generator) -> np.ndarray:
        flat = np.zeros(self.size)
        for k, view in enumerate(self.views(flat)):
            if k < len(self.levels):
                view[:] = rng.standard_normal(view.shape)
            elif view.ndim == 2:
                view[:] = rng.standard_normal(view.shape) * math.sqrt(2 / ((1 + LEAK**2) * max(1, len(view))))
        return flat

    def forward(self, flat: np.ndarray, numbers: np.ndarray, codes: np.ndarray, drop: float = 0.0, rng=None):
        """(margins, what the way back needs)."""
        views, n = self.views(flat), len(self.levels)
        x = np.concatenate([numbers, *(views[i][codes[:, i]] for i in range(n))], axis=1)
        layers, kept = views[n:], []
        for k in range(0, len(layers) - 2, 2):
            z = x @ layers[k] + layers[k + 1]
            mask = np.where(z > 0, 1.0, LEAK)
            if drop:
                mask = mask * (rng.random(z.shape) >= drop) / (1 - drop)
            kept.append((x, mask))
            x = z * mask
        kept.append((x, None))
        return (x @ layers[-2] + layers[-1])[:, 0], kept

    def backward(self, flat: np.ndarray, codes: np.ndarray, kept: list, rest: np.ndarray) -> np.ndarray:
        """The gradient of the summed loss, from its slope along each margin."""
        slope = np.zeros_like(flat)
        views, out, n = self.views(flat), self.views(slope), len(self.levels)
        back = rest[:, None]
        for k in range(len(kept) - 1, -1, -1):
            x, mask = kept[k]
            if mask is not None:
                back = back * mask
            out[n + 2 * k][:], out[n + 2 * k + 1][:] = x.T @ back, back.sum(axis=0)
            back = back @ views[n + 2 * k].T
        at = self.numbers
        for i, width in enumerate(self.widths):
            np.add.at(out[i], codes[:, i], back[:, at : at + width])
            at += width
        return slope


def _positive(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class _Table:
    """Rows as the networks see them: scaled numbers, and codes in which 0 is a level unseen in the fit."""

    def __init__(self, inputs: Inputs, encoders: dict):
        self.rows, self.inputs, self.encoders = _Rows(inputs, encoders), inputs, encoders

    def shape(self, s: Network) -> Shape:
        e = self.encoders[_encoder_of(s)]
        return Shape(len(self.inputs.numbers), [len(e.levels[c]) + 1 for c in self.inputs.categories], s.hidden)

    def read(self, values: np.ndarray, f: int) -> tuple[np.ndarray, np.ndarray]:
        e, n = self.encoders[f], len(self.inputs.numbers)
        codes = [self.rows.codes[f, c][values[:, n + i].astype(np.int64)] for i, c in enumerate(self.inputs.categories)]
        known = [np.where(code == len(e.levels[c]), 0, code + 1) for code, c in zip(codes, self.inputs.categories)]
        return (values[:, :n] - e.means) / e.deviations, np.stack(known, axis=1) if known else np.zeros((len(values), 0), np.int64)


def _epoch(table: _Table, s: Network, state: np.ndarray, shape: Shape, y, weight, values, f: int, number: int, part: int, step: float) -> np.ndarray:
    """The state (weights, both moments, steps taken) after the rows have been gone through once in a seeded order."""
    size = shape.size
    flat, first, second, t = state[:size].copy(), state[size : 2 * size].copy(), state[2 * size : 3 * size].copy(), float(state[-1])
    rng = np.random.default_rng((s.seed, number, part))
    numbers, codes = table.read(values, f)
    order = rng.permutation(len(y))
    for a in range(0, len(y), s.batch):
        at = order[a : a + s.batch]
        z, kept = shape.forward(flat, numbers[at], codes[at], s.dropout, rng)
        slope = shape.backward(flat, codes[at], kept, weight[at] * (_positive(z) - y[at]) / len(at)) + s.l2 * flat
        t += 1
        if s.optimizer == "adam":
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope * slope
            flat -= step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + _EPSILON)
        else:
            second = 0.99 * second + 0.01 * slope * slope
            flat -= step * slope / (np.sqrt(second) + _EPSILON)
    return np.concatenate([flat, first, second, [t]])


@dataclass(frozen=True)
class NetworkModel:
    """A trained network with the encoder of its rows. ``losses``: on the held rows, by epoch."""

    inputs: Inputs
    settings: Network
    encoder: object
    weights: np.ndarray
    losses: list[float]
    accuracy: float

    @property
    def best_epoch(self) -> int:
        return self.losses.index(min(self.losses)) + 1 if self.losses else 0

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Probability of the label 1 for each row."""
        table = _Table(self.inputs, {-1: self.encoder})
        shape, weights = table.shape(replace(self.settings, fold=None)), self.weights
        kept = [c for c in df.columns if c != out]
        stored = table.rows.coded(df, 1, None, None, None, kept)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    *_, values = table.rows.read(batch)
                    z, _ = shape.forward(weights, *table.read(values, -1))
                    yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(_positive(z))], ["row", "p"])

        found = stored.mapInArrow(run, f"row {stored.schema['row'].dataType.simpleString()}, p double")
        return found.select(*[F.col(f"row.`{c}`") for c in kept], F.col("p").alias(out))

    def size(self) -> dict[str, int]:
        return {"parameters": len(self.weights)}


def fit_many(df: DataFrame, settings: Sequence[Network], inputs: Inputs, label: str = "label", fold: str | None = None, held: str | None = None) -> list[NetworkModel]:
    """A network for each of the settings. Held rows are those of its fold, or those where the boolean column ``held`` is true; without any
    it takes all its epochs. The class weight is that of the rows it is trained on: negatives to positives."""
    marked = df if held is None else df.withColumn("__held", F.when(F.coalesce(F.col(held).cast("boolean"), F.lit(False)), 0).otherwise(1))
    if held is not None:  # held rows are fold 0, and every network leaves it out
        fold, settings = "__held", [replace(s, fold=0) for s in settings]
    encoders = fit_encoders(marked, inputs, 1, 0, fold)
    table = _Table(inputs, encoders)
    # few and whole partitions: an epoch's mean is over as many paths
    stored = staged(table.rows.coded(marked, 1, label, None, fold), "coded-rows")
    counts = {r["fold"]: (r["pos"], r["neg"]) for r in stored.groupBy("fold").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).collect()}
    ways = []
    for s in settings:
        f = _encoder_of(s)
        pos, neg = (sum(v[i] for k, v in counts.items() if f == -1 or k != f) for i in (0, 1))
        shape = table.shape(s)
        begin = shape.begin(np.random.default_rng(s.seed))
        ways.append({"s": s, "f": f, "shape": shape, "weight": neg / pos if pos else 1.0, "state": np.concatenate([begin, np.zeros(2 * shape.size + 1)]), "best": begin, "losses": [], "accuracy": math.nan, "step": s.step, "waited": 0, "done": False})
    for number in range(max((s.epochs for s in settings), default=0)):
        live = {m: w for m, w in enumerate(ways) if not w["done"] and number < w["s"].epochs}
        if not live:
            break
        trained = _pass(table, stored, live, number)
        for m, w in live.items():
            rows, state = trained.get(m, (0.0, None))
            if rows:
                w["state"] = state / rows
        measured = _held(table, stored, live)
        for m, w in live.items():
            weight, found = measured.get(m, (0.0, None))
            if not weight:  # nothing is held
                w["best"] = w["state"][: w["shape"].size]
                continue
            loss = float(found[0] / found[1])
            if not w["losses"] or loss < min(w["losses"]):
                w["best"], w["accuracy"], w["waited"] = w["state"][: w["shape"].size], float(found[2] / found[1]), 0
            else:
                w["waited"] += 1
            w["losses"].append(loss)
            if w["s"].plateau is not None and w["waited"] and w["waited"] % (w["s"].plateau + 1) == 0:
                w["step"] /= 2
            w["done"] = w["waited"] >= w["s"].patience
    return [NetworkModel(inputs, w["s"], encoders[w["f"]], w["best"], w["losses"], w["accuracy"]) for w in ways]


def _pass(table: _Table, stored: DataFrame, live: dict, number: int) -> dict:
    """The states after an epoch, as sums over the tasks weighted by their rows."""
    jobs = {m: (w["s"], w["f"], w["shape"], w["weight"], w["state"], w["step"]) for m, w in live.items()}

    def run(batches):
        part = TaskContext.get().partitionId()
        rows, sums = dict.fromkeys(jobs, 0.0), {m: np.zeros_like(j[4]) for m, j in jobs.items()}
        states = {m: j[4] for m, j in jobs.items()}
        for at, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            y, _, fold, _, values = table.rows.read(batch)
            for m, (s, f, shape, weight, _, step) in jobs.items():
                own = (fold != f) | (f == -1)
                if own.any():
                    states[m] = _epoch(table, s, states[m], shape, y[own], np.where(y[own] > 0.5, weight, 1.0), values[own], f, number, 1000 * part + at, step)
                    rows[m] += own.sum()
        for m in jobs:
            sums[m] = states[m] * rows[m]
        yield _sums(part, rows, sums)

    return _added(stored.select("y", "w", "fold", "ids", "values").mapInArrow(run, _SUMS))


def _held(table: _Table, stored: DataFrame, live: dict) -> dict:
    """(rows, (weighted loss, rows, hits)) on the held rows of each network."""
    jobs = {m: (w["f"], w["shape"], w["weight"], w["state"][: w["shape"].size]) for m, w in live.items() if w["f"] != -1}
    if not jobs:
        return {}

    def run(batches):
        rows, sums = dict.fromkeys(jobs, 0.0), {m: np.zeros(3) for m in jobs}
        for batch in batches:
            if not batch.num_rows:
                continue
            y, _, fold, _, values = table.rows.read(batch)
            for m, (f, shape, weight, flat) in jobs.items():
                own = fold == f
                if own.any():
                    z, _ = shape.forward(flat, *table.read(values[own], f))
                    truth = y[own]
                    loss = (np.where(truth > 0.5, weight, 1.0) * (np.logaddexp(0, z) - truth * z)).sum()
                    rows[m] += own.sum()
                    sums[m] += [loss, own.sum(), ((z > 0) == (truth > 0.5)).sum()]
        yield _sums(TaskContext.get().partitionId(), rows, sums)

    return _added(stored.select("y", "w", "fold", "ids", "values").mapInArrow(run, _SUMS))


def search(df: DataFrame, drawn: Sequence[Network], inputs: Inputs, fold: str = "fold", folds: int = 3, label: str = "label") -> tuple[Network, DataFrame, tuple[float, float]]:
    """Cross-validate drawn settings by the best loss on each held-out fold: the best ones, the table of all, and the mean and
    deviation of the best ones' accuracy."""
    models = fit_many(df, [replace(s, fold=f) for s in drawn for f in range(folds)], inputs, label, fold)
    rows, hits = [], []
    for c, s in enumerate(drawn):
        own = models[c * folds : (c + 1) * folds]
        losses = [min(m.losses) if m.losses else math.inf for m in own]
        hits.append((float(np.mean([m.accuracy for m in own])), float(np.std([m.accuracy for m in own]))))
        rows.append((c, "; ".join(f"{k}={v}" for k, v in sorted(asdict(s).items()) if k not in ("fold", "seed")), float(np.mean(losses)), float(np.std(losses)), *hits[-1]))
    table = df.sparkSession.createDataFrame(rows, "config int, params string, mean_test_score double, std_test_score double, mean_test_accuracy double, std_test_accuracy double")
    best = min(range(len(drawn)), key=lambda c: (rows[c][2], c))
    ranked = table.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.asc("mean_test_score"))))  # one row per configuration
    return drawn[best], ranked, hits[best]
