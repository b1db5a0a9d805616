"""Boosted trees of second order: gradients and curvatures, penalties on leaves, native categories, stopping with patience.

Columns are coded once as bins of one byte: numbers by their quantiles, categories by level, 0 for a missing value. A tree grows level by
level, and each level is one aggregate: every task adds the gradients and curvatures of its rows up by (node, column,
bin), the sums are put together in one exchange by (node, column), and window functions over the bins of a node's column find its best
split. Only that split of each node reaches the driver. The margins of all rows are a stored column; trees grown since it
was stored are added on the fly, and after `STORED` trees it is written anew to the shared folder, from which a lost
executor's work is repeated.

Sums are of integers (units of 2^-32), so a model does not depend on how the rows are dealt out. Several models over the same rows
(configurations, folds) grow side by side in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.models import evaluation
from slipstream.session import staged

UNIT = 2.0**32  # gradients are added up in units of 1 / UNIT
STORED = 10  # trees after which margins are written anew
BINS = 256  # codes of a column, 0 for a missing value
MODELS = 64  # models that grow side by side at most
CELLS = 1 << 22  # sums of (node, column, bin) that a pass holds in a task at most
_GRID = "model int, node int, col int, bin int, g bigint, h bigint, n bigint"


@dataclass(frozen=True)
class Settings:
    """What shapes a model. ``patience``: rounds without a smaller loss on the held rows after which boosting ends; the trees up to
    the best round are kept. ``fold``: rows of this fold are left out of the fit."""

    trees: int = 300
    depth: int = 6
    step: float = 0.3
    l2: float = 1.0
    l1: float = 0.0
    min_gain: float = 0.0
    min_curvature: float = 1.0
    rows: float = 1.0  # share of the rows a tree sees
    columns: float = 1.0  # share of the columns a tree sees
    level_columns: float = 1.0  # share of those that a level sees
    patience: int | None = None
    fold: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class Codes:
    """How columns become bins: ascending cuts of each number, levels of each category (those beyond are one code)."""

    numbers: dict[str, list[float]]
    categories: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *self.categories]

    def matrix(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Bins of rows whose columns come in the order of `names`: doubles, then strings."""
        out = np.zeros((len(columns[0]) if columns else 0, len(self.names)), np.uint8)
        for i, cuts in enumerate(self.numbers.values()):
            values = columns[i].to_numpy(zero_copy_only=False).astype(np.float64)
            known = ~np.isnan(values)
            out[known, i] = np.searchsorted(cuts, values[known], side="left") + 1
        for i, levels in enumerate(self.categories.values(), len(self.numbers)):
            place = {level: k for k, level in enumerate(levels, 1)}
            coded = columns[i].dictionary_encode()
            codes = np.array([0 if v is None else place.get(v, len(levels) + 1) for v in [*coded.dictionary.to_pylist(), None]], np.uint8)
            out[:, i] = codes[coded.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)]
        return out

    def columns(self, df: DataFrame) -> list[Column]:
        return [F.col(f"`{c}`").cast("double") for c in self.numbers] + [F.col(f"`{c}`").cast("string") for c in self.categories]


def fit_codes(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], bins: int = BINS) -> Codes:
    """Quantile cuts of each number (all rows, one pass) and the most frequent levels of each category (the first by name of equal ones).

    A number has at most ``bins`` - 1 bins and a category as many levels, the rest of which share one code."""
    most = min(bins, BINS) - 2
    shares = F.array(*[F.lit((i + 1) / (most + 1)) for i in range(most)])
    cuts = {}
    if numbers:
        known = [F.when(~F.isnan(c), c) for c in (F.col(f"`{n}`").cast("double") for n in numbers)]
        found = df.agg(*[F.percentile_approx(c, shares, F.lit(10_000)).alias(f"c{i}") for i, c in enumerate(known)]).head()
        cuts = {c: sorted(set(v or [])) for c, v in zip(numbers, found)}
    levels = {}
    for c in categories:
        level = F.col(f"`{c}`").cast("string").alias("level")
        counted = df.select(level).where("level IS NOT NULL").groupBy("level").count()
        levels[c] = sorted(r["level"] for r in counted.orderBy(F.desc("count"), "level").limit(most).collect())
    return Codes(cuts, levels)


@dataclass
class Tree:
    """Nodes in arrays; ``left`` and ``right`` are -1 in leaves. ``sets`` holds the codes that go left, one bit each."""

    column: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sets: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf, or the deepest node so far, of each row."""
        node = np.zeros(len(bins), np.int32)
        rows = np.arange(len(bins))
        while len(rows):
            here = node[rows]
            inner = self.left[here] >= 0
            rows, here = rows[inner], here[inner]
            code = bins[rows, self.column[here]]
            goes_left = (self.sets[here, code >> 3] >> (code & 7)) & 1
            node[rows] = np.where(goes_left, self.left[here], self.right[here])
        return node


@dataclass(frozen=True)
class Booster:
    """A fitted model: the margin is the base plus the values of the leaves that a row falls into."""

    codes: Codes
    base: float
    trees: list[Tree]
    settings: Settings
    losses: list[float] = field(default_factory=list)  # on the held rows before the first tree, after it, and so on

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(bins)]
        return out

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Probability of the label 1 for each row."""
        model = self

        def run(*columns: pa.Array) -> pa.Array:
            return pa.array(_share(model.margins(model.codes.matrix(columns))), pa.float64())

        return df.withColumn(out, F.arrow_udf(run, "double")(*self.codes.columns(df)))

    def importance(self, df: DataFrame) -> DataFrame:
        """Mean gain of the splits of each column; columns without splits have none."""
        total, n = np.zeros(len(self.codes.names)), np.zeros(len(self.codes.names))
        for tree in self.trees:
            inner = tree.left >= 0
            np.add.at(total, tree.column[inner], tree.gain[inner])
            np.add.at(n, tree.column[inner], 1)
        rows = [(c, float(t / k) if k else 0.0) for c, t, k in zip(self.codes.names, total, n)]
        return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")

    def size(self) -> dict[str, int]:
        leaves = sum(int((t.left < 0).sum()) for t in self.trees)
        splits = sum(int((t.left >= 0).sum()) for t in self.trees)
        return {"leaves": leaves, "splits": splits, "parameters": leaves + splits}


def _share(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -36, 36)))


class _Growing:
    """One model while it grows, on the driver; `trees` since the margins were stored travel to the tasks."""

    def __init__(self, index: int, settings: Settings, base: float, columns: int):
        self.index, self.settings, self.base, self.all_columns = index, settings, base, columns
        self.done: list[Tree] = []
        self.losses: list[float] = []
        self.stopped = False

    def begin(self) -> None:
        rng = np.random.default_rng((self.settings.seed, len(self.done)))
        some = max(1, round(self.settings.columns * self.all_columns))
        self.columns = np.sort(rng.permutation(self.all_columns)[:some])
        self.rng = rng
        self.nodes: list[dict] = [{"g": 0.0, "h": 0.0}]
        self.open = [0]

    def level(self) -> list[int]:
        """The columns that the next level may split by."""
        some = max(1, round(self.settings.level_columns * len(self.columns)))
        return sorted(int(c) for c in self.rng.permutation(self.columns)[:some])

    def split(self, found: dict[int, dict]) -> None:
        opened = []
        for node in self.open:
            best = found.get(node)
            if best is not None and node == 0:
                self.nodes[0] |= {"g": best["all_g"], "h": best["all_h"]}
            if best is None or best["gain"] is None:
                continue
            own = self.nodes[node]
            bits = np.zeros(BINS, np.uint8)
            bits[best["codes"] if best["codes"] else np.arange(1, best["bin"] + 1)] = 1
            bits[0] = best["missing_left"]
            children = len(self.nodes)
            own |= {"column": best["col"], "gain": best["gain"], "set": np.packbits(bits, bitorder="little"), "left": children}
            self.nodes.append({"g": best["g"], "h": best["h"]})
            self.nodes.append({"g": own["g"] - best["g"], "h": own["h"] - best["h"]})
            opened += [children, children + 1]
        self.open = opened

    def tree(self) -> Tree:
        """The tree as far as it is grown, with the values its nodes would have as leaves."""
        n = len(self.nodes)
        out = Tree(np.zeros(n, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.zeros((n, BINS // 8), np.uint8), np.zeros(n), np.zeros(n))
        for i, node in enumerate(self.nodes):
            out.value[i] = self.settings.step * leaf_value(node["g"], node["h"], self.settings)
            if "left" in node:
                out.column[i], out.left[i], out.right[i], out.sets[i], out.gain[i] = node["column"], node["left"], node["left"] + 1, node["set"], node["gain"]
        return out


def _shrunk(g: float, l1: float) -> float:
    return math.copysign(max(abs(g) - l1, 0.0), g)


def leaf_value(g: float, h: float, settings: Settings) -> float:
    """The step that minimises the second-order loss of a leaf with both penalties."""
    return 0.0 if h + settings.l2 <= 0 else -_shrunk(g, settings.l1) / (h + settings.l2)


def _uniform(ids: np.ndarray, *seeds: int) -> np.ndarray:
    """A number in [0, 1) for each row, the same on every run."""
    h = ids.astype(np.uint64)
    for s in seeds:
        h = (h ^ np.uint64(s & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * UNIT).astype(np.int64)


def _prepare(df: DataFrame, codes: Codes, key: str, label: str, weight: str | None, fold: str | None, held: str | None) -> DataFrame:
    """Rows as (row number by hash, label, weight, fold, held, bins)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bins = codes.matrix([batch.column(i) for i in range(5, batch.num_columns)]).tobytes()
                wide = len(codes.names)
                packed = pa.array([bins[i : i + wide] for i in range(0, batch.num_rows * wide, wide)] if wide else [b""] * batch.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], packed], ["row", "y", "w", "fold", "held", "bins"])

    fixed = [
        F.xxhash64(F.col(f"`{key}`")).alias("row"),
        F.col(f"`{label}`").cast("double").alias("y"),
        (F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")).alias("w"),
        (F.lit(-1) if fold is None else F.col(f"`{fold}`").cast("int")).alias("fold"),
        (F.lit(False) if held is None else F.coalesce(F.col(f"`{held}`").cast("boolean"), F.lit(False))).alias("held"),
    ]
    named = [c.alias(f"c{i}") for i, c in enumerate(codes.columns(df))]
    known = df.where(F.col(f"`{label}`").isNotNull())
    return known.select(*fixed, *named).mapInArrow(run, "row bigint, y double, w double, fold int, held boolean, bins binary")


def _read(batch: pa.RecordBatch, width: int, models: int):
    row, y, w, fold, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
    bins = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(len(row), width)
    margins = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.float64).reshape(len(row), models)
    return row, y, w, fold, held, bins, margins


@dataclass(frozen=True)
class _Work:
    """What a pass adds up for one model: some open nodes of the tree that grows, by some columns."""

    model: int
    settings: Settings
    number: int  # of the tree
    fresh: list[Tree]  # trees that the stored margins lack
    tree: Tree
    nodes: list[int]
    columns: list[int]


def _passes(work: list[_Work]) -> list[list[_Work]]:
    """The work in as many passes as keep the sums of each within `CELLS`."""
    out: list[list[_Work]] = [[]]
    free = CELLS
    for w in work:
        each, nodes = len(w.columns) * BINS, w.nodes
        while nodes:
            some = min(len(nodes), max(free // each, 0 if out[-1] else 1))
            if not some:
                out.append([])
                free = CELLS
                continue
            out[-1].append(replace(w, nodes=nodes[:some]))
            nodes, free = nodes[some:], free - some * each
    return [p for p in out if p]


def _grid(rows: DataFrame, width: int, models: int, work: list[_Work], losses: bool) -> DataFrame:
    """Sums by (model, node, column, bin) of the open nodes of the trees in work; with ``losses`` also the loss on the held
    rows, under node -1 (g: loss, h: weight)."""

    def run(batches):
        sums = [np.zeros((3, len(w.nodes), len(w.columns), BINS), np.int64) for w in work]
        lost = [[0, 0, 0] for _ in work]
        for batch in batches:
            if not batch.num_rows:
                continue
            row, y, w, fold, held, bins, margins = _read(batch, width, models)
            for own, total, job in zip(sums, lost, work):
                settings, nodes = job.settings, job.nodes
                margin = margins[:, job.model].copy()
                for old in job.fresh:
                    margin += old.value[old.leaves(bins)]
                p = _share(margin)
                if losses and nodes[0] == 0 and held.any():
                    loss = -np.where(y > 0.5, np.log(p), np.log1p(-p)) * w
                    for k, x in enumerate((loss, w, np.ones(len(w)))):
                        total[k] += int(_whole(x[held]).sum())
                use = ~held & (fold != settings.fold if settings.fold is not None else True)
                if settings.rows < 1:
                    use &= _uniform(row, settings.seed, job.number) < settings.rows
                place = np.full(len(job.tree.left), -1, np.int64)
                place[nodes] = np.arange(len(nodes))
                slot = place[job.tree.leaves(bins)]
                use &= slot >= 0
                if not use.any():
                    continue
                slot, g, h = slot[use], _whole((p - y) * w)[use], _whole(p * (1 - p) * w)[use]
                for k, c in enumerate(job.columns):
                    cell = slot * BINS + bins[use, c]
                    for which, x in enumerate((g, h, None)):
                        own[which, :, k, :] += _added(cell, x, len(nodes) * BINS).reshape(len(nodes), BINS)
        for own, total, job in zip(sums, lost, work):
            g, h, n = own
            node, col, code = np.nonzero(n)
            if len(node):
                yield _cells(job.model, np.array(job.nodes)[node], np.array(job.columns)[col], code, g[node, col, code], h[node, col, code], n[node, col, code])
            if total[2]:
                yield _cells(job.model, np.array([-1]), np.array([-1]), np.array([0]), *[np.array([x]) for x in total])

    return rows.mapInArrow(run, _GRID)


def _added(cell: np.ndarray, x: np.ndarray | None, size: int) -> np.ndarray:
    """Exact sums of 64-bit numbers by cell; counts without numbers."""
    if x is None:
        return np.bincount(cell, minlength=size)
    low, high = x & 0xFFFF_FFFF, x >> 32  # halves of rows of one batch add up exactly as doubles
    return np.bincount(cell, low, size).astype(np.int64) + (np.bincount(cell, high, size).astype(np.int64) << 32)


def _cells(m: int, node, col, code, g, h, n) -> pa.RecordBatch:
    columns = [np.full(len(node), m), node, col, code]
    return pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in columns], *[pa.array(c.astype(np.int64)) for c in (g, h, n)]], ["model", "node", "col", "bin", "g", "h", "n"])


def best_splits(grid: DataFrame, settings: Sequence[Settings], categories: Sequence[int]) -> DataFrame:
    """For each (model, node) the sums of all its rows and its best split, if one gains enough.

    One exchange by (model, node, column); a window over the bins of a node's column, at most `BINS`, gives the sums on the left of
    each cut. Missing values are tried on both sides. Categories are ordered by gradient over curvature, which makes one of
    their prefixes the best of all subsets. Of equal gains the lowest column, then the lowest bin, then missing on the left.
    """

    def of(name: str) -> Column:
        return F.element_at(F.array(*[F.lit(float(getattr(s, name))) for s in settings]), F.col("model") + 1)

    def exact(name: str) -> Column:
        return F.sum(F.col(name).cast("decimal(38,0)")).cast("double")

    keys = ["model", "node", "col"]
    cells = grid.repartition(*keys).groupBy(*keys, "bin").agg((exact("g") / UNIT).alias("g"), (exact("h") / UNIT).alias("h"), exact("n").alias("n"))
    cells = cells.withColumns({"l1": of("l1"), "l2": of("l2"), "least": of("min_curvature"), "enough": of("min_gain")})
    category = F.col("col").isin(*categories) if categories else F.lit(False)
    ordered = F.when(category, F.col("g") / (F.col("h") + F.col("l2") + 1e-12)).otherwise(F.lit(0.0))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(F.col("bin") > 0, ordered, "bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col("bin") > 0
    sums = {}
    for c in ("g", "h", "n"):
        sums[f"all_{c}"] = F.sum(c).over(whole)
        sums[f"none_{c}"] = F.coalesce(F.sum(F.when(~known, F.col(c))).over(whole), F.lit(0.0))
        sums[f"known_{c}"] = F.coalesce(F.sum(F.when(known, F.col(c))).over(upto), F.lit(0.0))
    sums["codes"] = F.collect_list(F.when(category & known, F.col("bin"))).over(upto)
    placed = cells.withColumns(sums).withColumn("missing_left", F.explode(F.array(F.lit(True), F.lit(False))))
    left = {c: F.col(f"known_{c}") + F.when(F.col("missing_left"), F.col(f"none_{c}")).otherwise(0.0) for c in ("g", "h", "n")}
    placed = placed.withColumns({f"left_{c}": v for c, v in left.items()})

    def worth(g: Column, h: Column) -> Column:
        shrunk = F.greatest(F.abs(g) - F.col("l1"), F.lit(0.0))
        return shrunk * shrunk / (h + F.col("l2"))

    rest = {c: F.col(f"all_{c}") - F.col(f"left_{c}") for c in ("g", "h", "n")}
    gain = worth(F.col("left_g"), F.col("left_h")) + worth(rest["g"], rest["h"]) - worth(F.col("all_g"), F.col("all_h"))
    # curvatures are positive, but differences of sums of them may miss 0 by a rounding
    fits = known & (F.col("left_n") > 0) & (rest["n"] > 0) & (F.col("left_h") >= F.col("least")) & (rest["h"] >= F.col("least"))
    fits = fits & (F.col("left_h") + F.col("l2") > 0) & (rest["h"] + F.col("l2") > 0)
    chosen = F.struct(
        F.round(gain, 9).alias("gain"),
        (-F.col("col")).alias("low_col"),
        (-F.col("bin")).alias("low_bin"),
        "missing_left",
        "col",
        "bin",
        F.col("left_g").alias("g"),
        F.col("left_h").alias("h"),
        "codes",
    )
    best = F.max(F.when(fits & (gain > F.greatest(F.col("enough"), F.lit(1e-9))), chosen))
    return placed.groupBy("model", "node").agg(best.alias("best"), F.first("all_g").alias("all_g"), F.first("all_h").alias("all_h"))


def _stored(rows: DataFrame, width: int, models: int, fresh: dict[int, list[Tree]], name: str) -> DataFrame:
    """The rows with the values of some trees added to their margins."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                *_, bins, margins = _read(batch, width, models)
                margins = margins.copy()
                for m, trees in fresh.items():
                    for tree in trees:
                        margins[:, m] += tree.value[tree.leaves(bins)]
                packed = pa.array([r.tobytes() for r in margins], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(6)], packed], [*batch.schema.names[:6], "margins"])

    return staged(rows.mapInArrow(run, rows.schema), name)


def fit_many(
    df: DataFrame,
    settings: Sequence[Settings],
    numbers: Sequence[str],
    categories: Sequence[str] = (),
    key: str = "id",
    label: str = "label",
    weight: str | None = None,
    fold: str | None = None,
    held: str | None = None,
    codes: Codes | None = None,
    start: Sequence[Booster] | None = None,
) -> list[Booster]:
    """One model for each of the settings, grown side by side over the same rows.

    ``key`` is unique per row and drives the row samples. Rows without a label are left out; rows where the boolean column ``held`` is true
    are not fitted but measured after every tree. ``start`` goes on with models of an earlier call. Codes are fitted on all rows that
    are not held unless they are given.
    """
    found = []
    codes = codes or (start[0].codes if start else fit_codes(_unheld(df, held), numbers, categories))
    for i in range(0, len(settings), MODELS):
        some = slice(i, i + MODELS)
        found += _grown(df, settings[some], codes, key, label, weight, fold, held, start and start[some])[0]
    return found


def _unheld(df: DataFrame, held: str | None) -> DataFrame:
    return df if held is None else df.where(~F.coalesce(F.col(held).cast("boolean"), F.lit(False)))


def _grown(df, settings, codes, key, label, weight, fold, held, start=None) -> tuple[list[Booster], DataFrame]:
    """The models, and the coded rows with the margins of all trees that were grown."""
    plain = staged(_prepare(df, codes, key, label, weight, fold, held), "coded-rows")
    share = plain.where("NOT held").agg(F.avg(F.col("y") * F.col("w")) / F.avg("w")).head()[0]
    share = min(max(share if share is not None else 0.5, 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    width, models = len(codes.names), len(settings)
    growing = [_Growing(i, s, start[i].base if start else base, width) for i, s in enumerate(settings)]
    rows = plain.withColumn("margins", F.lit(b"".join(np.float64(g.base).tobytes() for g in growing)))
    pending: dict[int, list[Tree]] = {g.index: [] for g in growing}
    if start:
        for g, old in zip(growing, start):
            g.done, g.losses = list(old.trees), list(old.losses[: len(old.trees) + 1])
        rows = _stored(rows, width, models, {g.index: g.done for g in growing}, "margins")
    wanted = list(range(len(codes.numbers), width))
    while live := [g for g in growing if not g.stopped]:
        for g in live:
            g.begin()
            if len(g.done) >= g.settings.trees:  # only the loss of the last tree is still to be measured
                g.stopped = held is None or len(g.losses) > len(g.done)
        depth = 0
        while True:
            work = [
                _Work(g.index, g.settings, len(g.done), pending[g.index], g.tree(), g.open, g.level())
                for g in live
                if g.open and not g.stopped and depth < max(1, g.settings.depth)
            ]
            if not work:
                break
            measured = held is not None and depth == 0
            by_model: dict[int, dict[int, dict]] = {}
            for part in _passes(work):
                for r in best_splits(_grid(rows, width, models, part, measured), settings, wanted).collect():  # a row for each open node
                    best = r["best"].asDict() if r["best"] is not None else {"gain": None}
                    by_model.setdefault(r["model"], {})[r["node"]] = best | {"all_g": r["all_g"], "all_h": r["all_h"]}
            for g in live:
                own = by_model.get(g.index, {})
                if measured:
                    _measure(g, own.pop(-1, None))
                if g.stopped or len(g.done) >= g.settings.trees or depth >= g.settings.depth:
                    g.open = []
                else:
                    g.split(own)
            depth += 1
        for g in live:
            if g.stopped or len(g.done) >= g.settings.trees:
                g.stopped = True
            else:
                g.done.append(g.tree())
                pending[g.index].append(g.done[-1])
        if max(map(len, pending.values())) >= STORED:
            rows = _stored(rows, width, models, pending, "margins")
            pending = {g.index: [] for g in growing}
    if any(pending.values()):
        rows = _stored(rows, width, models, pending, "margins")
    return [Booster(codes, g.base, _kept(g), g.settings, g.losses) for g in growing], rows


def _measure(g: _Growing, found: dict | None) -> None:
    """Take in the loss on the held rows, and stop when it has not fallen for as many rounds as patience allows."""
    if found is None or len(g.losses) > len(g.done):
        return
    g.losses.append(found["all_g"] / found["all_h"] if found["all_h"] else 0.0)
    best = g.losses.index(min(g.losses))
    if g.settings.patience is not None and len(g.losses) - 1 - best >= g.settings.patience:
        g.stopped = True


def _kept(g: _Growing) -> list[Tree]:
    if g.settings.patience is None or not g.losses:
        return g.done
    return g.done[: g.losses.index(min(g.losses))]


def fit(df: DataFrame, settings: Settings, numbers: Sequence[str], categories: Sequence[str] = (), **columns) -> Booster:
    """One model; see `fit_many`."""
    start = columns.pop("start", None)
    return fit_many(df, [settings], numbers, categories, start=None if start is None else [start], **columns)[0]


def search(
    df: DataFrame,
    drawn: Sequence[Settings],
    numbers: Sequence[str],
    categories: Sequence[str],
    key: str,
    fold: str = "fold",
    folds: int = 5,
    label: str = "label",
    weight: str | None = None,
) -> tuple[Settings, DataFrame]:
    """Cross-validate drawn settings by the area under the curve: the best ones, and the table of all.

    The models of all settings and folds grow side by side, `MODELS` at a time, so the number of passes over the rows follows the number
    of trees and not that of settings. A row's margin under the model that has left its fold out is its score."""
    codes = fit_codes(df, numbers, categories)
    every = [replace(s, fold=f, patience=None) for s in drawn for f in range(folds)]
    areas: list[float] = []
    for i in range(0, len(every), MODELS):
        some = every[i : i + MODELS]
        _, rows = _grown(df, some, codes, key, label, weight, fold, None)
        scored = _left_out(rows, some)
        area = evaluation.roc_auc(scored, "y", "margin", keys=["model"])
        found = {r["model"]: r["auc"] for r in area.collect()}  # a row for each model
        areas += [found.get(m) if found.get(m) is not None else math.nan for m in range(len(some))]
    rows = []
    for c, s in enumerate(drawn):
        own = np.array(areas[c * folds : (c + 1) * folds])
        rows.append((c, "; ".join(f"{k}={v}" for k, v in sorted(asdict(s).items()) if k not in ("fold", "seed")), float(own.mean()), float(own.std())))
    table = df.sparkSession.createDataFrame(rows, "config int, params string, mean_test_score double, std_test_score double")
    best = max(range(len(drawn)), key=lambda c: (-math.inf if math.isnan(rows[c][2]) else rows[c][2], -c))
    ranked = table.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc("mean_test_score"))))  # one row per configuration
    return drawn[best], ranked


def _left_out(rows: DataFrame, settings: Sequence[Settings]) -> DataFrame:
    """(model, y, margin) of every row for the models that have not seen its fold."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                _, y, _, fold, _, _, margins = _read(batch, 0, len(settings))
                for m, s in enumerate(settings):
                    own = fold == s.fold
                    if own.any():
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(own.sum(), m, np.int32)), pa.array(y[own]), pa.array(margins[own, m])], ["model", "y", "margin"])

    return rows.withColumn("bins", F.lit(b"")).mapInArrow(run, "model int, y double, margin double")
