"""Second-order trees against a plain version of their first trees, patience, resuming, search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream.models import boosting
from slipstream.models.boosting import Codes, Settings, fit, fit_many, search

NUMBERS, CATEGORIES = ["a", "b"], ["c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for i in range(400):
        a, b, c = rng.choice([rng.gauss(0, 1), None]), float(rng.randrange(6)), rng.choice(["k", "l", "m", "n", None])
        odds = (a or 0.4) + (c in ("k", "n")) * 1.5 - (b > 3)
        out.append((i, a, b, c, float(rng.random() < 1 / (1 + math.exp(-odds))), rng.choice([1.0, 2.0]), i % 3, i % 4 == 0))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c string, label double, w double, fold int, held boolean").repartition(5).cache()


def coded(rows, codes: Codes):
    """Bins of the rows by their definition."""
    out = []
    for _, a, b, c, *_ in rows:
        own = [0 if v is None else 1 + sum(v > cut for cut in codes.numbers[name]) for name, v in (("a", a), ("b", b))]
        own.append(0 if c is None else codes.categories["c"].index(c) + 1)
        out.append(own)
    return np.array(out)


def plain_tree(bins, y, w, margin, s: Settings, categories=(2,)):
    """(leaf values of the rows) of one tree: every cut of every column, each missing side tried."""
    p = 1 / (1 + np.exp(-margin))
    g, h = (p - y) * w, p * (1 - p) * w

    def worth(rows):
        t = max(abs(g[rows].sum()) - s.l1, 0)
        return t * t / (h[rows].sum() + s.l2)

    def value(rows):
        t = math.copysign(max(abs(g[rows].sum()) - s.l1, 0), g[rows].sum())
        return -s.step * t / (h[rows].sum() + s.l2)

    out = np.zeros(len(y))

    def grow(rows, depth):
        best = None
        if depth < s.depth:
            for c in range(bins.shape[1]):
                codes = sorted(set(bins[rows, c]) - {0})
                if c in categories:
                    codes.sort(key=lambda k: (g[rows][bins[rows, c] == k].sum() / (h[rows][bins[rows, c] == k].sum() + s.l2), k))
                for i, code in enumerate(codes):
                    for missing in (True, False):
                        left = np.isin(bins[rows, c], codes[: i + 1]) | ((bins[rows, c] == 0) & missing)
                        a, b = rows[left], rows[~left]
                        if len(a) and len(b) and h[a].sum() >= s.min_curvature and h[b].sum() >= s.min_curvature:
                            gain = worth(a) + worth(b) - worth(rows)
                            key = (round(gain, 7), -c, -code, missing)
                            if gain > max(s.min_gain, 1e-9) and (best is None or key > best[0]):
                                best = (key, a, b)
        if best is None:
            out[rows] = value(rows)
        else:
            grow(best[1], depth + 1)
            grow(best[2], depth + 1)

    grow(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("settings", [
    Settings(trees=3, depth=3, step=0.5),
    Settings(trees=2, depth=2, l1=1.5, l2=0.1, min_gain=0.5, min_curvature=4.0),
    Settings(trees=1, depth=5, l2=3.0, min_curvature=2.0),
])
def test_trees_are_the_plain_ones(table, rows, settings):
    model = fit(table, settings, NUMBERS, CATEGORIES, weight="w")
    bins = coded(rows, model.codes)
    y, w = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    share = (y * w).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    for _ in range(settings.trees):
        margin += plain_tree(bins, y, w, margin, settings)
    assert np.allclose(model.margins(bins.astype(np.uint8)), margin, atol=1e-6)
    got = {r["id"]: r["p"] for r in model.score(table).select("id", "p").collect()}
    assert all(abs(got[r[0]] - 1 / (1 + math.exp(-m))) < 1e-6 for r, m in zip(rows, margin))
    assert sum(t.gain.sum() for t in model.trees) > 0 and model.size()["leaves"] == model.size()["splits"] + settings.trees


def same(a, b):
    return all(np.array_equal(getattr(x, f), getattr(y, f)) for x, y in zip(a.trees, b.trees) for f in ("column", "left", "right", "sets", "value", "gain"))


def test_models_do_not_depend_on_partitions_or_company(table, monkeypatch):
    one = Settings(trees=3, depth=3, rows=0.7, columns=0.7, level_columns=0.8)
    other = Settings(trees=2, depth=2, seed=1, fold=1)
    alone = fit(table.repartition(2), one, NUMBERS, CATEGORIES, fold="fold")
    monkeypatch.setattr(boosting, "CELLS", 300)  # several passes for a level
    monkeypatch.setattr(boosting, "STORED", 1)
    both = fit_many(table, [one, other], NUMBERS, CATEGORIES, fold="fold", codes=alone.codes)
    assert same(alone, both[0]) and len(both[0].trees) == 3 and len(both[1].trees) == 2
    inside = fit(table.where("fold <> 1"), Settings(trees=2, depth=2, seed=1), NUMBERS, CATEGORIES, codes=alone.codes)
    first = both[1].trees[0]
    assert np.array_equal(inside.trees[0].column, first.column)


def test_going_on_with_a_model(table):
    s = Settings(trees=4, depth=2)
    whole = fit(table, s, NUMBERS, CATEGORIES, held="held")
    part = fit(table, Settings(trees=2, depth=2), NUMBERS, CATEGORIES, held="held")
    more = fit(table, s, NUMBERS, CATEGORIES, held="held", start=part)
    assert same(whole, more) and len(more.trees) == 4 and np.allclose(more.losses, whole.losses) and len(whole.losses) == 5


def test_patience_keeps_the_best_round(spark):
    """Held rows that contradict the others from the third column on: the loss falls, then rises."""
    rng = random.Random(1)
    rows = []
    for i in range(600):
        held = i % 3 == 0
        y = rng.random() < 0.5
        x = rng.gauss(1.2 if y else -1.2, 1)
        rows.append((i, x, rng.random(), float(y), held))
    df = spark.createDataFrame(rows, "id long, x double, z double, label double, held boolean")
    model = fit(df, Settings(trees=60, depth=4, step=0.5, min_curvature=0.0, l2=0.1, patience=3), ["x", "z"], held="held")
    best = model.losses.index(min(model.losses))
    assert 0 < best == len(model.trees) == model.best_round and len(model.losses) == best + 4 < 60
    assert all(loss >= model.losses[best] for loss in model.losses[best:])
    held = [r for r in model.score(df.where("held")).collect()]
    loss = -sum(math.log(r["p"] if r["label"] else 1 - r["p"]) for r in held) / len(held)
    assert loss == pytest.approx(model.losses[best], abs=1e-6)


def test_search(table):
    drawn = [Settings(trees=2, depth=1, step=0.3), Settings(trees=3, depth=3, step=0.5), Settings(trees=1, depth=0)]
    best, found = search(table, drawn, NUMBERS, CATEGORIES, "id", folds=3)
    ranks = {r["config"]: r for r in found.collect()}
    assert best == drawn[[c for c, r in ranks.items() if r["rank_test_score"] == 1][0]]
    assert ranks[2]["mean_test_score"] == pytest.approx(0.5) and ranks[1]["mean_test_score"] > 0.55
    # the same by fitting each fold by itself
    codes = boosting.fit_codes(table, NUMBERS, CATEGORIES)
    areas = []
    for f in range(3):
        model = fit(table, Settings(trees=2, depth=1, step=0.3, fold=f), NUMBERS, CATEGORIES, fold="fold", codes=codes)
        own = [(r["label"], r["p"]) for r in model.score(table.where(F.col("fold") == f)).collect()]
        pos, neg = ([p for y, p in own if y == v] for v in (1, 0))
        areas.append(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg))
    assert ranks[0]["mean_test_score"] == pytest.approx(np.mean(areas)) and ranks[0]["std_test_score"] == pytest.approx(np.std(areas))


def test_empty_and_odd_rows(spark, table):
    none = fit(table.limit(0), Settings(trees=2, depth=2), NUMBERS, CATEGORIES)
    assert all((t.left < 0).all() for t in none.trees) and none.score(table).where("p <> 0.5").count() == 0
    one_class = fit(table.withColumn("label", F.lit(1.0)), Settings(trees=1, depth=2), NUMBERS, CATEGORIES)
    assert one_class.score(table).where("p < 0.99").count() == 0
    odd = spark.createDataFrame([(1, None, float("nan"), "never seen")], "id long, a double, b double, c string")
    assert 0 < fit(table, Settings(trees=2, depth=2), NUMBERS, CATEGORIES).score(odd).head()["p"] < 1
    constant = table.withColumn("a", F.lit(None).cast("double"))
    assert fit(constant, Settings(trees=1, depth=2), ["a"]).size()["splits"] == 0
