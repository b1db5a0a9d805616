"""Networks: gradients against differences, learning, patience, plateaus."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream.models.embedding_net import Network, Shape, fit_many, search
from slipstream.models.penalty_path import Inputs

INPUTS = Inputs(None, ["a", "b"], ["c"], {})


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = rng.gauss(100, 20), rng.random(), rng.choice("klmnop")
        odds = 3 * math.sin((a - 100) / 12) + (2 if c in "kn" else -2)
        rows.append((i, a, b, c, float(rng.random() < 1 / (1 + math.exp(-odds))), i % 3, i % 5 == 0))
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, label double, fold int, held boolean")
    return df.repartition(2).cache()


def test_gradient():
    rng = np.random.default_rng(3)
    shape = Shape(2, [4, 3], (5, 4))
    flat = shape.begin(rng) + 0.01 * rng.standard_normal(shape.size)
    numbers, codes, y = rng.standard_normal((9, 2)), rng.integers(0, 3, (9, 2)), rng.integers(0, 2, 9).astype(float)

    def loss(w):
        z, _ = shape.forward(w, numbers, codes)
        return (np.logaddexp(0, z) - y * z).sum()

    z, kept = shape.forward(flat, numbers, codes)
    slope = shape.backward(flat, codes, kept, 1 / (1 + np.exp(-z)) - y)
    for k in rng.choice(shape.size, 40, replace=False):
        step = np.zeros_like(flat)
        step[k] = 1e-5
        assert slope[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-5, abs=1e-5)
    assert shape.size == 4 * 2 + 3 * 2 + 6 * 5 + 5 + 5 * 4 + 4 + 4 + 1


def test_networks_learn_and_keep_the_best_epoch(table):
    settings = [Network((16,), 0.02, dropout=0.1, epochs=25, patience=4, plateau=1), Network((8, 8), 0.02, "rmsprop", 32, epochs=12), Network((4,), 0.0, epochs=9, patience=3)]
    models = fit_many(table, settings, INPUTS, held="held")
    for model, s in zip(models, settings):
        assert len(model.losses) <= s.epochs and (len(model.losses) == s.epochs or len(model.losses) == model.best_epoch + s.patience)
    assert min(models[0].losses) < models[0].losses[0] and models[0].accuracy > 0.65 and models[1].accuracy > 0.6
    assert len(models[2].losses) == 4  # a step of nothing changes nothing
    scored = models[0].score(table.where("held")).collect()
    weight = table.where("NOT held").agg(F.sum(1 - F.col("label")) / F.sum("label")).head()[0]
    loss = -np.mean([weight * math.log(r["p"]) if r["label"] else math.log(1 - r["p"]) for r in scored])
    assert loss == pytest.approx(min(models[0].losses), rel=1e-6)
    again = fit_many(table, settings[:1], INPUTS, held="held")[0]
    assert np.array_equal(again.weights, models[0].weights)  # alone or in company
    odd = table.limit(1).withColumns({"c": F.lit("never seen"), "a": F.lit(None).cast("double")})
    assert 0 < models[0].score(odd).head()["p"] < 1


def test_search(table):
    drawn = [Network((4,), 1e-5, epochs=3), Network((16,), 0.03, dropout=0.0, epochs=8)]
    best, found, accuracy = search(table, drawn, INPUTS, folds=3)
    rows = {r["config"]: r for r in found.collect()}
    assert best == drawn[1] and rows[1]["rank_test_score"] == 1
    assert rows[1]["mean_test_accuracy"] == accuracy[0] > 0.65 and rows[1]["std_test_accuracy"] == accuracy[1]


def test_without_held_rows(table):
    model = fit_many(table, [Network((4,), 0.01, epochs=2)], INPUTS)[0]
    assert model.losses == [] and model.score(table).where("p > 0 AND p < 1").count() == 400
