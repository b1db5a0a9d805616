"""Many regressions at once against plain ones."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipstream.models import penalty_path
from slipstream.models.penalty_path import Inputs, Linear, fit_many, search

INPUTS = Inputs("text", ["a", "b"], ["c"], {"c": 0.1})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = "slow fast corner straight hairpin chicane long short climb drop".split()
    out = []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 7))) or None
        a, b, c = rng.gauss(5, 2), rng.choice([0.0, 1.0, 7.0]), rng.choice(["k"] * 5 + ["l"] * 4 + ["rare", None])
        odds = (a - 5) / 2 + ("fast" in (text or "")) * 1.5 - (c == "l")
        out.append((i, text, a, b, c, float(rng.random() < 1 / (1 + math.exp(-odds))), rng.choice([1.0, 2.0]), i % 3))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, a double, b double, c string, label double, w double, fold int").repartition(4).cache()


def plain_matrix(rows, known, settings):
    """Features of all rows, fitted on the known ones, by their definitions."""

    def grams(text):
        own = [w for w in (text or "").split() if len(w) > 1]
        return [" ".join(own[i : i + k]) for k in range(1, settings.ngrams + 1) for i in range(len(own) - k + 1)]

    tf, df = {}, {}
    for r in known:
        for g in grams(r[1]):
            tf[g] = tf.get(g, 0) + 1
        for g in set(grams(r[1])):
            df[g] = df.get(g, 0) + 1
    terms = sorted(tf, key=lambda g: (-tf[g], g))[: settings.max_features]
    weights = {g: math.log((len(known) + 1) / (df[g] + 1)) + 1 for g in terms}
    out = []
    numbers = np.array([[r[2], r[3]] for r in known])
    mean, sd = numbers.mean(0), numbers.std(0)
    counts = {lv: sum(r[4] == lv for r in known) for lv in {r[4] for r in known} - {None}}
    levels = sorted(lv for lv, n in counts.items() if n >= max(1, 0.1 * len(known)))
    for r in rows:
        own = grams(r[1])
        x = np.array([own.count(g) * weights[g] for g in terms])
        x = x / (np.linalg.norm(x) or 1)
        hot = [float(r[4] == lv) for lv in levels] + [float(r[4] not in levels)]
        out.append([*x, *((np.array([r[2], r[3]]) - mean) / sd), *hot, 1.0])
    return np.array(out), [*(f"tfidf_{g}" for g in terms), "a", "b", *(f"c_{lv}" for lv in levels), "c___infrequent__", "intercept"]


@pytest.mark.parametrize("settings", [Linear(0.5, 6, 1), Linear(3.0, 40, 2), Linear(0.01, 15, 3, fold=1)])
def test_fits_are_minima_of_the_plain_loss(table, rows, settings):
    others = [Linear(2.0, 10, 2, fold=0), Linear(1.0, 20, 1)]
    model = fit_many(table, [others[0], settings, others[1]], INPUTS, weight="w", fold="fold", tolerance=1e-6)[1]
    known = [r for r in rows if r[7] != settings.fold]
    x, names = plain_matrix(known, known, settings)
    assert model.names == names
    y, w = (np.array([r[i] for r in known]) for i in (5, 6))
    z = x @ model.coefficients
    penalty = model.coefficients.copy()
    penalty[-1] = 0
    slope = settings.strength * x.T @ (w * (1 / (1 + np.exp(-z)) - y)) + penalty
    assert np.abs(slope).max() < 1e-3 * max(1, settings.strength)
    loss = settings.strength * (w * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * penalty @ penalty
    assert model.loss == pytest.approx(loss)
    every, _ = plain_matrix(rows, known, settings)
    got = {r["id"]: r["p"] for r in model.score(table).select("id", "p").collect()}
    assert all(abs(got[r[0]] - 1 / (1 + math.exp(-float(q @ model.coefficients)))) < 1e-9 for r, q in zip(rows, every))


def test_search_scores_each_fold_by_a_model_that_has_not_seen_it(table, rows):
    drawn = [Linear(1e-4, 5, 1), Linear(1.0, 30, 2), Linear(50.0, 60, 3)]
    best, found, by_fold = search(table, drawn, INPUTS, folds=3, weight="w")
    table_ = {r["config"]: r for r in found.collect()}
    assert best == drawn[[c for c, r in table_.items() if r["rank_test_score"] == 1][0]]
    f1 = []
    for f, model in enumerate(fit_many(table, [Linear(1.0, 30, 2, fold=f) for f in range(3)], INPUTS, weight="w", fold="fold")):
        scored = model.score(table.where(F.col("fold") == f)).collect()
        tp = sum(r["p"] >= 0.5 and r["label"] == 1 for r in scored)
        wrong = sum((r["p"] >= 0.5) != (r["label"] == 1) for r in scored)
        f1.append(2 * tp / (2 * tp + wrong))
    assert table_[1]["mean_test_score"] == pytest.approx(np.mean(f1), abs=0.02) and len(by_fold) == 3
    assert [m.settings.fold for m in by_fold] == [0, 1, 2]


def test_passes_do_not_follow_the_number_of_settings(table, monkeypatch):
    passes = []
    real = penalty_path._Models.losses
    monkeypatch.setattr(penalty_path._Models, "losses", lambda self, stored, points: passes.append(len(points)) or real(self, stored, points))
    fit_many(table, [Linear(10.0**k, 10 + k, 1 + k % 2) for k in range(-3, 3)] * 10, INPUTS)
    assert passes[0] == 60 and len(passes) < 120


def test_without_text_or_rows(spark, table):
    plain = Inputs(None, ["a"], [], {})
    model = fit_many(table, [Linear()], plain)[0]
    assert model.names == ["a", "intercept"] and model.coefficients[0] > 0
    none = fit_many(table.limit(0), [Linear()], INPUTS)[0]
    assert none.score(table).where("p <> 0.5").count() == 0
    odd = spark.createDataFrame([(None, None, None, "never seen")], "text string, a double, b double, c string")
    assert 0 < fit_many(table, [Linear()], INPUTS)[0].score(odd).head()["p"] < 1


def test_terms_of_one_long_text_take_linear_time(spark):
    words = [f"w{i}" for i in range(30000)]
    texts = [(" ".join(words + words[:2] + words[:1]), 0), ("w0 w1 w0", 1)]
    df = spark.createDataFrame(texts, "text string, fold int")
    began = time.perf_counter()
    found = penalty_path.fit_encoders(df, penalty_path.Inputs("text", [], [], {}), 1, 2, "fold")
    assert time.perf_counter() - began < 60
    assert {f: e.terms[1] for f, e in found.items()} == {-1: ["w0", "w1"], 0: ["w0", "w1"], 1: ["w0", "w1"]}
    assert found[-1].weights[1].tolist() == [1.0, 1.0]
    assert found[0].weights[1].tolist() == [1.0, 1.0]


def test_strong_fits_end_after_few_passes(table, rows, monkeypatch):
    passes = []
    real = penalty_path._Models.losses
    monkeypatch.setattr(penalty_path._Models, "losses", lambda self, stored, points: passes.append(len(points)) or real(self, stored, points))
    settings = [Linear(s, 10 * k, n, fold=f) for s in (1e-3, 1.0, 100.0) for k in (1, 3, 6) for n in (1, 2) for f in range(3)]
    fitted = fit_many(table, settings, INPUTS, weight="w", fold="fold", tolerance=1e-6)
    assert passes[0] == len(settings) and len(passes) < 40
    for s, model in zip(settings, fitted):
        known = [r for r in rows if r[7] != s.fold]
        x, names = plain_matrix(known, known, s)
        assert model.names == names
        y, w = (np.array([r[i] for r in known]) for i in (5, 6))
        penalty = np.append(model.coefficients[:-1], 0)
        slope = s.strength * x.T @ (w * (1 / (1 + np.exp(-x @ model.coefficients)) - y)) + penalty
        assert np.abs(slope).max() < 1e-3 * max(1, s.strength)


@pytest.mark.parametrize("few", [None, 2])
def test_long_terms_are_counted_among_frequent_words(spark, monkeypatch, few):
    if few is not None:
        monkeypatch.setattr(penalty_path, "FEW", few)  # too many words to name: all n-grams are counted
    stored = []
    real = penalty_path.staged
    monkeypatch.setattr(penalty_path, "staged", lambda df, name, *more: stored.append(real(df, name, *more)) or stored[-1])
    rng = random.Random(8)
    texts = [([rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(12)] + [f"r{rng.randint(0, 400)}x" for _ in range(40)], i % 3) for i in range(60)]
    for words, _ in texts:
        rng.shuffle(words)
    texts += [([], 0), (["aa", "bb", "aa", "bb", "aa"] * 30, 1)]
    df = spark.createDataFrame([(" ".join(words) or None, f) for words, f in texts], "text string, fold int").repartition(3)
    found = penalty_path.fit_encoders(df, Inputs("text", [], [], {}), 3, 7, "fold")
    for f, encoder in found.items():
        known = [words for words, own in texts if own != f]
        for k in (1, 2, 3):
            grams = [[" ".join(words[i : i + n]) for n in range(1, k + 1) for i in range(len(words) - n + 1)] for words in known]
            tf = {g: sum(own.count(g) for own in grams) for g in {g for own in grams for g in own}}
            top = sorted(tf, key=lambda g: (-tf[g], g))[:7]
            assert encoder.terms[k] == top
            assert encoder.weights[k].tolist() == [math.log((len(known) + 1) / (sum(g in own for own in grams) + 1)) + 1 for g in top]
    pairs = {" ".join(words[i : i + 2]) for words, _ in texts for i in range(len(words) - 1)}
    assert (sum(df.where("term LIKE '% %'").count() for df in stored) < len(pairs) / 2) == (few is None)
