"""Evaluation against brute force, leakage rules, repeatable draws and imputation."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F

from slipstream.functions import encoders
from slipstream.models import classifiers, evaluation, features
from slipstream.operators import sampling, statistics


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(2), round(rng.random(), 2)) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id long, y int, p double").cache()


@pytest.mark.parametrize("spread", [False, True])
def test_auc_counts_pairs(scored, spread):
    rows, df = scored
    pos, neg = ([p for _, y, p in rows if y == v] for v in (1, 0))
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert evaluation.roc_auc(df, "y", "p", spread).head()[0] == pytest.approx(want)
    points = evaluation.roc_points(df, "y", "p", spread).orderBy("threshold").collect()
    assert points[0]["fpr"] == points[0]["tpr"] == 1.0
    t = points[40]["threshold"]
    assert points[40]["tpr"] == pytest.approx(sum(p >= t for p in pos) / len(pos))


def test_threshold_sweep(scored):
    rows, df = scored
    cuts = evaluation.thresholds(0.35, 0.65, 0.01)
    assert len(cuts) == 30
    for r in evaluation.threshold_sweep(df, "y", "p", cuts).collect():
        assert r["tp"] == sum(y == 1 and p >= r["threshold"] for _, y, p in rows)
        assert r["fp"] == sum(y == 0 and p >= r["threshold"] for _, y, p in rows)


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' ELSE 'common' END AS s")
    split = sampling.stratified_split(df, ["s"], "id", 0.25)
    assert {(r["s"], r["n"]) for r in split.groupBy("s").agg(F.sum("is_test").alias("n")).collect()} == {("rare", 25), ("common", 225)}
    again = sampling.stratified_split(df.repartition(7), ["s"], "id", 0.25)
    assert split.exceptAll(again).count() == 0
    folds = sampling.stratified_folds(df, ["s"], "id", 3).groupBy("s", "fold").count().collect()
    sizes = {s: sorted(r["count"] for r in folds if r["s"] == s) for s in ("rare", "common")}
    assert sizes == {"rare": [33, 33, 34], "common": [300, 300, 300]}


def test_draws_are_seeded():
    space = {"c": classifiers.log_uniform(1e-3, 1e2), "d": classifiers.integer(3, 12), "s": classifiers.choice("a", "b")}
    first, second = (classifiers.draw_configurations(space, 50, seed=1) for _ in range(2))
    assert first == second != classifiers.draw_configurations(space, 50, seed=2)
    assert all(1e-3 <= c["c"] <= 1e2 and 3 <= c["d"] < 12 for c in first)


def test_target_encoding_leaves_its_fold_out(spark):
    rows = [(i, "ab"[i % 2], int(i % 3 == 0), i % 5) for i in range(60)] + [(100, "c", 1, 0)]
    df = spark.createDataFrame(rows, "id long, level string, y int, fold int")
    test = spark.createDataFrame([(1, "a"), (2, "new")], "id long, level string")
    train, held = encoders.target_encode(df, "level", "y", "fold", "te", smooth=0.0, test=test)
    got = {r["id"]: r["te"] for r in train.collect()}
    outside = [y for _, lv, y, f in rows if lv == "a" and f != 0]
    assert got[0] == pytest.approx(sum(outside) / len(outside))
    others = [y for _, _, y, f in rows if f != 0]
    assert got[100] == pytest.approx(sum(others) / len(others))  # its level exists in its own fold only
    assert held.count() == 2 and held.where("te IS NULL").count() == 0


def test_inflation(spark):
    df = spark.range(200).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id * 7 % 31 AS DOUBLE) AS b", "2D * id + id * 7 % 31 AS c")
    factors = {r["Feature"]: r["VIF"] for r in statistics.variance_inflation(df, ["a", "b", "c"]).collect()}
    assert all(v == float("inf") for v in factors.values())
    kept = {r["Feature"]: r["VIF"] for r in statistics.prune_by_inflation(df, ["a", "b", "c"]).collect()}
    assert set(kept) == {"b", "c"} and max(kept.values()) <= 10


def test_imputation_takes_observed_values(spark):
    df = spark.range(200).selectExpr("id", "CAST(id AS DOUBLE) AS x", "CASE WHEN id % 9 <> 0 THEN 3D * id END AS y")
    got = statistics.impute_by_matching(df, "id", "y", ["x"], draws=1)
    assert got.where("y IS NULL").count() == 0
    for r in got.where("id % 9 = 0").collect():
        assert r["y"] % 3 == 0 and abs(r["y"] - 3 * r["id"]) <= 3 * 6
    limited = statistics.impute_by_matching(df, "id", "y", ["x"], where=F.col("id") < 50)
    assert limited.where("y IS NULL").count() == df.where("y IS NULL AND id >= 50").count()


def test_imputation_by_the_predictors_that_are_known(spark):
    """Rows lacking any of the predictors are filled by a model of their own, each from the donors nearest to it."""
    import numpy as np

    rng = random.Random(8)
    rows = []
    for i in range(500):
        a, b = rng.uniform(-3, 3), rng.choice([0.0, 1.0, 2.0])
        y = 10 * a + 100 * b + rng.gauss(0, 0.01)
        rows.append((i, None if i % 5 == 1 else a, None if i % 7 == 2 else b, None if i % 4 == 0 else y, y))
    rows += [(1000, None, None, None, 0.0), (1001, None, None, None, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double, truth double").repartition(4)
    got = {r["id"]: r for r in statistics.impute_by_matching(df, "id", "y", ["a", "b"], draws=4).collect()}
    assert len(got) == len(rows) and all(r["y"] is not None for r in got.values())
    assert got == {r["id"]: r for r in statistics.impute_by_matching(df.repartition(2), "id", "y", ["a", "b"], draws=4).collect()}
    whole = [r for r in got.values() if r["id"] % 4 == 0 and r["a"] is not None and r["b"] is not None]
    assert len(whole) > 50 and max(abs(r["y"] - r["truth"]) for r in whole) < 12  # the nearest donors are close
    by_b = [r for r in got.values() if r["id"] % 4 == 0 and r["id"] < 1000 and r["a"] is None and r["b"] is not None]
    assert by_b and max(abs(r["y"] - 100 * r["b"]) for r in by_b) < 45
    # the models are least squares over the rows that hold their predictors
    base = df.selectExpr("y", "true AS wanted", "a AS x0", "b AS x1", "IF(a IS NULL, 0, 1) + IF(b IS NULL, 0, 2) AS pattern")
    models = statistics.matching_models(base, 2, 3, 5)
    assert models.used == {p: p for p in range(4)}
    for own, columns in ((3, (1, 2)), (1, (1,)), (2, (2,)), (0, ())):
        known = [r for r in rows if r[3] is not None and all(r[c] is not None for c in columns)]
        x = np.array([[1.0, *(r[c] - models.means[c - 1] for c in columns)] for r in known])
        want = np.linalg.lstsq(x, np.array([r[3] for r in known]), rcond=None)[0]
        assert np.allclose(models.fitted[own][[0, *columns]], want, rtol=1e-3, atol=0.2)
        assert models.drawn[own].shape == (3, 3) and not np.array_equal(models.drawn[own][0], models.drawn[own][1])


def test_plan_of_imputation_does_not_hold_the_coefficients(spark, monkeypatch):
    """Eight patterns of known predictors with ten draws each: the models are read as rows, not written out at every use."""
    texts, keep = {}, statistics.staged

    def noted(df, name):
        texts[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(statistics, "staged", noted)
    xs = [f"CASE WHEN id % {5 + i} <> {i} THEN id * {i + 3} % 17 + 0.5D END AS x{i}" for i in range(3)]
    df = spark.range(600).selectExpr("id", *xs, "CASE WHEN id % 4 <> 0 THEN 3D * id END AS y")
    got = statistics.impute_by_matching(df, "id", "y", ["x0", "x1", "x2"])
    assert got.where("y IS NULL").count() == 0
    assert len(texts["ranked"]) < 60_000


def test_imputation_without_common_donors(spark):
    rows = [(1, 1.0, None, 5.0), (2, None, 2.0, 6.0), (3, 1.0, 2.0, None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    got = {r["id"]: r["y"] for r in statistics.impute_by_matching(df, "id", "y", ["a", "b"]).collect()}
    assert got[3] is not None and 5.0 <= got[4] <= 6.0
    nothing = df.withColumn("y", F.lit(None).cast("double"))
    assert statistics.impute_by_matching(nothing, "id", "y", ["a", "b"]).where("y IS NOT NULL").count() == 0


def test_tfidf_formula(spark):
    import math

    df = spark.createDataFrame([("slow corner",), ("fast corner corner",)], "t string")
    stages = features.tfidf_stages("t", "v", max_features=10, max_ngram=2, stop_words=False)
    model = Pipeline(stages=stages).fit(df)
    counts = next(s for s in model.stages if hasattr(s, "vocabulary"))
    row = model.transform(df).where("t LIKE 'slow%'").head()["v"].toArray()
    weights = {w: row[i] for i, w in enumerate(counts.vocabulary)}
    rare, common = math.log(3 / 2) + 1, 1.0
    length = math.sqrt(2 * rare**2 + common**2)
    assert weights["slow"] == pytest.approx(rare / length) and weights["corner"] == pytest.approx(common / length)
    assert "slow corner" in weights and weights["corner corner"] == 0


def test_out_of_fold_scores_cover_every_row(spark):
    df = spark.range(120).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS label", "CAST(id % 2 * 3 + id % 5 AS DOUBLE) AS x", "CAST(id % 3 AS INT) AS fold")
    pipeline = Pipeline(stages=[*features.feature_stages(["x"]), classifiers.logistic(rows=80, weighted=False, maxIter=10)])
    got = classifiers.out_of_fold(df, pipeline, folds=3)
    assert got.count() == 120 and got.where("p < 0 OR p > 1").count() == 0
    assert classifiers.model_size(pipeline.fit(df)) == {"parameters": 2}


def test_rare_levels_share_a_bucket(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 97 THEN 'often' ELSE concat('r', id) END AS d")
    fitted = encoders.fit_frequent(df, "d", 0.02)
    new = spark.createDataFrame([("often",), ("unseen",), (None,)], "d string")
    assert [r["o"] for r in encoders.apply_frequent(new, fitted, "d", "o").orderBy(F.desc("o")).collect()] == ["often", encoders.INFREQUENT, encoders.INFREQUENT]


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    rows = [(i, "good fast lap" if i % 3 else "bad slow lap", float(i % 3 > 0), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, label double, fold int")
    pipeline = Pipeline(stages=[*features.feature_stages(text="text", max_ngram=2), classifiers.logistic(weighted=False, maxIter=5)])
    plain = {r["id"]: r["p"] for r in classifiers.scored(pipeline.fit(df), df).collect()}
    cuts, cut = [], RegexTokenizer._transform
    monkeypatch.setattr(RegexTokenizer, "_transform", lambda self, rows: cuts.append(1) or cut(self, rows))
    last = pipeline.getStages()[-1]
    best, table = classifiers.random_search(df, pipeline, {last.regParam: classifiers.choice(0.1, 0.01)}, n=2, folds=2)
    assert len(cuts) == 1 and table.count() == 2
    assert classifiers.out_of_fold(df, pipeline, folds=2).count() == 40 and len(cuts) == 2
    model = classifiers.fitted(pipeline, df)
    assert len(cuts) == 3
    assert {r["id"]: r["p"] for r in classifiers.scored(model, df).collect()} == pytest.approx(plain)
    assert best.bestModel.transform(df).count() == 40
