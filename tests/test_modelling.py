"""The three modelling jobs end to end with the smallest budgets."""

import pytest
from pyspark.sql import functions as F

from slipstream.models import classifiers
from slipstream.plans import modelling
from slipstream.sources import sinks


@pytest.fixture(scope="module")
def table(spark):
    """Attempts whose outcome leans on one gap."""
    return spark.range(240).selectExpr(
        "concat('a', id) AS AttemptID", "CAST(id * 7919 % 100 + id % 3 * 25 > 80 AS INT) AS Sikeres", "2018 + CAST(id % 8 AS INT) AS Season",
        "(id * 7919 % 100) / 50D AS DeltaLapTime_1", "(id * 104729 % 97) / 40D AS DeltaLapTime_2",
        "concat('D', id % 6) AS Driver_Overtaker", "concat('D', id % 7) AS Driver_Passed", "concat('T', id % 3) AS Team_Overtaker",
        "concat('T', id % 4) AS Team_Passed", "concat('P', id % 5) AS Location", "concat('s', id % 2) AS S1Description",
        "'fast' AS S2Description", "'slow' AS S3Description", "concat('track number ', id % 5, ' fast corner') AS TrackDescription",
    ).withColumn("Stratify", F.concat_ws("_", "Sikeres", (F.col("Season") >= 2022).cast("int")))


def check(result, tmp_path, spark):
    m = result.metrics
    assert 0 <= m["auc"] <= 1 and 0 <= m["brier_score"] <= 1 and m["parameters"] > 0
    assert sum(map(sum, m["confusion_matrix"])) == result.predictions.count() > 0
    assert result.search.count() == 1
    sinks.write_metrics(spark, m, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).head()["auc"] == pytest.approx(m["auc"])


def test_linear(spark, table, tmp_path):
    result = modelling.linear_job(table, n=1, folds=2)
    check(result, tmp_path, spark)
    names = {r["feature"] for r in classifiers.importance(result.model, result.predictions).collect()}
    assert "DeltaLapTime_1" in names and any(n.startswith("tfidf_") for n in names)


def test_trees(spark, table, tmp_path):
    result = modelling.trees_job(table, n=1, folds=2, trees=3, most_trees=12, text_n=1, patience=3)
    check(result, tmp_path, spark)
    model = result.model
    assert len(model.trees) == model.losses.index(min(model.losses)) == result.metrics["best_round"] > 0
    assert {r["feature"] for r in classifiers.importance(model, table).collect()} >= {"TrackDesc_LR", "Driver_Passed"}


def test_network(spark, table, tmp_path):
    result = modelling.network_job(table, n=1, folds=2, search_epochs=3, epochs=10)
    check(result, tmp_path, spark)
    assert 0 < result.metrics["best_epoch"] <= 10 and 0 <= result.metrics["cv_accuracy_mean"] <= 1


def test_draws_of_the_step_size_act(spark, table):
    """Two draws that differ in the step alone give different networks."""
    from slipstream.models import features

    df = table.withColumn("label", F.col("Sikeres").cast("double"))
    stages = features.feature_stages(["DeltaLapTime_1", "DeltaLapTime_2"], ["Location"])
    fitted = [classifiers.EncodedNetwork(stages, hidden=[4], maxIter=5, stepSize=s).fit(df).stages[-1].weights for s in (0.001, 0.1)]
    assert fitted[0] != fitted[1]


def test_encoders_are_fitted_with_the_network(spark, table):
    """A level that a fit has not seen widens neither its codes nor its network."""
    from slipstream.models import features

    df = table.withColumn("label", F.col("Sikeres").cast("double"))
    net = classifiers.EncodedNetwork(features.feature_stages([], ["Location"]), hidden=[4], maxIter=2)
    some, every = net.fit(df.where("Location <> 'P4'")), net.fit(df)
    assert some.stages[-1].getLayers()[0] + 1 == every.stages[-1].getLayers()[0]
    assert some.transform(df).count() == df.count()


def test_penalty_is_not_in_units_of_deviation():
    assert not classifiers.logistic().getStandardization()
