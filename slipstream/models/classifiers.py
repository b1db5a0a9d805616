"""Classifiers on Spark ML: definitions, random search, out-of-fold scores, sizes and importances.

Training is distributed by Spark ML. The network is a multilayer perceptron on scaled numbers and
one-hot categories (a one-hot vector times a dense layer is an embedding); it has neither dropout nor
class weights.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.models import evaluation
from slipstream.models.boosting import Booster
from slipstream.models.embedding_net import NetworkModel
from slipstream.models.features import feature_names
from slipstream.models.penalty_path import LinearModel
from slipstream.operators.sampling import class_weights, permuted
from slipstream.session import staged

LABEL, WEIGHT, PROBABILITY = "label", "weight", "p"


def logistic(strength: float = 1.0, rows: int = 1, l1: float = 0.0, weighted: bool = True, **more) -> LogisticRegression:
    """Logistic regression; ``strength`` is the inverse penalty, so regParam is 1 / (strength * rows)."""
    if weighted:
        more["weightCol"] = WEIGHT
    # the penalty is on the columns as they come: numbers are scaled before, TF-IDF and one-hot columns are not
    more.setdefault("standardization", False)
    return LogisticRegression(labelCol=LABEL, regParam=1.0 / (strength * rows), elasticNetParam=l1, **more)


def naive_bayes(alpha: float = 1.0) -> NaiveBayes:
    return NaiveBayes(labelCol=LABEL, modelType="multinomial", smoothing=alpha)


def boosted_trees(trees: int = 300, validation: str | None = None, tolerance: float = 1e-4, **more) -> GBTClassifier:
    """Boosted trees on indexed categories; with ``validation`` a true/false column stops the boosting early.

    The tolerance is set in any case, so that it holds when a validation column is named later.
    """
    if validation is not None:
        more["validationIndicatorCol"] = validation
    return GBTClassifier(labelCol=LABEL, maxIter=trees, validationTol=tolerance, **more)


class EncodedNetwork(Estimator):
    """Encoders and a perceptron fitted together: the width of the network follows from the rows it is fitted on.

    Inside a cross-validation no encoder has seen the held-out fold. The solver is gradient descent, the one whose step size
    acts.
    """

    hidden = Param(Params._dummy(), "hidden", "units of the hidden layers", TypeConverters.toListInt)
    stepSize = Param(Params._dummy(), "stepSize", "step of the descent", TypeConverters.toFloat)
    blockSize = Param(Params._dummy(), "blockSize", "rows in a batch", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "steps of the descent", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the weights", TypeConverters.toInt)

    def __init__(self, stages: Sequence = (), **values):
        super().__init__()
        self._stages = list(stages)
        self._setDefault(hidden=[64, 32], stepSize=0.03, blockSize=128, maxIter=100, seed=42)
        self._set(**values)

    def copy(self, extra=None):
        found = super().copy(extra)
        found._stages = self._stages
        return found

    def _fit(self, df: DataFrame) -> PipelineModel:
        encode = Pipeline(stages=self._stages).fit(df)
        coded = encode.transform(df)
        width = coded.schema["features"].metadata["ml_attr"]["num_attrs"]
        value = self.getOrDefault
        net = MultilayerPerceptronClassifier(
            labelCol=LABEL,
            layers=[width, *value(self.hidden), 2],
            solver="gd",
            stepSize=value(self.stepSize),
            blockSize=value(self.blockSize),
            maxIter=value(self.maxIter),
            seed=value(self.seed),
        )
        return PipelineModel([*encode.stages, net.fit(coded)])


def with_class_weights(df: DataFrame, label: str = LABEL, mode: str = "balanced") -> DataFrame:
    """Add the class weight of each row; there are two classes."""
    weights = class_weights(df, label, mode).select(F.col(label).alias("__label"), F.col("weight").alias(WEIGHT))
    return df.join(F.broadcast(weights), F.col(label) == F.col("__label")).drop("__label")


def _prepared(pipeline: Pipeline, df: DataFrame, kept: Sequence[str], searched: Sequence = ()) -> tuple[list, Pipeline, DataFrame]:
    """The leading stages on words, which learn nothing, the pipeline of all others, and the rows that the first ones give, stored.

    Texts are cut into words once, however many fits and passes follow. Of the rows the ``kept`` columns stay, and what the others
    take; a stage with a ``searched`` param is no leading one.
    """
    stages, owners = pipeline.getStages(), {p.parent for p in searched}
    n = next((i for i, s in enumerate(stages) if isinstance(s, (Estimator, VectorAssembler)) or s.uid in owners), len(stages))
    if not n:
        return [], pipeline, df
    first, rest = stages[:n], stages[n:]
    taken = set(kept)
    for stage in rest:
        taken |= {stage.getOrDefault("inputCol")} if stage.hasParam("inputCol") and stage.isDefined("inputCol") else set()
        taken |= set(stage.getOrDefault("inputCols")) if stage.hasParam("inputCols") and stage.isDefined("inputCols") else set()
    if any(not s.hasParam("inputCol") and not s.hasParam("inputCols") and not s.hasParam("featuresCol") for s in rest):
        taken = None  # a stage that doesn't name what it takes
    rows = PipelineModel(first).transform(df)
    return first, Pipeline(stages=rest), staged(rows if taken is None else rows.select(*[c for c in rows.columns if c in taken]), "words")


def fitted(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """The same model as ``pipeline.fit``, for which texts are cut into words once."""
    first, rest, rows = _prepared(pipeline, df, df.columns)
    return PipelineModel([*first, *rest.fit(rows).stages])


def scored(model, df: DataFrame) -> DataFrame:
    """Class and probability of the positive class for each row."""
    if isinstance(model, (Booster, LinearModel, NetworkModel)):
        return model.score(df, PROBABILITY).withColumn("prediction", (F.col(PROBABILITY) >= 0.5).cast("double"))
    return model.transform(df).withColumn(PROBABILITY, vector_to_array("probability")[1])


# --- random search -----------------------------------------------------------------------------


def log_uniform(low: float, high: float) -> Callable:
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


def uniform(low: float, width: float) -> Callable:
    return lambda rng: rng.uniform(low, low + width)


def integer(low: int, high: int) -> Callable:
    """An integer from low up to, not including, high."""
    return lambda rng: rng.randrange(low, high)


def choice(*values) -> Callable:
    return lambda rng: rng.choice(values)


def draw_configurations(space: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` seeded draws, each key of ``space`` drawn independently."""
    rng = random.Random(seed)
    return [{key: draw(rng) for key, draw in space.items()} for _ in range(n)]


def evaluator(scoring: str):
    """``f1`` of the positive class, ``roc_auc``, ``accuracy`` or ``log_loss``."""
    if scoring == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC", numBins=0)
    names = {"f1": "fMeasureByLabel", "accuracy": "accuracy", "log_loss": "logLoss"}
    return MulticlassClassificationEvaluator(labelCol=LABEL, metricName=names[scoring], metricLabel=1.0)


def random_search(
    df: DataFrame,
    pipeline: Pipeline,
    space: dict,
    n: int,
    fold: str = "fold",
    folds: int = 5,
    scoring: str = "roc_auc",
    parallelism: int = 4,
    seed: int = 42,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Cross-validate ``n`` drawn configurations on the given folds; the refitted best, and the table.

    ``space`` maps Spark ML params of the pipeline's stages to draws.
    """
    grid = draw_configurations(space, n, seed)
    unread = {s.getOrDefault("inputCol") for s in pipeline.getStages()[:1] if s.hasParam("inputCol")}
    first, rest, rows = _prepared(pipeline, df, [c for c in df.columns if c not in unread], list(space))
    search = CrossValidator(
        estimator=rest,
        estimatorParamMaps=grid,
        evaluator=evaluator(scoring),
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
        seed=seed,
    )
    best = search.fit(rows)
    best.bestModel = PipelineModel([*first, *best.bestModel.stages])
    rows = [
        (i, "; ".join(f"{p.name}={v}" for p, v in sorted(grid[i].items(), key=lambda e: e[0].name)), float(m), float(s))
        for i, (m, s) in enumerate(zip(best.avgMetrics, best.stdMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "config int, params string, mean_test_score double, std_test_score double"
    )
    by = F.asc("mean_test_score") if scoring == "log_loss" else F.desc("mean_test_score")
    return best, table.withColumn("rank_test_score", F.rank().over(Window.orderBy(by)))  # one row per configuration


# --- out-of-fold scores ------------------------------------------------------------------------


def out_of_fold(df: DataFrame, pipeline: Pipeline, fold: str = "fold", folds: int = 5) -> DataFrame:
    """Every row scored by a model that did not see its fold."""
    _, rest, rows = _prepared(pipeline, df, df.columns)
    return _out_of_fold(df, rest, rows, fold, folds)


def _out_of_fold(df: DataFrame, pipeline: Pipeline, rows: DataFrame, fold: str, folds: int) -> DataFrame:
    parts = None
    for f in range(folds):
        model = pipeline.fit(rows.where(F.col(fold) != f))
        part = scored(model, rows.where(F.col(fold) == f)).select(*df.columns, PROBABILITY)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def stacked_text(
    train: DataFrame, test: DataFrame, pipeline: Pipeline, out: str, fold: str = "fold", folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """A text model's probability as one number: out of fold on train, from the full fit on test."""
    first, rest, rows = _prepared(pipeline, train, train.columns)
    inside = _out_of_fold(train, rest, rows, fold, folds).withColumnRenamed(PROBABILITY, out)
    outside = scored(PipelineModel([*first, *rest.fit(rows).stages]), test).select(*test.columns, F.col(PROBABILITY).alias(out))
    return inside, outside


# --- sizes and importances ---------------------------------------------------------------------


def model_size(model: PipelineModel) -> dict[str, int]:
    """Learned parameters: coefficients and intercept, leaves and splits, or network weights."""
    if isinstance(model, (Booster, LinearModel, NetworkModel)):
        return model.size()
    last = model.stages[-1]
    if hasattr(last, "trees"):
        nodes = [t.numNodes for t in last.trees]
        leaves = sum((n + 1) // 2 for n in nodes)
        return {"leaves": leaves, "splits": sum(nodes) - leaves, "parameters": sum(nodes)}
    if hasattr(last, "layers"):
        return {"parameters": len(last.weights)}
    return {"parameters": last.numFeatures + 1}


def importance(model: PipelineModel, df: DataFrame, sign: str = "elojel") -> DataFrame:
    """Signed coefficients, or for trees the gain of each feature, by feature name.

    ``sign`` names the column of the sign; the default is a fixed value, the report's own name.
    """
    if isinstance(model, (Booster, LinearModel)):
        table = model.importance(df)
    else:
        last = model.stages[-1]
        names = feature_names(model, model.transform(df.limit(0)))
        values = last.featureImportances.toArray() if hasattr(last, "trees") else last.coefficients.toArray()
        rows = [(n, float(v)) for n, v in zip(names, values)]
        table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return table.withColumn(sign, F.when(F.col("coefficient") >= 0, "positive").otherwise("negative"))


def permutation_importance(
    model, df: DataFrame, key: str, features: Sequence[str], seed: int = 42, spread: bool = True
) -> DataFrame:
    """Loss of AUC when one input column is shuffled, for each column.

    A shuffle is an exact permutation by a seeded bijection of row numbers. One join shuffles all columns; each scoring uses
    one of them.
    """
    paired = staged(permuted(df, key, features, "__other", seed, spread), "shuffled-columns")
    base = evaluation.roc_auc(scored(model, paired), LABEL, PROBABILITY)
    drops = None
    for f in features:
        mixed = paired.withColumn(f, F.col(f"__other.{f}"))
        drop = evaluation.roc_auc(scored(model, mixed), LABEL, PROBABILITY).select(F.lit(f).alias("Feature"), "auc")
        drops = drop if drops is None else drops.unionByName(drop)
    return drops.select("Feature", (base.scalar() - F.col("auc")).alias("Importance"))
