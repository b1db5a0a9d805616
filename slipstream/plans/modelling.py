"""The three modelling jobs on a model input table: split, search, refit, threshold, test metrics.

Input tables keep ``AttemptID`` (``model_variant(..., keep_id=True)``), which splits are drawn by. Nothing is
fitted on the test rows: rows are divided first. All encoders sit inside the cross-validated estimator. Search budgets are
arguments, with the sizes of the full jobs as defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.models import boosting, classifiers, embedding_net, evaluation, features, penalty_path
from slipstream.models.classifiers import LABEL, PROBABILITY
from slipstream.operators import reshape, sampling, statistics
from slipstream.session import staged

KEY, TARGET, STRATUM = "AttemptID", "Sikeres", "Stratify"
DRIVERS = ["Driver_Overtaker", "Driver_Passed"]
TEAMS = ["Team_Overtaker", "Team_Passed"]
PLACES = ["Location", "S1Description", "S2Description", "S3Description"]
TEXT = "TrackDescription"

#: What the searches draw from.
LINEAR_SPACE = {"strength": classifiers.log_uniform(1e-3, 1e2), "max_features": classifiers.choice(*range(50, 501, 10))}
TREE_SPACE = {
    "depth": classifiers.integer(3, 12),
    "step": classifiers.log_uniform(0.005, 0.3),
    "min_curvature": classifiers.integer(1, 15),
    "rows": classifiers.uniform(0.5, 0.5),
    "columns": classifiers.uniform(0.5, 0.5),
    "level_columns": classifiers.uniform(0.5, 0.5),
    "min_gain": classifiers.log_uniform(1e-4, 5.0),
    "l1": classifiers.log_uniform(1e-4, 10.0),
    "l2": classifiers.log_uniform(1e-3, 10.0),
}
NETWORK_SPACE = {
    "hidden": classifiers.choice((64,), (128,), (64, 32), (128, 64), (128, 64, 32)),
    "step": classifiers.log_uniform(1e-4, 1e-2),
    "optimizer": classifiers.choice("adam", "rmsprop"),
    "batch": classifiers.choice(32, 64, 128),
    "dropout": classifiers.uniform(0.1, 0.4),
    "l2": classifiers.log_uniform(1e-5, 1e-2),
}


@dataclass
class Result:
    """A fitted model with its search table, scored test rows and metrics."""

    model: object
    search: DataFrame
    predictions: DataFrame
    metrics: dict


def _divide(df: DataFrame, test_share: float, folds: int, fold_by: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Train rows with stratified folds and class weights, and test rows; stored, as every fit reads them."""
    labelled = df.withColumn(LABEL, F.col(TARGET).cast("double"))
    split = sampling.stratified_split(labelled, [STRATUM], KEY, test_share, seed, "__test")
    train = sampling.stratified_folds(split.where("__test = 0"), [fold_by], KEY, folds, seed)
    train = classifiers.with_class_weights(train.drop("__test"))
    return staged(train, "train"), staged(split.where("__test = 1").drop("__test"), "test")


def _numbers(df: DataFrame) -> list[str]:
    return reshape.numeric_columns(df, exclude=[TARGET, LABEL, "fold", classifiers.WEIGHT])


def _best_cut(scored: DataFrame, cuts: list[float]) -> float:
    return evaluation.best_threshold(evaluation.threshold_sweep(scored, LABEL, PROBABILITY, cuts)).head()["threshold"]


def score_metrics(scored: DataFrame, threshold: float) -> dict:
    """Threshold-bound and threshold-free measures of scored rows, one value each."""
    classed = scored.withColumn("__class", (F.col(PROBABILITY) >= threshold).cast("int"))
    row = evaluation.class_metrics(classed, LABEL, "__class").head()
    loss = evaluation.probability_metrics(scored, LABEL, PROBABILITY).head()
    return {
        "accuracy": row["accuracy"],
        "f1_score": row["f1"],
        "confusion_matrix": [[row["tn"], row["fp"]], [row["fn"], row["tp"]]],
        "auc": evaluation.roc_auc(scored, LABEL, PROBABILITY).head()[0],
        "binary_cross_entropy": loss["log_loss"],
        "brier_score": loss["brier"],
    }


def _search_metrics(table: DataFrame, name: str) -> dict:
    best = table.orderBy("rank_test_score", "config").limit(1).head()
    return {f"cv_{name}_mean": best["mean_test_score"], f"cv_{name}_std": best["std_test_score"]}


def _chosen(search_model, pipeline: Pipeline, smallest: bool = False) -> Pipeline:
    """The pipeline with the parameters that won the search."""
    means = list(search_model.avgMetrics)
    best = means.index(min(means) if smallest else max(means))
    return pipeline.copy(search_model.getEstimatorParamMaps()[best])


def _text_space(stages: list, most: int = 500) -> dict:
    """Draws of the vocabulary size and of the longest word n-gram, for the TF-IDF stages among these."""
    counts = next(s for s in stages if s.hasParam("vocabSize"))
    space = {counts.vocabSize: classifiers.choice(*range(50, most + 1, 10))}
    joined = next((s for s in stages if s.hasParam("statement")), None)
    if joined is not None:
        space[joined.statement] = classifiers.choice(*features.ngram_statements("tfidf", joined.getStatement()))
    return space


def linear_job(
    df: DataFrame, n: int = 300, folds: int = 5, max_ngram: int = 3, limit: float = 10.0, seed: int = 42
) -> Result:
    """Logistic regression on columns that pass the inflation test, rare drivers pooled, track text as TF-IDF.

    The penalty, the size of the vocabulary and the longest n-gram, up to ``max_ngram``, are searched; all settings and folds are fitted in the
    same passes. The threshold is the best F1 of out-of-fold scores on the train rows.
    """
    df = df.dropna(subset=[TEXT, *DRIVERS, *TEAMS, TARGET])
    train, test = _divide(df, 0.2, folds, TARGET, seed)
    kept = [r["Feature"] for r in statistics.prune_by_inflation(train, _numbers(train), limit).collect()]
    train, test = (d.dropna(subset=kept) for d in (train, test))
    inputs = penalty_path.Inputs(TEXT, kept, [*DRIVERS, *TEAMS], {c: 0.02 for c in DRIVERS})
    space = LINEAR_SPACE | {"ngrams": classifiers.integer(1, max_ngram + 1)}
    drawn = [penalty_path.Linear(**c) for c in classifiers.draw_configurations(space, n, seed)]
    best, table, by_fold = penalty_path.search(train, drawn, inputs, folds=folds, label=LABEL, weight=classifiers.WEIGHT)
    outside = None
    for f, model in enumerate(by_fold):
        part = classifiers.scored(model, train.where(F.col("fold") == f))
        outside = part if outside is None else outside.unionByName(part)
    cut = _best_cut(outside, evaluation.evenly_spaced(0.3, 0.7, 101))
    model = penalty_path.fit_many(train, [best], inputs, label=LABEL, weight=classifiers.WEIGHT)[0]
    scored = classifiers.scored(model, test)
    metrics = {
        **classifiers.model_size(model),
        **_search_metrics(table, "f1"),
        "best_threshold": cut,
        **score_metrics(scored, cut),
    }
    return Result(model, table, scored, metrics)


def trees_job(
    df: DataFrame, n: int = 600, folds: int = 5, trees: int = 300, most_trees: int = 2000, text_n: int = 20, patience: int = 40, seed: int = 42
) -> Result:
    """Second-order boosted trees on native categories, with the track text as one out-of-fold probability.

    Depth, step, least curvature of a leaf, shares of rows and columns, least gain and both penalties are searched. The winner is
    refitted with up to ``most_trees`` trees, until its loss on a 15% slice has not fallen for ``patience`` of them; the trees up to the best
    one are kept. The best threshold of that slice is reported; classes use 0.5.
    """
    train, test = _divide(df, 0.2, folds, STRATUM, seed)
    rows = train.count()
    text_stages = features.feature_stages(text=TEXT, max_ngram=2)
    text_model = Pipeline(stages=[*text_stages, classifiers.logistic(1.0, rows, weighted=False, maxIter=50)])
    strength = classifiers.log_uniform(1e-3, 1e2)
    text_space = {text_model.getStages()[-1].regParam: lambda rng: 1.0 / (strength(rng) * rows), **_text_space(text_stages)}
    searched, _ = classifiers.random_search(train, text_model, text_space, text_n, folds=folds, scoring="roc_auc", seed=seed)
    text_model = _chosen(searched, text_model)
    train, test = classifiers.stacked_text(train, test, text_model, "TrackDesc_LR", folds=folds)
    train, test = staged(train, "train-stacked"), staged(test, "test-stacked")
    numbers = _numbers(train)
    categories = [*DRIVERS, *TEAMS]
    drawn = [boosting.Settings(trees=trees, seed=seed, **c) for c in classifiers.draw_configurations(TREE_SPACE, n, seed)]
    best, table = boosting.search(train, drawn, numbers, categories, KEY, folds=folds, label=LABEL)

    sliced = sampling.stratified_split(train, [STRATUM], KEY, 0.15, seed + 1, "__held")
    sliced = staged(sliced.withColumn("__held", F.col("__held") == 1), "train-sliced")
    winner = replace(best, trees=most_trees, patience=patience)
    model = boosting.fit(sliced, winner, numbers, categories, key=KEY, label=LABEL, held="__held")
    cut = _best_cut(classifiers.scored(model, sliced.where("__held")), evaluation.thresholds(0.35, 0.65, 0.01))
    scored = classifiers.scored(model, test)
    metrics = {
        **classifiers.model_size(model),
        **_search_metrics(table, "auc"),
        "best_round": model.best_round,
        "best_validation_log_loss": min(model.losses),
        "best_threshold": cut,
        **score_metrics(scored, 0.5),
    }
    return Result(model, table, scored, metrics)


def network_job(df: DataFrame, n: int = 100, folds: int = 3, search_epochs: int = 50, epochs: int = 100, seed: int = 42) -> Result:
    """Entity-embedding network on scaled numbers and categories; the threshold is the best F1 of a 15% slice.

    Layers, step, optimizer, batch, dropout and penalty are searched, with stopping after 5 epochs without a smaller loss. The winner
    is trained again until its loss on the slice has not fallen for 10 epochs; its step is halved on plateaus.
    """
    train, test = _divide(df, 0.15, folds, STRATUM, seed)
    # codes come from the rows of each fit, with one place for levels unseen in them
    inputs = penalty_path.Inputs(None, _numbers(train), [*DRIVERS, *TEAMS, *PLACES], {})
    drawn = [embedding_net.Network(epochs=search_epochs, patience=5, seed=seed, **c) for c in classifiers.draw_configurations(NETWORK_SPACE, n, seed)]
    best, table, accuracy = embedding_net.search(train, drawn, inputs, folds=folds, label=LABEL)
    sliced = sampling.stratified_split(train, [STRATUM], KEY, 0.15, seed + 1, "__held")
    sliced = staged(sliced.withColumn("__held", F.col("__held") == 1), "train-sliced")
    model = embedding_net.fit_many(sliced, [replace(best, epochs=epochs, patience=10, plateau=2)], inputs, label=LABEL, held="__held")[0]
    cut = _best_cut(classifiers.scored(model, sliced.where("__held")), evaluation.thresholds(0.35, 0.65, 0.025))
    scored = classifiers.scored(model, test)
    metrics = {
        **classifiers.model_size(model),
        **_search_metrics(table, "log_loss"),
        "cv_accuracy_mean": accuracy[0],
        "cv_accuracy_std": accuracy[1],
        "best_epoch": model.best_epoch,
        "best_threshold": cut,
        **score_metrics(scored, cut),
    }
    return Result(model, table, scored, metrics)
