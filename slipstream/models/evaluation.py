"""Evaluation of scored rows (label 0/1, probability) as aggregations.

Everything except the curve points is a fixed number of sums, combined before the shuffle. Rank-based
measures first reduce the rows to counts per distinct score, then take running totals by score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.operators.scans import bin_index, ordered_scan, running_total


def thresholds(start: float, stop: float, step: float) -> list[float]:
    """Values from start up to, not including, stop."""
    out, i = [], 0
    while start + i * step < stop - 1e-12:
        out.append(start + i * step)
        i += 1
    return out


def evenly_spaced(start: float, stop: float, n: int) -> list[float]:
    return [start + (stop - start) * i / (n - 1) for i in range(n)]


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(2 * tp + fp + fn == 0, F.lit(0.0)).otherwise(2 * tp / (2 * tp + fp + fn))


def threshold_sweep(df: DataFrame, label: str, score: str, cuts: Sequence[float]) -> DataFrame:
    """Counts and F1 at each threshold, a row being positive when its score is at least the threshold.

    Rows are counted once by the number of thresholds they reach; the sweep is over those counts.
    """
    cuts = sorted(cuts)
    reached = bin_index(F.col(score), F.array(*[F.lit(float(t)) for t in cuts]), len(cuts))
    counted = df.groupBy(reached.alias("__reached")).agg(
        F.sum(F.col(label).cast("long")).alias("__pos"), F.count("*").alias("__all")
    )
    # at most one row per threshold, each spread to the thresholds at or below it
    grid = F.array(
        *[F.struct(F.lit(i + 1).alias("__i"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(cuts)]
    )
    return (
        counted.select("__reached", "__pos", "__all", F.inline(grid))
        .withColumn("__in", F.col("__reached") >= F.col("__i"))
        .groupBy("threshold")
        .agg(
            F.sum(F.when(F.col("__in"), F.col("__pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("__in"), F.col("__all") - F.col("__pos")).otherwise(0)).alias("fp"),
            F.sum(F.when(~F.col("__in"), F.col("__pos")).otherwise(0)).alias("fn"),
        )
        .withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the highest F1, the lowest threshold of equals."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Count and share of the total of each (label, prediction)."""
    counts = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # at most four rows


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and F1 of predicted classes, as one row."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    count = lambda c: F.sum(c.cast("long"))
    sums = df.agg(
        count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(~y & ~p).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.withColumns({"accuracy": (tp + tn) / (tp + fp + fn + tn), "f1": _f1(tp, fp, fn)})


def probability_metrics(df: DataFrame, label: str, score: str, clip: float = 1e-15) -> DataFrame:
    """Log loss and Brier score, as one row."""
    y, p = F.col(label), F.greatest(F.least(F.col(score), F.lit(1 - clip)), F.lit(clip))
    loss = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(F.avg(loss).alias("log_loss"), F.avg(F.pow(F.col(score) - y, F.lit(2.0))).alias("brier"))


def _by_score(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, spread: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, of each group of ``keys``; a tie counts half."""
    counts = _by_score(df, label, score, keys)
    ranked = ordered_scan(counts, keys, ["score"], {"__below": running_total(F.col("neg"))}, spread)
    beaten = F.col("pos") * (F.col("__below") - F.col("neg") / 2)
    return ranked.groupBy(*keys).agg(F.try_divide(F.sum(beaten), F.sum("pos") * F.sum("neg")).alias("auc"))


def roc_points(df: DataFrame, label: str, score: str, spread: bool = True) -> DataFrame:
    """False and true positive rate at each distinct score, taken as the threshold."""
    counts = _by_score(df, label, score).withColumn("__down", -F.col("score"))
    ranked = ordered_scan(
        counts, [], ["__down"], {"tp": running_total(F.col("pos")), "fp": running_total(F.col("neg"))}, spread
    )
    positives, negatives = (counts.agg(F.sum(c)).scalar() for c in ("pos", "neg"))
    return ranked.select(
        F.col("score").alias("threshold"), (F.col("fp") / negatives).alias("fpr"), (F.col("tp") / positives).alias("tpr")
    )


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and share of positives in equal bins of the score; empty bins are left out."""
    bin_no = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    return df.groupBy(bin_no.cast("int").alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(label).alias("share_positive"), F.count("*").alias("n")
    )


def rank_configurations(scores: DataFrame, config: str, score: str, largest: bool = True) -> DataFrame:
    """Mean and population deviation of fold scores per configuration, with the rank (ties share the best)."""
    table = scores.groupBy(config).agg(
        F.avg(score).alias("mean_test_score"), F.stddev_pop(score).alias("std_test_score")
    )
    by = F.desc("mean_test_score") if largest else F.asc("mean_test_score")
    return table.withColumn("rank_test_score", F.rank().over(Window.orderBy(by)))


def top_by_magnitude(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The ``k`` rows largest in absolute value, ties by name."""
    return df.orderBy(F.abs(value).desc(), name).limit(k)
