"""Encoders that are fitted by aggregation and applied by joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.operators.scans import numbered

INFREQUENT = "__infrequent__"


def fit_scaler(df: DataFrame, columns: Sequence[str], sample: bool = False) -> DataFrame:
    """One row with the mean and deviation of each column; population deviation unless ``sample``."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    aggs = [f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("sd", deviation))]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subtract the mean and divide by the deviation; a constant column is only centred."""
    joined = df.withColumn("__fit", fitted.select(F.struct("*")).scalar())
    scaled = {
        c: F.expr(f"(`{c}` - __fit.`__mean_{c}`) / CASE WHEN __fit.`__sd_{c}` = 0 THEN 1 ELSE __fit.`__sd_{c}` END")
        for c in columns
    }
    return joined.withColumns(scaled).select(*df.columns)


def fit_frequent(df: DataFrame, column: str, min_frequency: float = 0.02) -> DataFrame:
    """Levels with at least ``min_frequency`` of the rows: at most 1 / min_frequency of them."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*")).scalar()
    # the kept levels are few whatever the data holds
    kept = counts.where(F.col("__n") >= total * min_frequency)
    return kept.select(F.col(column).alias("__level"))


def apply_frequent(df: DataFrame, fitted: DataFrame, column: str, out: str) -> DataFrame:
    """Keep frequent levels; rare and unseen ones become one bucket."""
    # bounded by 1 / min_frequency rows, so a broadcast is always small
    joined = df.join(F.broadcast(fitted), F.col(column) == F.col("__level"), "left")
    return joined.withColumn(out, F.coalesce("__level", F.lit(INFREQUENT))).drop("__level")


def fit_ordinal(df: DataFrame, column: str, spread: bool = True) -> DataFrame:
    """Code of each level in alphabetical order, from 1."""
    levels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("__level")).distinct()
    return numbered(levels, [], ["__level"], "__code", spread)


def apply_ordinal(df: DataFrame, fitted: DataFrame, column: str, out: str) -> DataFrame:
    """Code of the level; 0 is kept for levels not seen when fitting."""
    joined = df.join(fitted, F.col(column) == F.col("__level"), "left")
    return joined.withColumn(out, F.coalesce("__code", F.lit(0))).drop("__level", "__code")


def _smoothed(n: Column, s: Column, all_n: Column, all_s: Column, smooth: float | str) -> Column:
    """Level mean shrunk towards the overall mean; the label is 0 or 1."""
    mean, overall = s / n, all_s / all_n
    if smooth == "auto":
        within, between = mean * (1 - mean), overall * (1 - overall)
        share = between * n / (between * n + within)
        blended = share * mean + (1 - share) * overall
    else:
        blended = (s + overall * smooth) / (n + smooth)
    return F.when(n > 0, F.coalesce(blended, mean)).otherwise(overall)


def target_encode(
    df: DataFrame,
    column: str,
    label: str,
    fold: str,
    out: str,
    smooth: float | str = "auto",
    test: DataFrame | None = None,
):
    """Out-of-fold target means of a 0/1 label: each row is encoded without its own fold.

    Everything comes from one aggregate per (level, fold). With ``test`` a second frame is returned,
    encoded by the mean over the fold encoders.
    """
    cells = df.groupBy(F.col(column).alias("__level"), F.col(fold).alias("__fold")).agg(
        F.count("*").alias("__n"), F.sum(label).alias("__s")
    )
    folds = cells.groupBy(F.col("__fold").alias("__f")).agg(F.sum("__n").alias("__fn"), F.sum("__s").alias("__fs"))
    rows, positives = (folds.agg(F.sum(c)).scalar() for c in ("__fn", "__fs"))
    per_fold = folds.select(
        "__f", (rows - F.col("__fn")).alias("__on"), (positives - F.col("__fs")).alias("__os")
    )
    every_fold = per_fold.agg(F.collect_list(F.struct("__f", "__on", "__os"))).scalar()  # k entries
    levels = cells.groupBy(F.col("__level").alias("__lv")).agg(F.sum("__n").alias("__ln"), F.sum("__s").alias("__ls"))
    others = (
        levels.withColumn("__folds", every_fold)
        .select("__lv", "__ln", "__ls", F.inline("__folds"))
        .join(cells, F.col("__lv").eqNullSafe(F.col("__level")) & (F.col("__f") == F.col("__fold")), "left")
        .select(
            "__lv",
            "__f",
            _smoothed(
                F.col("__ln") - F.coalesce("__n", F.lit(0)),
                F.col("__ls") - F.coalesce("__s", F.lit(0)),
                F.col("__on"),
                F.col("__os"),
                smooth,
            ).alias("__code"),
        )
    )
    # a level's codes travel together, one for each fold: the join is by level, and a frequent level is split like any skewed key
    codes = others.groupBy("__lv").agg(F.map_from_entries(F.collect_list(F.struct("__f", "__code"))).alias("__codes"))
    joined = df.join(codes, F.col(column).eqNullSafe(F.col("__lv")))
    encoded = joined.withColumn(out, F.try_element_at("__codes", F.col(fold))).select(*df.columns, out)
    if test is None:
        return encoded
    mean_code = others.groupBy("__lv").agg(F.avg("__code").alias("__code"))
    unseen = per_fold.agg(F.avg(F.col("__os") / F.col("__on"))).scalar()
    scored = (
        test.join(mean_code, F.col(column).eqNullSafe(F.col("__lv")), "left")
        .withColumn(out, F.coalesce(F.col("__code"), unseen))
        .select(*test.columns, out)
    )
    return encoded, scored
