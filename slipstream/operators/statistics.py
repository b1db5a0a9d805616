"""Correlation, variance inflation, and imputation by predictive mean matching."""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.operators.scans import ordered_scan, running_total
from slipstream.session import growing, staged


def correlation_pairs(df: DataFrame, columns: Sequence[str], above: float | None = None) -> DataFrame:
    """Pearson correlation of every pair, each pair on the rows where both are known; one pass.

    With ``above`` only pairs whose absolute correlation is larger.
    """
    pairs = list(combinations(sorted(columns), 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("Variable_1"), F.lit(b).alias("Variable_2"), F.col(f"c{i}").alias("Correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    long = wide.select(F.inline(rows))
    return long if above is None else long.where(F.abs("Correlation") > above)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Correlation matrix of the complete rows: a p by p result of one distributed pass."""
    complete = df.dropna(subset=list(columns)).select(*[F.col(c).cast("double").alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(complete)
    return Correlation.corr(vectors, "v").head()[0].toArray()


def _inflation(matrix: np.ndarray) -> np.ndarray:
    """1 / (1 - R2) of each variable on the others; infinite for an exact combination of them."""
    factors = []
    for i in range(len(matrix)):
        others = np.delete(np.arange(len(matrix)), i)
        r = matrix[others, i]
        explained = float(r @ np.linalg.pinv(matrix[np.ix_(others, others)], hermitian=True) @ r)
        factors.append(np.inf if 1 - explained < 1e-10 else 1 / (1 - explained))
    return np.array(factors)


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation factor of each column, from the correlation matrix of one pass."""
    factors = _inflation(correlation_matrix(df, columns))
    rows = [(c, float(v)) for c, v in zip(columns, factors)]
    return df.sparkSession.createDataFrame(rows, "Feature string, VIF double")


def prune_by_inflation(df: DataFrame, columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Drop the column with the largest factor until none exceeds ``limit``; the survivors' factors.

    The data is read once: dropping a column only drops a row and a column of the matrix.
    """
    kept, matrix = list(columns), correlation_matrix(df, columns)
    while len(kept) > 1:
        factors = _inflation(matrix)
        worst = int(np.argmax(factors))
        if not factors[worst] > limit:
            break
        kept.pop(worst)
        matrix = np.delete(np.delete(matrix, worst, 0), worst, 1)
    factors = _inflation(matrix)
    rows = [(c, float(v)) for c, v in zip(kept, factors)]
    return df.sparkSession.createDataFrame(rows, "Feature string, VIF double")


@dataclass(frozen=True)
class MatchingModels:
    """Regressions of the target for each pattern of known predictors. A pattern has a bit for each predictor.

    ``used`` maps a pattern to the predictors its rows are matched by (fewer, where no row with a known target has all of them).
    ``fitted`` holds the coefficients of each such set (the intercept first, 0 for predictors outside it), ``drawn`` those of each
    draw. Predictors are taken from their ``means``."""

    means: np.ndarray
    used: dict[int, int]
    fitted: dict[int, np.ndarray]
    drawn: dict[int, np.ndarray]


def _draw(sums: np.ndarray, chosen: list[int], draws: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients from the sums of products of (1, predictors, target), and draws from their posterior."""
    places = [0, *[i + 1 for i in chosen]]
    width = len(sums) - 1
    inner, cross, n = sums[np.ix_(places, places)], sums[places, width], sums[0, 0]
    # a slight ridge, as a predictor may follow from others
    spread = np.linalg.pinv(inner + 1e-5 * np.diag(np.diag(inner)), hermitian=True)
    best = spread @ cross
    left = max(float(sums[width, width] - 2 * best @ cross + best @ inner @ best), 0.0)
    values, vectors = np.linalg.eigh((spread + spread.T) / 2)
    root = vectors * np.sqrt(np.clip(values, 0, None))  # a square root of the covariance, also where it is singular
    fitted, drawn = np.zeros(width), np.zeros((draws, width))
    fitted[places] = best
    for m in range(draws):
        deviation = np.sqrt(left / rng.chisquare(max(n - len(places), 1)))
        drawn[m, places] = best + deviation * (root @ rng.standard_normal(len(places)))
    return fitted, drawn


def matching_models(rows: DataFrame, predictors: int, draws: int, seed: int) -> MatchingModels:
    """Fit the models of all patterns from one pass of sums: rows are (y, x0, x1, ..., pattern, wanted).

    Sums of products are kept by pattern, and a set of predictors is fitted on all patterns that hold it."""
    xs = [F.col(f"x{i}") for i in range(predictors)]
    mean = rows.agg(*[F.avg(x) for x in xs]).head()
    means = np.array([m if m is not None else 0.0 for m in mean])
    parts = [F.lit(1.0), *[F.coalesce(x - F.lit(float(m)), F.lit(0.0)) for x, m in zip(xs, means)], F.col("y")]
    pairs = [(i, j) for i in range(len(parts)) for j in range(i, len(parts))]
    found = rows.groupBy("pattern").agg(
        F.sum(F.when(F.col("y").isNull() & F.col("wanted"), 1).otherwise(0)).alias("asking"),
        *[F.sum(F.when(F.col("y").isNotNull(), parts[i] * parts[j])).alias(f"s{k}") for k, (i, j) in enumerate(pairs)],
    )
    sums, asking = {}, []
    for r in found.collect():  # a row for each pattern
        matrix = np.zeros((len(parts), len(parts)))
        for k, (i, j) in enumerate(pairs):
            matrix[i, j] = matrix[j, i] = r[f"s{k}"] or 0.0
        sums[r["pattern"]] = matrix
        if r["asking"]:
            asking.append(r["pattern"])
    zero = np.zeros((len(parts), len(parts)))
    known = lambda wanted: sum((m for p, m in sums.items() if p & wanted == wanted), zero)
    used, fitted, drawn = {}, {}, {}
    for pattern in sorted(asking):
        own = pattern
        while own and known(own)[0, 0] == 0:  # without the predictor that fewest rows with a target have
            bits = [1 << i for i in range(predictors) if own >> i & 1]
            own ^= min(bits, key=lambda b: (known(b)[0, 0], b))
        if known(own)[0, 0] == 0:
            continue
        used[pattern] = own
        if own not in fitted:
            chosen = [i for i in range(predictors) if own >> i & 1]
            fitted[own], drawn[own] = _draw(known(own), chosen, draws, np.random.default_rng((seed, own)))
    return MatchingModels(means, used, fitted, drawn)


def _digits(*parts) -> Column:
    """A number from 0 to 2^32 - 1 by the MD5 of some values."""
    text = F.concat_ws("-", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def impute_by_matching(
    df: DataFrame,
    key: str,
    target: str,
    predictors: Sequence[str],
    draws: int = 10,
    donors: int = 5,
    seed: int = 123,
    where=None,
    spread: bool = True,
) -> DataFrame:
    """Predictive mean matching: fill ``target`` with observed values of rows predicted alike.

    Each of ``draws`` imputations predicts a missing row with coefficients drawn from the posterior of a linear model, and the
    rows with a known target with the fitted ones; it takes the value of one of the ``donors`` rows nearest by prediction, picked by the MD5 of key,
    draw and seed. The mean over the draws is filled in. Rows that lack predictors are matched by those they have, with a
    model of their own; a row without any draws from all known values. ``where`` limits which missing rows are filled; ``key``
    is unique per row. Nothing is filled only if no row has a target.

    The nearest donors are found by rank: donors are ranked by prediction, each draw of a missing row looks up its place among
    them, and only the ranks around it are joined. Equal predictions are in the order of an MD5.
    """
    wanted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    bits = [F.when(F.col(f"x{i}").isNotNull(), 1 << i).otherwise(0) for i in range(len(predictors))]
    rows = df.select(
        F.col(key).alias("key"), F.col(target).cast("double").alias("y"), wanted.alias("wanted"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(predictors)]
    ).withColumn("pattern", functools.reduce(lambda a, b: a + b, bits, F.lit(0)))
    models = matching_models(rows, len(predictors), draws, seed)
    if not models.used:
        return df

    def predicted(coefficients: Column) -> Column:
        parts = [F.coalesce(F.col(f"x{i}") - F.lit(float(m)), F.lit(0.0)) * coefficients[i + 1] for i, m in enumerate(models.means)]
        return functools.reduce(lambda a, b: a + b, parts, coefficients[0])

    # a row for each model, at most one for each pattern: as literals they would stand in the plan at every use
    table = [{"model": own, "fitted": c.tolist(), "drawn": models.drawn[own].tolist()} for own, c in models.fitted.items()]
    told = F.from_json(F.lit(json.dumps(table)), "array<struct<model int, fitted array<double>, drawn array<array<double>>>>")
    told = staged(df.sparkSession.range(1).select(F.inline(told)), "coefficients")
    used = F.create_map(*[x for p, own in models.used.items() for x in (F.lit(p), F.lit(own))])
    known = rows.where("y IS NOT NULL")
    holds = F.filter(F.array(*[F.lit(own) for own in models.fitted]), lambda own: F.col("pattern").bitwiseAND(own) == own)
    giving = known.withColumn("model", F.explode(holds)).join(F.broadcast(told.drop("drawn")), "model").select(
        "model", predicted(F.col("fitted")).alias("at"), F.md5(F.col("key").cast("string")).alias("tie"), F.lit(0).alias("late"), "y"
    )
    numbers = F.array(*[F.lit(m) for m in range(draws)])
    missing = rows.where("y IS NULL AND wanted").withColumn("model", F.element_at(used, F.col("pattern"))).withColumn("draw", F.explode(numbers))
    tie = F.md5(F.concat_ws("-", F.col("key").cast("string"), F.col("draw").cast("string"), F.lit(f"{seed}-place")))
    missing = missing.join(F.broadcast(told.drop("fitted")), "model").withColumn("drawn", F.element_at("drawn", F.col("draw") + 1))
    asking = missing.select("model", predicted(F.col("drawn")).alias("at"), tie.alias("tie"), F.lit(1).alias("late"), "key", "draw")
    stacked = giving.unionByName(asking, allowMissingColumns=True)
    # stored, as donors and askers are both taken from it
    ranked = ordered_scan(stacked, ["model"], ["at", "tie", "late", "key", "draw"], {"rank": running_total((F.col("late") == 0).cast("long"))}, spread)
    ranked = staged(ranked, "ranked")
    donor = ranked.where("late = 0").select("model", "rank", F.col("at").alias("donor_at"), F.col("y").alias("value"))
    around = F.explode(F.sequence(F.col("rank") - donors + 1, F.col("rank") + donors))
    near = ranked.where("late = 1").select("model", "key", "draw", F.col("at").alias("own"), around.alias("rank"))
    candidate = F.struct(F.abs(F.col("donor_at") - F.col("own")).alias("gap"), "rank", "value")
    # at most 2 * donors rows for each draw of a missing row
    pools = near.join(growing(donor), ["model", "rank"]).groupBy("key", "draw").agg(F.slice(F.array_sort(F.collect_list(candidate)), 1, donors).alias("pool"))
    pick = (F.pmod(_digits(F.col("key"), F.col("draw"), seed), F.size("pool")) + 1).cast("int")
    filled = pools.select("key", F.element_at("pool", pick)["value"].alias("value")).groupBy(F.col("key").alias("__key")).agg(F.avg("value").alias("__drawn"))
    joined = df.join(growing(filled), F.col(key) == F.col("__key"), "left")
    return joined.withColumn(target, F.coalesce(F.col(target), F.col("__drawn"))).select(*df.columns)
