"""Repeatable samples, exact stratified splits and folds, class weights.

The order inside a stratum is the order of a hash, so it is uniform and the same on every run. A
stratum may hold most of the rows: a split marks its rows where they lie, ranks come from a spread scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.operators.scans import Scan, first_per_group, numbered, ordered_scan, running_total
from slipstream.session import staged

DIGITS = 4  # hexadecimal digits of a hash that a histogram counts
FEW = 100_000  # strata whose cuts are broadcast
ROUNDS = 4  # of the bijection of row numbers
WALKS = 40  # fewer numbers than the root of n lie beyond n, so a longer walk is out of the question for any n


def hash_text(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def hash_position(digest: Column) -> Column:
    """The leading bits of a hash text as a number that orders like the text."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def hash_rank(
    df: DataFrame, strata: Sequence[str], key: str, seed: int, out: str, spread: bool = True
) -> DataFrame:
    """Rank from 1 inside each stratum, in hash order of a unique key."""
    hashed = df.withColumn("__hash", hash_text(key, seed))
    return numbered(hashed, strata, ["__hash"], out, spread).drop("__hash")


def stratified_split(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    fraction: float,
    seed: int = 42,
    out: str = "is_test",
    spread: bool = True,
) -> DataFrame:
    """Mark ``fraction`` of every stratum, rounded to whole rows, with 1 and the rest with 0."""
    if spread:
        return _marked(df, strata, key, fraction, seed, out)
    hashed = df.withColumn("__hash", hash_text(key, seed))
    one = F.lit(1).cast("long")
    scans = {"__rank": running_total(one), "__rest": Scan("sum", one, backward=True)}  # the stratum's size, without a join
    ranked = ordered_scan(hashed, strata, ["__hash"], scans, spread)
    held = F.col("__rank") <= F.floor((F.col("__rank") + F.col("__rest") - 1) * fraction + 0.5)
    return ranked.withColumn(out, held.cast("int")).select(*df.columns, out)


def _small(frame: DataFrame, name: str) -> DataFrame:
    """A table with a row for each stratum: stored, and broadcast if there are few of them."""
    stored = staged(frame, name)
    return F.broadcast(stored) if stored.limit(FEW + 1).count() <= FEW else stored


def _marked(df: DataFrame, strata: Sequence[str], key: str, fraction: float, seed: int, out: str) -> DataFrame:
    """The split by selection: the hash of the last held row of each stratum is found by two histograms of hash digits and a
    look at the few rows that share them, and rows are marked where they lie. Only hashes and strata are read for that."""
    names = [f"__s{i}" for i in range(len(strata))]
    lean = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(strata, names)], hash_text(key, seed).alias("__hash"))

    def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
        met = F.lit(True)
        for c, n in zip(columns, names):
            met = met & left[c].eqNullSafe(right[f"{n}_"])
        return met

    def renamed(frame: DataFrame, *more: str) -> DataFrame:
        return frame.select(*[F.col(n).alias(f"{n}_") for n in names], *more)

    whole = Window.partitionBy(*names)
    upto = whole.orderBy("__digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 16^4 cells at most

    def cell(counts: DataFrame, wanted: Column) -> DataFrame:
        """The cell that holds the wanted row, and how many rows of it are wanted."""
        running = counts.withColumns({"__upto": F.sum("__n").over(upto), "__all": F.sum("__n").over(whole)}).withColumn("__wanted", wanted)
        hit = running.where("__upto >= __wanted AND __upto - __n < __wanted")
        return renamed(hit.withColumn("__left", F.col("__wanted") - F.col("__upto") + F.col("__n")), F.col("__digits").alias("__cell"), F.col("__left"))

    digits = F.substring("__hash", 1, DIGITS)
    counts = lean.groupBy(*names, digits.alias("__digits")).agg(F.count("*").alias("__n"))
    first = _small(cell(counts, F.floor(F.col("__all") * fraction + 0.5)), "cells")
    inside = lean.join(first, same(lean, first, names) & (digits == F.col("__cell")))
    counts = inside.groupBy(*names, F.substring("__hash", 1, 2 * DIGITS).alias("__digits")).agg(F.count("*").alias("__n"), F.first("__left").alias("__go"))
    second = _small(cell(counts, F.col("__go")), "cells")
    inside = lean.join(second, same(lean, second, names) & (F.substring("__hash", 1, 2 * DIGITS) == F.col("__cell")))
    # one in 16^8 rows of the stratum
    last = inside.groupBy(*names).agg(F.sort_array(F.collect_list("__hash")).alias("__h"), F.first("__left").alias("__go"))
    cuts = _small(renamed(last, F.element_at("__h", F.col("__go").cast("int")).alias("__cut")), "cuts")
    held = F.coalesce(hash_text(key, seed) <= F.col("__cut"), F.lit(False)).cast("int")
    return df.join(cuts, same(df, cuts, list(strata)), "left").withColumn(out, held).select(*df.columns, out)


def permuted(df: DataFrame, key: str, columns: Sequence[str], out: str, seed: int = 42, spread: bool = True) -> DataFrame:
    """Add a struct of some columns of another row, so that every row gives to exactly one row.

    Rows are numbered by key and a seeded bijection of the numbers says who gives to whom: rounds that add the MD5 of one half
    of a number to the other, repeated while the outcome is no number of a row. ``key`` is unique.
    """
    numbered_ = numbered(df, [], [key], "__number", spread).withColumn("__number", F.col("__number") - 1)
    n = df.agg(F.count("*")).scalar()
    size = F.greatest(n, F.lit(1))
    high = F.ceil(F.sqrt(size.cast("double"))).cast("long")
    sized = numbered_.withColumns({"__all": size, "__high": high}).withColumn("__low", F.ceil(F.col("__all") / F.col("__high")).cast("long"))
    chosen = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        _mixed(F.col("__number"), F.col("__high"), F.col("__low"), seed),
        lambda at, _: F.when(at < F.col("__all"), at).otherwise(_mixed(at, F.col("__high"), F.col("__low"), seed)),
    )
    asking = sized.withColumn("__from", chosen).drop("__number", "__all", "__high", "__low")
    giving = numbered_.select(F.col("__number").alias("__from"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(out))
    return asking.join(giving, "__from").select(*df.columns, out)


def _mixed(number: Column, high: Column, low: Column, seed: int) -> Column:
    """A bijection of the numbers below high * low."""
    halves = F.struct(F.floor(number / low).cast("long").alias("l"), (number % low).alias("r"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def turn(at: Column, k: Column) -> Column:
        text = F.concat_ws("-", F.lit(str(seed)), k.cast("string"), F.when(k % 2 == 0, at["r"]).otherwise(at["l"]).cast("string"))
        step = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
        even = F.struct(((at["l"] + step) % high).alias("l"), at["r"].alias("r"))
        return F.when(k % 2 == 0, even).otherwise(F.struct(at["l"].alias("l"), ((at["r"] + step) % low).alias("r")))

    return F.aggregate(rounds, halves, turn, lambda at: at["l"] * low + at["r"])


def stratified_folds(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    k: int = 5,
    seed: int = 42,
    out: str = "fold",
    spread: bool = True,
) -> DataFrame:
    """Fold number 0 to k-1, dealt out in turn inside each stratum."""
    ranked = hash_rank(df, strata, key, seed, "__rank", spread)
    return ranked.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def class_weights(df: DataFrame, label: str, mode: str = "balanced") -> DataFrame:
    """Weight per label value: rows / (classes * rows of the class), or negatives / positives for 1."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("all"),
            F.count("*").alias("classes"),
            F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("neg"),
            F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("pos"),
        )
    )
    both = counts.withColumn("__t", totals.scalar())
    if mode == "balanced":
        weight = F.col("__t.all") / (F.col("__t.classes") * F.col("n"))
    elif mode == "positive":
        weight = F.when(F.col(label) == 1, F.col("__t.neg") / F.col("__t.pos")).otherwise(F.lit(1.0))
    else:
        raise ValueError("mode is 'balanced' or 'positive'")
    return both.select(label, "n", weight.alias("weight"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in hash order: a distributed top-n, not a full sort."""
    return df.orderBy(hash_text(key, seed)).limit(n)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, by the hash of the key."""
    return df.where(hash_position(hash_text(key, seed)) < F.lit(int(fraction * 16**12)))


def random_per_group(df: DataFrame, keys: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """One repeatable pick per group, aggregated with map-side combining."""
    return first_per_group(df, keys, [hash_text(key, seed)])
