"""Joins on time and on rank: as-of, "was it active in this interval", adjacent pairs, rank ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.operators.scans import latest, ordered_scan, running_total
from slipstream.session import growing, staged


def _all_known(columns: Sequence[str]):
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def asof_left(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    fact_time: str,
    values: dict[str, str],
    spread: bool = True,
) -> DataFrame:
    """Each probe row with the latest fact of the same key at or before its time.

    ``values`` maps fact columns to output names. Both inputs share the ``keys`` columns; keys are equal as in a SQL join,
    so a null key matches nothing. A probe with a null key or time, or with no earlier fact, gets null values; the first two
    never enter the scan. Of several facts at one instant, the largest by value is taken, so that the result does not depend
    on row order. Probes and facts are stacked and scanned once in time order: no pair is ever built.
    """
    keys = list(keys)
    taken = [F.col(c).alias(n) for c, n in values.items()]
    facts = facts.where(_all_known([*keys, fact_time])).select(
        *keys, F.col(fact_time).alias("__at"), F.struct(*taken).alias("__fact")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in probes.columns])
    can_match = _all_known([*keys, probe_time])
    asking = probes.where(can_match).select(*keys, F.col(probe_time).alias("__at"), row.alias("__probe"))
    stacked = facts.withColumn("__late", F.lit(0)).unionByName(asking.withColumn("__late", F.lit(1)), allowMissingColumns=True)
    scanned = ordered_scan(stacked, keys, ["__at", "__late", "__fact"], {"__hit": latest(F.col("__fact"))}, spread)
    answered = scanned.where(F.col("__late") == 1).select(
        "__probe.*", *[F.col(f"__hit.{n}").alias(n) for n in values.values()]
    )
    return answered.unionByName(probes.where(~can_match), allowMissingColumns=True)


def interval_flags(
    rows: DataFrame,
    samples: DataFrame,
    keys: Sequence[str],
    sample_time: str,
    intervals: dict[str, tuple[str, str]],
    spread: bool = True,
) -> DataFrame:
    """For each interval, 1 when some sample of the same key lies in the closed interval, else 0.

    ``samples`` holds only the samples that count (filter before calling: the filter reaches the
    scan). ``intervals`` maps an output flag to its (low, high) columns; a null bound or key gives 0.
    A sample lies in [low, high] exactly when the latest sample up to ``high`` is not before
    ``low``. The distinct upper bounds of all flags are looked up in one scan of the samples, without
    the rows they came from, and joined back by key and bound.
    """
    keys = list(keys)
    bounds = F.array(*[F.col(high) for high in dict.fromkeys(high for _, high in intervals.values())])
    asked = rows.select(*keys, F.explode(bounds).alias("__until")).where(_all_known([*keys, "__until"])).distinct()
    asked = staged(asked, "asked") if spread else asked  # the scan reads it for its borders and carries too
    seen = asof_left(asked, samples.select(*keys, sample_time), keys, "__until", sample_time, {sample_time: "__seen"}, spread)
    seen = staged(seen.where(F.col("__seen").isNotNull()), "bounds")
    out = rows
    for flag, (low, high) in intervals.items():
        found = seen.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__until", "__seen")
        same = F.col(high) == F.col("__until")
        for k in keys:
            same = same & (F.col(k) == F.col(f"__k_{k}"))
        inside = F.coalesce(F.col("__seen") >= F.col(low), F.lit(False))
        out = out.join(growing(found), same, "left").withColumn(flag, inside.cast("int")).drop(*[f"__k_{k}" for k in keys], "__until", "__seen")
    return out


def adjacent_pairs(
    ahead: DataFrame, behind: DataFrame, keys: Sequence[str], position: str, carry: Sequence[str]
) -> DataFrame:
    """Rows of ``behind`` that sit exactly one position after a row of ``ahead`` in the same group.

    The distance of one is part of the equality keys, so this is a plain hash join, not a self
    product with a filter. ``carry`` columns come out with ``_Ahead`` / ``_Behind`` suffixes.
    """
    carry = list(dict.fromkeys([*carry, position]))
    left = ahead.where(F.col(position).isNotNull()).select(
        *keys, (F.col(position) + 1).alias("__next"), *[F.col(c).alias(f"{c}_Ahead") for c in carry]
    )
    right = behind.where(F.col(position).isNotNull()).select(
        *keys, F.col(position).alias("__next"), *[F.col(c).alias(f"{c}_Behind") for c in carry]
    )
    return left.join(growing(right), [*keys, "__next"]).drop("__next")


def rank_range_join(
    movers: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    low: str,
    high: str,
    rank: str,
    how: str = "inner",
    row_key: Sequence[str] | None = None,
    width: int = 16,
) -> DataFrame:
    """Match ``movers`` with the ``others`` of the same group whose ``rank`` is in [low, high).

    Ranks are cut into bins, ``width`` times wider on each level. A mover goes to the level whose bins are about as wide as
    its interval, so it is repeated at most ``width`` + 1 times whatever it spans; the others go to the levels that movers
    use, of which there are few. The join is on (keys, level, bin), so a crowded group spreads over many tasks. A mover that
    gained nothing has an empty interval and is never repeated. ``how='left'`` keeps unmatched movers once; ``row_key`` then
    identifies a mover. The ``others`` columns besides ``keys`` must not clash with those of ``movers``.
    """
    keys, width = list(keys), max(width, 2)
    level = F.floor(F.log(F.greatest(F.col(high) - F.col(low), F.lit(1)).cast("double")) / F.log(F.lit(float(width)))).cast("int")
    bin_of = lambda at: F.floor(at / F.pow(F.lit(float(width)), F.col("__level"))).cast("long")
    asking = movers.where(F.col(low) < F.col(high)).withColumn("__level", level)
    levels = asking.agg(F.collect_set("__level")).scalar()  # at most one for each power of the width
    spread = asking.withColumn("__bin", F.explode(F.sequence(bin_of(F.col(low)), bin_of(F.col(high) - 1))))
    binned = others.where(F.col(rank).isNotNull()).withColumn("__level", F.explode(levels)).withColumn("__bin", bin_of(F.col(rank)))
    inside = (F.col(rank) >= F.col(low)) & (F.col(rank) < F.col(high))
    pairs = spread.join(growing(binned), [*keys, "__level", "__bin"]).where(inside).drop("__level", "__bin")
    if how == "inner":
        return pairs
    if how != "left" or row_key is None:
        raise ValueError("how is 'inner', or 'left' together with row_key")
    extra = [c for c in others.columns if c not in keys]
    matched = pairs.select(*row_key).distinct()
    alone = movers.join(growing(matched), list(row_key), "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True).select(*movers.columns, *extra)


def count_in_rank_range(
    movers: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    low: str,
    high: str,
    rank: str,
    out: str,
    spread: bool = True,
) -> DataFrame:
    """How many ``others`` have a rank in [low, high), without building the matches.

    The number below a rank is a running count along the rank axis, so each interval needs two lookups: below ``high`` minus
    below ``low``. Linear in the input however many matches there are. Equal intervals of a group are counted once and joined
    back, so equal movers each get the count. A null key or bound counts 0.
    """
    keys = list(keys)
    marks = others.where(_all_known([*keys, rank])).select(
        *keys, F.col(rank).cast("double").alias("__at"), F.lit(1).alias("__one"), F.lit(1).alias("__late")
    )
    asked = movers.where(F.col(low) < F.col(high)).where(_all_known(keys)).select(*keys, F.col(low).alias("__low"), F.col(high).alias("__high")).distinct()
    at_low = F.struct(F.col("__low").cast("double").alias("__at"), F.lit(-1).alias("__sign"))
    at_high = F.struct(F.col("__high").cast("double").alias("__at"), F.lit(1).alias("__sign"))
    edges = asked.select(*keys, "__low", "__high", F.explode(F.array(at_low, at_high)).alias("__edge")).select(
        *keys, "__low", "__high", "__edge.__at", "__edge.__sign", F.lit(0).alias("__one"), F.lit(0).alias("__late")
    )
    stacked = marks.unionByName(edges, allowMissingColumns=True)
    scanned = ordered_scan(stacked, keys, ["__at", "__late"], {"__below": running_total(F.col("__one"))}, spread)
    counted = (
        scanned.where(F.col("__late") == 0)
        .groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys], "__low", "__high")
        .agg(F.sum(F.col("__sign") * F.col("__below")).cast("long").alias("__n"))
    )
    same = (F.col(low) == F.col("__low")) & (F.col(high) == F.col("__high"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"__k_{k}"))
    return movers.join(growing(counted), same, "left").select(*movers.columns, F.coalesce("__n", F.lit(0)).alias(out))
