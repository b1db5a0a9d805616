"""Counts, integrity checks and schema comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.operators.scans import ordered_scan, running_total


def more_than(df: DataFrame, keys: Sequence[str], limit: int, out: str = "n") -> DataFrame:
    """Groups with more rows than they may have."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).where(F.col(out) > limit)


def groups_of_size(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Rows of groups that have exactly ``size`` rows. Counted with map-side combining, then semi-joined."""
    whole = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") == size).select(*keys)
    return df.join(whole, list(keys), "left_semi")


def single_members(df: DataFrame, keys: Sequence[str], role: str, member: str, roles: Sequence[str]) -> DataFrame:
    """Keys of groups in which every role has exactly one distinct member, with that member per role."""
    aggs = []
    for r in roles:
        value = F.when(F.col(role) == r, F.col(member))
        # one distinct non-null value: smallest and largest agree, no set is collected
        aggs += [F.min(value).alias(f"__lo_{r}"), F.max(value).alias(f"__hi_{r}")]
    grouped = df.groupBy(*keys).agg(*aggs)
    condition = F.lit(True)
    for r in roles:
        condition = condition & (F.col(f"__lo_{r}") == F.col(f"__hi_{r}"))
    return grouped.where(condition).select(*keys, *[F.col(f"__lo_{r}").alias(r) for r in roles])


def distinct_per_group(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(out))


def distinct_tuples(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """How many distinct value combinations there are, as one row."""
    return df.select(*columns).distinct().agg(F.count("*").alias(out))


def frequency(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(out))


def cumulative_frequency(df: DataFrame, column: str, spread: bool = True) -> DataFrame:
    """Frequency, percent of the total and cumulative percent, the rarest value first.

    Equal frequencies are ordered by value, as text. The running total is a spread scan in the order of frequency and
    value, so no frequency puts its values in one task.
    """
    counted = frequency(df, column, "Gyakorisag")
    placed = counted.withColumn("__text", F.col(column).cast("string"))
    ranked = ordered_scan(placed, [], ["Gyakorisag", "__text"], {"__upto": running_total(F.col("Gyakorisag"))}, spread)
    share = F.lit(100.0) / df.agg(F.count("*")).scalar()
    return ranked.select(
        column, "Gyakorisag", (F.col("Gyakorisag") * share).alias("Szazalek"), (F.col("__upto") * share).alias("Kumulativ_Szazalek")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls of each column as (column, nulls), from one pass over the data."""
    counts = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "nulls")


def duplicated(df: DataFrame, keys: Sequence[str] | None = None, out: str = "n") -> DataFrame:
    """Key values, or whole rows when no keys are given, that occur more than once."""
    return more_than(df, list(keys or df.columns), 1, out)


def same_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many distinct values only one side has, and whether there are none."""
    only_left, only_right = left.subtract(right), right.subtract(left)
    counts = only_left.agg(F.count("*").alias("only_left"))
    counts = counts.withColumn("only_right", only_right.agg(F.count("*")).scalar())
    return counts.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def schema_listing(df: DataFrame, kind: str = "Tipus", known: str = "known") -> DataFrame:
    """Name and type of each column, and how many of its values are known: one pass over the rows."""
    columns = [F.struct(F.lit(c).alias("Valtozo_Neve"), F.lit(t).alias(kind), F.count(F.col(f"`{c}`")).alias(known)) for c, t in df.dtypes]
    return df.agg(F.array(*columns).alias("c")).select(F.inline("c"))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of both frames side by side, with their types and numbers of known values; a missing one is null on its side."""
    a = schema_listing(left, "Tipus_Sikeres", "known_Sikeres")
    return a.join(schema_listing(right, "Tipus_Sikertelen", "known_Sikertelen"), "Valtozo_Neve", "full_outer")
