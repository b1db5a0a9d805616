"""The two parties of an event: comparing them lap by lap, and locating the event in time.

A group is one attempt on one lap: at most one row per role, so windows over it are tiny.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OVERTAKER, PASSED = "Overtaker", "Passed"


def role_value(column: str | Column, role: str, group: Sequence[str]) -> Column:
    """The value one role has in the group, on every row of the group."""
    column = F.col(column) if isinstance(column, str) else column
    return F.max(F.when(F.col("Role") == role, column)).over(Window.partitionBy(*group))


def counterpart_delta(df: DataFrame, group: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Own value minus the other role's value, for each ``measure -> output`` pair.

    Each role's measures travel as one struct, so the group is windowed once for all of them.
    """
    fields = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in measures)
    packed = F.expr(f"named_struct('there', 1, {fields})")
    both = df.withColumns(
        {
            "__mover": role_value(packed, OVERTAKER, group),
            "__target": role_value(packed, PASSED, group),
        }
    )
    deltas = {
        out: F.expr(f"`{m}` - CASE WHEN Role = '{OVERTAKER}' THEN __target.`{m}` ELSE __mover.`{m}` END")
        for m, out in measures.items()
    }
    return both.withColumns(deltas).drop("__mover", "__target")


def session_times(df: DataFrame) -> DataFrame:
    """Fill missing session times at the end of each sector, each from the one before it."""
    chain = [
        ("Sector1SessionTime", "LapStartTime", "Sector1"),
        ("Sector2SessionTime", "Sector1SessionTime", "Sector2"),
        ("Sector3SessionTime", "Sector2SessionTime", "Sector3"),
    ]
    for target, start, length in chain:
        df = df.withColumn(target, F.coalesce(F.col(target), F.col(start) + F.col(length)))
    return df


def pass_sector(df: DataFrame, group: Sequence[str], out: str = "OTSector") -> DataFrame:
    """Sector in which the overtaker got ahead: the first whose end-of-sector gap is negative.

    0 when there is none; a gap of exactly zero, or an unknown one, also gives 0.
    """
    gaps = F.struct(*[F.col(f"DeltaSector{i}SessionTime").alias(f"g{i}") for i in (1, 2, 3)])
    return df.withColumn("__gap", role_value(gaps, OVERTAKER, group)).withColumn(out, _sector("__gap")).drop("__gap")


def _sector(gap: str) -> Column:
    first, second, third = (F.col(f"{gap}.g{i}") for i in (1, 2, 3))
    return (
        F.when(first < 0, 1)
        .when((first > 0) & (second < 0), 2)
        .when((first > 0) & (second > 0) & (third < 0), 3)
        .otherwise(0)
    )


def pass_interval(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Session-time interval of the sector of the pass, from the overtaker; null off the base lap."""
    times = ["LapStartTime", "Sector1SessionTime", "Sector2SessionTime", "Time"]
    packed = F.struct(*[F.col(t).alias(t) for t in times])
    mover = df.withColumn("__mover", role_value(packed, OVERTAKER, group))

    def bound(shift: int) -> Column:
        at = F.lit(None).cast("double")
        for sector in (1, 2, 3):
            at = F.when(F.col("OTSector") == sector, F.col(f"__mover.{times[sector - 1 + shift]}")).otherwise(at)
        return F.when(F.col("BaseLap") == F.col("LapNumber"), at)

    return mover.withColumns(
        {"OvertakeIntervall_Bottom": bound(0), "OvertakeIntervall_Upper": bound(1)}
    ).drop("__mover")


def attempt_interval(df: DataFrame) -> DataFrame:
    """Interval of the sector where the gap changed least on the base lap; the first such sector wins.

    Off the base lap, or when no change is known, both bounds are null.
    """
    gaps = ["DeltaSessionTime", "DeltaSector1SessionTime", "DeltaSector2SessionTime", "DeltaSector3SessionTime"]
    ends = ["LapStartTime", "Sector1SessionTime", "Sector2SessionTime", "Sector3SessionTime"]
    change = [F.abs(F.col(b) - F.col(a)) for a, b in zip(gaps, gaps[1:])]
    smallest = F.least(*change)
    on_base = F.col("LapNumber") == F.col("BaseLap")

    def bound(shift: int) -> Column:
        at = F.lit(None).cast("double")
        for sector in (2, 1, 0):
            at = F.when(change[sector] == smallest, F.col(ends[sector + shift])).otherwise(at)
        return F.when(on_base, at)

    return df.withColumns({"TryIntervall_Bottom": bound(0), "TryIntervall_Upper": bound(1)})
