"""Operators on ordered rows: repair of gaps, stops and stints, runs and streaks.

Every operator takes the group keys and a total order explicitly. ``spread`` is passed on to
the ordered scan: False for groups that are bounded by what they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.operators.scans import (
    OrderedRows,
    Scan,
    first_per_group,
    following,
    latest,
    ordered_scan,
    previous,
    running_total,
)
from slipstream.session import staged


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    columns: Sequence[str],
    spread: bool = True,
) -> DataFrame:
    """Linear interpolation of nulls by row index between the known values around them.

    Leading and trailing nulls stay null, as does everything in a group with one known value.
    """
    scans = {"__i": running_total(F.lit(1).cast("long"))}
    for c in columns:
        scans[f"__lo_{c}"] = latest(F.col(f"`{c}`"), placed=True)
        scans[f"__hi_{c}"] = latest(F.col(f"`{c}`"), backward=True, placed=True)
    around = ordered_scan(df, keys, order, scans, spread)
    filled = {}
    for c in columns:
        lo, hi = f"__lo_{c}", f"__hi_{c}"
        line = f"`{lo}`.v + (`{hi}`.v - `{lo}`.v) / (`{hi}`.i - `{lo}`.i) * (__i - `{lo}`.i)"
        filled[c] = F.expr(f"CASE WHEN `{c}` IS NULL THEN {line} ELSE `{c}` END")
    return around.withColumns(filled).select(*df.columns)


def fill_down_up(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    columns: Sequence[str],
    spread: bool = True,
) -> DataFrame:
    """Fill nulls with the latest earlier value, and what is still null with the next later one."""
    scans = {}
    for c in columns:
        scans[f"__down_{c}"] = latest(F.col(c))
        scans[f"__up_{c}"] = latest(F.col(c), backward=True)
    around = ordered_scan(df, keys, order, scans, spread)
    filled = {c: F.coalesce(F.col(f"__down_{c}"), F.col(f"__up_{c}")) for c in columns}
    return around.withColumns(filled).select(*df.columns)


def pit_timing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    start: str = "LapStartTime",
    pit_in: str = "PitInTime",
    pit_out: str = "PitOutTime",
    spread: bool = True,
) -> DataFrame:
    """Time spent on each stop and the 0/1 flags around it (in-lap, out-lap, lap after the out-lap)."""
    exit_time = F.col(pit_out) - F.col(start)
    scans = {
        "__next_start": following(F.col(start)),
        "__next_exit": following(exit_time),
        "__prev_out": previous(F.col(pit_out)),
    }
    around = ordered_scan(df, keys, order, scans, spread)
    stopped_in, stopped_out = F.col(pit_in).isNotNull(), F.col(pit_out).isNotNull()
    entry_time = F.col("__next_start") - F.col(pit_in)
    return around.withColumns(
        {
            "PitEntryTime": entry_time,
            "PitExitTime": exit_time,
            "PitTime": entry_time + F.col("__next_exit"),
            "PitInLap": stopped_in.cast("int"),
            "PitOutLap": stopped_out.cast("int"),
            "PitOutLagLap": F.col("__prev_out").isNotNull().cast("int"),
            "Pit": (stopped_in | stopped_out).cast("int"),
        }
    ).drop("__next_start", "__next_exit", "__prev_out")


def stint_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    stint: str = "Stint",
    flag: str = "Pit",
    spread: bool = True,
) -> DataFrame:
    """Fill a missing stint with 1 + the number of flagged rows before this one.

    With ``flag='Pit'`` both the in-lap and the out-lap count; pass ``PitOutLap`` to count a stop once.
    """
    flagged = F.coalesce(F.col(flag), F.lit(0))
    counted = ordered_scan(df, keys, order, {"__flags": running_total(flagged)}, spread)
    rebuilt = (F.col("__flags") - flagged + 1).cast("double")
    return counted.withColumn(stint, F.coalesce(F.col(stint).cast("double"), rebuilt)).drop("__flags")


def retirement_lap(df: DataFrame, race: Sequence[str], driver: str, lap: str, out: str = "DNF", spread: bool = True) -> DataFrame:
    """0 for a driver who reached the last lap but one of the race, else the driver's last lap.

    A driver with a missing lap number has no known last lap, so the code is null. A spread race is aggregated per driver and
    joined back; else windows over the race do.
    """
    if not spread:
        by_driver, by_race = Window.partitionBy(*race, driver), Window.partitionBy(*race)
        whole = F.count(lap).over(by_driver) == F.count("*").over(by_driver)
        topped = df.withColumns({"__known": F.when(whole, F.max(lap).over(by_driver)), "__race_top": F.max(lap).over(by_race)})
        return topped.withColumn(out, _retired(F.col("__known"), F.col("__race_top"))).drop("__known", "__race_top")
    per_driver = df.groupBy(*race, driver).agg(
        F.max(lap).alias("__top"), (F.count(lap) == F.count("*")).alias("__whole")
    )
    per_race = per_driver.groupBy(*race).agg(F.max("__top").alias("__race_top"))
    known = F.when(F.col("__whole"), F.col("__top"))
    code = per_driver.join(per_race, list(race)).withColumn(out, _retired(known, F.col("__race_top"))).select(*race, driver, out)
    return df.join(code, [*race, driver], "left")


def _retired(top: Column, race_top: Column) -> Column:
    return F.when(top >= race_top - 1, F.lit(0.0)).otherwise(top.cast("double"))


def position_change(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    position: str = "Position",
    spread: bool = True,
) -> DataFrame:
    """Position on the row before, and the change since then (negative is a gain)."""
    around = ordered_scan(df, keys, order, {"PrevLapPosition": previous(F.col(position))}, spread)
    return around.withColumn("PositionChange", F.col(position) - F.col("PrevLapPosition"))


def consecutive_runs(
    df: DataFrame,
    keys: Sequence[str],
    lap: str,
    length: int = 3,
    step: int = 1,
    spread: bool = True,
) -> DataFrame:
    """Keep rows that end a run of ``length`` rows whose laps are at most ``step`` apart.

    ``step=1`` is the strict rule: each lap follows directly on the one before.
    """
    # a row starts a new run unless it follows the row before closely enough
    ordered = OrderedRows(df, keys, [lap], spread).add({"__before": previous(F.col(lap)), "__rows": running_total(F.lit(1))})
    joined_on = F.coalesce(F.col(lap) - F.col("__before") <= step, F.lit(False))
    started = ordered.add({"__first": latest(F.when(~joined_on, F.col("__rows")))}).rows
    return started.where(F.col("__rows") - F.col("__first") + 1 >= length).select(*df.columns)


def streaks(
    df: DataFrame,
    keys: Sequence[str],
    lap: str,
    max_gap: float = 3,
    out: str = "Streak_ID",
    spread: bool = True,
) -> DataFrame:
    """Number the streaks of each group from 0: a gap above ``max_gap`` starts the next one."""
    ordered = OrderedRows(df, keys, [lap], spread).add({"__before": previous(F.col(lap))})
    breaks = F.coalesce((F.col(lap) - F.col("__before") > max_gap).cast("int"), F.lit(0))
    return ordered.add({out: running_total(breaks)}).rows.drop("__before")


def best_per_group(df: DataFrame, keys: Sequence[str], by: Sequence[Column | str]) -> DataFrame:
    """One row per group: the smallest by ``by``, whose last entries break ties."""
    return first_per_group(df, keys, by)


def group_median_fill(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    spread: bool = True,
) -> DataFrame:
    """Replace nulls by the exact median of the group (null when the group has no value)."""
    if not spread:
        group = Window.partitionBy(*keys)
        return df.withColumns({c: F.coalesce(F.col(c), F.median(c).over(group)) for c in columns})
    kinds = dict(df.dtypes)
    # all columns in one scan: a value is (group, column, value), whatever column it is from
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    long = df.select(*[F.col(f"`{k}`") for k in keys], F.posexplode(values).alias("__column", "__value"))
    middle = exact_median(long, [*keys, "__column"], "__value", "__median", spread)
    wide = middle.groupBy(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("__column") == i, F.col("__median"))).alias(f"__median_{i}") for i in range(len(columns))]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__k_{k}"))
    filled = {}
    for i, c in enumerate(columns):
        whole = kinds[c] in ("tinyint", "smallint", "int", "bigint")  # the middle of two whole numbers may be none
        filled[c] = F.coalesce(F.col(f"`{c}`").cast("double") if whole else F.col(f"`{c}`"), F.col(f"__median_{i}"))
    return df.join(wide, same, "left").withColumns(filled).select(*df.columns)


def exact_median(df: DataFrame, keys: Sequence[str], column: str, out: str, spread: bool = True) -> DataFrame:
    """Exact median per group from running counts over its distinct values, from both ends.

    Equal values are combined before the shuffle and a group is never held in one place, unlike the
    built-in aggregate, whose buffer keeps every distinct value of a group.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("__n"))
    counts = staged(counts, "counts") if spread else counts  # borders, carries and ranks all read them
    scans = {"__upto": running_total(F.col("__n")), "__onward": Scan("sum", F.col("__n"), backward=True)}
    ranked = ordered_scan(counts, keys, [column], scans, spread)
    rows = F.col("__upto") + F.col("__onward") - F.col("__n")
    low, high = F.floor((rows + 1) / 2), F.floor((rows + 2) / 2)
    holds = lambda at: (F.col("__upto") >= at) & (F.col("__upto") - F.col("__n") < at)
    middle = F.when(holds(low), F.col(column)), F.when(holds(high), F.col(column))
    return ranked.groupBy(*keys).agg(((F.max(middle[0]) + F.max(middle[1])) / 2).alias(out))
