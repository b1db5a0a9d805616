"""From lap timing to attempts: successful passes, failed attempts, and the context of both.

All plans cover every race of the input at once. A race (Season, Round) is the unit of work: at most
a few thousand laps, so laps are shuffled once by race and the windows and joins below reuse that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.functions import maps
from slipstream.operators import roles, sequence, temporal
from slipstream.operators.reshape import lap_window, unpivot_roles
from slipstream.operators.scans import first_per_group
from slipstream.session import growing, staged

RACE = ["Season", "Round"]
CAR = [*RACE, "Driver"]
UNUSED = ["IsPersonalBest", "Deleted", "DeletedReason", "IsAccurate", "FastF1Generated"]

LAP_DELTAS = {
    "LapTimeCalculated": "DeltaLapTime",
    "Sector1": "DeltaS1Time",
    "Sector2": "DeltaS2Time",
    "Sector3": "DeltaS3Time",
    "TyreLife": "DeltaTyreLife",
    "SpeedI1": "DeltaSpeedI1",
    "SpeedI2": "DeltaSpeedI2",
    "SpeedFL": "DeltaSpeedFL",
    "SpeedST": "DeltaSpeedST",
}
START_DELTA = {"LapStartTime": "DeltaSessionTime"}
SESSION_DELTAS = {f"Sector{i}SessionTime": f"DeltaSector{i}SessionTime" for i in (1, 2, 3)}


def repair_laps(laps: DataFrame, across_drivers: bool = False) -> DataFrame:
    """Fill what the timing feed left out.

    Tyre age and speeds are interpolated by lap; tyre age and finish-line speed are then carried into
    the ends. Lap and sector times are derived from one another, and what cannot be derived becomes
    the driver's median. ``across_drivers`` interpolates over the whole race in driver and lap order
    instead of per driver, which lets values leak from one driver to the next.
    """
    laps = laps.drop(*UNUSED)
    keys, order = (RACE, ["__car", "LapNumber"]) if across_drivers else (CAR, ["LapNumber"])
    if across_drivers:
        cars = Window.partitionBy(*RACE).orderBy("Driver")
        laps = laps.withColumn("__car", F.dense_rank().over(cars))
    laps = sequence.interpolate(laps, keys, order, ["TyreLife", "SpeedI1", "SpeedI2", "SpeedST", "SpeedFL"], spread=False)
    laps = sequence.fill_down_up(laps, keys, order, ["TyreLife", "SpeedFL"], spread=False).drop("__car")

    lap = F.coalesce("LapTime", F.col("Sector1Time") + F.col("Sector2Time") + F.col("Sector3Time"))
    laps = laps.withColumn("LapTimeCalculated", lap)
    for target, raw, first, second in [
        ("Sector1", "Sector1Time", "Sector2Time", "Sector3Time"),
        ("Sector2", "Sector2Time", "Sector1", "Sector3Time"),
        ("Sector3", "Sector3Time", "Sector1", "Sector2"),
    ]:
        rest = F.col("LapTimeCalculated") - F.col(first) - F.col(second)
        laps = laps.withColumn(target, F.coalesce(F.col(raw), rest))
    return sequence.group_median_fill(laps, CAR, ["LapTimeCalculated", "Sector1", "Sector2", "Sector3"], spread=False)


def prepare_laps(laps: DataFrame, across_drivers: bool = False, count_stops_once: bool = False) -> DataFrame:
    """Repaired laps with stops, stints, retirement, position change, eligibility and tyre class."""
    laps = repair_laps(laps, across_drivers)
    laps = sequence.pit_timing(laps, CAR, ["LapNumber"], spread=False)
    laps = sequence.stint_number(
        laps, CAR, ["LapNumber"], flag="PitOutLap" if count_stops_once else "Pit", spread=False
    )
    laps = sequence.retirement_lap(laps, RACE, "Driver", "LapNumber", spread=False)
    laps = sequence.position_change(laps, CAR, ["LapNumber"], spread=False)
    return laps.withColumns(
        {
            "Flag": maps.status_flag(F.col("TrackStatus")),
            "OTable": maps.eligible_lap(F.col("Pit"), F.col("TrackStatus"), F.col("LapTimeCalculated")),
            "CompoundFactor": maps.compound_class(F.col("Compound")),
        }
    )


def passes(prepared: DataFrame) -> DataFrame:
    """One row per car passed on a lap: who passed whom, numbered inside each race.

    The mover's and the passed car's conditions are applied on their own side, before the join.
    """
    moved = (F.col("PositionChange") < 0) & (F.col("LapNumber") > 1)
    racing = (F.col("OTable") == 1) & (F.col("PitInLap") == 0) & (F.col("PitOutLap") == 0)
    movers = prepared.where(moved & racing).select(*CAR, "LapNumber", "Position", "PrevLapPosition")
    on_track = (F.col("PitInLap") == 0) & (F.col("PitOutLap") == 0) & (F.col("PitOutLagLap") == 0)
    finishing = F.coalesce(F.col("DNF"), F.lit(0.0)) == 0
    lost = F.col("Position") >= F.col("PrevLapPosition")
    targets = prepared.where(F.col("LapNumber").isNotNull() & lost & on_track & finishing).select(
        *RACE,
        "LapNumber",
        F.col("Driver").alias("PassedDriver"),
        F.col("PrevLapPosition").alias("PassedDriverPrevPos"),
    )
    found = temporal.rank_range_join(
        movers, targets, [*RACE, "LapNumber"], "Position", "PrevLapPosition", "PassedDriverPrevPos"
    ).where(F.col("PassedDriver") != F.col("Driver"))
    found = _number_in_race(found, ["Driver", "LapNumber", "PassedDriver"], "OvertakeID")
    return found.select(*RACE, "OvertakeID", F.col("LapNumber").alias("BaseLap"), "Driver", "PassedDriver")


def _number_in_race(df: DataFrame, order: list[str], out: str) -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*RACE).orderBy(*order)))


def find_overtakes(laps: DataFrame, **options) -> DataFrame:
    """Successful passes as role-by-lap rows: the base lap and the two before, for both cars.

    Movers, targets and lap details all come from the prepared laps, which are stored once.
    """
    prepared = staged(prepare_laps(laps, **options), "prepared-laps")
    return describe_overtakes(prepared, passes(prepared))


def describe_overtakes(prepared: DataFrame, found: DataFrame) -> DataFrame:
    """Role-by-lap rows of given passes, with the deltas, the sector and the interval of the pass."""
    group = [*RACE, "OvertakeID", "LapNumber"]
    rows = unpivot_roles(found, [*RACE, "OvertakeID", "BaseLap"], {"Driver": roles.OVERTAKER, "PassedDriver": roles.PASSED})
    rows = lap_window(rows, "BaseLap", before=2, first=1)
    rows = rows.join(growing(prepared), [*CAR, "LapNumber"], "left")
    rows = roles.counterpart_delta(roles.session_times(rows), group, {**START_DELTA, **LAP_DELTAS, **SESSION_DELTAS})
    rows = roles.pass_interval(roles.pass_sector(rows, group), group)
    return rows.withColumn("Sikeres", F.lit(1))


def following_runs(prepared: DataFrame, length: int = 3, step: int = 1) -> DataFrame:
    """Pairs of cars that sat one place apart for ``length`` laps in a row, numbered inside each race."""
    ahead = prepared.where((F.col("OTable") == 1) & (F.col("Flag") == 0))
    pairs = temporal.adjacent_pairs(ahead, prepared, [*RACE, "LapNumber"], "Position", ["Driver"])
    runs = sequence.consecutive_runs(
        pairs, [*RACE, "Driver_Ahead", "Driver_Behind"], "LapNumber", length, step, spread=False
    )
    runs = _number_in_race(runs, ["Driver_Ahead", "Driver_Behind", "LapNumber"], "FailedID")
    return runs.select(*RACE, "FailedID", F.col("LapNumber").alias("BaseLap"), "Driver_Ahead", "Driver_Behind")


def find_failed_attempts(
    laps: DataFrame,
    max_gap: float = 1.5,
    run_length: int = 3,
    lap_step: int = 1,
    streak_gap: float = 3,
    **options,
) -> DataFrame:
    """Failed attempts as role-by-lap rows: the closest moment of each spell of close following."""
    prepared = staged(prepare_laps(laps, **options), "prepared-laps")
    return describe_failed_attempts(
        prepared, following_runs(prepared, run_length, lap_step), max_gap, run_length, streak_gap
    )


def describe_failed_attempts(
    prepared: DataFrame, runs: DataFrame, max_gap: float = 1.5, run_length: int = 3, streak_gap: float = 3
) -> DataFrame:
    """Role-by-lap rows of the runs that stayed within ``max_gap`` seconds on every lap.

    Of runs by the same two cars at most ``streak_gap`` laps apart only the one with the smallest gap
    on its base lap is kept, the earliest of equals.
    """
    attempt = [*RACE, "FailedID"]
    rows = unpivot_roles(runs, [*attempt, "BaseLap"], {"Driver_Behind": roles.OVERTAKER, "Driver_Ahead": roles.PASSED})
    rows = lap_window(rows, "BaseLap", before=run_length - 1)
    rows = rows.join(growing(prepared), [*CAR, "LapNumber"], "left")
    rows = roles.counterpart_delta(rows, [*attempt, "LapNumber"], START_DELTA)
    close = rows.where(F.abs("DeltaSessionTime") < max_gap)

    mover = F.col("Role") == roles.OVERTAKER
    battles = (
        close.groupBy(*attempt, "BaseLap")
        .agg(
            F.count("*").alias("__rows"),
            F.countDistinct(F.when(mover, F.col("Driver"))).alias("__movers"),
            F.countDistinct(F.when(~mover, F.col("Driver"))).alias("__targets"),
            F.max(F.when(mover, F.col("Driver"))).alias("__Overtaker"),
            F.max(F.when(~mover, F.col("Driver"))).alias("__Passed"),
            F.max(F.when(mover & (F.col("LapNumber") == F.col("BaseLap")), F.abs("DeltaSessionTime"))).alias("__gap"),
        )
        .where((F.col("__rows") == 2 * run_length) & (F.col("__movers") == 1) & (F.col("__targets") == 1))
    )
    pair = [*RACE, "__Overtaker", "__Passed"]
    spells = sequence.streaks(battles, pair, "BaseLap", streak_gap, spread=False)
    best = first_per_group(spells, [*pair, "Streak_ID"], ["__gap", "BaseLap"]).select(*attempt)

    kept = roles.session_times(close.join(growing(best), attempt, "left_semi"))
    kept = roles.counterpart_delta(kept, [*attempt, "LapNumber"], {**SESSION_DELTAS, **LAP_DELTAS})
    return kept.withColumn("Sikeres", F.lit(0))


DRS_OPEN = (10, 14)  # telemetry codes of an open flap


def attach_drs(
    attempts: DataFrame,
    telemetry: DataFrame,
    low: str,
    high: str,
    spread: bool = True,
) -> DataFrame:
    """Was the flap open in the interval of the attempt, and at any time on the row's own lap?

    The attempts of one car in one race are few; only telemetry can crowd a key, so the scan is spread.
    """
    open_samples = telemetry.where(F.col("DRS").between(*DRS_OPEN)).select(*CAR, "SessionTime")
    return temporal.interval_flags(
        attempts,
        open_samples,
        CAR,
        "SessionTime",
        {"DRS_OTSector": (low, high), "DRS_Lap": ("LapStartTime", "Time")},
        spread,
    )


WEATHER = ["AirTemp", "Humidity", "Pressure", "Rainfall", "TrackTemp", "WindDirection", "WindSpeed"]


def attach_weather(
    attempts: DataFrame,
    weather: DataFrame,
    time: str,
    spread: bool = True,
) -> DataFrame:
    """Latest weather sample of the same race at or before ``time``."""
    facts = weather.withColumnRenamed("Race", "Round").withColumnRenamed("Time", "__sampled")
    values = {"__sampled": "Weather_Time", **{c: c for c in WEATHER}}
    return temporal.asof_left(attempts, facts, RACE, time, "__sampled", values, spread)


def base_lap_time(attempts: DataFrame, attempt_id: str, time: str, out: str) -> DataFrame:
    """The time the overtaker had on the base lap, on every row of the attempt."""
    on_base = (F.col("LapNumber") == F.col("BaseLap")) & (F.col("Role") == roles.OVERTAKER)
    whole = Window.partitionBy(*RACE, attempt_id)
    return attempts.withColumn(out, F.max(F.when(on_base, F.col(time))).over(whole))
