"""From role-by-lap rows of attempts to one wide row per attempt and the model input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.functions import maps, text
from slipstream.operators import reshape, roles, statistics
from slipstream.operators.scans import first_per_group
from slipstream.plans import race
from slipstream.plans.race import RACE, WEATHER
from slipstream.session import discard, staged

# The columns both kinds of attempt are brought to, in order.
MEASURES = [
    "LapNumber", "LapTimeCalculated", "Position", "Sector1", "Sector2", "Sector3",
    "DeltaLapTime", "DeltaS1Time", "DeltaS2Time", "DeltaS3Time",
    "DeltaSector1SessionTime", "DeltaSector2SessionTime", "DeltaSector3SessionTime",
    "SpeedI1", "SpeedI2", "SpeedFL", "SpeedST", "DeltaSpeedI1", "DeltaSpeedI2", "DeltaSpeedFL", "DeltaSpeedST",
    "Stint", "CompoundFactor", "FreshTyre", "TyreLife", "DeltaTyreLife", "DRS_OTSector", "DRS_Lap",
]
# Columns of an event and of a track.
EVENT = ["EventName", "Country", "Location", "EventDate"]
TRACK = [
    "BrakingLevel", "OvertakingDifficulty", "SpeedDescription", "Corners",
    "S1Description", "S2Description", "S3Description",
]
SIDES = [roles.OVERTAKER, roles.PASSED]


_CONTEXT = ["DRS_OTSector", "DRS_Lap", "Weather_Time", *WEATHER]


def conform(df: DataFrame, id_column: str) -> DataFrame:
    """Bring either kind of attempt to the common columns; a missing column is an error."""
    attempt = F.concat_ws("_", *[F.col(c).cast("string") for c in (*RACE, "Sikeres", id_column)])
    columns = [*RACE, "Driver", "Team", "Role", "BaseLap", *MEASURES, *EVENT, "Weather_Time", *WEATHER, "Sikeres"]
    return df.select(attempt.alias("AttemptID"), *columns)


def attempt_laps(laps: DataFrame, telemetry: DataFrame, weather: DataFrame, **options) -> DataFrame:
    """Both kinds of attempt from the raw tables, with flap flags and weather, as common rows.

    The prepared laps feed six branches; they are stored once and each branch reads its own columns.
    The two kinds are stacked before their context is attached, so telemetry and weather are scanned
    once for both. The stacked rows are read some ten times on the way; they are stored before the flap flags,
    before the weather and after it, else the plan that the driver holds has all of the above anew for each reading.
    The two kinds are stored one after the other, so the driver holds the plan of one of them.
    """
    prepared = staged(race.prepare_laps(laps, **options), "prepared-laps")
    won = race.describe_overtakes(prepared, race.passes(prepared)).withColumnsRenamed(
        {"OvertakeIntervall_Bottom": "__low", "OvertakeIntervall_Upper": "__high", "OvertakeID": "__id"}
    )
    won = won.withColumn("__sky", F.col("__low"))
    runs = staged(race.following_runs(prepared), "runs")
    lost = race.describe_failed_attempts(prepared, runs)
    lost = race.base_lap_time(roles.attempt_interval(lost), "FailedID", "Time", "__sky").withColumnsRenamed(
        {"TryIntervall_Bottom": "__low", "TryIntervall_Upper": "__high", "FailedID": "__id"}
    )
    known = [c for c in MEASURES if c not in _CONTEXT]
    slim = [*RACE, "__id", "Driver", "Team", "Role", "BaseLap", *known, *EVENT, "Sikeres"]
    slim += ["LapStartTime", "Time", "__low", "__high", "__sky"]
    both = staged(won.select(*slim), "attempt-rows", lost.select(*slim))
    discard(prepared)
    discard(runs)
    flagged = staged(race.attach_drs(both, telemetry, "__low", "__high"), "flagged-rows")
    discard(both)
    rows = staged(conform(race.attach_weather(flagged, weather, "__sky"), "__id"), "attempt-laps")
    discard(flagged)
    return rows


def redo_speed_delta(df: DataFrame, chosen: Column, measure: str = "SpeedI2", delta: str = "DeltaSpeedI2") -> DataFrame:
    """Recompute one delta where ``chosen`` holds, lap by lap; other rows keep theirs."""
    group = [*RACE, "AttemptID", "LapNumber"]
    again = roles.counterpart_delta(df.withColumnRenamed(delta, "__kept"), group, {measure: "__new"})
    return again.withColumn(delta, F.when(chosen, F.col("__new")).otherwise(F.col("__kept"))).select(*df.columns)


SPEED_PREDICTORS = ["Season", "Round", "Sector1", "Sector2", "Sector3", "SpeedI1", "SpeedST", "LapNumber"]


def impute_speed(df: DataFrame, season: int = 2025, race_round: int = 22, draws: int = 10, seed: int = 123) -> DataFrame:
    """Fill a speed trap that was out for one race from alike laps of all races, and redo its delta there."""
    chosen = (F.col("Season") == season) & (F.col("Round") == race_round)
    keyed = df.withColumn("__row", F.concat_ws("|", "AttemptID", "Role", F.col("LapNumber").cast("string")))
    filled = statistics.impute_by_matching(
        keyed, "__row", "SpeedI2", SPEED_PREDICTORS, draws=draws, seed=seed, where=chosen
    ).drop("__row")
    return redo_speed_delta(filled, chosen)


def track_features(schedule: DataFrame, sheet: DataFrame) -> DataFrame:
    """One row per event and location: braking level from the list, the rest from the sheet.

    The location is brought to one spelling on both sides before joining.
    """
    events = (
        schedule.where(F.col("EventName").contains("Grand Prix"))
        .select("EventName", "Location")
        .distinct()
        .withColumn("BrakingLevel", maps.braking_level(F.col("Location")))
        .withColumn("Location", maps.known_location(F.col("Location")))
    )
    names = {"Sector 1": "S1Description", "Sector 2": "S2Description", "Sector 3": "S3Description"}
    described = (
        sheet.withColumnsRenamed(names)
        .withColumns(
            {
                "Location": maps.known_location(F.col("Location")),
                "OvertakingDifficulty": text.strip_prefix(F.col("Overtaking"), "Overtaking"),
                "SpeedDescription": text.strip_prefix(F.col("Speed"), "Speed"),
            }
        )
        .drop("Overtaking", "Speed")
    )
    return events.join(described, "Location", "left").select("EventName", "Location", *TRACK)


def attach_track(df: DataFrame, features: DataFrame) -> DataFrame:
    """Track text and levels by event and location, with the era and the stratum of each row.

    Joining on both keys keeps one row per row even when an event has been held in two places.
    """
    known = features.withColumnRenamed("Location", "__place")
    placed = df.withColumn("__place", maps.known_location(F.col("Location")))
    joined = placed.join(known, ["EventName", "__place"], "left").drop("__place")
    new_era = maps.era(F.col("Season"))
    return joined.withColumns({"Era": new_era, "Stratify": maps.stratum(F.col("Sikeres"), new_era)})


def seeded_draw(key: Column, percent: int, seed: int = 42) -> Column:
    """1 for about ``percent`` of the keys, always the same ones for one seed: by the MD5 of both."""
    digits = F.substring(F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed)))), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % 100 < percent).cast("int")


def widen(df: DataFrame, laps: int = 2, window: int = 3, relative: bool = False, seed: int = 42) -> DataFrame:
    """One row per attempt: constants, both parties, and each measure by role and lap.

    Lap 1 is the earliest lap of the attempt; with ``relative`` the index counts back from the base lap
    instead, so an attempt with a short history has nulls at its start. ``laps`` indices of the measures
    are kept; the flap flag of the attempt itself comes from index ``window``. Weather is that of the
    base lap, so an attempt has exactly one row.
    """
    ids = ["AttemptID", "Season", "Round", *EVENT, *TRACK, "Era", "Stratify", "Sikeres"]
    lap_index = (
        (F.col("LapNumber") - F.col("BaseLap") + window).cast("int")
        if relative
        else F.row_number().over(Window.partitionBy(*RACE, "AttemptID", "Role").orderBy("LapNumber"))
    )
    indexed = df.withColumn("Lap_Index", lap_index)
    kept = [m for m in MEASURES if m != "DRS_OTSector"]
    cells = []
    for measure in MEASURES:
        for role in SIDES:
            if measure.startswith("Delta") and role == roles.PASSED:
                continue  # the mirror image of the overtaker's
            for lap in range(1, window + 1):
                if measure in kept and lap > laps:
                    continue
                here = f"Role = '{role}' AND Lap_Index = {lap}"
                cells.append(F.expr(f"max(CASE WHEN {here} THEN {measure} END) AS {measure}_{role}_{lap}"))
    for value in ("Driver", "Team", "BaseLap"):
        cells += [F.expr(f"max(CASE WHEN Role = '{role}' THEN {value} END) AS {value}_{role}") for role in SIDES]
    cells += [F.expr(f"max(CASE WHEN LapNumber = BaseLap THEN {c} END) AS {c}") for c in WEATHER]
    wide = indexed.groupBy(*ids).agg(*cells)

    gap = F.abs(f"DeltaSector3SessionTime_Overtaker_{laps}")
    mover, target = (F.col(f"DRS_OTSector_{r}_{window}") for r in SIDES)
    mover = F.coalesce(mover, F.when(gap < 1, 1).when(gap > 1, 0))
    target = F.coalesce(target, seeded_draw(F.col("AttemptID"), 33, seed))
    wide = wide.withColumns({"DRS_OTSector_Overtaker": mover, "DRS_OTSector_Passed": target})
    return wide.drop(*[f"DRS_OTSector_{r}_{k}" for r in SIDES for k in range(1, window + 1)])


def flatten(df: DataFrame, laps: int = 2, **options) -> DataFrame:
    """The wide table with constants of the later laps and raw sectors dropped, and nulls filled with 0."""
    wide = widen(df, laps=laps, **options)
    later = range(2, laps + 1)
    constant = ["CompoundFactor", "FreshTyre", "Position", "Stint"]
    drops = [f"{c}_{r}_{k}" for c in constant for r in SIDES for k in later]
    drops += [f"LapNumber_{roles.PASSED}_{k}" for k in range(1, laps + 1)]
    drops += ["Era", "Round", "EventName", "EventDate", "Country"]
    drops += [c for c in wide.columns if c.startswith("Sector")]
    renames = {"BaseLap_Overtaker": "BaseLap"}
    renames |= {f"LapNumber_Overtaker_{k}": f"LapNumber{k}" for k in range(1, laps + 1)}
    for old, new in [("CompoundFactor", "Compound"), ("FreshTyre", "FreshTyre"), ("Position", "Position"), ("Stint", "Stint")]:
        renames |= {f"{old}_{r}_1": f"{new}_{r}" for r in SIDES}
    slim = wide.drop(*drops).withColumnsRenamed(renames)
    return reshape.last_column(reshape.fill_missing(slim), "Sikeres")


def pick_one(df: DataFrame, key: str = "AttemptID", seed: int = 42) -> DataFrame:
    """One row per key, chosen by a seeded hash of the row; the same row every time."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed))
    return first_per_group(df, [key], [row_hash])


def model_variant(
    flat: DataFrame,
    raw: bool = True,
    corner_words: bool = True,
    text_mode: str = "combined",
    trimmed: bool = True,
    laps: int = 2,
    keep_id: bool = False,
) -> DataFrame:
    """One of the model input tables.

    text_mode     ``combined``: place and sector texts as one lower-case text
                  ``character``: place and each sector phrase as a category of its own
    raw           keep lap times, speeds and tyre ages beside their deltas
    corner_words  keep the words corner and corners in the combined text
    trimmed       shorten names and drop columns that repeat one another
    keep_id       keep AttemptID, which splits and folds are drawn by
    """
    if text_mode not in ("combined", "character"):
        raise ValueError("text_mode is 'combined' or 'character'")
    as_int = {c: F.col(c).cast("int") for c in ("Rainfall", "FreshTyre_Overtaker", "FreshTyre_Passed")}
    out = flat.withColumns(
        {
            **as_int,
            "Team_Overtaker": maps.current_team(F.col("Team_Overtaker")),
            "Team_Passed": maps.current_team(F.col("Team_Passed")),
            "OvertakingDifficulty": maps.difficulty_level(F.col("OvertakingDifficulty")),
            "SpeedDescription": maps.speed_level(F.col("SpeedDescription")),
            "Location": maps.known_location(F.col("Location")),
        }
    )
    sectors = ["S1Description", "S2Description", "S3Description"]
    if text_mode == "character":
        out = out.withColumns({c: text.phrase(F.col(c)) for c in sectors})
        return reshape.last_column(out if keep_id else out.drop("AttemptID"), "Sikeres")

    described = text.joined_text(*[F.col(c) for c in ("Location", *sectors)])
    if not corner_words:
        described = text.strip_corner_words(described)
    out = out.withColumn("TrackDescription", described).drop("Location", *sectors)
    out = out if keep_id else out.drop("AttemptID")
    indices = range(1, laps + 1)
    if trimmed:
        out = out.drop(
            "BaseLap_Passed",
            "Position_Overtaker",
            *[f"LapNumber{k}" for k in indices],
            *[f"TyreLife_{r}_{k}" for r in SIDES for k in range(1, laps)],
        )
        names = {f"{d}_Overtaker_{k}": f"{d}_{k}" for d in ("DeltaLapTime", "DeltaS1Time", "DeltaS2Time", "DeltaS3Time") for k in indices}
        names |= {f"TyreLife_{r}_{laps}": f"TyreLife_{r}" for r in SIDES} | {"Position_Passed": "TargetPosition"}
        out = out.withColumnsRenamed(names)
    if not raw:
        measured = ["LapTimeCalculated", "SpeedI1", "SpeedI2", "SpeedFL", "SpeedST"]
        out = out.drop(
            *[f"{m}_{r}_{k}" for m in measured for r in SIDES for k in indices],
            *[f"DeltaTyreLife_Overtaker_{k}" for k in range(1, laps)],
            *[f"TyreLife_{r}" for r in SIDES],
        )
        kept = [f"DeltaSector{i}SessionTime" for i in (1, 2, 3)] + [f"DeltaSpeed{s}" for s in ("FL", "I1", "I2", "ST")]
        names = {f"{d}_Overtaker_{k}": f"{d}_{k}" for d in kept for k in indices}
        out = out.withColumnsRenamed(names | {f"DeltaTyreLife_Overtaker_{laps}": "DeltaTyreLife"})
    return reshape.last_column(out, "Sikeres")


VARIANTS = {
    "clean": {},
    "clean_without_corners": {"corner_words": False},
    "delta": {"raw": False},
    "delta_without_corners": {"raw": False, "corner_words": False},
    "all_variables": {"trimmed": False},
    "all_variables_without_corners": {"trimmed": False, "corner_words": False},
    "character": {"text_mode": "character"},
}
