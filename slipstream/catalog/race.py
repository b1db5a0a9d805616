"""Queries that run the race plans on the derived season."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.catalog import field
from slipstream.catalog.registry import Registry
from slipstream.operators import roles
from slipstream.plans import attempts, race
from slipstream.session import growing, staged

_GAPS = ["TyreLife", "SpeedI1", "SpeedI2", "SpeedFL", "SpeedST"]
_CAR = '"Season", "Round", "Driver"'


def _quoted(names, prefix=""):
    return ", ".join(f'{prefix}"{n}"' for n in names)


def _interpolated(c: str) -> str:
    lo = f"""last_value(CASE WHEN "{c}" IS NOT NULL THEN {{}} END IGNORE NULLS) OVER
        (PARTITION BY {_CAR} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    hi = f"""first_value(CASE WHEN "{c}" IS NOT NULL THEN {{}} END IGNORE NULLS) OVER
        (PARTITION BY {_CAR} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
    v0, i0, v1, i1 = (t.format(x) for t, x in ((lo, f'"{c}"'), (lo, "i"), (hi, f'"{c}"'), (hi, "i")))
    return f"""CASE WHEN "{c}" IS NULL THEN {v0} + ({v1} - {v0}) / ({i1} - {i0}) * (i - {i0}) ELSE "{c}" END AS "{c}\""""


def _carried(c: str) -> str:
    return f"""coalesce(
      last_value("{c}" IGNORE NULLS) OVER (PARTITION BY {_CAR} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value("{c}" IGNORE NULLS) OVER (PARTITION BY {_CAR} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS "{c}\""""


PREPARED_SQL = f"""{field.LAPS_SQL},
indexed AS (SELECT *, row_number() OVER (PARTITION BY {_CAR} ORDER BY "LapNumber") AS i FROM laps),
interpolated AS (SELECT * REPLACE ({", ".join(_interpolated(c) for c in _GAPS)}) FROM indexed),
carried AS (SELECT * REPLACE ({", ".join(_carried(c) for c in ("TyreLife", "SpeedFL"))}) FROM interpolated),
lap_known AS (SELECT *, coalesce("LapTime", "Sector1Time" + "Sector2Time" + "Sector3Time") AS lt FROM carried),
s1_known AS (SELECT *, coalesce("Sector1Time", lt - "Sector2Time" - "Sector3Time") AS s1 FROM lap_known),
s2_known AS (SELECT *, coalesce("Sector2Time", lt - s1 - "Sector3Time") AS s2 FROM s1_known),
s3_known AS (SELECT *, coalesce("Sector3Time", lt - s1 - s2) AS s3 FROM s2_known),
repaired AS (
  SELECT *,
    coalesce(lt, median(lt) OVER (PARTITION BY {_CAR})) AS "LapTimeCalculated",
    coalesce(s1, median(s1) OVER (PARTITION BY {_CAR})) AS "Sector1",
    coalesce(s2, median(s2) OVER (PARTITION BY {_CAR})) AS "Sector2",
    coalesce(s3, median(s3) OVER (PARTITION BY {_CAR})) AS "Sector3"
  FROM s3_known),
stopped AS (
  SELECT *,
    lead("LapStartTime") OVER car - "PitInTime" AS "PitEntryTime",
    "PitOutTime" - "LapStartTime" AS "PitExitTime",
    lead("LapStartTime") OVER car - "PitInTime" + lead("PitOutTime" - "LapStartTime") OVER car AS "PitTime",
    CAST("PitInTime" IS NOT NULL AS INTEGER) AS "PitInLap",
    CAST("PitOutTime" IS NOT NULL AS INTEGER) AS "PitOutLap",
    CAST(lag("PitOutTime") OVER car IS NOT NULL AS INTEGER) AS "PitOutLagLap",
    CAST("PitInTime" IS NOT NULL OR "PitOutTime" IS NOT NULL AS INTEGER) AS "Pit",
    CASE WHEN max("LapNumber") OVER (PARTITION BY {_CAR}) >= max("LapNumber") OVER (PARTITION BY "Season", "Round") - 1
      THEN 0.0::DOUBLE ELSE max("LapNumber") OVER (PARTITION BY {_CAR}) END AS "DNF",
    lag("Position") OVER car AS "PrevLapPosition",
    "Position" - lag("Position") OVER car AS "PositionChange",
    CAST("TrackStatus" <> '1' AS INTEGER) AS "Flag",
    CASE WHEN "Compound" IN ('SOFT', 'ULTRASOFT', 'SUPERSOFT', 'HYPERSOFT') THEN 1 WHEN "Compound" = 'MEDIUM' THEN 2
      WHEN "Compound" = 'HARD' THEN 3 WHEN "Compound" IN ('WET', 'INTERMEDIATE') THEN 4 ELSE 0 END AS "CompoundFactor"
  FROM repaired WINDOW car AS (PARTITION BY {_CAR} ORDER BY "LapNumber")),
prepared AS (
  SELECT * REPLACE (coalesce("Stint", CAST(coalesce(sum("Pit") OVER (PARTITION BY {_CAR} ORDER BY "LapNumber"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS DOUBLE)) AS "Stint"),
    CASE WHEN "Pit" = 0 AND coalesce(contains("TrackStatus", '1'), false) AND "LapTimeCalculated" IS NOT NULL
      THEN 1 ELSE 0 END AS "OTable"
  FROM stopped)
"""


def _delta(measure: str) -> str:
    return f'''"{measure}" - CASE WHEN "Role" = 'Overtaker' THEN max(CASE WHEN "Role" = 'Passed' THEN "{measure}" END) OVER grp
        ELSE max(CASE WHEN "Role" = 'Overtaker' THEN "{measure}" END) OVER grp END'''


def _deltas(pairs: dict[str, str]) -> str:
    return ", ".join(f'{_delta(m)} AS "{d}"' for m, d in pairs.items())


def _mover(column: str) -> str:
    return f'''max(CASE WHEN "Role" = 'Overtaker' THEN "{column}" END) OVER grp'''


def _filled_session(source: str) -> str:
    return f"""SELECT * REPLACE (coalesce("Sector3SessionTime", "Sector2SessionTime" + "Sector3") AS "Sector3SessionTime") FROM (
      SELECT * REPLACE (coalesce("Sector2SessionTime", "Sector1SessionTime" + "Sector2") AS "Sector2SessionTime") FROM (
        SELECT * REPLACE (coalesce("Sector1SessionTime", "LapStartTime" + "Sector1") AS "Sector1SessionTime") FROM {source}))"""


_D1, _D2, _D3 = (_mover(f"DeltaSector{i}SessionTime") for i in (1, 2, 3))

OVERTAKES_SQL = f"""{PREPARED_SQL},
passes AS (
  SELECT a."Season", a."Round", a."Driver", p."Driver" AS "PassedDriver", a."LapNumber" AS "BaseLap",
    row_number() OVER (PARTITION BY a."Season", a."Round" ORDER BY a."Driver", a."LapNumber", p."Driver") AS "OvertakeID"
  FROM prepared a JOIN prepared p ON a."Season" = p."Season" AND a."Round" = p."Round" AND a."LapNumber" = p."LapNumber"
    AND a."PrevLapPosition" > p."PrevLapPosition" AND a."Position" <= p."PrevLapPosition"
  WHERE a."Driver" <> p."Driver" AND a."PositionChange" < 0 AND a."LapNumber" > 1 AND a."OTable" = 1
    AND a."PitInLap" = 0 AND a."PitOutLap" = 0 AND p."PitInLap" = 0 AND p."PitOutLap" = 0 AND p."PitOutLagLap" = 0
    AND p."DNF" = 0 AND p."Position" >= p."PrevLapPosition"),
pass_roles AS (
  SELECT "Season", "Round", "OvertakeID", "BaseLap", r AS "Role", CASE WHEN r = 'Overtaker' THEN "Driver" ELSE "PassedDriver" END AS "Driver",
    "BaseLap" - k AS "LapNumber"
  FROM passes, unnest(['Overtaker', 'Passed']) t(r), unnest([0, 1, 2]) s(k) WHERE "BaseLap" - k >= 1),
pass_laps AS (SELECT * FROM pass_roles LEFT JOIN prepared USING ("Season", "Round", "Driver", "LapNumber")),
pass_filled AS ({_filled_session("pass_laps")}),
pass_deltas AS (
  SELECT *, {_deltas({**race.START_DELTA, **race.LAP_DELTAS, **race.SESSION_DELTAS})} FROM pass_filled
  WINDOW grp AS (PARTITION BY "Season", "Round", "OvertakeID", "LapNumber")),
pass_sector AS (
  SELECT *, CASE WHEN {_D1} < 0 THEN 1 WHEN {_D1} > 0 AND {_D2} < 0 THEN 2
      WHEN {_D1} > 0 AND {_D2} > 0 AND {_D3} < 0 THEN 3 ELSE 0 END AS "OTSector"
  FROM pass_deltas WINDOW grp AS (PARTITION BY "Season", "Round", "OvertakeID", "LapNumber")),
overtakes AS (
  SELECT *,
    CASE WHEN "BaseLap" <> "LapNumber" THEN NULL WHEN "OTSector" = 1 THEN {_mover("LapStartTime")}
      WHEN "OTSector" = 2 THEN {_mover("Sector1SessionTime")} WHEN "OTSector" = 3 THEN {_mover("Sector2SessionTime")} END AS "OvertakeIntervall_Bottom",
    CASE WHEN "BaseLap" <> "LapNumber" THEN NULL WHEN "OTSector" = 1 THEN {_mover("Sector1SessionTime")}
      WHEN "OTSector" = 2 THEN {_mover("Sector2SessionTime")} WHEN "OTSector" = 3 THEN {_mover("Time")} END AS "OvertakeIntervall_Upper",
    1 AS "Sikeres"
  FROM pass_sector WINDOW grp AS (PARTITION BY "Season", "Round", "OvertakeID", "LapNumber"))
"""

FAILED_SQL = f"""{PREPARED_SQL},
pairs AS (
  SELECT a."Season", a."Round", a."LapNumber", a."Driver" AS ahead, b."Driver" AS behind
  FROM prepared a JOIN prepared b ON a."Season" = b."Season" AND a."Round" = b."Round" AND a."LapNumber" = b."LapNumber"
    AND b."Position" - a."Position" = 1
  WHERE a."OTable" = 1 AND a."TrackStatus" = '1'),
runs AS (
  SELECT *, row_number() OVER (PARTITION BY "Season", "Round" ORDER BY ahead, behind, "LapNumber") AS "FailedID" FROM (
    SELECT *, lag("LapNumber", 1) OVER w AS l1, lag("LapNumber", 2) OVER w AS l2 FROM pairs
    WINDOW w AS (PARTITION BY "Season", "Round", ahead, behind ORDER BY "LapNumber"))
  WHERE "LapNumber" = l1 + 1 AND l1 = l2 + 1),
run_roles AS (
  SELECT "Season", "Round", "FailedID", "LapNumber" AS "BaseLap", r AS "Role",
    CASE WHEN r = 'Overtaker' THEN behind ELSE ahead END AS "Driver", "LapNumber" - k AS "LapNumber"
  FROM runs, unnest(['Overtaker', 'Passed']) t(r), unnest([0, 1, 2]) s(k)),
run_laps AS (SELECT * FROM run_roles LEFT JOIN prepared USING ("Season", "Round", "Driver", "LapNumber")),
run_gaps AS (SELECT *, {_deltas(race.START_DELTA)} FROM run_laps
  WINDOW grp AS (PARTITION BY "Season", "Round", "FailedID", "LapNumber")),
run_close AS (SELECT * FROM run_gaps WHERE abs("DeltaSessionTime") < 1.5),
battles AS (
  SELECT "Season", "Round", "FailedID", "BaseLap", max(CASE WHEN "Role" = 'Overtaker' THEN "Driver" END) AS ov,
    max(CASE WHEN "Role" = 'Passed' THEN "Driver" END) AS pa,
    max(CASE WHEN "Role" = 'Overtaker' AND "LapNumber" = "BaseLap" THEN abs("DeltaSessionTime") END) AS gap
  FROM run_close GROUP BY 1, 2, 3, 4 HAVING count(*) = 6),
spells AS (
  SELECT *, sum(CASE WHEN "BaseLap" - before > 3 THEN 1 ELSE 0 END) OVER w AS streak FROM (
    SELECT *, lag("BaseLap") OVER (PARTITION BY "Season", "Round", ov, pa ORDER BY "BaseLap") AS before FROM battles)
  WINDOW w AS (PARTITION BY "Season", "Round", ov, pa ORDER BY "BaseLap")),
best AS (
  SELECT "Season", "Round", "FailedID" FROM spells
  QUALIFY row_number() OVER (PARTITION BY "Season", "Round", ov, pa, streak ORDER BY gap, "BaseLap") = 1),
run_kept AS (SELECT * FROM run_close SEMI JOIN best USING ("Season", "Round", "FailedID")),
run_filled AS ({_filled_session("run_kept")}),
failed AS (SELECT *, {_deltas({**race.SESSION_DELTAS, **race.LAP_DELTAS})}, 0 AS "Sikeres" FROM run_filled
  WINDOW grp AS (PARTITION BY "Season", "Round", "FailedID", "LapNumber"))
"""

_ATTEMPT_COLUMNS = """i:BaseLap d:LapNumber DeltaSessionTime DeltaLapTime DeltaS1Time DeltaS2Time DeltaS3Time DeltaTyreLife
  DeltaSpeedI1 DeltaSpeedI2 DeltaSpeedFL DeltaSpeedST Sector1SessionTime Sector2SessionTime Sector3SessionTime
  DeltaSector1SessionTime DeltaSector2SessionTime DeltaSector3SessionTime i:Sikeres"""

registry = Registry()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@registry.add(
    "prepared_laps",
    """i:Season Round s:Driver d:LapNumber Position LapTimeCalculated Sector1 Sector2 Sector3 TyreLife SpeedI1 SpeedI2 SpeedFL
    SpeedST Stint PitEntryTime PitExitTime PitTime DNF PrevLapPosition PositionChange i:PitInLap PitOutLap PitOutLagLap Pit Flag
    OTable CompoundFactor""",
    f"WITH {PREPARED_SQL} SELECT * FROM prepared",
)
def prepared_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.prepare_laps(field.laps(spark, sf_dir))


@registry.add(
    "overtakes",
    f"""i:Season Round OvertakeID s:Role Driver {_ATTEMPT_COLUMNS} OTSector d:OvertakeIntervall_Bottom OvertakeIntervall_Upper""",
    f"WITH {OVERTAKES_SQL} SELECT * FROM overtakes",
)
def overtakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.find_overtakes(field.laps(spark, sf_dir))


@registry.add(
    "failed_attempts",
    f"i:Season Round FailedID s:Role Driver {_ATTEMPT_COLUMNS}",
    f"WITH {FAILED_SQL} SELECT * FROM failed",
)
def failed_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.find_failed_attempts(field.laps(spark, sf_dir))


@registry.add(
    "overtakes_per_race",
    "i:Season Round n_distinct_overtakes",
    f"""WITH {OVERTAKES_SQL} SELECT "Season", "Round", count(DISTINCT "OvertakeID") AS n_distinct_overtakes
    FROM overtakes GROUP BY 1, 2""",
)
def overtakes_per_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = race.find_overtakes(field.laps(spark, sf_dir))
    return found.groupBy("Season", "Round").agg(F.countDistinct("OvertakeID").alias("n_distinct_overtakes"))


def _drs(low: str, high: str) -> str:
    return f"""CASE WHEN EXISTS (SELECT 1 FROM telemetry t WHERE t."Season" = o."Season" AND t."Round" = o."Round"
      AND t."Driver" = o."Driver" AND t."SessionTime" >= o."{low}" AND t."SessionTime" <= o."{high}"
      AND t."DRS" BETWEEN 10 AND 14) THEN 1 ELSE 0 END"""


_WEATHER_OUT = ", ".join([f'w."{c}"' for c in race.WEATHER] + ['w."Time" AS "Weather_Time"'])


def _with_weather(source: str, time: str) -> str:
    return f"""SELECT o.*, {_WEATHER_OUT} FROM {source} o ASOF LEFT JOIN weather w
      ON o."Season" = w."Season" AND o."Round" = w."Race" AND o."{time}" >= w."Time" """


def _conformed(source: str, id_column: str) -> str:
    columns = [c for c in ["Driver", "Team", "Role", "BaseLap", *attempts.MEASURES, "EventName", "Country", "Location",
               "Weather_Time", *race.WEATHER, "Sikeres"]]
    return f"""SELECT "Season" || '_' || "Round" || '_' || "Sikeres" || '_' || "{id_column}" AS "AttemptID",
      "Season", "Round", {_quoted(columns)} FROM {source}"""


_CHANGE = [
    'abs("DeltaSector1SessionTime" - "DeltaSessionTime")',
    'abs("DeltaSector2SessionTime" - "DeltaSector1SessionTime")',
    'abs("DeltaSector3SessionTime" - "DeltaSector2SessionTime")',
]
_LEAST = f"least({', '.join(_CHANGE)})"


def _try_bound(ends: list[str]) -> str:
    cases = " ".join(f'WHEN {c} = {_LEAST} THEN "{e}"' for c, e in zip(_CHANGE, ends))
    return f'CASE WHEN "LapNumber" <> "BaseLap" THEN NULL {cases} END'


_TRY = f"""SELECT *, {_try_bound(["LapStartTime", "Sector1SessionTime", "Sector2SessionTime"])} AS "TryIntervall_Bottom",
    {_try_bound(["Sector1SessionTime", "Sector2SessionTime", "Sector3SessionTime"])} AS "TryIntervall_Upper",
    max(CASE WHEN "Role" = 'Overtaker' AND "LapNumber" = "BaseLap" THEN "Time" END)
      OVER (PARTITION BY "Season", "Round", "FailedID") AS base_time
  FROM failed"""

ATTEMPTS_SQL = f"""{OVERTAKES_SQL},
{FAILED_SQL[len(PREPARED_SQL) + 2:]},
won_drs AS (SELECT o.*, {_drs("OvertakeIntervall_Bottom", "OvertakeIntervall_Upper")} AS "DRS_OTSector",
  {_drs("LapStartTime", "Time")} AS "DRS_Lap" FROM overtakes o),
won AS ({_with_weather("won_drs", "OvertakeIntervall_Bottom")}),
tried AS ({_TRY}),
lost_drs AS (SELECT o.*, {_drs("TryIntervall_Bottom", "TryIntervall_Upper")} AS "DRS_OTSector",
  {_drs("LapStartTime", "Time")} AS "DRS_Lap" FROM tried o),
lost AS ({_with_weather("lost_drs", "base_time")}),
attempt_laps AS ({_conformed("won", "OvertakeID")} UNION ALL {_conformed("lost", "FailedID")})
"""


def _attempt_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.attempt_laps(
        field.laps(spark, sf_dir), field.telemetry(spark, sf_dir), field.weather(spark, sf_dir)
    )


def _wide_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = attempts.track_features(field.schedule(spark, sf_dir), field.track_sheet(spark, sf_dir))
    return attempts.attach_track(_attempt_laps(spark, sf_dir), features)


_MEASURE_KINDS = " ".join(
    ("i:" if m in ("CompoundFactor", "DRS_OTSector", "DRS_Lap") else "b:" if m == "FreshTyre" else "d:") + m
    for m in attempts.MEASURES
)


@registry.add(
    "attempt_laps",
    f"""s:AttemptID i:Season Round s:Driver Team Role d:BaseLap {_MEASURE_KINDS} s:EventName Country Location
    d:Weather_Time AirTemp Humidity Pressure TrackTemp WindDirection WindSpeed b:Rainfall i:Sikeres""",
    f"WITH {ATTEMPTS_SQL} SELECT * FROM attempt_laps",
)
def attempt_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempt_laps(spark, sf_dir)


_KNOWN = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in attempts.maps.LOCATION_ALIAS.items())


def known(column: str) -> str:
    return f"CASE {column} {_KNOWN} ELSE {column} END"


_BRAKING = " ".join(
    f"WHEN \"Location\" IN ({', '.join(repr(p) for p in places)}) THEN {level}"
    for level, places in attempts.maps.BRAKING_LEVEL.items()
)
TRACK_SQL = f"""
races AS (SELECT n_name || ' Grand Prix' AS "EventName", ({field._sql_list(field.LOCATIONS)})[n_nationkey + 1] AS "Location" FROM nation),
features AS (
  SELECT "EventName", {known('r."Location"')} AS place, CASE {_BRAKING.replace('"Location"', 'r."Location"')} END AS "BrakingLevel",
    regexp_replace("Overtaking", '^Overtaking\\s+', '') AS "OvertakingDifficulty",
    regexp_replace("Speed", '^Speed\\s+', '') AS "SpeedDescription", "Corners",
    "S1" AS "S1Description", "S2" AS "S2Description", "S3" AS "S3Description"
  FROM races r LEFT JOIN sheet s ON {known('r."Location"')} = {known('s."Location"')})"""

_INDICES = (1, 2, 3)


def _cell(measure: str, role: str, lap: int) -> str:
    return f"""max(CASE WHEN "Role" = '{role}' AND li = {lap} THEN "{measure}" END)"""


_FLAT_MEASURES = [
    m for m in attempts.MEASURES if not m.startswith("Sector") and m not in ("LapNumber", "DRS_OTSector")
]


def _flat_columns() -> list[tuple[str, str, str]]:
    """(output, kind, SQL) of the measures kept in the flat table."""
    out = []
    for m in _FLAT_MEASURES:
        kind = {"CompoundFactor": "i", "DRS_Lap": "i", "FreshTyre": "b"}.get(m, "d")
        for role in ("Overtaker", "Passed"):
            if m.startswith("Delta") and role == "Passed":
                continue
            if m in ("CompoundFactor", "FreshTyre", "Position", "Stint"):
                name = "Compound" if m == "CompoundFactor" else m
                out.append((f"{name}_{role}", kind, _cell(m, role, 1)))
            else:
                out += [(f"{m}_{role}_{k}", kind, _cell(m, role, k)) for k in (1, 2)]
    out += [(f"LapNumber{k}", "d", _cell("LapNumber", "Overtaker", k)) for k in (1, 2)]
    return out


_FLAT = _flat_columns()
_WEATHER_KINDS = [(c, "b" if c == "Rainfall" else "d") for c in race.WEATHER]
_BASE = """max(CASE WHEN "LapNumber" = "BaseLap" THEN "{c}" END)"""

FLAT_SQL = f"""{ATTEMPTS_SQL},{TRACK_SQL},
placed AS (
  SELECT a.*, f.* EXCLUDE ("EventName", place), CASE WHEN "Season" < 2022 THEN 0 ELSE 1 END AS "Era"
  FROM attempt_laps a LEFT JOIN features f ON a."EventName" = f."EventName" AND {known('a."Location"')} = f.place),
indexed_laps AS (SELECT *, row_number() OVER (PARTITION BY "AttemptID", "Role" ORDER BY "LapNumber") AS li FROM placed),
flat AS (
  SELECT "AttemptID", "Season", "Location", coalesce("BrakingLevel", 0) AS "BrakingLevel", "OvertakingDifficulty",
    "SpeedDescription", coalesce("Corners", 0) AS "Corners", "S1Description", "S2Description", "S3Description",
    "Sikeres" || '_' || "Era" AS "Stratify", "Sikeres",
    max(CASE WHEN "Role" = 'Overtaker' THEN "Driver" END) AS "Driver_Overtaker",
    max(CASE WHEN "Role" = 'Passed' THEN "Driver" END) AS "Driver_Passed",
    max(CASE WHEN "Role" = 'Overtaker' THEN "Team" END) AS "Team_Overtaker",
    max(CASE WHEN "Role" = 'Passed' THEN "Team" END) AS "Team_Passed",
    max(CASE WHEN "Role" = 'Overtaker' THEN "BaseLap" END) AS "BaseLap",
    max(CASE WHEN "Role" = 'Passed' THEN "BaseLap" END) AS "BaseLap_Passed",
    coalesce({_cell("DRS_OTSector", "Overtaker", 3)}, CASE
      WHEN abs({_cell("DeltaSector3SessionTime", "Overtaker", 2)}) < 1 THEN 1
      WHEN abs({_cell("DeltaSector3SessionTime", "Overtaker", 2)}) > 1 THEN 0 END, 0) AS "DRS_OTSector_Overtaker",
    coalesce({_cell("DRS_OTSector", "Passed", 3)}, CASE WHEN ('0x' || substr(md5("AttemptID" || '-42'), 1, 8))::BIGINT % 100 < 33 THEN 1 ELSE 0 END) AS "DRS_OTSector_Passed",
    {", ".join(f'coalesce({_BASE.format(c=c)}, {"false" if k == "b" else 0}) AS "{c}"' for c, k in _WEATHER_KINDS)},
    {", ".join(f'coalesce({sql}, {"false" if k == "b" else 0}) AS "{n}"' for n, k, sql in _FLAT)}
  FROM indexed_laps
  GROUP BY "AttemptID", "Season", "Location", "BrakingLevel", "OvertakingDifficulty", "SpeedDescription", "Corners",
    "S1Description", "S2Description", "S3Description", "Era", "Sikeres")
"""

# the passed car's flap flag is a seeded random draw where it is missing
_FLAT_OUT = f"""s:AttemptID i:Season s:Location i:BrakingLevel s:OvertakingDifficulty SpeedDescription i:Corners
  s:S1Description S2Description S3Description Stratify Driver_Overtaker Driver_Passed Team_Overtaker Team_Passed
  d:BaseLap BaseLap_Passed i:DRS_OTSector_Overtaker DRS_OTSector_Passed {" ".join(f"{k}:{c}" for c, k in _WEATHER_KINDS)}
  {" ".join(f"{k}:{n}" for n, k, _ in _FLAT)} i:Sikeres"""


@registry.add("attempts_wide", _FLAT_OUT, f"WITH {FLAT_SQL} SELECT * FROM flat")
def attempts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.flatten(_wide_input(spark, sf_dir))


def _map_case(column: str, table: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in table.items()) + " END"


def _team(side: str) -> str:
    c = f'"Team_{side}"'
    return f"replace(coalesce({_map_case(c, attempts.maps.TEAM_LINEAGE)}, {c}), ' ', '')"


_VARIANT_COMMON = f"""* REPLACE (CAST("Rainfall" AS INTEGER) AS "Rainfall", CAST("FreshTyre_Overtaker" AS INTEGER) AS "FreshTyre_Overtaker",
    CAST("FreshTyre_Passed" AS INTEGER) AS "FreshTyre_Passed", {_team("Overtaker")} AS "Team_Overtaker", {_team("Passed")} AS "Team_Passed",
    {_map_case('"OvertakingDifficulty"', attempts.maps.DIFFICULTY_LEVEL)} AS "OvertakingDifficulty",
    {_map_case('"SpeedDescription"', attempts.maps.SPEED_LEVEL)} AS "SpeedDescription", {known('"Location"')} AS "Location")"""

_LONGEST = "|".join(
    w.replace("'", "''") for w in sorted(attempts.text.PHRASE_STOP_WORDS, key=lambda w: (-len(w), w))
)


def _phrase(c: str) -> str:
    kept = f"""regexp_replace(lower("{c}"), '\\b({_LONGEST})\\b', '', 'g')"""
    return f"""replace(trim(regexp_replace(regexp_replace({kept}, '\\p{{P}}', '', 'g'), '\\s+', ' ', 'g')), ' ', '_') AS "{c}" """


_CHARACTER_OUT = f"""i:Season s:Location i:BrakingLevel OvertakingDifficulty SpeedDescription Corners
  s:S1Description S2Description S3Description Stratify Driver_Overtaker Driver_Passed Team_Overtaker Team_Passed
  d:BaseLap BaseLap_Passed i:DRS_OTSector_Overtaker DRS_OTSector_Passed {" ".join(f"{'i' if k == 'b' else k}:{c}" for c, k in _WEATHER_KINDS)}
  {" ".join(f"{'i' if k == 'b' else k}:{n}" for n, k, _ in _FLAT)} i:Sikeres"""


@registry.add(
    "model_input_character",
    _CHARACTER_OUT,
    f"""WITH {FLAT_SQL}, named AS (SELECT {_VARIANT_COMMON} FROM flat)
    SELECT * REPLACE ({", ".join(_phrase(f"S{i}Description") for i in (1, 2, 3))}) FROM named""",
)
def model_input_character(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.model_variant(attempts.flatten(_wide_input(spark, sf_dir)), **attempts.VARIANTS["character"])


_DELTA_NAMES = {f"{d}_{k}": f"{d}_Overtaker_{k}" for d in (
    "DeltaLapTime", "DeltaS1Time", "DeltaS2Time", "DeltaS3Time", "DeltaSector1SessionTime", "DeltaSector2SessionTime",
    "DeltaSector3SessionTime", "DeltaSpeedFL", "DeltaSpeedI1", "DeltaSpeedI2", "DeltaSpeedST") for k in (1, 2)}


@registry.add(
    "model_input_delta",
    f"""i:Season BrakingLevel OvertakingDifficulty SpeedDescription Corners s:Stratify TrackDescription Driver_Overtaker
    Driver_Passed Team_Overtaker Team_Passed d:BaseLap TargetPosition {" ".join(_DELTA_NAMES)} DeltaTyreLife
    i:Compound_Overtaker Compound_Passed FreshTyre_Overtaker FreshTyre_Passed Rainfall Sikeres""",
    f"""WITH {FLAT_SQL}, named AS (SELECT {_VARIANT_COMMON} FROM flat)
    SELECT *, {", ".join(f'"{old}" AS "{new}"' for new, old in _DELTA_NAMES.items())},
      "DeltaTyreLife_Overtaker_2" AS "DeltaTyreLife", "Position_Passed" AS "TargetPosition",
      regexp_replace(lower(concat_ws(' ', "Location", coalesce("S1Description", 'NA'), coalesce("S2Description", 'NA'),
        coalesce("S3Description", 'NA'))), '\\bcorners?\\b', '', 'g') AS "TrackDescription"
    FROM named""",
)
def model_input_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = attempts.flatten(_wide_input(spark, sf_dir))
    return attempts.model_variant(flat, **attempts.VARIANTS["delta_without_corners"])


@registry.add("speed_imputed", "s:AttemptID Role d:LapNumber SpeedI2 DeltaSpeedI2")
def speed_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed trap that was out in round 1 of 2025, filled from alike laps."""
    return attempts.impute_speed(_attempt_laps(spark, sf_dir), 2025, 1)


@registry.add(
    "speed_filled",
    "s:AttemptID Role d:LapNumber KeptSpeedI2 KeptDelta b:filled observed",
    f"""WITH {ATTEMPTS_SQL}, known AS (SELECT min("SpeedI2") AS lo, max("SpeedI2") AS hi FROM attempt_laps)
    SELECT "AttemptID", "Role", "LapNumber", "SpeedI2" AS "KeptSpeedI2",
      CASE WHEN "Season" <> 2025 OR "Round" <> 1 THEN "DeltaSpeedI2" END AS "KeptDelta",
      "SpeedI2" IS NOT NULL OR ("Season" = 2025 AND "Round" = 1) AS filled,
      CASE WHEN "SpeedI2" IS NOT NULL OR ("Season" = 2025 AND "Round" = 1) THEN true END AS observed
    FROM attempt_laps, known""",
)
def speed_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What imputation leaves as it was, which rows have a speed afterwards, and whether it lies among the observed ones."""
    laps = _attempt_laps(spark, sf_dir)
    chosen = (F.col("Season") == 2025) & (F.col("Round") == 1)
    keys = ["AttemptID", "Role", "LapNumber"]
    before = laps.select(*keys, F.col("SpeedI2").alias("KeptSpeedI2"))
    after = attempts.impute_speed(laps, 2025, 1)
    span = laps.agg(F.struct(F.min("SpeedI2").alias("lo"), F.max("SpeedI2").alias("hi"))).scalar()
    found = after.join(growing(before), keys).withColumns(
        {"KeptDelta": F.when(~chosen, F.col("DeltaSpeedI2")), "filled": F.col("SpeedI2").isNotNull(), "span": span}
    )
    return found.withColumn("observed", F.expr("SpeedI2 >= span.lo - 1e-9 AND SpeedI2 <= span.hi + 1e-9"))
