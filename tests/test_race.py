"""Hand-made laps with known passes and failed attempts."""

import pytest
from pyspark.sql import functions as F

from slipstream.operators import roles, sequence, statistics, temporal
from slipstream.plans import race

SCHEMA = """Season int, Round int, EventName string, Country string, Location string, EventDate timestamp, Driver string,
  Team string, LapNumber double, Position double, Stint double, TyreLife double, Time double, LapTime double,
  Sector1Time double, Sector2Time double, Sector3Time double, LapStartTime double, Sector1SessionTime double,
  Sector2SessionTime double, Sector3SessionTime double, PitInTime double, PitOutTime double, SpeedI1 double,
  SpeedI2 double, SpeedFL double, SpeedST double, Compound string, FreshTyre boolean, TrackStatus string, IsAccurate boolean"""


def lap(driver, number, position, start=None, **more):
    start = number * 90.0 + position if start is None else start
    row = {
        "Season": 2023, "Round": 1, "EventName": "X Grand Prix", "Country": "X", "Location": "Monza", "EventDate": None,
        "Driver": driver, "Team": "T", "LapNumber": float(number), "Position": None if position is None else float(position),
        "Stint": 1.0, "TyreLife": float(number), "LapTime": 90.0, "Sector1Time": 30.0, "Sector2Time": 30.0,
        "Sector3Time": 30.0, "LapStartTime": start, "Sector1SessionTime": start + 30, "Sector2SessionTime": start + 60,
        "Sector3SessionTime": start + 90, "Time": start + 90, "PitInTime": None, "PitOutTime": None, "SpeedI1": 280.0,
        "SpeedI2": 285.0, "SpeedFL": 290.0, "SpeedST": 300.0, "Compound": "SOFT", "FreshTyre": True, "TrackStatus": "1",
        "IsAccurate": True,
    }
    row.update(more)
    return row


def frame(spark, rows):
    names = [c.strip().split()[0] for c in SCHEMA.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def swap_race(changes=None, last=5, at=3):
    """A passes B on lap ``at``; ``changes`` maps (driver, lap) to other values."""
    rows = []
    for n in range(1, last + 1):
        before = n < at
        rows.append(lap("A", n, 5 if before else 4, **(changes or {}).get(("A", n), {})))
        rows.append(lap("B", n, 4 if before else 5, **(changes or {}).get(("B", n), {})))
        rows.append(lap("C", n, 9))
    return rows


def found(spark, rows):
    got = race.passes(race.prepare_laps(frame(spark, rows))).collect()
    return sorted((r["OvertakeID"], r["Driver"], r["PassedDriver"], int(r["BaseLap"])) for r in got)


def test_simple_pass(spark):
    laps = frame(spark, swap_race())
    rows = race.find_overtakes(laps)
    got = rows.select("OvertakeID", "Role", "Driver", "BaseLap", "LapNumber", "OTSector", "Sikeres").collect()
    assert len(got) == 6
    assert {(r["Role"], r["Driver"]) for r in got} == {("Overtaker", "A"), ("Passed", "B")}
    assert {r["LapNumber"] for r in got} == {1.0, 2.0, 3.0}
    assert {r["Sikeres"] for r in got} == {1}
    base = rows.where("LapNumber = BaseLap").select("OvertakeIntervall_Bottom", "OvertakeIntervall_Upper").distinct().collect()
    # A is ahead by the end of sector 1 of lap 3
    assert [tuple(r) for r in base] == [(274.0, 304.0)]
    off = rows.where("LapNumber <> BaseLap AND OvertakeIntervall_Bottom IS NOT NULL")
    assert off.count() == 0
    assert "IsAccurate" not in rows.columns


@pytest.mark.parametrize(
    "changes, passes",
    [
        ({}, 1),
        ({("B", 3): {"PitInTime": 300.0}}, 0),
        ({("B", 3): {"PitOutTime": 300.0}}, 0),
        ({("B", 2): {"PitOutTime": 200.0}}, 0),
        ({("A", 3): {"PitInTime": 300.0}}, 0),
        ({("A", 3): {"TrackStatus": "2"}}, 0),
        ({("A", 3): {"TrackStatus": "12"}}, 1),
        ({("A", 3): {"TrackStatus": None}}, 0),
        ({("A", 2): {"Position": None}}, 0),
        ({("B", 3): {"Position": 3.0}}, 0),
    ],
)
def test_pass_rule(spark, changes, passes):
    assert len(found(spark, swap_race(changes))) == passes


def test_double_pass_is_numbered_by_passed_car(spark):
    rows = [lap("A", 1, 6), lap("B", 1, 4), lap("C", 1, 5), lap("A", 2, 4), lap("B", 2, 5), lap("C", 2, 6)]
    assert found(spark, rows) == [(1, "A", "B", 2), (2, "A", "C", 2)]


def test_retirement(spark):
    rows = [r for r in swap_race(last=6) if not (r["Driver"] == "B" and r["LapNumber"] > 4)]
    assert found(spark, rows) == []  # B's last lap is two short
    rows = [r for r in swap_race(last=6) if not (r["Driver"] == "B" and r["LapNumber"] > 5)]
    assert len(found(spark, rows)) == 1  # one lap down still counts as finishing


def test_early_laps(spark):
    rows = race.find_overtakes(frame(spark, swap_race(at=2)))
    assert sorted((r["Role"], r["LapNumber"]) for r in rows.select("Role", "LapNumber").collect()) == [
        ("Overtaker", 1.0), ("Overtaker", 2.0), ("Passed", 1.0), ("Passed", 2.0),
    ]
    assert found(spark, swap_race(at=1)) == []


def test_races_do_not_mix(spark):
    rows = swap_race() + [{**r, "Season": 2024} for r in swap_race()]
    assert found(spark, rows) == [(1, "A", "B", 3), (1, "A", "B", 3)]


def test_gap_of_zero_has_no_sector(spark):
    rows = race.find_overtakes(frame(spark, swap_race({("A", 3): {"Sector1SessionTime": 305.0}, ("B", 3): {"Sector1SessionTime": 305.0}})))
    got = rows.where("LapNumber = 3").select("OTSector", "OvertakeIntervall_Bottom").distinct().collect()
    assert [tuple(r) for r in got] == [(0, None)]


def test_repair(spark):
    rows = [lap("A", n, 1) for n in range(1, 6)]
    rows[0].update(LapTime=None)
    rows[1].update(Sector2Time=None, LapTime=95.0)
    rows[2].update(LapTime=None, Sector1Time=None, Sector2Time=None, Sector3Time=None)
    rows[0].update(SpeedI1=None)
    rows[2].update(SpeedI1=None)
    rows[3].update(SpeedI1=300.0)
    rows[4].update(SpeedI1=None, SpeedFL=None)
    got = race.repair_laps(frame(spark, rows)).orderBy("LapNumber").collect()
    assert [r["LapTimeCalculated"] for r in got] == [90.0, 95.0, 90.0, 90.0, 90.0]
    assert [r["Sector2"] for r in got] == [30.0, 35.0, 30.0, 30.0, 30.0]
    assert [r["SpeedI1"] for r in got] == [None, 280.0, 290.0, 300.0, None]
    assert got[4]["SpeedFL"] == 290.0


def test_interpolation_across_drivers(spark):
    rows = [lap("A", 1, 1, SpeedI1=100.0), lap("A", 2, 1, SpeedI1=None), lap("B", 1, 2, SpeedI1=300.0)]
    by_driver = race.repair_laps(frame(spark, rows)).where("Driver = 'A' AND LapNumber = 2").head()["SpeedI1"]
    whole = race.repair_laps(frame(spark, rows), across_drivers=True).where("Driver = 'A' AND LapNumber = 2").head()["SpeedI1"]
    assert (by_driver, whole) == (None, 200.0)


def test_stint_counts_both_laps_of_a_stop(spark):
    rows = [lap("A", n, 1, Stint=None) for n in range(1, 7)]
    rows[2].update(PitInTime=300.0)
    rows[3].update(PitOutTime=380.0)
    twice = race.prepare_laps(frame(spark, rows)).orderBy("LapNumber").collect()
    assert [r["Stint"] for r in twice] == [1.0, 1.0, 1.0, 2.0, 3.0, 3.0]
    once = race.prepare_laps(frame(spark, rows), count_stops_once=True).orderBy("LapNumber").collect()
    assert [r["Stint"] for r in once] == [1.0, 1.0, 1.0, 1.0, 2.0, 2.0]


def chase(gaps, start=2):
    """B follows A with the given gaps at lap start, one per lap."""
    rows = []
    for i, gap in enumerate(gaps):
        n = start + i
        rows += [lap("A", n, 1, start=n * 90.0), lap("B", n, 2, start=n * 90.0 + gap)]
    return rows


@pytest.mark.parametrize(
    "gaps, bases",
    [
        ([1.0, 1.4, 1.2], [4]),
        ([1.0, 1.0, 1.6], []),
        ([1.0, 1.0, 1.5], []),
        ([1.0, 1.0], []),
        ([1.3, 1.2, 1.1, 0.9, 1.4], [5]),
        ([1.3, 1.2, 1.0, 1.0, 1.0], [4]),
    ],
)
def test_failed_attempt(spark, gaps, bases):
    rows = race.find_failed_attempts(frame(spark, chase(gaps)))
    got = rows.select("BaseLap", "Role", "LapNumber", "Driver", "Sikeres").collect()
    assert sorted({int(r["BaseLap"]) for r in got}) == bases
    assert len(got) == 6 * len(bases)
    assert all(r["Sikeres"] == 0 and r["Driver"] == ("B" if r["Role"] == "Overtaker" else "A") for r in got)


def test_streaks(spark):
    df = spark.createDataFrame([("p", float(n), 1.0) for n in (5, 6, 9, 13)], "pair string, lap double, gap double")
    got = sequence.streaks(df, ["pair"], "lap", 3).orderBy("lap").collect()
    assert [r["Streak_ID"] for r in got] == [0, 0, 0, 1]
    best = sequence.best_per_group(sequence.streaks(df, ["pair"], "lap", 3), ["pair", "Streak_ID"], ["gap", "lap"])
    assert sorted(r["lap"] for r in best.collect()) == [5.0, 13.0]


def test_attempt_interval_ties(spark):
    schema = """BaseLap double, LapNumber double, LapStartTime double, Sector1SessionTime double, Sector2SessionTime double,
      Sector3SessionTime double, DeltaSessionTime double, DeltaSector1SessionTime double, DeltaSector2SessionTime double,
      DeltaSector3SessionTime double"""
    rows = [
        (5.0, 5.0, 0.0, 30.0, 60.0, 90.0, 1.0, 1.25, 1.5, 3.0),  # sectors 1 and 2 tie
        (5.0, 5.0, 0.0, 30.0, 60.0, 90.0, 1.0, None, 1.5, 1.75),  # only sector 3 is known
        (5.0, 4.0, 0.0, 30.0, 60.0, 90.0, 1.0, 1.25, 1.5, 3.0),  # not the base lap
        (5.0, 5.0, 0.0, 30.0, 60.0, 90.0, None, None, None, None),
    ]
    got = roles.attempt_interval(spark.createDataFrame(rows, schema)).collect()
    assert [(r["TryIntervall_Bottom"], r["TryIntervall_Upper"]) for r in got] == [
        (0.0, 30.0), (60.0, 90.0), (None, None), (None, None),
    ]


def test_drs_and_weather(spark):
    rows = race.find_overtakes(frame(spark, swap_race()))
    telemetry = spark.createDataFrame(
        [(2023, 1, "A", 304.0, 12), (2023, 1, "B", 305.0, 12), (2023, 2, "B", 280.0, 12), (2023, 1, "B", 100.0, 8)],
        "Season int, Round int, Driver string, SessionTime double, DRS int",
    )
    flagged = race.attach_drs(rows, telemetry, "OvertakeIntervall_Bottom", "OvertakeIntervall_Upper")
    got = {(r["Driver"], r["LapNumber"]): (r["DRS_OTSector"], r["DRS_Lap"]) for r in flagged.collect()}
    assert got == {("A", 3.0): (1, 1), ("B", 3.0): (0, 1), ("A", 2.0): (0, 0), ("B", 2.0): (0, 0), ("A", 1.0): (0, 0), ("B", 1.0): (0, 0)}
    weather = spark.createDataFrame(
        [(2023, 1, 270.0, 20.0), (2023, 1, 275.0, 21.0), (2023, 2, 273.0, 30.0)], "Season int, Race int, Time double, AirTemp double"
    ).selectExpr("*", "1D AS Humidity", "1D AS Pressure", "false AS Rainfall", "1D AS TrackTemp", "1 AS WindDirection", "1D AS WindSpeed")
    wet = race.attach_weather(rows, weather, "OvertakeIntervall_Bottom")
    assert {(r["LapNumber"], r["Weather_Time"], r["AirTemp"]) for r in wet.collect()} == {(3.0, 270.0, 20.0), (2.0, None, None), (1.0, None, None)}
    assert wet.agg(F.count("*")).head()[0] == 6


def test_growing_sides_are_not_broadcast(spark):
    """Sides that grow with the input are shuffled, however small their files look to the optimizer."""
    laps = frame(spark, swap_race())
    asked = spark.createDataFrame([("a", 1.0, 2.0)], "k string, low double, high double")
    samples = spark.createDataFrame([("a", 1.5)], "k string, at double")
    flagged = temporal.interval_flags(asked, samples, ["k"], "at", {"hit": ("low", "high")}, spread=False)
    values = spark.createDataFrame([(i, None if i % 5 == 0 else float(i), float(i)) for i in range(40)], "id int, y double, x double")
    filled = statistics.impute_by_matching(values, "id", "y", ["x"], draws=2, spread=False)
    for found in (race.find_overtakes(laps), race.find_failed_attempts(laps), flagged, filled):
        found.collect()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert flagged.head()["hit"] == 1 and filled.where("y IS NULL").count() == 0
