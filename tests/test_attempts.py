"""Wide rows, value maps, text forms and the model input tables."""

import pytest
from pyspark.sql import functions as F

from slipstream.catalog import field
from slipstream.catalog import race as queries
from slipstream.functions import maps, text
from slipstream.plans import attempts
from slipstream.session import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flat(spark):
    return attempts.flatten(queries._wide_input(spark, SF)).cache()


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(x,) for x in inputs], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_value_maps(spark):
    teams = ["Alfa Romeo Racing", "RB", "Renault", "Ferrari", "Racing Point", None]
    assert values(spark, maps.current_team, teams) == ["KickSauber", "RacingBulls", "Alpine", "Ferrari", "AstonMartin", None]
    assert values(spark, maps.difficulty_level, ["Medium", "Very Difficult", "Easy"]) == [1, 4, None]
    assert values(spark, maps.braking_level, ["Monza", "Suzuka", "X"]) == [5, 1, None]
    assert values(spark, maps.compound_class, ["SOFT", "HARD", "INTERMEDIATE", "??", None]) == [1, 3, 4, 0, 0]
    assert values(spark, maps.known_location, ["Monte Carlo", "Monza"]) == ["Monaco", "Monza"]
    assert values(spark, maps.era, [2021, 2022], "int") == [0, 1]


def test_texts(spark):
    told = ["Fast CORNERS, and the corner.", "It's  the   end", None]
    assert values(spark, text.phrase, told) == ["fast_corners_corner", "end", None]
    assert values(spark, text.strip_corner_words, ["fast corners and the corner, cornering"]) == ["fast  and the , cornering"]
    joined = spark.range(1).select(text.joined_text(F.lit("Monza"), F.lit(None).cast("string"))).head()[0]
    assert joined == "monza na"
    assert values(spark, lambda c: text.strip_prefix(c, "Speed"), ["Speed Very High", "High Speed "]) == ["Very High", "High Speed "]


def test_track_join_keeps_rows(spark):
    schedule = spark.createDataFrame(
        [("Abu Dhabi Grand Prix", "Yas Island"), ("Abu Dhabi Grand Prix", "Yas Marina"), ("Abu Dhabi Grand Prix", "Paul Ricard"), ("Testing", "Sakhir")],
        "EventName string, Location string",
    )
    sheet = spark.createDataFrame(
        [("Yas Marina", "Overtaking Good", "Speed High", 16, "a", "b", "c")],
        "Location string, Overtaking string, Speed string, Corners int, `Sector 1` string, `Sector 2` string, `Sector 3` string",
    )
    features = attempts.track_features(schedule.where("Location <> 'Yas Marina'"), sheet)
    rows = spark.createDataFrame([(2021, "Abu Dhabi Grand Prix", "Yas Island", 1), (2022, "Abu Dhabi Grand Prix", "Sochi", 0)], "Season int, EventName string, Location string, Sikeres int")
    got = attempts.attach_track(rows, features).orderBy("Season").collect()
    assert [(r["OvertakingDifficulty"], r["BrakingLevel"], r["Stratify"]) for r in got] == [("Good", 3, "1_0"), (None, None, "0_1")]


def test_plans_hold_each_step_once(spark):
    """The stacked rows are stored before each step that reads them often, so the driver's plan has nothing of the steps before."""
    plan = queries._attempt_laps(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 8 and "OTable" not in plan
    flat = attempts.flatten(queries._wide_input(spark, SF))
    for name in ("character", "delta_without_corners"):
        variant = attempts.model_variant(flat, **attempts.VARIANTS[name])
        assert len(variant._jdf.queryExecution().executedPlan().toString()) < 200_000, name


def test_rows_of_attempts_are_stored_by_small_plans(spark, monkeypatch):
    """The two kinds of attempt are stored one after the other, and the rows again after the weather."""
    exchanges, keep = {}, attempts.staged

    def noted(df, name, *more):
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (df, *more)]
        exchanges[name] = [plan.count("Exchange") for plan in plans]
        return keep(df, name, *more)

    monkeypatch.setattr(attempts, "staged", noted)
    plan = queries._attempt_laps(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(exchanges["attempt-rows"]) == 2 and max(exchanges["attempt-rows"]) <= 12
    assert "Window [" not in plan and "Join" not in plan


def test_parts_of_a_stored_table_have_the_same_columns(spark):
    both = staged(spark.range(2), "parts", spark.range(2, 5))
    assert sorted(r["id"] for r in both.collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        staged(spark.range(2), "parts", spark.range(2).select(F.col("id").cast("int")))


def test_one_row_per_attempt(spark, flat):
    long = queries._wide_input(spark, SF)
    assert flat.count() == long.select("AttemptID").distinct().count() == flat.select("AttemptID").distinct().count()
    assert flat.columns[-1] == "Sikeres"
    nulls = flat.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c, t in flat.dtypes if t != "string"]).head()
    assert not any(nulls)
    assert not [c for c in flat.columns if c.startswith("Delta") and "_Passed_" in c]


def test_flap_flag_rules(spark, flat):
    rows = flat.select("DRS_OTSector_Overtaker", "DRS_OTSector_Passed").distinct().collect()
    assert {v for r in rows for v in r} <= {0, 1}


def test_variants(flat):
    shapes = {name: attempts.model_variant(flat, **options) for name, options in attempts.VARIANTS.items()}
    assert all("AttemptID" not in v.columns and v.columns[-1] == "Sikeres" for v in shapes.values())
    assert "DeltaTyreLife" in shapes["delta"].columns and "SpeedI1_Overtaker_1" not in shapes["delta"].columns
    assert "SpeedI1_Overtaker_1" in shapes["clean"].columns and "TargetPosition" in shapes["clean"].columns
    assert "LapNumber1" in shapes["all_variables"].columns and "LapNumber1" not in shapes["clean"].columns
    assert {"Location", "S1Description"} <= set(shapes["character"].columns)
    assert shapes["clean"].columns == shapes["clean_without_corners"].columns
    told = shapes["delta_without_corners"].select("TrackDescription").distinct().collect()
    assert told and not any("corner" in r[0] for r in told)
    with pytest.raises(ValueError):
        attempts.model_variant(flat, text_mode="other")


def test_three_laps(spark):
    wide = attempts.flatten(queries._wide_input(spark, SF), laps=3)
    variant = attempts.model_variant(wide, raw=False, laps=3)
    assert {"DeltaLapTime_3", "DeltaTyreLife", "TargetPosition"} <= set(variant.columns)


def test_relative_laps(spark):
    long = queries._wide_input(spark, SF)
    wide = attempts.widen(long, laps=3, relative=True)
    short = wide.where("LapNumber_Overtaker_1 IS NULL")
    assert wide.where("LapNumber_Overtaker_3 <> BaseLap_Overtaker").count() == 0
    assert short.where("BaseLap_Overtaker > 2").count() == 0


def test_pick_one_is_repeatable(flat):
    doubled = flat.unionByName(flat.withColumn("AirTemp", F.col("AirTemp") + 1))
    first, second = (attempts.pick_one(d).select("AttemptID", "AirTemp").orderBy("AttemptID").collect() for d in (doubled, doubled.repartition(3)))
    assert first == second and len(first) == flat.count()


def test_speed_delta_is_redone_where_chosen(spark):
    rows = [("a", 1.0, "Overtaker", 10.0, 99.0), ("a", 1.0, "Passed", 4.0, 99.0), ("a", 2.0, "Overtaker", 7.0, 99.0), ("a", 2.0, "Passed", 9.0, 99.0)]
    df = spark.createDataFrame(rows, "AttemptID string, LapNumber double, Role string, SpeedI2 double, DeltaSpeedI2 double")
    df = df.withColumns({"Season": F.lit(2025), "Round": F.lit(22)})
    got = attempts.redo_speed_delta(df, F.col("LapNumber") == 1).orderBy("LapNumber", "Role").collect()
    assert [r["DeltaSpeedI2"] for r in got] == [6.0, -6.0, 99.0, 99.0]


def test_conform_needs_every_column(spark):
    with pytest.raises(Exception, match="Driver"):
        attempts.conform(spark.createDataFrame([(1, 1, 1, 1)], "Season int, Round int, Sikeres int, OvertakeID int"), "OvertakeID")


def test_field_is_a_race(spark):
    laps = field.laps(spark, SF)
    assert laps.groupBy("Season", "Round", "Driver", "LapNumber").count().where("count > 1").count() == 0
