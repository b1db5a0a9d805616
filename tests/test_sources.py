"""Landed files: feather, nanosecond times, season folders, lookups, metrics."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from slipstream.session import checkpoint_folder
from slipstream.sources import ingest, readers, sinks


def test_feather(spark, tmp_path):
    for race in (1, 2):
        pd.DataFrame(
            {
                "Time": pd.to_timedelta([1.5, 60.25], unit="s"),
                "AirTemp": [20.5, None],
                "Rainfall": [True, False],
                "Race": [race, race],
                "Day": pd.to_datetime(["2024-03-01", "2024-03-02"]),
            }
        ).to_feather(tmp_path / f"weather_{race}.feather")
    got = readers.read_feather(spark, str(tmp_path / "*.feather"))
    assert dict(got.dtypes)["Time"] == "double"
    rows = sorted((r["Race"], r["Time"], r["AirTemp"], r["Rainfall"]) for r in got.collect())
    assert rows[0] == (1, 1.5, 20.5, True) and len(rows) == 4
    assert got.where("AirTemp IS NULL").count() == 2


def test_laps_of_all_seasons(spark, tmp_path):
    for season in (2018, 2019):
        pd.DataFrame(
            {
                "Driver": ["A"],
                "LapTime": pd.to_timedelta([90.125], unit="s"),
                "EventDate": pd.Series(pd.to_datetime(["2018-03-25 05:10:00"])).astype("datetime64[ns]"),
            }
        ).to_parquet(tmp_path / f"laps_{season}.parquet")
    got = readers.read_laps(spark, str(tmp_path)).orderBy("Season").collect()
    assert [(r["Season"], r["LapTime"]) for r in got] == [(2018, 90.125), (2019, 90.125)]
    assert got[0]["EventDate"] == datetime.datetime(2018, 3, 25, 5, 10)


def test_existing_paths(spark, tmp_path):
    (tmp_path / "r1.parquet").write_bytes(b"")
    found, absent = readers.existing_paths(spark, [f"{tmp_path}/r1.parquet", f"{tmp_path}/r2.parquet"])
    assert len(found) == 1 and absent == [f"{tmp_path}/r2.parquet"]


def test_lenient_scan_skips_broken_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet")
    df = spark.read.schema("id long").option("ignoreCorruptFiles", "true").parquet(str(tmp_path / "good"), str(tmp_path / "bad"))
    assert df.count() == 3
    with pytest.raises(ValueError, match="missing columns: speed"):
        readers.read_parquet(spark, str(tmp_path / "good"), ["id", "speed"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2018, "a"), (2019, "b")], "Season int, x string")
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert (tmp_path / "p" / "Season=2018").is_dir()
    sinks.write_report(df, str(tmp_path / "c"))
    assert readers.read_lookup(spark, str(tmp_path / "c")).count() == 2
    sinks.write_metrics(spark, {"f1": 0.5, "best": {"depth": 3}, "matrix": [[1, 2], [3, 4]]}, str(tmp_path / "m"))
    row = spark.read.json(str(tmp_path / "m")).head()
    assert row["f1"] == 0.5 and row["best"]["depth"] == 3 and row["matrix"][1] == [3, 4]


def test_ingest(spark):
    laps = spark.createDataFrame([(2018, 1, "44"), (2018, 1, "99"), (2018, 2, "44")], "Season int, Round int, DriverNumber string")
    quali = spark.createDataFrame([(2018, 1, "44", 1.0)], "Season int, Round int, DriverNumber string, Position double")
    got = ingest.grid_position(laps, quali)
    assert sorted((r["Round"], r["DriverNumber"], r["GridPosition"]) for r in got.collect()) == [(1, "44", 1.0), (1, "99", None), (2, "44", None)]
    names = spark.createDataFrame([("44", "HAM")], "DriverNumber string, Abbreviation string")
    assert {r["Driver"] for r in ingest.driver_code(laps, names, ["DriverNumber"]).collect()} == {"HAM", "99"}
    calendar = spark.createDataFrame([("testing", 0), ("conventional", 1)], "EventFormat string, Round int")
    assert ingest.count_races(calendar).head()[0] == 1
    expected = spark.createDataFrame([(2018, 1), (2018, 3)], "Season int, Round int")
    assert {(r["Round"], r["rows"]) for r in ingest.rows_per_round(laps, expected).collect()} == {(1, 2), (3, 0)}


def test_checkpoint_folder_is_the_sessions(spark):
    assert checkpoint_folder(spark) == spark.sparkContext.getCheckpointDir()


def test_durations(spark):
    df = spark.createDataFrame([(90_500_000_000, 1.5)], "LapTime long, Time double")
    assert tuple(readers.durations_to_seconds(df).head()) == (90.5, 1.5)
    stamp = spark.range(1).select(readers.nanos_to_timestamp(F.lit(1_500_000_000_000)).alias("t")).head()[0]
    assert stamp == datetime.datetime(1970, 1, 1, 0, 25)


def test_seasons_come_from_folders_or_names(spark, tmp_path):
    laps = spark.createDataFrame([(2018, 1.0), (2019, 2.0), (2019, 3.0)], "Season int, x double")
    sinks.write_parquet(laps, str(tmp_path / "own"))
    back = readers.read_seasons(spark, str(tmp_path / "own"))
    assert sorted(map(tuple, back.select("Season", "x").collect())) == [(2018, 1.0), (2019, 2.0), (2019, 3.0)]
    plan = back.where("Season = 2018")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Season" in plan
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "named").mkdir()
    for year in (2020, 2021):
        pq.write_table(pa.table({"x": [float(year)]}), tmp_path / "named" / f"laps_{year}.parquet")
    named = readers.read_seasons(spark, str(tmp_path / "named"))
    assert sorted(map(tuple, named.select("Season", "x").collect())) == [(2020, 2020.0), (2021, 2021.0)]
    laps.select("x").write.parquet(str(tmp_path / "nameless"))
    with pytest.raises(Exception, match="no season"):
        readers.read_seasons(spark, str(tmp_path / "nameless")).collect()


def test_unreadable_files_are_listed(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"not a table at all")
    found = readers.unreadable(spark, [str(tmp_path / "bad.parquet"), str(tmp_path / "good" / "*.parquet")])
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["bad.parquet"]
