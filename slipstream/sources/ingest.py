"""Metadata on landed session files: event, grid slot, driver code, and what arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT = ["EventName", "Country", "Location", "EventDate"]


def race_calendar(schedule: DataFrame) -> DataFrame:
    """Events that are races weekends, testing left out."""
    return schedule.where(F.col("EventFormat") != "testing")


def count_races(schedule: DataFrame) -> DataFrame:
    return race_calendar(schedule).agg(F.count("*").alias("races"))


def stamp_event(df: DataFrame, calendar: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Add event columns by season and round.

    A calendar has one row per event; the optimizer broadcasts it when its size allows.
    """
    return df.join(calendar.select(*keys, *columns).dropDuplicates(list(keys)), list(keys), "left")


def grid_position(laps: DataFrame, quali: DataFrame, race: Sequence[str] = ("Season", "Round")) -> DataFrame:
    """Qualifying position of each car as its grid slot; null for a car without one."""
    slots = quali.select(*race, "DriverNumber", F.col("Position").alias("GridPosition"))
    return laps.join(slots, [*race, "DriverNumber"], "left")


def driver_code(df: DataFrame, drivers: DataFrame, keys: Sequence[str], out: str = "Driver") -> DataFrame:
    """The driver's abbreviation, or the car number when there is none."""
    known = drivers.select(*keys, F.col("Abbreviation").alias("__code"))
    return df.join(known, list(keys), "left").withColumn(out, F.coalesce("__code", "DriverNumber")).drop("__code")


def rows_per_round(df: DataFrame, expected: DataFrame, keys: Sequence[str] = ("Season", "Round")) -> DataFrame:
    """Rows that arrived for each expected round, 0 for one that is missing."""
    arrived = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return expected.select(*keys).join(arrived, list(keys), "left").fillna(0, ["rows"])
