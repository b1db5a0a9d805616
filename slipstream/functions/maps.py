"""Value maps of the race domain, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tyre compounds by class.
COMPOUND_CLASS = {
    "SOFT": 1,
    "ULTRASOFT": 1,
    "SUPERSOFT": 1,
    "HYPERSOFT": 1,
    "MEDIUM": 2,
    "HARD": 3,
    "WET": 4,
    "INTERMEDIATE": 4,
}

# Former team names and the current name of the same entry.
TEAM_LINEAGE = {
    "Force India": "Aston Martin",
    "Racing Point": "Aston Martin",
    "Alfa Romeo": "Kick Sauber",
    "Alfa Romeo Racing": "Kick Sauber",
    "Sauber": "Kick Sauber",
    "AlphaTauri": "Racing Bulls",
    "Toro Rosso": "Racing Bulls",
    "RB": "Racing Bulls",
    "Renault": "Alpine",
}

# Ordinal levels of the track descriptions.
DIFFICULTY_LEVEL = {"Medium": 1, "Good": 2, "Difficult": 3, "Very Difficult": 4}
SPEED_LEVEL = {"Low": 1, "Medium": 2, "High": 3, "Very High": 4}

# Second names of the same place.
LOCATION_ALIAS = {"Yas Island": "Yas Marina", "Monte Carlo": "Monaco", "Miami Gardens": "Miami"}

# Braking level of each location, by level.
BRAKING_LEVEL = {
    1: ["Silverstone", "Suzuka"],
    2: ["Barcelona", "São Paulo", "Zandvoort", "Hockenheim"],
    3: [
        "Yas Island",
        "Austin",
        "Lusail",
        "Budapest",
        "Imola",
        "Las Vegas",
        "Melbourne",
        "Miami",
        "Monaco",
        "Shanghai",
        "Marina Bay",
        "Miami Gardens",
        "Monte Carlo",
        "Singapore",
        "Mugello",
        "Sochi",
        "Nürburgring",
        "Portimão",
        "Le Castellet",
    ],
    4: ["Baku", "Mexico City", "Jeddah", "Montréal", "Spa-Francorchamps", "Spielberg", "Istanbul"],
    5: ["Monza", "Sakhir"],
}


def lookup(value: Column, table: dict) -> Column:
    """The entry for ``value`` in a literal map, or null."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), value)


def compound_class(compound: Column) -> Column:
    return F.coalesce(lookup(compound, COMPOUND_CLASS), F.lit(0))


def current_team(team: Column, squeeze: bool = True) -> Column:
    """The current name of a team; without spaces when ``squeeze``."""
    name = F.coalesce(lookup(team, TEAM_LINEAGE), team)
    return F.replace(name, F.lit(" "), F.lit("")) if squeeze else name


def difficulty_level(text: Column) -> Column:
    return lookup(text, DIFFICULTY_LEVEL)


def speed_level(text: Column) -> Column:
    return lookup(text, SPEED_LEVEL)


def known_location(location: Column) -> Column:
    return F.coalesce(lookup(location, LOCATION_ALIAS), location)


def braking_level(location: Column) -> Column:
    """Braking level 1 to 5 of a location; null when the location is not listed."""
    return lookup(location, {place: level for level, places in BRAKING_LEVEL.items() for place in places})


def era(season: Column, first_new: int = 2022) -> Column:
    return (season >= first_new).cast("int")


def stratum(label: Column, era_flag: Column) -> Column:
    return F.concat_ws("_", label.cast("string"), era_flag.cast("string"))


def status_flag(status: Column) -> Column:
    """1 when the track status is anything but exactly clear; null for an unknown status."""
    return (status != "1").cast("int")


def eligible_lap(pit: Column, status: Column, lap_time: Column) -> Column:
    """1 for a lap without a stop, clear for at least a part, and with a known time."""
    clear = F.coalesce(status.contains("1"), F.lit(False))
    return F.coalesce((pit == 0) & clear & lap_time.isNotNull(), F.lit(False)).cast("int")
