"""A season of races derived from the given tables, in Spark and in SQL.

Users are cars, twenty to a race, and days are laps. The order on the road is the order of the running
totals of event values, so leads change early and settle later, as in a race. Lap, sector, speed and
stop columns are integer arithmetic on the day's cents; days without events leave them null, which
gives the repair steps something to repair. Everything grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CARS = 20
LOCATIONS = [
    "Silverstone", "Suzuka", "Barcelona", "São Paulo", "Zandvoort", "Yas Island", "Austin", "Lusail", "Budapest",
    "Imola", "Las Vegas", "Melbourne", "Monte Carlo", "Miami Gardens", "Shanghai", "Singapore", "Baku", "Jeddah",
    "Montréal", "Spa-Francorchamps", "Spielberg", "Istanbul", "Monza", "Sakhir", "Kyalami",
]
TEAMS = [
    "Mercedes", "Ferrari", "RB", "Alfa Romeo Racing", "Renault",
    "Force India", "Red Bull Racing", "Williams", "Haas F1 Team", "McLaren",
]
COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "WET", "INTERMEDIATE", "ULTRASOFT", "SUPERSOFT", "HYPERSOFT", "TEST"]
STATUS = ["1", "1", "1", "1", "2", "12", "1", "1", None, "1"]
DIFFICULTY = ["Good", "Medium", "Difficult", "Very Difficult", "Easy"]
SPEED = ["Low", "Medium", "High", "Very High"]


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RACE_EXPR = [
    f"CAST(2018 + (user_id div {CARS}) % 8 AS INT) AS Season",
    f"CAST((user_id div {CARS}) div 8 + 1 AS INT) AS Round",
    "concat('D', user_id) AS Driver",
]
_DAY_EXPR = "datediff(CAST(ts AS DATE), DATE '2024-01-01')"
_CENTS_EXPR = "CAST(round(value * 100) AS BIGINT)"
_SESSION_EXPR = f"(({_DAY_EXPR} + 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 864D"


def _array(values: list) -> str:
    return "array(" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + ")"


def laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per car and day up to the car's last event; days between events are filled in.

    Events are combined per car and day before they are shuffled, then brought together by race; each
    row spreads over the days since the one before it, so the gaps need no join.
    """
    events = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    daily = events.groupBy("user_id", F.expr(f"{_DAY_EXPR} AS last")).agg(
        F.expr(f"sum({_CENTS_EXPR}) AS cents"), F.expr("count(*) AS events")
    )
    daily = daily.selectExpr("*", f"user_id div {CARS} AS race_no", *_RACE_EXPR).repartition("Season", "Round")
    car = "PARTITION BY Season, Round, Driver"
    spread = daily.selectExpr("*", f"lag(last) OVER ({car} ORDER BY last) AS before").selectExpr(
        "*", "explode(sequence(coalesce(before, -1) + 1, last)) AS day"
    )
    known = spread.selectExpr("*", "CASE WHEN day = last THEN cents END AS c", "CASE WHEN day = last THEN events END AS n")
    ranked = known.selectExpr("*", f"sum(coalesce(c, 0)) OVER ({car} ORDER BY day) AS total").selectExpr(
        "*", "row_number() OVER (PARTITION BY Season, Round, day ORDER BY total DESC, user_id) AS pos", "day + 1 AS lap"
    )
    timed = ranked.selectExpr("*", "user_id AS u", "lap * 1000 + pos * 9 + (user_id * 7 + lap * 3) % 10 AS tenths")
    return timed.selectExpr(
        "Season",
        "Round",
        "concat('NATION_', race_no % 25, ' Grand Prix') AS EventName",
        "concat('NATION_', race_no % 25) AS Country",
        f"element_at({_array(LOCATIONS)}, CAST(race_no % 25 + 1 AS INT)) AS Location",
        "CAST(date_add(make_date(Season, 3, 1), Round) AS TIMESTAMP) AS EventDate",
        "Driver",
        "CAST(u AS STRING) AS DriverNumber",
        f"element_at({_array(TEAMS)}, CAST((u % {CARS}) div 2 + 1 AS INT)) AS Team",
        "CAST(lap AS DOUBLE) AS LapNumber",
        "CAST(pos AS DOUBLE) AS Position",
        "CASE WHEN u % 3 <> 0 THEN CAST((lap - 1) div 11 + 1 AS DOUBLE) END AS Stint",
        "tenths / 10D AS LapStartTime",
        "(tenths + 860 + coalesce(c, 0) % 61) / 10D AS Time",
        "CASE WHEN n % 3 <> 2 THEN (8300 + c % 300 + c % 400 + c % 200) / 100D END AS LapTime",
        "CASE WHEN c % 19 <> 0 THEN (2500 + c % 300) / 100D END AS Sector1Time",
        "CASE WHEN c % 23 <> 0 THEN (3000 + c % 400) / 100D END AS Sector2Time",
        "CASE WHEN c % 7 <> 0 THEN (2800 + c % 200) / 100D END AS Sector3Time",
        "CASE WHEN c % 5 <> 0 THEN (tenths + 250 + c % 31) / 10D END AS Sector1SessionTime",
        "CASE WHEN c % 11 <> 0 THEN (tenths + 560 + c % 41) / 10D END AS Sector2SessionTime",
        "CASE WHEN c % 13 <> 0 THEN (tenths + 850 + c % 51) / 10D END AS Sector3SessionTime",
        "CASE WHEN (u + lap) % 13 = 0 THEN (tenths + 840) / 10D END AS PitInTime",
        "CASE WHEN (u + lap) % 13 = 1 AND lap > 1 THEN (tenths + 30) / 10D END AS PitOutTime",
        "CASE WHEN c % 4 <> 0 THEN CAST(lap % 11 + 1 AS DOUBLE) END AS TyreLife",
        "CASE WHEN c % 6 <> 0 THEN 250 + (c % 800) / 10D END AS SpeedI1",
        "CASE WHEN NOT (Season = 2025 AND Round = 1) AND c % 9 <> 0 THEN 240 + (c % 700) / 10D END AS SpeedI2",
        "CASE WHEN c % 8 <> 0 THEN 260 + (c % 600) / 10D END AS SpeedFL",
        "CASE WHEN c % 10 <> 0 THEN 270 + (c % 500) / 10D END AS SpeedST",
        f"element_at({_array(COMPOUNDS)}, CAST(u % {len(COMPOUNDS)} + 1 AS INT)) AS Compound",
        "u % 2 = 0 AS FreshTyre",
        f"element_at({_array(STATUS)}, CAST((race_no + lap) % {len(STATUS)} + 1 AS INT)) AS TrackStatus",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*_RACE_EXPR, f"{_SESSION_EXPR} AS SessionTime", f"CAST(8 + {_CENTS_EXPR} % 8 AS INT) AS DRS")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").where("event_type = 'error'")
    c = _CENTS_EXPR
    return errors.selectExpr(
        _RACE_EXPR[0],
        _RACE_EXPR[1].replace("AS Round", "AS Race"),
        f"{_SESSION_EXPR} AS Time",
        f"15 + ({c} % 200) / 10D AS AirTemp",
        f"CAST(40 + {c} % 50 AS DOUBLE) AS Humidity",
        f"CAST(1000 + {c} % 20 AS DOUBLE) AS Pressure",
        f"{c} % 5 = 0 AS Rainfall",
        f"25 + ({c} % 300) / 10D AS TrackTemp",
        f"CAST({c} % 360 AS INT) AS WindDirection",
        f"({c} % 80) / 10D AS WindSpeed",
    )


def track_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-kept sheet of track features, one row per location."""
    nation, part = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("n_nationkey")
    sheet = nation.join(part, part.p_partkey == k)
    return sheet.select(
        _pick(LOCATIONS, k).alias("Location"),
        F.concat(F.lit("Overtaking "), _pick(DIFFICULTY, k % len(DIFFICULTY))).alias("Overtaking"),
        F.concat(F.lit("Speed "), _pick(SPEED, k % len(SPEED))).alias("Speed"),
        (k + 10).cast("int").alias("Corners"),
        F.concat(F.lit("Fast "), F.col("p_name"), F.lit(" corners, and the corner.")).alias("Sector 1"),
        F.concat(F.lit("A long  "), F.col("p_name"), F.lit(" corner; then it's flat")).alias("Sector 2"),
        F.concat(F.lit("The "), F.col("p_name"), F.lit(" chicane (slow)")).alias("Sector 3"),
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    races = nation.select(
        F.concat("n_name", F.lit(" Grand Prix")).alias("EventName"),
        _pick(LOCATIONS, k).alias("Location"),
        F.lit("conventional").alias("EventFormat"),
        (k + 1).cast("int").alias("RoundNumber"),
    )
    tests = nation.where("n_nationkey < 2").select(
        F.lit("Pre-Season Testing").alias("EventName"),
        _pick(LOCATIONS, k + 23).alias("Location"),
        F.lit("testing").alias("EventFormat"),
        F.lit(0).alias("RoundNumber"),
    )
    return races.unionByName(tests)


def _sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


_SECOND = "(extract(hour from ts) * 3600 + extract(minute from ts) * 60 + cast(floor(extract(second from ts)) as bigint))"
_RACE = f"""2018 + (user_id // {CARS}) % 8 AS "Season", (user_id // {CARS}) // 8 + 1 AS "Round", 'D' || user_id AS "Driver\""""
_DAY = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
_CENTS = "CAST(round(value * 100) AS BIGINT)"

LAPS_SQL = f"""
daily AS (SELECT user_id, {_DAY} AS day, sum({_CENTS}) AS c, count(*) AS n FROM events GROUP BY 1, 2),
grid AS (SELECT user_id, unnest(range(0, last + 1)) AS day FROM (SELECT user_id, max(day) AS last FROM daily GROUP BY 1)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY race_no, day ORDER BY total DESC, user_id) AS pos FROM (
    SELECT g.user_id AS user_id, g.day AS day, g.user_id // {CARS} AS race_no, d.c AS c, d.n AS n,
           sum(coalesce(d.c, 0)) OVER (PARTITION BY g.user_id ORDER BY g.day) AS total
    FROM grid g LEFT JOIN daily d ON g.user_id = d.user_id AND g.day = d.day)),
timed AS (SELECT *, day + 1 AS lap, (day + 1) * 1000 + pos * 9 + (user_id * 7 + (day + 1) * 3) % 10 AS tenths FROM ordered),
laps AS (
  SELECT {_RACE},
    'NATION_' || (race_no % 25) || ' Grand Prix' AS "EventName", 'NATION_' || (race_no % 25) AS "Country",
    ({_sql_list(LOCATIONS)})[race_no % 25 + 1] AS "Location",
    ({_sql_list(TEAMS)})[(user_id % {CARS}) // 2 + 1] AS "Team",
    CAST(lap AS DOUBLE) AS "LapNumber", CAST(pos AS DOUBLE) AS "Position",
    CASE WHEN user_id % 3 <> 0 THEN CAST((lap - 1) // 11 + 1 AS DOUBLE) END AS "Stint",
    CAST(tenths AS DOUBLE) / 10 AS "LapStartTime",
    CAST(tenths + 860 + coalesce(c, 0) % 61 AS DOUBLE) / 10 AS "Time",
    CASE WHEN n % 3 <> 2 THEN CAST(8300 + c % 300 + c % 400 + c % 200 AS DOUBLE) / 100 END AS "LapTime",
    CASE WHEN c % 19 <> 0 THEN CAST(2500 + c % 300 AS DOUBLE) / 100 END AS "Sector1Time",
    CASE WHEN c % 23 <> 0 THEN CAST(3000 + c % 400 AS DOUBLE) / 100 END AS "Sector2Time",
    CASE WHEN c % 7 <> 0 THEN CAST(2800 + c % 200 AS DOUBLE) / 100 END AS "Sector3Time",
    CASE WHEN c % 5 <> 0 THEN CAST(tenths + 250 + c % 31 AS DOUBLE) / 10 END AS "Sector1SessionTime",
    CASE WHEN c % 11 <> 0 THEN CAST(tenths + 560 + c % 41 AS DOUBLE) / 10 END AS "Sector2SessionTime",
    CASE WHEN c % 13 <> 0 THEN CAST(tenths + 850 + c % 51 AS DOUBLE) / 10 END AS "Sector3SessionTime",
    CASE WHEN (user_id + lap) % 13 = 0 THEN CAST(tenths + 840 AS DOUBLE) / 10 END AS "PitInTime",
    CASE WHEN (user_id + lap) % 13 = 1 AND lap > 1 THEN CAST(tenths + 30 AS DOUBLE) / 10 END AS "PitOutTime",
    CASE WHEN c % 4 <> 0 THEN CAST(lap % 11 + 1 AS DOUBLE) END AS "TyreLife",
    CASE WHEN c % 6 <> 0 THEN 250 + CAST(c % 800 AS DOUBLE) / 10 END AS "SpeedI1",
    CASE WHEN race_no <> 7 AND c % 9 <> 0 THEN 240 + CAST(c % 700 AS DOUBLE) / 10 END AS "SpeedI2",
    CASE WHEN c % 8 <> 0 THEN 260 + CAST(c % 600 AS DOUBLE) / 10 END AS "SpeedFL",
    CASE WHEN c % 10 <> 0 THEN 270 + CAST(c % 500 AS DOUBLE) / 10 END AS "SpeedST",
    ({_sql_list(COMPOUNDS)})[user_id % {len(COMPOUNDS)} + 1] AS "Compound",
    user_id % 2 = 0 AS "FreshTyre",
    ({_sql_list(STATUS)})[(race_no + lap) % {len(STATUS)} + 1] AS "TrackStatus"
  FROM timed),
telemetry AS (
  SELECT {_RACE}, CAST(({_DAY} + 1) * 86400 + {_SECOND} AS DOUBLE) / 864 AS "SessionTime", 8 + {_CENTS} % 8 AS "DRS"
  FROM events),
weather AS (
  SELECT DISTINCT ON ("Season", "Race", "Time") * FROM (
    SELECT 2018 + (user_id // {CARS}) % 8 AS "Season", (user_id // {CARS}) // 8 + 1 AS "Race",
      CAST(({_DAY} + 1) * 86400 + {_SECOND} AS DOUBLE) / 864 AS "Time",
      15 + CAST({_CENTS} % 200 AS DOUBLE) / 10 AS "AirTemp", CAST(40 + {_CENTS} % 50 AS DOUBLE) AS "Humidity",
      CAST(1000 + {_CENTS} % 20 AS DOUBLE) AS "Pressure", {_CENTS} % 5 = 0 AS "Rainfall",
      25 + CAST({_CENTS} % 300 AS DOUBLE) / 10 AS "TrackTemp", CAST({_CENTS} % 360 AS INTEGER) AS "WindDirection",
      CAST({_CENTS} % 80 AS DOUBLE) / 10 AS "WindSpeed"
    FROM events WHERE event_type = 'error')
  ORDER BY "Season", "Race", "Time", "AirTemp" DESC, "Humidity" DESC, "Pressure" DESC, "Rainfall" DESC, "TrackTemp" DESC,
    "WindDirection" DESC, "WindSpeed" DESC),
sheet AS (
  SELECT ({_sql_list(LOCATIONS)})[n_nationkey + 1] AS "Location",
    ({_sql_list(DIFFICULTY)})[n_nationkey % {len(DIFFICULTY)} + 1] AS "Overtaking",
    ({_sql_list(SPEED)})[n_nationkey % {len(SPEED)} + 1] AS "Speed", n_nationkey + 10 AS "Corners",
    'Fast ' || p_name || ' corners, and the corner.' AS "S1", 'A long  ' || p_name || ' corner; then it''s flat' AS "S2",
    'The ' || p_name || ' chicane (slow)' AS "S3"
  FROM nation JOIN part ON p_partkey = n_nationkey)
"""
