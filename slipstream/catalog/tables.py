"""Operator queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.catalog import field
from slipstream.catalog.field import table
from slipstream.catalog.registry import Registry
from slipstream.functions import encoders, maps, text
from slipstream.operators import profile, reshape, roles, sampling, sequence, statistics, temporal
from slipstream.operators.scans import first_per_group, numbered
from slipstream.plans import race
from slipstream.sources import ingest

registry = Registry()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

# --- joins on time and rank ----------------------------------------------------------------------

_BOARD = f"""WITH {field.LAPS_SQL}, board AS (
  SELECT "Season", "Round", "Driver", "LapNumber", "Position",
    lag("Position") OVER (PARTITION BY "Season", "Round", "Driver" ORDER BY "LapNumber") AS prev FROM laps)"""


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each car on each lap and on the one before."""
    laps = field.laps(spark, sf_dir).select("Season", "Round", "Driver", "LapNumber", "Position")
    return sequence.position_change(laps, race.CAR, ["LapNumber"], spread=False)


def _targets(board: DataFrame) -> DataFrame:
    return board.where("PrevLapPosition IS NOT NULL").selectExpr(
        "Season", "Round", "LapNumber", "Driver AS PassedDriver", "PrevLapPosition AS PassedPrev"
    )


@registry.add(
    "rank_range_left",
    "i:Season Round s:Driver d:LapNumber Position PrevLapPosition s:PassedDriver d:PassedPrev",
    f"""{_BOARD} SELECT a."Season", a."Round", a."Driver", a."LapNumber", a."Position", a.prev AS "PrevLapPosition",
      b."Driver" AS "PassedDriver", b.prev AS "PassedPrev"
    FROM board a LEFT JOIN board b ON a."Season" = b."Season" AND a."Round" = b."Round" AND a."LapNumber" = b."LapNumber"
      AND a.prev > b.prev AND a."Position" <= b.prev""",
)
def rank_range_left(spark, sf_dir):
    board = _board(spark, sf_dir)
    lap = [*race.RACE, "LapNumber"]
    return temporal.rank_range_join(
        board, _targets(board), lap, "Position", "PrevLapPosition", "PassedPrev", "left", [*race.CAR, "LapNumber"]
    )


@registry.add(
    "overtakes_per_lap",
    "i:Season Round s:Driver d:LapNumber i:passed",
    f"""{_BOARD} SELECT a."Season", a."Round", a."Driver", a."LapNumber", count(b."Driver") AS passed
    FROM board a LEFT JOIN board b ON a."Season" = b."Season" AND a."Round" = b."Round" AND a."LapNumber" = b."LapNumber"
      AND a.prev > b.prev AND a."Position" <= b.prev GROUP BY 1, 2, 3, 4""",
)
def overtakes_per_lap(spark, sf_dir):
    board = _board(spark, sf_dir).select(*race.CAR, "LapNumber", "Position", "PrevLapPosition")
    lap = [*race.RACE, "LapNumber"]
    return temporal.count_in_rank_range(
        board, _targets(board), lap, "Position", "PrevLapPosition", "PassedPrev", "passed", spread=False
    )


@registry.add(
    "adjacent_pairs",
    "i:Season Round d:LapNumber s:Driver_Ahead Driver_Behind d:Position_Ahead Position_Behind",
    f"""{_BOARD} SELECT a."Season", a."Round", a."LapNumber", a."Driver" AS "Driver_Ahead", b."Driver" AS "Driver_Behind",
      a."Position" AS "Position_Ahead", b."Position" AS "Position_Behind"
    FROM board a JOIN board b ON a."Season" = b."Season" AND a."Round" = b."Round" AND a."LapNumber" = b."LapNumber"
      AND b."Position" - a."Position" = 1""",
)
def adjacent_pairs(spark, sf_dir):
    board = _board(spark, sf_dir)
    return temporal.adjacent_pairs(board, board, [*race.RACE, "LapNumber"], "Position", ["Driver"])


_RUNS = f"""{_BOARD}, pairs AS (
  SELECT a."Season", a."Round", a."LapNumber", a."Driver" AS ahead, b."Driver" AS behind
  FROM board a JOIN board b ON a."Season" = b."Season" AND a."Round" = b."Round" AND a."LapNumber" = b."LapNumber"
    AND b."Position" - a."Position" = 1),
runs AS (SELECT * FROM (
  SELECT *, lag("LapNumber") OVER w AS l1 FROM pairs
  WINDOW w AS (PARTITION BY "Season", "Round", ahead, behind ORDER BY "LapNumber")) WHERE "LapNumber" - l1 <= 15)"""


def _close_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = _board(spark, sf_dir)
    pairs = temporal.adjacent_pairs(board, board, [*race.RACE, "LapNumber"], "Position", ["Driver"])
    pair = [*race.RACE, "Driver_Ahead", "Driver_Behind"]
    return sequence.consecutive_runs(pairs, pair, "LapNumber", length=2, step=15, spread=False)


@registry.add(
    "failed_streaks",
    "i:Season Round s:Driver_Ahead Driver_Behind d:LapNumber i:Streak_ID",
    f"""{_RUNS}, spells AS (
      SELECT "Season", "Round", ahead AS "Driver_Ahead", behind AS "Driver_Behind", "LapNumber",
        sum(CASE WHEN "LapNumber" - before > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY "Season", "Round", ahead, behind
          ORDER BY "LapNumber") AS "Streak_ID"
      FROM (SELECT *, lag("LapNumber") OVER (PARTITION BY "Season", "Round", ahead, behind ORDER BY "LapNumber") AS before FROM runs))
    SELECT "Season", "Round", "Driver_Ahead", "Driver_Behind", "Streak_ID", min("LapNumber") AS "LapNumber"
    FROM spells GROUP BY 1, 2, 3, 4, 5""",
)
def failed_streaks(spark, sf_dir):
    pair = [*race.RACE, "Driver_Ahead", "Driver_Behind"]
    spells = sequence.streaks(_close_runs(spark, sf_dir), pair, "LapNumber", 3, spread=False)
    return sequence.best_per_group(spells, [*pair, "Streak_ID"], ["LapNumber"])


@registry.add(
    "interval_exists_flags",
    "i:o_orderkey in_sixty in_ten",
    """SELECT o_orderkey,
      CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity BETWEEN 10 AND 14
        AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 60 DAY) THEN 1 ELSE 0 END AS in_sixty,
      CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity BETWEEN 10 AND 14
        AND l_shipdate >= o_orderdate - INTERVAL 1000 DAY AND l_shipdate <= o_orderdate) THEN 1 ELSE 0 END AS in_ten
    FROM orders""",
)
def interval_exists_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_orderkey", "o_orderdate", "o_orderdate + INTERVAL 60 DAYS AS until",
        "o_orderdate - INTERVAL 1000 DAYS AS since",
    )
    lines = table(spark, sf_dir, "lineitem").where("l_quantity BETWEEN 10 AND 14")
    moments = lines.selectExpr("l_orderkey AS k", "l_shipdate")
    spans = {"in_sixty": ("o_orderdate", "until"), "in_ten": ("since", "o_orderdate")}
    return temporal.interval_flags(orders, moments, ["k"], "l_shipdate", spans)


@registry.add(
    "asof_left",
    "i:event_id user_id error_id d:error_value",
    """SELECT e.event_id, e.user_id, x.event_id AS error_id, x.value AS error_value
    FROM (SELECT * FROM events WHERE event_type = 'click') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') x ON e.user_id = x.user_id AND e.ts >= x.ts""",
)
def asof_left(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    errors = events.where("event_type = 'error'")
    return temporal.asof_left(
        clicks, errors, ["user_id"], "ts", "ts", {"event_id": "error_id", "value": "error_value"}
    )


# --- roles -----------------------------------------------------------------------------------------

_ROLES = """roles AS (
  SELECT l_orderkey, l_suppkey % 3 AS lap, CASE WHEN l_linenumber % 2 = 1 THEN 'Overtaker' ELSE 'Passed' END AS "Role",
    max(l_quantity) AS quantity, max(l_tax) AS tax, max(l_discount) AS discount
  FROM lineitem GROUP BY 1, 2, 3)"""


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey", "l_suppkey % 3 AS lap", "l_quantity", "l_tax", "l_discount",
            "CASE WHEN l_linenumber % 2 = 1 THEN 'Overtaker' ELSE 'Passed' END AS Role",
        )
        .groupBy("l_orderkey", "lap", "Role")
        .agg(F.max("l_quantity").alias("quantity"), F.max("l_tax").alias("tax"), F.max("l_discount").alias("discount"))
    )


_PARTS = """("quantity" - CASE WHEN "Role" = 'Overtaker' THEN max(CASE WHEN "Role" = 'Passed' THEN quantity END) OVER g
  ELSE max(CASE WHEN "Role" = 'Overtaker' THEN quantity END) OVER g END)"""


@registry.add(
    "counterpart_delta",
    "i:l_orderkey lap s:Role d:quantity d:dq dt",
    f"""WITH {_ROLES} SELECT *, {_PARTS} AS dq, {_PARTS.replace("quantity", "tax")} AS dt
    FROM roles WINDOW g AS (PARTITION BY l_orderkey, lap)""",
)
def counterpart_delta(spark, sf_dir):
    return roles.counterpart_delta(_roles(spark, sf_dir), ["l_orderkey", "lap"], {"quantity": "dq", "tax": "dt"})


@registry.add(
    "sector_class",
    "i:l_orderkey lap s:Role i:OTSector",
    f"""WITH {_ROLES}, d AS (SELECT *, {_PARTS} AS g1, {_PARTS.replace("quantity", "tax")} AS g2,
      {_PARTS.replace("quantity", "discount")} AS g3 FROM roles WINDOW g AS (PARTITION BY l_orderkey, lap)),
    m AS (SELECT *, max(CASE WHEN "Role" = 'Overtaker' THEN g1 END) OVER g AS m1,
      max(CASE WHEN "Role" = 'Overtaker' THEN g2 END) OVER g AS m2, max(CASE WHEN "Role" = 'Overtaker' THEN g3 END) OVER g AS m3
      FROM d WINDOW g AS (PARTITION BY l_orderkey, lap))
    SELECT l_orderkey, lap, "Role", CASE WHEN m1 < 0 THEN 1 WHEN m1 > 0 AND m2 < 0 THEN 2
      WHEN m1 > 0 AND m2 > 0 AND m3 < 0 THEN 3 ELSE 0 END AS "OTSector" FROM m""",
)
def sector_class(spark, sf_dir):
    group = ["l_orderkey", "lap"]
    gaps = {m: f"DeltaSector{i}SessionTime" for i, m in enumerate(("quantity", "tax", "discount"), 1)}
    return roles.pass_sector(roles.counterpart_delta(_roles(spark, sf_dir), group, gaps), group)


@registry.add(
    "attempt_interval",
    "i:l_orderkey lap s:Role d:TryIntervall_Bottom TryIntervall_Upper",
    f"""WITH {_ROLES}, c AS (SELECT *, abs(discount - tax) AS c1, abs(tax - discount * 2) AS c2, abs(discount * 3 - tax) AS c3 FROM roles)
    SELECT l_orderkey, lap, "Role",
      CASE WHEN lap <> 1 THEN NULL WHEN c1 = least(c1, c2, c3) THEN quantity WHEN c2 = least(c1, c2, c3) THEN quantity + 1
        WHEN c3 = least(c1, c2, c3) THEN quantity + 2 END AS "TryIntervall_Bottom",
      CASE WHEN lap <> 1 THEN NULL WHEN c1 = least(c1, c2, c3) THEN quantity + 1 WHEN c2 = least(c1, c2, c3) THEN quantity + 2
        WHEN c3 = least(c1, c2, c3) THEN quantity + 3 END AS "TryIntervall_Upper" FROM c""",
)
def attempt_interval(spark, sf_dir):
    shaped = _roles(spark, sf_dir).selectExpr(
        "*", "lap AS LapNumber", "1 AS BaseLap", "tax AS DeltaSessionTime", "discount AS DeltaSector1SessionTime",
        "0D AS zero", "quantity AS LapStartTime", "quantity + 1 AS Sector1SessionTime",
        "quantity + 2 AS Sector2SessionTime", "quantity + 3 AS Sector3SessionTime",
    )
    # gaps chosen so that the three changes are |discount - tax|, |tax - 2 discount| and |3 discount - tax|
    shaped = shaped.selectExpr(
        "*",
        "DeltaSector1SessionTime + (tax - discount * 2) AS DeltaSector2SessionTime",
    ).selectExpr("*", "DeltaSector2SessionTime + (discount * 3 - tax) AS DeltaSector3SessionTime")
    return roles.attempt_interval(shaped)


# --- rows to columns and back --------------------------------------------------------------------

_LINES = """SELECT l_orderkey, l_linestatus AS "Role", li AS "Lap_Index", l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS li FROM lineitem)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_linestatus", "Role")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return numbered(lines, ["l_orderkey", "Role"], order, "Lap_Index", spread=False)  # an order has few lines


@registry.add(
    "pivot_measures",
    "i:l_orderkey " + "d:" + " ".join(f"{m}_{r}_{k}" for m in ("l_quantity", "l_extendedprice") for r in "OF" for k in (1, 2, 3)),
    f"""SELECT l_orderkey, {", ".join(
        f'''max(CASE WHEN "Role" = '{r}' AND "Lap_Index" = {k} THEN {m} END) AS "{m}_{r}_{k}"'''
        for m in ("l_quantity", "l_extendedprice") for r in "OF" for k in (1, 2, 3))} FROM ({_LINES}) GROUP BY 1""",
)
def pivot_measures(spark, sf_dir):
    return reshape.pivot_laps(
        _lines(spark, sf_dir), ["l_orderkey"], ["l_quantity", "l_extendedprice"], ["O", "F"], [1, 2, 3]
    )


@registry.add(
    "pivot_roles",
    "i:l_orderkey d:top_O top_F i:n_O n_F s:o_orderstatus",
    """SELECT s.*, o_orderstatus FROM (SELECT l_orderkey, max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS "top_O",
      max(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS "top_F",
      max(CASE WHEN l_linestatus = 'O' THEN l_linenumber END) AS "n_O",
      max(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS "n_F" FROM lineitem GROUP BY 1) s
    LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def pivot_roles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linestatus AS Role", "l_extendedprice AS top", "l_linenumber AS n"
    )
    halves = reshape.pivot_roles(lines, ["l_orderkey"], ["top", "n"], ["O", "F"])
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_orderstatus")
    return halves.join(orders, "l_orderkey", "left")


@registry.add(
    "unpivot_roles",
    "i:o_orderkey s:Role Driver i:BaseLap LapNumber d:o_totalprice",
    """SELECT r.*, c_acctbal AS o_totalprice FROM (
      SELECT o_orderkey, r AS "Role", CASE WHEN r = 'Overtaker' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS "Driver",
        day(o_orderdate) AS "BaseLap", day(o_orderdate) - k AS "LapNumber"
      FROM orders, unnest(['Overtaker', 'Passed']) t(r), unnest([0, 1, 2]) s(k) WHERE day(o_orderdate) - k >= 1) r
    LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = "Driver" """,
)
def unpivot_roles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_custkey AS STRING) AS car", "o_orderpriority AS other", "day(o_orderdate) AS BaseLap"
    )
    rows = reshape.unpivot_roles(orders, ["o_orderkey", "BaseLap"], {"car": "Overtaker", "other": "Passed"})
    rows = reshape.lap_window(rows, "BaseLap", before=2, first=1)
    known = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS Driver", "c_acctbal AS o_totalprice")
    return rows.join(known, "Driver", "left")


@registry.add(
    "unpivot_columns",
    "s:variable d:total i:n",
    """SELECT variable, sum(value) AS total, count(*) AS n FROM (
      UNPIVOT (SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax
      INTO NAME variable VALUE value) GROUP BY 1""",
)
def unpivot_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    long = reshape.unpivot_columns(lines, ["l_orderkey"], ["l_quantity", "l_discount", "l_tax"], "variable", "value")
    return long.groupBy("variable").agg(F.sum("value").alias("total"), F.count("*").alias("n"))


# --- sequences ---------------------------------------------------------------------------------------

_GAPPED = "SELECT *, CASE WHEN event_id % 3 <> 0 THEN value END AS v, epoch_us(ts) AS at FROM events"


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "ts", "CASE WHEN event_id % 3 <> 0 THEN value END AS v"
    )


@registry.add(
    "interpolate_linear",
    "i:event_id user_id d:v",
    f"""SELECT event_id, user_id, CASE WHEN v IS NULL THEN v0 + (v1 - v0) / (i1 - i0) * (i - i0) ELSE v END AS v FROM (
      SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i0,
        first_value(v IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER f AS i1
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM ({_GAPPED}))
      WINDOW b AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        f AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
)
def interpolate_linear(spark, sf_dir):
    return sequence.interpolate(_gapped(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["v"])


@registry.add(
    "fill_down_up",
    "i:event_id user_id d:v",
    f"""SELECT event_id, user_id, coalesce(
        last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
    FROM ({_GAPPED})""",
)
def fill_down_up(spark, sf_dir):
    return sequence.fill_down_up(_gapped(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["v"])


@registry.add(
    "median_impute",
    "s:l_returnflag i:l_linenumber n d:total",
    """SELECT l_returnflag, l_linenumber, count(*) AS n, sum(coalesce(q, m)) AS total FROM (
      SELECT *, median(q) OVER (PARTITION BY l_returnflag, l_linenumber) AS m FROM (
        SELECT *, CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS q FROM lineitem)) GROUP BY 1, 2""",
)
def median_impute(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "l_linenumber", "CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS q"
    )
    filled = sequence.group_median_fill(lines, ["l_returnflag", "l_linenumber"], ["q"])
    return filled.groupBy("l_returnflag", "l_linenumber").agg(F.count("*").alias("n"), F.sum("q").alias("total"))


_STOPS = """SELECT event_id, user_id, ts, event_id AS i, epoch_us(ts) / 1e6 AS s,
  CASE WHEN event_type = 'error' THEN epoch_us(ts) / 1e6 + value END AS pit_in,
  CASE WHEN event_type = 'signup' THEN epoch_us(ts) / 1e6 + value END AS pit_out,
  CASE WHEN user_id % 2 = 0 THEN CAST(event_id % 7 AS DOUBLE) END AS stint FROM events"""


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "unix_micros(CAST(ts AS TIMESTAMP)) / 1e6D AS LapStartTime",
        "CASE WHEN event_type = 'error' THEN unix_micros(CAST(ts AS TIMESTAMP)) / 1e6D + value END AS PitInTime",
        "CASE WHEN event_type = 'signup' THEN unix_micros(CAST(ts AS TIMESTAMP)) / 1e6D + value END AS PitOutTime",
        "CASE WHEN user_id % 2 = 0 THEN CAST(event_id % 7 AS DOUBLE) END AS Stint",
    )


@registry.add(
    "pit_times",
    "i:event_id user_id d:PitEntryTime PitExitTime PitTime i:PitInLap PitOutLap PitOutLagLap Pit",
    f"""SELECT event_id, user_id, lead(s) OVER w - pit_in AS "PitEntryTime", pit_out - s AS "PitExitTime",
      lead(s) OVER w - pit_in + lead(pit_out - s) OVER w AS "PitTime", pit_in IS NOT NULL AS "PitInLap",
      pit_out IS NOT NULL AS "PitOutLap", lag(pit_out) OVER w IS NOT NULL AS "PitOutLagLap",
      pit_in IS NOT NULL OR pit_out IS NOT NULL AS "Pit" FROM ({_STOPS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def pit_times(spark, sf_dir):
    return sequence.pit_timing(_stops(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@registry.add(
    "stint_id",
    "i:event_id user_id d:Stint",
    f"""SELECT event_id, user_id, coalesce(stint, coalesce(sum(CASE WHEN pit_in IS NOT NULL OR pit_out IS NOT NULL THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1) AS "Stint"
    FROM ({_STOPS})""",
)
def stint_id(spark, sf_dir):
    stops = _stops(spark, sf_dir).selectExpr("*", "CAST(PitInTime IS NOT NULL OR PitOutTime IS NOT NULL AS INT) AS Pit")
    return sequence.stint_number(stops, ["user_id"], ["ts", "event_id"])


@registry.add(
    "dnf_code",
    "i:race user_id d:DNF",
    """SELECT DISTINCT race, user_id, CASE WHEN top >= max(top) OVER (PARTITION BY race) - 1 THEN 0 ELSE top END AS "DNF" FROM (
      SELECT user_id // 20 AS race, user_id, max(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) AS top FROM events GROUP BY 1, 2)""",
)
def dnf_code(spark, sf_dir):
    laps = table(spark, sf_dir, "events").selectExpr(
        "CAST(floor(user_id / 20) AS BIGINT) AS race", "user_id", "datediff(CAST(ts AS DATE), DATE '2024-01-01') AS lap"
    )
    return sequence.retirement_lap(laps, ["race"], "user_id", "lap").select("race", "user_id", "DNF").distinct()


@registry.add(
    "position_change",
    "i:Season Round s:Driver d:LapNumber Position PrevLapPosition PositionChange",
    f"""{_BOARD} SELECT *, prev AS "PrevLapPosition", "Position" - prev AS "PositionChange" FROM board""",
)
def position_change(spark, sf_dir):
    return _board(spark, sf_dir)


_FULL_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@registry.add(
    "keep_first",
    "i:l_orderkey l_linenumber l_partkey l_suppkey d:l_extendedprice",
    f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_FULL_ORDER}) = 1",
)
def keep_first(spark, sf_dir):
    return first_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], _FULL_ORDER.split(", "))


@registry.add(
    "random_pick",
    "i:o_custkey o_orderkey d:o_totalprice",
    """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY md5(o_orderkey || '-42')) = 1""",
)
def random_pick(spark, sf_dir):
    return sampling.random_per_group(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey")


# --- integrity, counts, schema -------------------------------------------------------------------------


@registry.add(
    "integrity_having",
    "i:l_orderkey n",
    "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 6",
)
def integrity_having(spark, sf_dir):
    return profile.more_than(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 6)


@registry.add(
    "group_size_filter",
    "i:l_orderkey l_linenumber l_partkey d:l_quantity",
    "SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 6",
)
def group_size_filter(spark, sf_dir):
    return profile.groups_of_size(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 6)


@registry.add(
    "role_members",
    "i:l_orderkey O F",
    """SELECT l_orderkey, max(CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS "O", max(CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS "F"
    FROM lineitem GROUP BY 1 HAVING count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_suppkey END) = 1
      AND count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) = 1""",
)
def role_members(spark, sf_dir):
    return profile.single_members(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linestatus", "l_suppkey", ["O", "F"])


@registry.add(
    "distinct_counts",
    "s:event_type i:users total",
    """SELECT event_type, count(DISTINCT user_id) AS users, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) FROM events)) AS total
    FROM events GROUP BY 1""",
)
def distinct_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("user_id", "event_type", "CAST(ts AS DATE) AS day")
    total = profile.distinct_tuples(events, ["user_id", "event_type", "day"], "total")
    users = profile.distinct_per_group(events, ["event_type"], "user_id", "users")
    return users.withColumn("total", total.scalar())


_CUMULATIVE = """SELECT {c}, n AS "Gyakorisag", 100.0 * n / sum(n) OVER () AS "Szazalek",
  100.0 * sum(n) OVER (ORDER BY n, {c} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER () AS "Kumulativ_Szazalek"
FROM (SELECT {c}, count(*) AS n FROM {t} GROUP BY 1)"""


@registry.add("freq_cumulative", "s:p_name i:Gyakorisag d:Szazalek Kumulativ_Szazalek", _CUMULATIVE.format(c="p_name", t="part"))
def freq_cumulative(spark, sf_dir):
    return profile.cumulative_frequency(table(spark, sf_dir, "part"), "p_name")


@registry.add(
    "frequency_table",
    "s:o_orderstatus i:n",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
)
def frequency_table(spark, sf_dir):
    return profile.frequency(table(spark, sf_dir, "orders"), "o_orderstatus")


@registry.add(
    "null_profile",
    "s:column i:nulls",
    """UNPIVOT (SELECT count(*) - count("Sector1Time") AS "Sector1Time", count(*) - count("LapTime") AS "LapTime",
      count(*) - count("TrackStatus") AS "TrackStatus", count(*) - count("Driver") AS "Driver" FROM (WITH """
    + field.LAPS_SQL
    + """ SELECT * FROM laps)) ON "Sector1Time", "LapTime", "TrackStatus", "Driver" INTO NAME "column" VALUE nulls""",
)
def null_profile(spark, sf_dir):
    return profile.null_profile(field.laps(spark, sf_dir).select("Sector1Time", "LapTime", "TrackStatus", "Driver"))


@registry.add(
    "duplicates", "s:text i:n", "SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1"
)
def duplicates(spark, sf_dir):
    return profile.duplicated(table(spark, sf_dir, "documents"), ["text"])


_PEOPLE = [
    "CAST(2020 AS {i}) AS \"Season\", c_custkey AS \"ID\", c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 1 AS \"Sikeres\"",
    "CAST(2020 AS {i}) AS \"Season\", s_suppkey AS \"ID\", s_name AS name, s_acctbal AS balance, CAST(NULL AS {s}) AS segment, 0 AS \"Sikeres\"",
]


@registry.add(
    "union_conform",
    "s:AttemptID name segment d:balance i:Sikeres",
    " UNION ALL ".join(
        f"""SELECT "Season" || '_' || "Sikeres" || '_' || "ID" AS "AttemptID", name, segment, balance, "Sikeres"
        FROM (SELECT {p.format(i="INTEGER", s="VARCHAR")} FROM {t})"""
        for p, t in zip(_PEOPLE, ("customer", "supplier"))
    ),
)
def union_conform(spark, sf_dir):
    won = table(spark, sf_dir, "customer").selectExpr(
        "concat_ws('_', 2020, 1, c_custkey) AS AttemptID", "c_name AS name", "c_mktsegment AS segment",
        "c_acctbal AS balance", "1 AS Sikeres",
    )
    lost = table(spark, sf_dir, "supplier").selectExpr(
        "concat_ws('_', 2020, 0, s_suppkey) AS AttemptID", "s_name AS name", "s_acctbal AS balance", "0 AS Sikeres"
    )
    return won.unionByName(lost, allowMissingColumns=True)


@registry.add(
    "set_equality",
    "i:only_left only_right b:equal",
    """SELECT l AS only_left, r AS only_right, l = 0 AND r = 0 AS equal FROM
      (SELECT count(*) AS l FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)),
      (SELECT count(*) AS r FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer))""",
)
def set_equality(spark, sf_dir):
    return profile.same_values(
        table(spark, sf_dir, "customer").select("c_nationkey"),
        table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS c_nationkey"),
    )


def _listed(table: str, names: dict[str, str]) -> str:
    """Name, type and number of known values of each column of a table."""
    kind = "CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END"
    rows = [f"SELECT '{n}' AS name, {kind.format(c=c)} AS t, count({c}) AS n FROM {table}" for c, n in names.items()]
    return " UNION ALL ".join(rows)


@registry.add(
    "schema_diff",
    "s:Valtozo_Neve Tipus_Sikeres Tipus_Sikertelen i:known_Sikeres known_Sikertelen",
    f"""SELECT name AS "Valtozo_Neve", a.t AS "Tipus_Sikeres", b.t AS "Tipus_Sikertelen", a.n AS "known_Sikeres", b.n AS "known_Sikertelen" FROM
    ({_listed("customer", {"c_custkey": "c_custkey", "c_name": "name", "c_nationkey": "nationkey", "c_acctbal": "c_acctbal", "c_mktsegment": "c_mktsegment"})}) AS a
    FULL JOIN ({_listed("supplier", {"s_suppkey": "s_suppkey", "s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "s_acctbal"})}) AS b USING (name)""",
)
def schema_diff(spark, sf_dir):
    won = table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "name", "c_nationkey": "nationkey"})
    lost = table(spark, sf_dir, "supplier").withColumnsRenamed({"s_name": "name", "s_nationkey": "nationkey"})
    return profile.schema_diff(won, lost)


# --- values and projections --------------------------------------------------------------------------


# Fixed values, written out once more for the twin so that a wrong entry of the maps shows: tyre classes, former names of teams,
# second names of places, and the braking level of each place, in the order of the levels.
_VALUE_MAPS = """CASE WHEN "Compound" IN ('SOFT', 'ULTRASOFT', 'SUPERSOFT', 'HYPERSOFT') THEN 1 WHEN "Compound" = 'MEDIUM' THEN 2
        WHEN "Compound" = 'HARD' THEN 3 WHEN "Compound" IN ('WET', 'INTERMEDIATE') THEN 4 ELSE 0 END AS "CompoundFactor",
      replace(CASE WHEN "Team" IN ('Force India', 'Racing Point') THEN 'Aston Martin'
        WHEN "Team" IN ('Alfa Romeo', 'Alfa Romeo Racing', 'Sauber') THEN 'Kick Sauber'
        WHEN "Team" IN ('AlphaTauri', 'Toro Rosso', 'RB') THEN 'Racing Bulls'
        WHEN "Team" = 'Renault' THEN 'Alpine' ELSE "Team" END, ' ', '') AS "Team",
      CASE "Location" WHEN 'Yas Island' THEN 'Yas Marina' WHEN 'Monte Carlo' THEN 'Monaco' WHEN 'Miami Gardens' THEN 'Miami'
        ELSE "Location" END AS "Location",
      CASE WHEN "Location" IN ('Silverstone', 'Suzuka') THEN 1
        WHEN "Location" IN ('Barcelona', 'São Paulo', 'Zandvoort', 'Hockenheim') THEN 2
        WHEN "Location" IN ('Yas Island', 'Austin', 'Lusail', 'Budapest', 'Imola', 'Las Vegas', 'Melbourne', 'Miami', 'Monaco',
          'Shanghai', 'Marina Bay', 'Miami Gardens', 'Monte Carlo', 'Singapore', 'Mugello', 'Sochi', 'Nürburgring', 'Portimão',
          'Le Castellet') THEN 3
        WHEN "Location" IN ('Baku', 'Mexico City', 'Jeddah', 'Montréal', 'Spa-Francorchamps', 'Spielberg', 'Istanbul') THEN 4
        WHEN "Location" IN ('Monza', 'Sakhir') THEN 5 END AS "BrakingLevel","""


@registry.add(
    "value_maps",
    "i:Season Round s:Driver i:CompoundFactor s:Team Location i:BrakingLevel Era",
    f"""WITH {field.LAPS_SQL} SELECT DISTINCT "Season", "Round", "Driver",
      {_VALUE_MAPS}
      CASE WHEN "Season" < 2022 THEN 0 ELSE 1 END AS "Era" FROM laps""",
)
def value_maps(spark, sf_dir):
    cars = field.laps(spark, sf_dir).select("Season", "Round", "Driver", "Compound", "Team", "Location").distinct()
    place = F.col("Location")
    return cars.select(
        "Season",
        "Round",
        "Driver",
        maps.compound_class(F.col("Compound")).alias("CompoundFactor"),
        maps.current_team(F.col("Team")).alias("Team"),
        maps.known_location(place).alias("Location"),
        maps.braking_level(place).alias("BrakingLevel"),
        maps.era(F.col("Season")).alias("Era"),
    )


@registry.add(
    "strata",
    "i:o_orderkey s:Stratify r_name",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END || '_' || CASE WHEN year(o_orderdate) < 1998 THEN 0 ELSE 1 END AS "Stratify", r_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def strata(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    label = (F.col("o_orderstatus") == "F").cast("int")
    marked = orders.withColumn("Stratify", maps.stratum(label, maps.era(F.year("o_orderdate"), 1998)))
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        marked.join(customer, marked.o_custkey == customer.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
    )


@registry.add(
    "project_shape",
    "i:order_key line d:total d:net gross b:returned i:Sikeres",
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_extendedprice AS total, l_extendedprice * (1 - l_discount) AS net,
      l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross, coalesce(l_returnflag = 'R', false) AS returned,
      coalesce(CASE WHEN l_quantity > 25 THEN 1 END, 0) AS "Sikeres"
    FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 AND l_returnflag IN ('R', 'A')""",
)
def project_shape(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_quantity BETWEEN 5 AND 45 AND l_returnflag IN ('R', 'A')")
    levels = lines.withColumns({"Sikeres": F.expr("CASE WHEN l_quantity > 25 THEN 1 END"), "net": F.expr("l_extendedprice * (1 - l_discount)")})
    levels = levels.withColumns({"gross": F.expr("net * (1 + l_tax)"), "returned": F.expr("l_returnflag = 'R'")})
    renamed = levels.withColumnsRenamed({"l_orderkey": "order_key", "l_linenumber": "line", "l_extendedprice": "total"})
    slim = renamed.drop(*reshape.columns_like(renamed, "^l_"))
    return reshape.last_column(reshape.fill_missing(slim), "Sikeres").dropna(subset=["total", "net"])


@registry.add(
    "semi_join_members",
    "i:o_orderkey s:o_orderpriority",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def semi_join_members(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").join(ids, "o_orderkey", "left_semi")


# --- text ----------------------------------------------------------------------------------------------


@registry.add(
    "text_clean",
    "i:doc_id s:clean joined",
    """SELECT doc_id, replace(trim(regexp_replace(regexp_replace(lower(text), '\\p{P}', '', 'g'), '\\s+', ' ', 'g')), ' ', '_') AS clean,
      lower(concat_ws(' ', lang, source, 'NA')) AS joined FROM documents""",
)
def text_clean(spark, sf_dir):
    cleaned = text.squish(text.strip_punctuation(F.lower("text")))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.replace(cleaned, F.lit(" "), F.lit("_")).alias("clean"),
        text.joined_text(F.col("lang"), F.col("source"), F.lit(None).cast("string")).alias("joined"),
    )


_WORDS = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents"


@registry.add("word_frequency", "s:word i:n", f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY 1")
def word_frequency(spark, sf_dir):
    return text.word_frequency(table(spark, sf_dir, "documents").select("text"), "text")


@registry.add(
    "stopwords_found",
    "s:word",
    f"SELECT DISTINCT word FROM ({_WORDS}) WHERE word IN ({', '.join(chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39) for w in text.PHRASE_STOP_WORDS)})",
)
def stopwords_found(spark, sf_dir):
    return text.stop_words_found(table(spark, sf_dir, "documents").select("text"), ["text"])


@registry.add(
    "mean_words",
    "d:text source",
    "SELECT avg(len(regexp_split_to_array(text, '\\s+'))) AS text, avg(len(regexp_split_to_array(source, '\\s+'))) AS source FROM documents",
)
def mean_words(spark, sf_dir):
    return text.mean_words(table(spark, sf_dir, "documents"), ["text", "source"])


@registry.add(
    "tfidf_weights",
    "s:word i:df d:idf",
    f"""SELECT word, count(DISTINCT doc_id) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) + 1 AS idf
    FROM ({_WORDS}) GROUP BY 1""",
)
def tfidf_weights(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.document_frequency(documents, "text")


# --- statistics and encoders ----------------------------------------------------------------------------

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@registry.add(
    "corr_pairs",
    "s:Variable_1 Variable_2 d:Correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"Variable_1\", '{b}' AS \"Variable_2\", corr({a}, {b}) AS \"Correlation\" FROM lineitem"
        for i, a in enumerate(sorted(_NUMBERS))
        for b in sorted(_NUMBERS)[i + 1 :]
    ),
)
def corr_pairs(spark, sf_dir):
    return statistics.correlation_pairs(table(spark, sf_dir, "lineitem"), _NUMBERS)


_LOT = "CASE WHEN p_partkey % 3 = 0 THEN p_size END"


@registry.add(
    "strong_pairs",
    "s:Variable_1 Variable_2 d:Correlation",
    f"""WITH p AS (SELECT p_retailprice, p_size, p_partkey, 2 * p_size + p_partkey % 2 AS double_size, {_LOT} AS some_size FROM part),
    r AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM p" for a, b in (("double_size", "p_partkey"), ("double_size", "p_retailprice"), ("double_size", "p_size"), ("double_size", "some_size"), ("p_partkey", "p_retailprice"), ("p_partkey", "p_size"), ("p_partkey", "some_size"), ("p_retailprice", "p_size"), ("p_retailprice", "some_size"), ("p_size", "some_size")))})
    SELECT a AS "Variable_1", b AS "Variable_2", c AS "Correlation" FROM r WHERE abs(c) > 0.95""",
)
def strong_pairs(spark, sf_dir):
    """Pairs of columns that are correlated above 0.95, each on the rows where both are known."""
    parts = table(spark, sf_dir, "part").selectExpr("p_retailprice", "p_size", "p_partkey", "2 * p_size + p_partkey % 2 AS double_size", f"{_LOT} AS some_size")
    return statistics.correlation_pairs(parts, parts.columns, above=0.95)


_R = "r12 AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_tax) AS b, corr(l_extendedprice, l_tax) AS c FROM lineitem)"
_DET = "(1 + 2 * a * b * c - a * a - b * b - c * c)"


@registry.add(
    "vif",
    "s:Feature d:VIF",
    f"""WITH {_R} SELECT 'l_quantity' AS "Feature", (1 - c * c) / {_DET} AS "VIF" FROM r12
    UNION ALL SELECT 'l_extendedprice', (1 - b * b) / {_DET} FROM r12 UNION ALL SELECT 'l_tax', (1 - a * a) / {_DET} FROM r12""",
)
def vif(spark, sf_dir):
    return statistics.variance_inflation(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


def _det(x: str, y: str, z: str) -> str:
    """Determinant of the correlation matrix of three columns, from the correlations of their pairs."""
    return f"(1 + 2 * {x}{y} * {x}{z} * {y}{z} - {x}{y} * {x}{y} - {x}{z} * {x}{z} - {y}{z} * {y}{z})"


@registry.add(
    "vif_prune",
    "s:Feature d:VIF",
    # the quantity follows exactly from the two prices and goes first; of the prices the one with the larger factor goes next
    f"""WITH v AS (SELECT l_extendedprice, l_discount, l_tax, l_extendedprice * 2 + l_quantity AS double_price FROM lineitem),
    r AS (SELECT corr(l_extendedprice, l_discount) AS pd, corr(l_extendedprice, l_tax) AS pt, corr(double_price, l_discount) AS bd,
      corr(double_price, l_tax) AS bt, corr(l_discount, l_tax) AS dt FROM v),
    k AS (SELECT dt, {_det("b", "d", "t")} >= {_det("p", "d", "t")} AS gone, CASE WHEN gone THEN bd ELSE pd END AS sd, CASE WHEN gone THEN bt ELSE pt END AS st,
      {_det("s", "d", "t")} AS whole FROM r)
    SELECT CASE WHEN gone THEN 'double_price' ELSE 'l_extendedprice' END AS "Feature", (1 - dt * dt) / whole AS "VIF" FROM k
    UNION ALL SELECT 'l_discount', (1 - st * st) / whole FROM k UNION ALL SELECT 'l_tax', (1 - sd * sd) / whole FROM k""",
)
def vif_prune(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("double_price", F.expr("l_extendedprice * 2 + l_quantity"))
    return statistics.prune_by_inflation(lines, [*_NUMBERS, "double_price"])


@registry.add(
    "scale",
    "i:l_orderkey l_linenumber d:l_quantity l_extendedprice",
    """SELECT l_orderkey, l_linenumber, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
      (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS l_extendedprice FROM lineitem""",
)
def scale(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    columns = ["l_quantity", "l_extendedprice"]
    return encoders.apply_scaler(lines, encoders.fit_scaler(lines, columns), columns)


@registry.add(
    "infrequent_levels",
    "s:bucket i:n",
    """SELECT CASE WHEN c >= 0.045 * total THEN p_brand ELSE '__infrequent__' END AS bucket, count(*) AS n FROM (
      SELECT p_brand, count(*) OVER (PARTITION BY p_brand) AS c, count(*) OVER () AS total FROM part) GROUP BY 1""",
)
def infrequent_levels(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_brand")
    bucketed = encoders.apply_frequent(parts, encoders.fit_frequent(parts, "p_brand", 0.045), "p_brand", "bucket")
    return bucketed.groupBy("bucket").agg(F.count("*").alias("n"))


@registry.add(
    "ordinal_oov",
    "i:p_partkey s:p_name i:code",
    """SELECT p_partkey, p_name, coalesce(code, 0) AS code FROM part LEFT JOIN (
      SELECT n, row_number() OVER (ORDER BY n) AS code FROM (SELECT DISTINCT p_name AS n FROM part WHERE p_size <= 3)) ON p_name = n""",
)
def ordinal_oov(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    fitted = encoders.fit_ordinal(parts.where("p_size <= 3"), "p_name")
    return encoders.apply_ordinal(parts, fitted, "p_name", "code")


@registry.add(
    "target_encode_oof",
    "i:o_orderkey d:te",
    """WITH o AS (SELECT o_orderkey, o_orderpriority AS lv, CAST(o_orderkey % 5 AS INTEGER) AS fold, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
    c AS (SELECT lv, fold, count(*) AS n, sum(y) AS s FROM o GROUP BY 1, 2),
    t AS (SELECT lv, sum(n) AS n, sum(s) AS s FROM c GROUP BY 1), f AS (SELECT fold, sum(n) AS n, sum(s) AS s FROM c GROUP BY 1),
    g AS (SELECT sum(n) AS n, sum(s) AS s FROM c),
    p AS (SELECT c.lv, c.fold, (t.n - c.n)::DOUBLE AS n, (t.s - c.s) / (t.n - c.n) AS m, (g.s - f.s) / (g.n - f.n) AS o
      FROM c JOIN t USING (lv) JOIN f USING (fold) CROSS JOIN g)
    SELECT o_orderkey, (p.o * (1 - p.o) * n * m + m * (1 - m) * p.o) / (p.o * (1 - p.o) * n + m * (1 - m)) AS te
    FROM o JOIN p ON o.lv = p.lv AND o.fold = p.fold""",
)
def target_encode_oof(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderpriority", "CAST(o_orderkey % 5 AS INT) AS fold", "CAST(o_orderstatus = 'F' AS INT) AS y"
    )
    return encoders.target_encode(orders, "o_orderpriority", "y", "fold", "te")


# --- samples -----------------------------------------------------------------------------------------------

_HASHED = "row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '-42'))"


@registry.add(
    "strat_split",
    "i:o_orderkey s:o_orderstatus i:is_test",
    f"""SELECT o_orderkey, o_orderstatus, {_HASHED} <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.2::DOUBLE + 0.5) AS is_test FROM orders""",
)
def strat_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(orders, ["o_orderstatus"], "o_orderkey", 0.2)


_STEP = "('0x' || substr(md5('42-' || {k} || '-' || {half}), 1, 12))::BIGINT"
_TURNS = {0: "(l + " + _STEP.format(k=0, half="r") + ") % high AS l, r", 1: "l, (r + " + _STEP.format(k=1, half="l") + ") % low AS r",
          2: "(l + " + _STEP.format(k=2, half="r") + ") % high AS l, r", 3: "l, (r + " + _STEP.format(k=3, half="l") + ") % low AS r"}


def _mixed_sql(rows: str) -> str:
    """Rows (o_orderkey, pos, high, low, n) with ``pos`` after one pass of the bijection."""
    out = f"SELECT *, pos // low AS l, pos % low AS r FROM {rows}"
    for turn in _TURNS.values():
        out = f"SELECT o_orderkey, high, low, n, {turn} FROM ({out})"
    return f"SELECT o_orderkey, l * low + r AS pos, high, low, n FROM ({out})"


@registry.add(
    "permuted_rows",
    "i:o_orderkey donor d:o_totalprice",
    f"""WITH RECURSIVE s AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS number, count(*) OVER () AS n FROM orders),
    b AS (SELECT o_orderkey, number AS pos, ceil(sqrt(n))::BIGINT AS high, ceil(n / ceil(sqrt(n)))::BIGINT AS low, n FROM s),
    w AS ({_mixed_sql("b")} UNION ALL ({_mixed_sql("(SELECT * FROM w WHERE pos >= n)")}))
    SELECT w.o_orderkey, s.o_orderkey AS donor, s.o_totalprice FROM w JOIN s ON w.pos = s.number WHERE w.pos < w.n""",
)
def permuted_rows(spark, sf_dir):
    """Each order with the key and price of another one: an exact permutation."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    found = sampling.permuted(orders, "o_orderkey", ["o_orderkey", "o_totalprice"], "other")
    return found.select("o_orderkey", F.col("other.o_orderkey").alias("donor"), F.col("other.o_totalprice").alias("o_totalprice"))


@registry.add(
    "strat_kfold",
    "i:o_orderkey s:o_orderstatus i:fold",
    f"SELECT o_orderkey, o_orderstatus, ({_HASHED} - 1) % 5 AS fold FROM orders",
)
def strat_kfold(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_folds(orders, ["o_orderstatus"], "o_orderkey", 5)


@registry.add(
    "class_weights",
    "i:y n d:weight",
    """SELECT y, n, sum(n) OVER () / (count(*) OVER () * n) AS weight FROM (
      SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, count(*) AS n FROM orders GROUP BY 1)""",
)
def class_weights(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderstatus = 'F' AS INT) AS y")
    return sampling.class_weights(orders, "y")


@registry.add("sample_n", "i:p_partkey s:p_name", "SELECT * FROM part ORDER BY md5(p_partkey || '-42') LIMIT 50")
def sample_n(spark, sf_dir):
    return sampling.sample_rows(table(spark, sf_dir, "part"), "p_partkey", 50)


@registry.add(
    "sample_fraction",
    "i:l_orderkey n",
    """SELECT l_orderkey, count(*) AS n FROM lineitem WHERE substr(md5(l_orderkey || '-42'), 1, 12) < printf('%012x', CAST(floor(0.01::DOUBLE * 281474976710656) AS BIGINT)) GROUP BY 1""",
)
def sample_fraction(spark, sf_dir):
    kept = sampling.sample_fraction(table(spark, sf_dir, "lineitem"), "l_orderkey", 0.01)
    return kept.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@registry.add("pmm_impute", "i:event_id d:value")
def pmm_impute(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 10 <> 0 THEN value END AS value", "CAST(user_id AS DOUBLE) AS u",
        "CAST(hour(ts) AS DOUBLE) AS h", "CAST(get_json_object(props, '$.k') AS DOUBLE) AS k",
    )
    return statistics.impute_by_matching(events, "event_id", "value", ["u", "h", "k"])


# --- calendar and lookups --------------------------------------------------------------------------------


@registry.add("calendar_count", "i:races", "SELECT count(*) AS races FROM nation")
def calendar_count(spark, sf_dir):
    return ingest.count_races(field.schedule(spark, sf_dir))


@registry.add(
    "lookup_fallback",
    "i:o_orderkey s:Driver d:GridPosition",
    """SELECT o_orderkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, CAST(o_custkey AS VARCHAR)) AS "Driver",
      CASE WHEN c_acctbal > 0 THEN c_acctbal END AS "GridPosition" FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def lookup_fallback(spark, sf_dir):
    laps = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS DriverNumber", "1 AS Season", "1 AS Round")
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").selectExpr(
        "CAST(c_custkey AS STRING) AS DriverNumber", "c_name AS Abbreviation", "c_acctbal AS Position", "1 AS Season", "1 AS Round"
    )
    coded = ingest.driver_code(laps, known, ["DriverNumber"])
    return ingest.grid_position(coded, known)


@registry.add(
    "metadata_stamp",
    "s:Driver EventName Location i:rows",
    f"""SELECT 'D' || user_id AS "Driver", n_name || ' Grand Prix' AS "EventName", ({field._sql_list(field.LOCATIONS)})[n_nationkey + 1] AS "Location", count(*) AS rows
    FROM events JOIN nation ON n_nationkey = user_id % 25 GROUP BY ALL""",
)
def metadata_stamp(spark, sf_dir):
    samples = table(spark, sf_dir, "events").selectExpr("concat('D', user_id) AS Driver", "CAST(user_id % 25 + 1 AS INT) AS RoundNumber")
    calendar = ingest.race_calendar(field.schedule(spark, sf_dir))
    stamped = ingest.stamp_event(samples, calendar, ["RoundNumber"], ["EventName", "Location"])
    return stamped.groupBy("Driver", "EventName", "Location").agg(F.count("*").alias("rows"))
