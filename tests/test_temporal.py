"""Edges of the time and rank joins."""

import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators import temporal


@pytest.fixture(params=[None, 2])
def split(request):
    return request.param


def test_asof_edges(spark, split):
    facts = spark.createDataFrame([(1, 10.0, "a"), (1, 20.0, "b"), (2, 5.0, "c"), (1, 20.0, "bb")], "race int, t double, w string")
    probes = spark.createDataFrame(
        [(1, "before", 9.0), (1, "equal", 10.0), (1, "between", 15.0), (1, "tie", 20.0), (1, "none", None), (3, "other", 50.0)],
        "race int, name string, at double",
    )
    got = temporal.asof_left(probes, facts, ["race"], "at", "t", {"w": "w", "t": "wt"}, split)
    assert {r["name"]: r["w"] for r in got.collect()} == {
        "before": None, "equal": "a", "between": "a", "tie": "bb", "none": None, "other": None,
    }
    assert got.columns == ["race", "name", "at", "w", "wt"]


def test_interval_flag_edges(spark, split):
    telemetry = spark.createDataFrame(
        [("A", 10.0, 10), ("A", 20.0, 14), ("A", 30.0, 9), ("A", 40.0, 15), ("B", 10.0, 12), ("A", 0.0, 12)],
        "car string, t double, drs int",
    )
    rows = spark.createDataFrame(
        [
            ("A", "at low", 10.0, 11.0), ("A", "at high", 19.0, 20.0), ("A", "code 9", 25.0, 35.0), ("A", "code 15", 35.0, 45.0),
            ("A", "no bound", None, 20.0), ("A", "no top", 10.0, None), ("B", "other car", 15.0, 30.0), ("C", "no samples", 0.0, 99.0),
        ],
        "car string, name string, lo double, hi double",
    )
    opened = telemetry.where("drs BETWEEN 10 AND 14")
    got = temporal.interval_flags(rows, opened, ["car"], "t", {"hit": ("lo", "hi")}, split)
    assert {r["name"]: r["hit"] for r in got.collect()} == {
        "at low": 1, "at high": 1, "code 9": 0, "code 15": 0, "no bound": 0, "no top": 0, "other car": 0, "no samples": 0,
    }


@pytest.mark.parametrize("width", [1, 4, 16])
def test_rank_range_join_is_complete(spark, width):
    rng = random.Random(11)
    movers = [(g, i, rng.randrange(40), rng.randrange(40)) for g in range(3) for i in range(40)]
    others = [(g, 100 + i, rng.choice([None, rng.randrange(40)])) for g in range(3) for i in range(40)]
    left = spark.createDataFrame(movers, "g int, id int, lo int, hi int")
    right = spark.createDataFrame(others, "g int, other int, r int")
    want = sorted((m[1], o[1]) for m in movers for o in others if m[0] == o[0] and o[2] is not None and m[2] <= o[2] < m[3])
    got = temporal.rank_range_join(left, right, ["g"], "lo", "hi", "r", width=width)
    assert sorted((r["id"], r["other"]) for r in got.collect()) == want
    outer = temporal.rank_range_join(left, right, ["g"], "lo", "hi", "r", "left", ["g", "id"], width)
    matched = {(m[0], m[1]) for m in movers for o in others if m[0] == o[0] and o[2] is not None and m[2] <= o[2] < m[3]}
    assert outer.count() == len(want) + len(movers) - len(matched)
    counts = temporal.count_in_rank_range(left, right, ["g"], "lo", "hi", "r", "n", None)
    assert sum(r["n"] for r in counts.collect()) == len(want)


def test_adjacent_pairs(spark):
    rows = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0), (1, "C", 4.0), (2, "D", 2.0), (1, "E", None)], "lap int, car string, pos double")
    got = temporal.adjacent_pairs(rows, rows, ["lap"], "pos", ["car"]).collect()
    assert [(r["car_Ahead"], r["car_Behind"]) for r in got] == [("A", "B")]


def test_range_join_is_an_equality_join(spark):
    movers = spark.range(10).select(F.lit(1).alias("g"), "id", F.col("id").alias("lo"), (F.col("id") + 2).alias("hi"))
    others = spark.range(10).select(F.lit(1).alias("g"), F.col("id").alias("r"))
    plan = temporal.rank_range_join(movers, others, ["g"], "lo", "hi", "r")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_keys_match_nothing(spark):
    probes = spark.createDataFrame([("a", 5.0, 6.0), (None, 5.0, 6.0), ("a", None, 6.0)], "k string, t double, u double")
    facts = spark.createDataFrame([("a", 4.0, 1), (None, 4.0, 7)], "k string, s double, v int")
    got = temporal.asof_left(probes, facts, ["k"], "t", "s", {"v": "seen"})
    assert sorted(((r.k, r.t, r.seen) for r in got.collect()), key=str) == sorted([("a", 5.0, 1), (None, 5.0, None), ("a", None, None)], key=str)
    flags = temporal.interval_flags(probes.withColumn("low", F.lit(3.0)), facts, ["k"], "s", {"f": ("low", "t"), "g": ("t", "u")})
    assert sorted(((r.k, r.t, r.f, r.g) for r in flags.collect()), key=str) == sorted([("a", 5.0, 1, 0), (None, 5.0, 0, 0), ("a", None, 0, 0)], key=str)


def test_equal_movers_each_get_their_count(spark):
    movers = spark.createDataFrame([("a", 1, 4)] * 2 + [(None, 1, 4), ("a", 3, 3), ("a", None, 4)], "k string, low int, high int")
    others = spark.createDataFrame([("a", 1), ("a", 3), ("a", 4), (None, 2)], "k string, r int")
    got = temporal.count_in_rank_range(movers, others, ["k"], "low", "high", "r", "n")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([("a", 1, 4, 2)] * 2 + [(None, 1, 4, 0), ("a", 3, 3, 0), ("a", None, 4, 0)], key=str)


def test_wide_intervals_are_not_repeated_per_rank(spark):
    movers = spark.createDataFrame([("a", 0, 100_000_000), ("a", 10, 12)], "k string, low long, high long")
    others = spark.createDataFrame([("a", 11), ("a", 99_999_999), ("a", 100_000_000)], "k string, r long")
    got = temporal.rank_range_join(movers, others, ["k"], "low", "high", "r")
    assert sorted((r.low, r.r) for r in got.collect()) == [(0, 11), (0, 99_999_999), (10, 11)]
