"""The spread way of an ordered scan gives what plain windows give, whatever the skew."""

import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators import scans
from slipstream.operators import profile, sampling, scans, sequence, temporal
from slipstream.operators.scans import (
    bin_index,
    first_per_group,
    following,
    latest,
    ordered_scan,
    previous,
    running_total,
)

SPREAD = {"spread": True}


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds more than a third of the rows; values are missing in places."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}"
        data.append((key, float(rng.randrange(80)), i, None if rng.random() < 0.4 else rng.randrange(9)))
    data += [(None, float(i % 7), 1000 + i, i) for i in range(60)]
    return spark.createDataFrame(data, "k string, t double, id long, v long").repartition(5)


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    left, right = (sorted(map(tuple, d.collect()), key=key) for d in (a, b.select(*a.columns)))
    assert left == right


def all_scans():
    return {
        "total": running_total(F.col("v")),
        "down": latest(F.col("v")),
        "up": latest(F.col("v"), backward=True),
        "prev": previous(F.col("v")),
        "next": following(F.col("v")),
    }


@pytest.mark.parametrize("keys", [["k"], []])
def test_spread_equals_plain(rows, keys):
    order = ["t", "id"]
    same(
        ordered_scan(rows, keys, order, all_scans(), spread=False),
        ordered_scan(rows, keys, order, all_scans(), **SPREAD),
    )


def test_zoneless_times_can_be_cut(spark, rows):
    timed = rows.withColumn("ts", F.expr("CAST(timestamp_seconds(t) AS TIMESTAMP_NTZ)"))
    counted = {"n": running_total(F.lit(1))}
    same(
        ordered_scan(timed, ["k"], ["ts", "id"], counted, False).select("id", "n"),
        ordered_scan(timed, ["k"], ["ts", "id"], counted, **SPREAD).select("id", "n"),
    )


def test_bin_index(spark):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 0.5, 1.0, 2.5, 9.0)], "x double")
    cuts = F.array(*[F.lit(float(c)) for c in (0, 1, 2)])
    assert [r[0] for r in df.select(bin_index(F.col("x"), cuts, 3)).collect()] == [0, 0, 1, 1, 2, 3, 3]


def test_first_per_group(rows):
    got = {r["k"]: (r["t"], r["id"]) for r in first_per_group(rows, ["k"], ["t", "id"]).collect()}
    want = {}
    for r in rows.collect():
        want[r["k"]] = min(want.get(r["k"], (1e9, 0)), (r["t"], r["id"]))
    assert got == want


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, s: sequence.interpolate(d.withColumn("v", F.col("v").cast("double")), ["k"], ["t", "id"], ["v"], s),
        lambda d, s: sequence.fill_down_up(d, ["k"], ["t", "id"], ["v"], s),
        lambda d, s: sequence.streaks(d, ["k"], "id", 3, spread=s),
        lambda d, s: sequence.consecutive_runs(d, ["k"], "id", 2, 3, spread=s),
        lambda d, s: sequence.position_change(d, ["k"], ["t", "id"], "v", spread=s),
        lambda d, s: sequence.retirement_lap(d.withColumn("lap", F.when(F.col("id") % 17 > 0, F.col("id"))), ["k"], "t", "lap", spread=s),
        lambda d, s: sampling.permuted(d, "id", ["v"], "other", spread=s),
        lambda d, s: sampling.stratified_folds(d, ["k"], "id", 4, spread=s),
        lambda d, s: sampling.stratified_split(d, ["k"], "id", 0.3, spread=s),
        lambda d, s: profile.cumulative_frequency(d, "id", spread=s),
        lambda d, s: temporal.asof_left(
            d.withColumn("late", F.col("t") + 0.5), d.where("v is not null"), ["k"], "late", "t", {"v": "seen"}, s
        ),
        lambda d, s: temporal.interval_flags(
            d.withColumn("to", F.col("t") + 1), d.where("v < 4"), ["k"], "t", {"hit": ("t", "to")}, s
        ),
        lambda d, s: temporal.count_in_rank_range(
            d.withColumn("to", F.col("t") + F.col("v")), d.select("k", F.col("t").alias("r")), ["k"], "t", "to", "r", "n", s
        ),
    ],
)
def test_operators_do_not_depend_on_the_spread(rows, operator):
    rows = rows.where("k is not null")
    same(operator(rows, False), operator(rows, True))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 613])
def test_permutations_are_exact(spark, n):
    rows = spark.range(n).selectExpr("id * 3 AS id", "id AS v")
    found = sampling.permuted(rows, "id", ["id", "v"], "other").collect()
    assert sorted(r.id for r in found) == sorted(r.other.id for r in found) == [3 * i for i in range(n)]
    assert n < 100 or sum(r.id == r.other.id for r in found) < 10
    again = sampling.permuted(rows.repartition(3), "id", ["id", "v"], "other").collect()
    assert {(r.id, r.other.id) for r in found} == {(r.id, r.other.id) for r in again}


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.3, 1.0])
def test_splits_by_selection(spark, rows, fraction):
    found = sampling.stratified_split(rows, ["k"], "id", fraction)
    same(sampling.stratified_split(rows, ["k"], "id", fraction, spread=False), found)
    assert "SinglePartition" not in found._jdf.queryExecution().toString()


def test_ordered_scans_write_nothing(spark, rows, tmp_path):
    """Borders and carries come from the rows themselves, whatever is chained."""
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    for found in (sequence.interpolate(stored.withColumn("v", F.col("v").cast("double")), ["k"], ["t", "id"], ["v"]), sequence.streaks(stored, ["k"], "id")):
        assert found.count() == rows.count() and all(path in f for f in found.inputFiles())


def test_exact_median(spark, rows):
    want = rows.groupBy("k").agg(F.median("v").alias("m")).where("k is not null")
    for split in (False, True):
        got = sequence.exact_median(rows.where("k is not null"), ["k"], "v", "m", split)
        same(want, got)
    filled = [sequence.group_median_fill(rows, ["k"], ["v"], s) for s in (False, True)]
    same(filled[0], filled[1])


def test_backward_scan_of_one_large_group_is_linear(spark):
    """One group of a million rows in one task: a frame to the end of the group would take days."""
    rows = spark.range(1_000_000).selectExpr("1 AS k", "id", "IF(id % 1000 = 7, id, NULL) AS v")
    found = ordered_scan(rows, ["k"], ["id"], {"up": latest(F.col("v"), backward=True), "rest": scans.Scan("sum", F.lit(1), True)}, spread=False)
    row = found.agg(F.sum("up").alias("s"), F.max("rest").alias("m"), F.count("up").alias("n")).first()
    assert (row.m, row.n) == (1_000_000, 999_008)
    assert row.s == sum(7 * 1 + 0 for _ in range(8)) + sum((1000 * b + 7) * 1000 for b in range(1, 1000))


def test_no_frame_runs_to_the_end_of_a_group():
    import pathlib

    import slipstream

    root = pathlib.Path(slipstream.__file__).parent
    assert not [p for p in root.rglob("*.py") if "unboundedFollowing" in p.read_text()]


def test_texts_with_one_prefix_are_spread(spark):
    rows = spark.range(400).selectExpr("concat('Customer#000000', lpad(id % 200, 9, '0')) AS t")
    got = {r.t: r for r in profile.cumulative_frequency(rows, "t").collect()}
    names = sorted(got)
    assert [round(got[n].Kumulativ_Szazalek, 6) for n in names] == [round(0.5 * (i + 1), 6) for i in range(200)]


def test_a_row_is_compared_with_few_borders_however_many_ranges(spark):
    rows = spark.createDataFrame([(i % 3, i) for i in range(300)], "k int, v int")
    kept, compared = spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for parts in (4, 800):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            placed = scans.OrderedRows(rows, ["k"], ["v"])._rows
            compared[parts] = placed._jdf.queryExecution().analyzed().toString().count("element_at")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert compared[800] < 4 * compared[4]
    assert scans.numbered(rows, ["k"], ["v"], "n").where("n <> (v - k) / 3 + 1").count() == 0
