"""Ordered scans inside groups that stay parallel when one group holds most of the rows.

A plain window function sends a whole group to one task. That is the right plan for groups that are
bounded by what they are (the laps of a driver in a race) and the wrong one for any other. A spread
scan cuts the order of (keys, order) into ranges, so a group of any size lies in as many ranges as it
calls for; each range is scanned on its own, and what came before arrives as one small carry row for
a group that crosses a border between ranges. There is one way for groups of every size.

The borders are quantiles of a sample drawn by hash, which is a subquery of the plan: the same rows give the same borders however
often and wherever they are read, so nothing is written and nothing runs before an action. Rows move once, to (keys, range).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANGE, _INDEX, _CUTS, _OFFSET = "__scan_range", "__scan_index", "__scan_cuts", "__scan_offset"
SAMPLED = 32  # sampled rows for each range


@dataclass(frozen=True)
class Scan:
    """One output of an ordered scan.

    kind      ``sum``: running total of ``value``, this row included (nulls count as 0)
              ``last``: latest non-null ``value`` at or before this row
              ``prev``: ``value`` of the row before, null included
    backward  scan from the end of the group to its start
    placed    ``last`` only: a struct of the value ``v`` and the number ``i`` of its row in the group
    """

    kind: str
    value: Column
    backward: bool = False
    placed: bool = False


def running_total(value) -> Scan:
    return Scan("sum", value)


def latest(value, backward: bool = False, placed: bool = False) -> Scan:
    return Scan("last", value, backward, placed)


def previous(value) -> Scan:
    return Scan("prev", value)


def following(value) -> Scan:
    return Scan("prev", value, backward=True)


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _once(value: Column) -> Column:
    """The same value, in an expression that the optimizer does not write out anew wherever it is used."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def bin_index(value: Column, cuts: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (at most ``most`` of them) are at or below ``value``.

    A binary search; a null value gives 0.
    """
    steps = [1 << b for b in range(most.bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.try_element_at(cuts, at + s) <= value, at + s).otherwise(at),
    )


def _found(scan: Scan) -> Column:
    """What a ``last`` scan looks for: the value, with the row's number if it is placed."""
    if not scan.placed:
        return scan.value
    return F.when(scan.value.isNotNull(), F.struct(scan.value.alias("v"), F.col(_INDEX).alias("i")))


def _windowed(df: DataFrame, keys: list, order: list[Column], scans: dict[str, Scan]) -> DataFrame:
    """The plain form: window functions over whole groups (or the part of a group in one range)."""
    forward = Window.partitionBy(*keys).orderBy(*order)
    upto = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if any(s.placed for s in scans.values()):
        df = df.withColumn(_INDEX, F.row_number().over(forward).cast("long"))
    outputs = {}
    for name, scan in scans.items():
        # a frame from here to the end would be computed anew for every row: the order is turned round instead
        frame = upto if not scan.backward else _reversed(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if scan.kind == "sum":
            outputs[name] = F.sum(F.coalesce(scan.value, F.lit(0))).over(frame)
        elif scan.kind == "last":
            outputs[name] = F.last(_found(scan), ignorenulls=True).over(frame)
        else:
            step = F.lead if scan.backward else F.lag
            # a struct is never null itself, so a missing row differs from a null value
            outputs[name] = step(F.struct(scan.value.alias("v")), 1).over(forward)
    return df.withColumns(outputs)


def _reversed(keys: list, order: list[Column]):
    return Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])


def _finish(df: DataFrame, scans: dict[str, Scan]) -> DataFrame:
    unwrap = {n: F.col(f"`{n}`.v") for n, s in scans.items() if s.kind == "prev"}
    return (df.withColumns(unwrap) if unwrap else df).drop(_INDEX)


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"__scan_k_{k}"])
    return condition


class OrderedRows:
    """Rows in a total order inside groups, to which scans are added one after another.

    ``order`` is a total order inside a group, ascending, nulls first. ``spread=False`` states that
    groups are bounded by what they are; the scans are then plain windows. Else the rows are cut into ranges
    by borders that follow from the rows alone. Each call of `add` reads the rows of groups that cross a border once more,
    for their carries, so scans that do not need each other's outputs belong in one call.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence, spread: bool = True):
        self.keys, self.order, self.spread = list(keys), [_column(c) for c in order], spread
        self._columns = list(df.columns)
        self._rows = df
        if spread:
            self._cut(df)

    def _cut(self, df: DataFrame) -> None:
        """Number the ranges, and set apart the rows of groups that cross a border."""
        ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        own = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(self.keys)])
        place = F.struct(own.alias("k"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(self.order)]).alias("o")) if self.keys else F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(self.order)]).alias("o"))
        # the first rows by hash are a sample that every reading of the rows gives again
        sample = df.select(place.alias("p")).orderBy(F.xxhash64("p")).limit(SAMPLED * ranges)
        quantile = F.transform(
            F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.try_element_at(F.col("s"), F.ceil(i * F.size("s") / ranges).cast("int"))
        )
        cuts = sample.agg(F.sort_array(F.collect_list("p")).alias("s")).select(F.when(F.size("s") > 0, F.array_distinct(quantile)))
        # how many borders are at or below a row: a binary search in generated code, so a row takes few comparisons however many ranges
        with_cuts = df.withColumn(_CUTS, cuts.scalar()).withColumn(_RANGE, F.lit(0))
        for step in [1 << b for b in range(ranges.bit_length() - 1, -1, -1)]:
            passed = F.when(F.try_element_at(F.col(_CUTS), F.col(_RANGE) + step) <= place, step).otherwise(0)
            with_cuts = with_cuts.withColumn(_RANGE, _once(F.col(_RANGE) + passed))
        self._rows = with_cuts.drop(_CUTS)
        crossing = F.col(_CUTS).isNotNull()
        if self.keys:
            # a group lies on both sides of a border only if the border next to the row is its own
            below, above = (F.when(at > 0, F.try_element_at(F.col(_CUTS), at))["k"] for at in (F.col(_RANGE), F.col(_RANGE) + 1))
            crossing = crossing & (below.eqNullSafe(own) | above.eqNullSafe(own))
        self._edge = with_cuts.where(crossing).drop(_CUTS)

    @property
    def rows(self) -> DataFrame:
        return self._rows.drop(_RANGE)

    def add(self, scans: dict[str, Scan]) -> OrderedRows:
        """Add the outputs of some scans, which may use the outputs of earlier ones."""
        if not self.spread:
            self._rows = _finish(_windowed(self._rows, self.keys, self.order, scans), scans)
            return self
        carry = self._carries(scans)
        self._rows, self._edge = (self._carried(rows, carry, scans) for rows in (self._rows, self._edge))
        return self

    def _carried(self, rows: DataFrame, carry: DataFrame, scans: dict[str, Scan]) -> DataFrame:
        """The scans inside each range, with what the ranges before it bring."""
        local = _windowed(rows, [*self.keys, _RANGE], self.order, scans)
        matched = _same_key(local, carry, self.keys) & (local[_RANGE] == carry["__scan_k_range"])
        joined = local.join(F.broadcast(carry), matched, "left")  # a range has at most two groups that cross its borders
        merged = {}
        for name, scan in scans.items():
            here, carried = F.col(f"`{name}`"), F.col(f"__scan_c_{name}")
            if scan.kind == "sum":
                merged[name] = here + F.coalesce(carried, F.lit(0))
            elif scan.placed:
                moved = F.struct(here["v"].alias("v"), (here["i"] + F.coalesce(F.col(_OFFSET), F.lit(0))).alias("i"))
                merged[name] = F.when(here.isNotNull(), moved).otherwise(carried)
            else:
                merged[name] = F.coalesce(here, carried)
        return _finish(joined.withColumns(merged).select(*[F.col(f"`{c}`") for c in local.columns]), scans)

    def _carries(self, scans: dict[str, Scan]) -> DataFrame:
        """What the other ranges hold of each crossing group: one summary row per range, scanned per group."""
        names = [f"__scan_k_{k}" for k in self.keys]
        placed = any(s.placed for s in scans.values())
        rows = self._edge
        if placed:
            forward = Window.partitionBy(*self.keys, _RANGE).orderBy(*self.order)
            rows = rows.withColumn(_INDEX, F.row_number().over(forward).cast("long"))
        rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(self.order)])
        summaries = {}
        for name, scan in scans.items():
            if scan.kind == "sum":
                summaries[name] = F.sum(F.coalesce(scan.value, F.lit(0)))
            else:
                pick = F.min_by if scan.backward else F.max_by
                if scan.kind == "last":
                    summaries[name] = pick(_found(scan), F.when(scan.value.isNotNull(), rank))
                else:
                    summaries[name] = pick(F.struct(scan.value.alias("v")), rank)
        grouped = rows.groupBy(F.col(_RANGE).alias("__scan_k_range"), *[F.col(f"`{k}`").alias(n) for k, n in zip(self.keys, names)])
        per_part = grouped.agg(*[v.alias(f"__scan_s_{n}") for n, v in summaries.items()], F.count("*").alias("__scan_n"))
        walks = {b: Window.partitionBy(*names).orderBy(F.col("__scan_k_range").desc() if b else F.col("__scan_k_range").asc()) for b in (False, True)}
        before = {b: w.rowsBetween(Window.unboundedPreceding, -1) for b, w in walks.items()}
        carries = {_OFFSET: F.sum("__scan_n").over(before[False])}
        if placed:  # numbers inside a range become numbers inside the group
            per_part = per_part.withColumns(carries)
            moved = {}
            for name, scan in scans.items():
                if scan.placed:
                    c = F.col(f"__scan_s_{name}")
                    moved[f"__scan_s_{name}"] = F.when(c.isNotNull(), F.struct(c["v"].alias("v"), (c["i"] + F.coalesce(F.col(_OFFSET), F.lit(0))).alias("i")))
            per_part, carries = per_part.withColumns(moved), {}
        for name, scan in scans.items():
            summary, frame = F.col(f"__scan_s_{name}"), before[scan.backward]
            carries[f"__scan_c_{name}"] = F.sum(summary).over(frame) if scan.kind == "sum" else F.last(summary, ignorenulls=True).over(frame)
        outputs = [f"__scan_c_{n}" for n in scans]
        return per_part.withColumns(carries).select("__scan_k_range", _OFFSET, *names, *outputs)


def ordered_scan(
    df: DataFrame, keys: Sequence[str], order: Sequence, scans: dict[str, Scan], spread: bool = True
) -> DataFrame:
    """Add the scan outputs to ``df``; see `OrderedRows`."""
    return OrderedRows(df, keys, order, spread).add(scans).rows


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence, out: str, spread: bool = True) -> DataFrame:
    """Row number from 1 inside each group, in the given total order."""
    return ordered_scan(df, keys, order, {out: running_total(F.lit(1).cast("long"))}, spread)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The whole first row of each group, as an aggregate with map-side combining (no group is collected)."""
    order = [_column(c) for c in order]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, rank).alias("row"))
    return picked.select("row.*")
