"""Rows to columns and back: roles, lap windows, pivots, and matrices to long form."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_roles(df: DataFrame, ids: Sequence[str], roles: dict[str, str], value: str = "Driver") -> DataFrame:
    """One row per role: ``roles`` maps the column that holds a party to the name of its role."""
    cases = [F.struct(F.lit(role).alias("Role"), F.col(column).alias(value)) for column, role in roles.items()]
    return df.select(*ids, F.inline(F.array(*cases)))


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Long form of several columns of one type."""
    return df.unpivot(list(ids), list(columns), name, value)


def lap_window(df: DataFrame, base: str, before: int = 2, first: float | None = None, out: str = "LapNumber") -> DataFrame:
    """One row per lap from ``base - before`` to ``base``; laps below ``first`` are left out."""
    laps = F.sequence((F.col(base) - before).cast("long"), F.col(base).cast("long"))
    spread = df.withColumn(out, F.explode(laps))
    if first is not None:
        spread = spread.where(F.col(out) >= first)
    return spread.withColumn(out, F.col(out).cast(df.schema[base].dataType))


def pivot_roles(df: DataFrame, ids: Sequence[str], values: Sequence[str], roles: Sequence[str]) -> DataFrame:
    """One row per ``ids`` with ``{value}_{role}`` columns.

    A plain aggregate over a fixed list of roles: one pass, map-side combined, and a schema that does
    not depend on the data.
    """
    cells = [
        F.max(F.when(F.col("Role") == role, F.col(value))).alias(f"{value}_{role}") for value in values for role in roles
    ]
    return df.groupBy(*ids).agg(*cells)


def pivot_laps(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    roles: Sequence[str],
    laps: Sequence[int],
    index: str = "Lap_Index",
) -> DataFrame:
    """One row per ``ids`` with ``{measure}_{role}_{lap}`` columns, in one aggregation."""
    cells = []
    for measure in measures:
        for role in roles:
            for lap in laps:
                here = (F.col("Role") == role) & (F.col(index) == lap)
                cells.append(F.max(F.when(here, F.col(measure))).alias(f"{measure}_{role}_{lap}"))
    return df.groupBy(*ids).agg(*cells)


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Column names that match a regular expression anywhere."""
    return [c for c in df.columns if re.search(pattern, c)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, less the excluded ones."""
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def last_column(df: DataFrame, column: str) -> DataFrame:
    """Move one column to the end."""
    return df.select(*[c for c in df.columns if c != column], column)


def fill_missing(df: DataFrame, value: int = 0) -> DataFrame:
    """Replace nulls by 0 in numeric columns and by false in boolean ones."""
    return df.fillna(value).fillna(bool(value))
