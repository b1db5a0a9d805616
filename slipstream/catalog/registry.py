"""Registering queries: one column list gives both engines the same names, types and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DIGITS = 6
_SPARK = {"i": "bigint", "d": "double", "s": "string", "b": "boolean"}
_SQL = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def columns_of(text: str) -> list[tuple[str, str]]:
    """``"i:Season Round s:Driver"`` as (name, kind) pairs; a kind holds until the next one."""
    pairs, kind = [], ""
    for word in text.split():
        if word[1:2] == ":":
            kind, word = word[0], word[2:]
        pairs.append((word, kind))
    return pairs


class Registry:
    """Queries of one module, with their SQL twins."""

    def __init__(self):
        self.QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.ORACLES: dict[str, str] = {}

    def add(self, name: str, columns: str, sql: str | None = None):
        """Register the decorated function; its result and the SQL text are brought to ``columns``."""
        pairs = columns_of(columns)

        def wrap(query: Callable[[SparkSession, str], DataFrame]):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                found = query(spark, sf_dir)
                return found.selectExpr(
                    *[
                        f"round(CAST(`{c}` AS DOUBLE), {DIGITS}) AS `{c}`" if k == "d" else f"CAST(`{c}` AS {_SPARK[k]}) AS `{c}`"
                        for c, k in pairs
                    ]
                )

            self.QUERIES[name] = run
            if sql is not None:
                casts = [
                    f'round(CAST("{c}" AS DOUBLE), {DIGITS}) AS "{c}"' if k == "d" else f'CAST("{c}" AS {_SQL[k]}) AS "{c}"'
                    for c, k in pairs
                ]
                self.ORACLES[name] = f"SELECT {', '.join(casts)} FROM ({sql.strip()})"
            return query

        return wrap
