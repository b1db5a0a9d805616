"""Run registered queries beside their SQL twins and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "tolist"):
        return str(value.tolist())
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((c is None, type(c).__name__ if not isinstance(c, (int, float)) else "n", c if c is not None else 0) for c in r))


def compare(frame, con, sql: str) -> tuple[bool, str]:
    """(same, explanation) for a Spark frame and the SQL text of its twin."""
    got_columns, got = frame.columns, [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    if len(got) != len(want):
        return False, f"{len(got)} rows, SQL has {len(want)}"
    a, b = _sorted_rows(got_columns, got), _sorted_rows(want_columns, want)
    names = sorted(got_columns)
    wrong, kinds = [], set()
    for x, y in zip(a, b):
        for name, p, q in zip(names, x, y):
            if p is not None and q is not None and type(p) is not type(q):
                kinds.add((name, type(p).__name__, type(q).__name__))
            near = isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1.1e-6)
            if p != q and not near:
                wrong.append((name, p, q))
    if wrong:
        return False, f"{len(wrong)} cells differ: {wrong[:6]}"
    if kinds:
        return False, f"types differ: {sorted(kinds)}"
    return True, f"{len(got)} rows"


def main(names):
    import __spark_entry__ as entry
    from slipstream.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    if names and names[0].startswith("sf"):
        sf_dir = f"/root/testdata/{names.pop(0)}"
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                same, why = compare(frame, con, oracles[name])
            else:
                same, why = True, f"{frame.count()} rows (no SQL)"
        except Exception as error:  # report every query of the list
            same, why = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not same
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {why}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
