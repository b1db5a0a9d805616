"""Line dedup: counts, filters, deletion."""

from collections import Counter

import numpy as np
import pytest

from slipstream.llm import line_dedup
from slipstream.llm.line_dedup import CuckooFilter, LineIndex, drop_common
from slipstream.llm.queries import prepare
from tests.llm.conftest import rows_of


def brute(rows, least, counted=None):
    """(id, n_lines, n_dropped, kept) of every row; lines are counted over ``counted``."""

    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    n = Counter(k for _, t in (rows if counted is None else counted) for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if n[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


LINES = [
    (1, "Home\nabout us\nText of one"),
    (2, " home \r\nABOUT US\ntext of two\n"),
    (3, "home\nhome\nÉTÉ"),
    (4, "été\n\n  \nhome "),
    (4, "été\n\n  \nhome "),
    (None, "about us"),
    (None, None),
    (5, ""),
    (6, "\n\n"),
    (7, "x" * 50_000 + "\nhome"),
    (8, "\x1chome\nabout us\t"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "n", 5, b"k") for i, t in rows], "doc_id long, text string, kept string, block int, key binary").repartition(3)


@pytest.mark.parametrize("least", [1, 2, 3, 100])
def test_common_lines_go(spark, least):
    docs = frame(prepare(spark), LINES)
    found = drop_common(docs, LineIndex(spark, least).insert(docs))
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept") == brute(LINES, least)
    assert set(found.columns) == {"doc_id", "block", "key", "n_lines", "n_dropped", "kept"}


def test_edge_documents(edge_docs, edge_rows):
    found = drop_common(edge_docs, LineIndex(edge_docs.sparkSession, 2).insert(edge_docs))
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept") == brute(edge_rows, 2)


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK", 2)
    docs = frame(prepare(spark), LINES)
    assert rows_of(drop_common(docs, LineIndex(spark, 2).insert(docs)), "doc_id", "n_lines", "n_dropped", "kept") == brute(LINES, 2)


def test_documents_are_added_and_deleted(spark):
    prepare(spark)
    more = [(20, "about us\nnew"), (21, "new\nlast"), (22, "last\nnew\nHOME")]
    docs, later = frame(spark, LINES), frame(spark, more)
    first = LineIndex(spark, 3).insert(docs)
    second = first.insert(later)
    both = docs.unionByName(later)
    columns = ("doc_id", "n_lines", "n_dropped", "kept")
    assert rows_of(drop_common(both, second), *columns) == brute(LINES + more, 3)
    third = second.delete(later)
    assert rows_of(drop_common(both, third), *columns) == brute(LINES + more, 3, LINES)
    assert rows_of(third.counts(), "key", "docs") == rows_of(first.counts(), "key", "docs")
    assert rows_of(third.compacted().counts(), "key", "docs") == rows_of(first.counts(), "key", "docs")
    assert rows_of(third.filters.selectExpr("shard", "hex(filter) AS f"), "shard", "f") != rows_of(second.filters.selectExpr("shard", "hex(filter) AS f"), "shard", "f")
    assert rows_of(drop_common(docs, first), *columns) == brute(LINES, 3)  # the earlier index is as it was
    none = third.delete(docs)
    assert none.counts().count() == 0 and all(set(r.filter) <= {0} for r in none.filters.collect())
    assert rows_of(drop_common(docs, none), *columns) == brute(LINES, 100)
    with pytest.raises(ValueError):
        first.delete(later)


def test_full_filters_are_built_anew(spark):
    prepare(spark)
    index = LineIndex(spark, 1).insert(frame(spark, [(1, "a")]))
    rows = [(k, f"line {k}\nother {k}") for k in range(3000)]
    docs = frame(spark, rows)
    index = index.insert(docs)
    assert index.filters.where("filter IS NULL").count() == 0
    assert rows_of(drop_common(docs, index), "doc_id", "n_dropped") == [(k, 2) for k in sorted(range(3000), key=lambda k: repr((k, 2)))]


def test_no_documents(no_docs):
    index = LineIndex(no_docs.sparkSession, 1).insert(no_docs)
    assert drop_common(no_docs, index).count() == 0 and index.counts().count() == 0


def test_filters():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (5000, 2), dtype=np.uint64)
    keys[:, 1] |= rng.integers(0, 2, 5000, dtype=np.uint64) << np.uint64(63)
    own = CuckooFilter.holding(keys)
    assert own.contains(keys).all()
    other = rng.integers(0, 2**63, (20000, 2), dtype=np.uint64)
    assert own.contains(other).mean() < 0.01
    own = CuckooFilter.read(own.written())
    own.remove(keys[:4000])
    assert own.contains(keys[4000:]).all() and own.contains(keys[:4000]).mean() < 0.01
    own.remove(keys[4000:])
    assert not own.table.any()
    tight = CuckooFilter(np.zeros((1024, 4), np.uint16))
    assert tight.insert(keys[:3700]) and tight.contains(keys[:3700]).all()  # nine tenths full
    assert not tight.insert(keys[3700:])
    same = np.repeat(keys[:1], 50, axis=0)
    same[:, 0] = np.arange(50)
    assert CuckooFilter.holding(same).contains(other).all()  # too many equal fingerprints: lets all through
