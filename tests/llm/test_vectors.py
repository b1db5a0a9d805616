"""Vector codes against a brute-force version in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from slipstream.llm import vector_codes
from slipstream.llm.queries import prepare
from slipstream.llm.vector_codes import Codebooks, Gnat, compress, decode, encode, train
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int, code int, row string"


def whole(x):
    return int(x) * 256 if abs(x) > 2.0**60 else math.floor(x * 256)


def brute(rows, parts, size, rounds, dimension):
    kept = [(i, [whole(x) for x in v], lab) for i, v, lab in rows if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    width = dimension // parts
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:size]
    books = [[r[1][k * width : (k + 1) * width] for r in start] for k in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            held = [[] for _ in books[k]]
            for _, v, _ in kept:
                x = v[k * width : (k + 1) * width]
                held[nearest(x, books[k])[1]].append(x)
            books[k] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[k])]
    out, sums = [], {}
    for i, v, lab in kept:
        found = [nearest(v[k * width : (k + 1) * width], books[k]) for k in range(parts)]
        error = min(sum(d for d, _ in found), 2**63 - 1)
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, lab))
        sums[lab] = sums.get(lab, 0) + error
    text = ",".join(str(c) for b in books for e in b for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, min(sums[lab], 2**63 - 1), sha) for i, c, e, lab in out), key=repr)


def vectors(n, dimension, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dimension)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * dimension, 1), (n + 2, [math.nan] + [0.0] * (dimension - 1), 1), (n + 3, [math.inf] + [0.0] * (dimension - 1), None)]
    rows += [(n + 4, [], 1), (n + 5, [0.5] * (dimension + 1), 1), (n + 6, [-0.001] * dimension, 2), (None, [0.1] * dimension, 2), (None, [0.1] * dimension, 2)]
    rows += [(5, rows[6][1], 0), (5, rows[5][1], 0)]  # repeated keys, equal vectors
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "r") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("parts, size, n", [(4, 8, 60), (2, 64, 90), (8, 200, 40)])
def test_codes(spark, parts, size, n):
    rows = vectors(n, 8)
    found = compress(frame(prepare(spark), rows), parts, size)
    assert set(found.columns) == {"vec_id", "label", "row", "code", "error", "label_error", "codebooks_sha256"}
    assert rows_of(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == brute(rows, parts, size, 2, 8)


@pytest.mark.parametrize("large", [1e9, 1e38, 1e300])
def test_large_components(spark, large):
    rows = vectors(20, 4) + [(100, [large, 0.0, -large, 1.0], None), (1, [0.0, -large / 2, 3.0, 1.0], 1)]
    found = compress(frame(prepare(spark), rows), 2, 6)
    assert rows_of(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == brute(rows, 2, 6, 2, 4)


def test_no_vectors(spark):
    docs = frame(prepare(spark), [(1, None, 1), (2, [math.nan] * 16, 1)])
    books = train(docs)
    assert books.dimension == 0 and encode(docs, books).count() == 0
    assert compress(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        train(docs, size=300)


def test_many_labels_and_none(spark, monkeypatch):
    rows = vectors(40, 8)
    docs = frame(prepare(spark), rows)
    monkeypatch.setattr(vector_codes, "LABELS", 1)
    books = train(docs, 4, 8)
    found = encode(docs, books)
    assert rows_of(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == brute(rows, 4, 8, 2, 8)
    assert rows_of(encode(docs, books, label=None), "vec_id", "error") == sorted(((r[0], r[2]) for r in brute(rows, 4, 8, 2, 8)), key=repr)


def test_decoding(spark):
    prepare(spark)
    books = Codebooks((((256, -512), (0, 1)), ((7, 7), (128, 0))))
    codes = spark.createDataFrame([(1, "0001"), (2, "0100"), (3, None)], "vec_id long, code string")
    found = dict(map(tuple, decode(codes, books).select("vec_id", "embedding").collect()))
    assert found == {1: [1.0, -2.0, 0.5, 0.0], 2: [0.0, 1 / 256, 7 / 256, 7 / 256], 3: None}


@pytest.mark.parametrize("spread", [2, 40, 10**6])
def test_gnat_is_exact_and_prunes(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread * 50, spread * 50, (12, 3))
    entries = centres[rng.integers(0, 12, 250)] + rng.integers(-spread, spread, (250, 3))
    points = np.concatenate([centres[rng.integers(0, 12, 3000)] + rng.integers(-2 * spread, 2 * spread, (3000, 3)), entries])
    tree = Gnat(entries)
    at, best = tree.nearest(points)
    squared = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    assert (best == squared.min(1)).all() and (at == squared.argmin(1)).all()
    assert tree.measured < 0.4 * squared.size
