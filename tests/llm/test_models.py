"""Quality and language models: held-out accuracy, and every odd input."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slipstream.llm import arrow, language, quality
from slipstream.llm.queries import QUERIES, held_out
from tests.llm.conftest import rows_of

SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_rows(spark):
    found = QUERIES["op1_quality"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = found.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    row = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("a"), F.min("score"), F.max("score")).first()
    assert row.a > 0.95 and 0 <= row[1] <= row[2] <= 1


def test_quality_of_odd_rows(edge_docs, edge_rows, no_docs, spark):
    labels = spark.createDataFrame([(10, 1.0), (10, 1.0), (22, 0.0), (23, 0.0), (14, None), (None, 1.0), (99, 0.0)], "doc_id long, label double")
    model = quality.train(edge_docs, labels)
    found = quality.score(edge_docs, model)
    assert found.count() == len(edge_rows) and found.where("score IS NULL OR predicted IS NULL").isEmpty()
    scores = dict(rows_of(found, "doc_id", "score"))
    assert scores[10] > scores[22] and scores[14] == scores[15]
    assert {r[0] for r in rows_of(found.where("doc_id IN (3, 10)"), "score")} == {scores[10]}  # equal texts, equal scores
    assert quality.score(no_docs, model).isEmpty()
    untrained = quality.train(edge_docs, labels.limit(0))
    assert {r[0] for r in rows_of(quality.score(edge_docs, untrained), "score")} == {0.5}


def test_scores_are_dot_products():
    data, offsets = arrow.flat(pa.array(["One two, two!", "", "éé 12 ß", None]))
    weights = np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32)
    want = [1 / (1 + np.exp(-(0.3 + float(weights[i] @ v)))) for i, v in quality.bags(data, offsets)]
    assert quality.scores(data, offsets, weights, 0.3) == pytest.approx(want, rel=1e-5)


def test_language_of_held_out_rows(spark):
    found = QUERIES["op6_language"](spark, SF)
    held = found.where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_language_of_odd_rows(edge_docs, edge_rows, no_docs):
    model = language.train(edge_docs)
    found = language.identify(edge_docs, model)
    assert found.count() == len(edge_rows)
    by_id = {r[0]: r[1:] for r in rows_of(found, "doc_id", "lang_pred", "score")}
    for nothing in (14, 15, 16, 20):
        assert by_id[nothing] == ("und", 0.0)
    assert by_id[10][0] in ("en", "fr") and 0 <= by_id[10][1] <= 1
    assert language.train(no_docs) is None
    assert {r[0] for r in rows_of(language.identify(edge_docs, None), "lang_pred")} == {"und"}
    assert language.identify(no_docs, model).isEmpty()


def test_kernel_counts_shared_buckets():
    rows = language.presence(pa.array(["abc abc", "ABC!", "xyz", "", None]))
    k = language.kernel(rows, rows)
    assert k[0, 0] == pytest.approx(1) and k[0, 1] > 0.5 > k[0, 2] and k[3, 3] == 0
    assert k[0, 1] == pytest.approx((rows[0] * rows[1]).sum() / np.sqrt(rows[0].sum() * rows[1].sum()))


def test_held_out_is_the_remainder_of_the_hash(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_learner_is_the_plain_loop():
    """Follow-the-regularised-leader, coordinate by coordinate."""
    import math

    rng = np.random.default_rng(5)
    rows = []
    for k in range(40):
        index = np.unique(rng.integers(0, 30, 6)).astype(np.int32)
        rows.append((float(k % 3 == 0), index, rng.random(len(index)).astype(np.float32) + (index < 8) * (k % 3 == 0)))
    found, bias = quality.learn(rows, epochs=3)
    z, n = {}, {}

    def weight(i):
        s = z.get(i, 0.0)
        if abs(s) <= quality.L1:
            return 0.0
        return -(s - math.copysign(quality.L1, s)) / ((quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    order = np.random.default_rng(3)
    for _ in range(3):
        for k in order.permutation(len(rows)):
            label, index, value = rows[k]
            features = [*zip(index.tolist(), value.tolist()), ("bias", 1.0)]
            own = {i: weight(i) for i, _ in features}
            p = 1 / (1 + math.exp(-sum(own[i] * x for i, x in features)))
            for i, x in features:
                g = (p - label) * x
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA * own[i]
                n[i] = n.get(i, 0.0) + g * g
    assert bias == pytest.approx(weight("bias"), rel=1e-6)
    for i in range(40):
        assert found[i] == pytest.approx(weight(i), rel=1e-5, abs=1e-7)
    assert not found[40:].any()


def test_ridge_is_the_plain_solve():
    """With every text a landmark the model is kernel ridge regression, solved in its dual."""
    texts = ["the cat sat on the mat", "a dog ran over the hill", "this is the other one", "le chat est sur la table", "un chien court sur la colline", "ceci est une autre chose", "der hund", "die katze"]
    label = np.array([0, 0, 0, 1, 1, 1, 2, 2])
    rows = language.presence(pa.array(texts))
    model = language.fit(["en", "fr", "de"], label, rows, marks=10)
    k = language.kernel(rows, rows).astype(np.float64)
    root = np.sqrt(1 / np.bincount(label)[label] / 3)
    y = np.where(label[:, None] == np.arange(3), 1.0, -1.0)
    dual = np.linalg.solve(root[:, None] * k * root + language.RIDGE / len(texts) * np.eye(len(texts)), root[:, None] * y)
    other = language.presence(pa.array(["the hill", "la chose", "katze und hund", "zzz"]))
    want = (language.kernel(other, rows) * root) @ dual
    assert np.allclose(model.values(other), want, atol=1e-3)
    assert model.values(other)[:3].argmax(axis=1).tolist() == [0, 1, 2]
