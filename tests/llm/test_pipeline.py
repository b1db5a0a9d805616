"""Every stage of the pipeline on its own input, and all of them."""

from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from slipstream.session import staged
from tests.llm import brute
from tests.llm.conftest import rows_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(edge_docs):
    return edge_docs.select(*COLUMNS)


@pytest.fixture(scope="module")
def sf_dir(spark, edge_rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, edge_rows[5][1]), (2, "short")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_are_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "bpe"]


def test_language(spark, docs, sf_dir):
    kept = pipeline.identify_language(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    gone = {r.doc_id for r in docs.exceptAll(kept).collect()}
    assert {14, 15, 16, 20} <= gone and not gone & {3, 7, 10, 11, 12, 13, 21, 24}
    assert pipeline.identify_language(spark, docs.limit(0), sf_dir).isEmpty()


def test_texts_of_other_languages_go_and_labelled_ones_stay(spark):
    import base64
    import random

    rng = random.Random(3)
    foreign = [
        "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待" * 2,
        "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem",
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400)),
        base64.b64encode(rng.randbytes(300)).decode(),
        rng.randbytes(300).hex(),
        "q" * 400,
    ]
    own = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*COLUMNS)
    planted = spark.createDataFrame([(-k, t, None, "p", len(t)) for k, t in enumerate(foreign, 1)], own.schema)
    kept = pipeline.identify_language(spark, own.unionByName(planted), "").select("doc_id").collect()
    kept = {r.doc_id for r in kept}
    assert not {k for k in kept if k < 0}
    held = own.where(pipeline.held_out()).where("lang IS NOT NULL AND text rlike '[a-zA-Z]'").select("doc_id").collect()
    assert len(held) > 200 and {r.doc_id for r in held} <= kept


def test_near_copies(spark, docs, edge_rows, sf_dir):
    kept = pipeline.join_near_copies(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    found, groups = brute.linked(edge_rows, 5, Fraction(4, 5))
    with_words = [k for k, f in enumerate(found) if f[1]]
    assert kept.count() == len({groups[k] for k in with_words}) + len(found) - len(with_words)
    best = {}
    for k in with_words:
        key = brute.order(edge_rows[k][0])
        best[groups[k]] = min(best.get(groups[k], brute.LAST), key)
    want = sorted([None if v == brute.LAST else v for v in best.values()] + [f[0] for f in found if not f[1]], key=repr)
    assert [r[0] for r in rows_of(kept, "doc_id")] == want


def test_near_copies_under_one_key(spark):
    words = [f"w{k}" for k in range(80)]
    near = " ".join(["other", *words[1:]])
    docs = spark.createDataFrame([(None, " ".join(words)), (None, near), (7, "v " + " ".join(words[::-1])), (7, " ".join(words[::-1]))], "doc_id long, text string")
    assert rows_of(pipeline.join_near_copies(spark, docs, ""), "doc_id") == [(7,), (None,)]


def test_repeats_are_cut(spark, docs, edge_rows, sf_dir):
    kept = pipeline.cut_repeats(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    want = []
    for (i, t), (_, _, n, _, rest) in zip(edge_rows, brute.repeated_bytes(edge_rows, pipeline.REPEAT_BYTES)):
        text = None if t is None else rest.decode("utf-8", "ignore")
        if not n or text:
            want.append((i, text, len(text or "")))
    assert rows_of(kept, "doc_id", "text", "n_chars") == sorted(want, key=repr)


def test_a_repeated_passage_of_51_short_words_is_cut(spark):
    passage = " ".join("abcdefghijklmnopqrstuvwxyz"[k * 7 % 26] for k in range(51))
    assert len(passage.encode()) == 101
    docs = spark.createDataFrame([(1, f"First {passage}. End"), (2, f"Second {passage}! Stop")], "doc_id long, text string")
    kept = dict(rows_of(pipeline.cut_repeats(spark, docs, ""), "doc_id", "text"))
    assert kept[1] == f"First {passage}. End" and passage not in kept[2] and len(kept[2]) < 20


def test_benchmark_passages(spark, docs, sf_dir):
    kept = pipeline.decontaminate_benchmark(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    assert {r.doc_id for r in docs.exceptAll(kept).collect()} == {7, 12, 13, 25}


def test_ids(spark, docs, edge_rows, sf_dir):
    import hashlib

    lib = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    want = []
    for i, t in edge_rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest()))
    assert rows_of(pipeline.encode(spark, docs, sf_dir), "doc_id", "n_tokens", "ids_sha256") == sorted(want, key=repr)


def test_whole_run(spark):
    sf = "/root/testdata/sf0.001"
    found = pipeline.run(spark, sf)
    rows = {r.doc_id for r in found.collect()}
    assert 0 < len(rows) < spark.read.parquet(f"{sf}/documents.parquet").count()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), name)
    assert {r.doc_id for r in docs.collect()} == rows
