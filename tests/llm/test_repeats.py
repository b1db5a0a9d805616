"""Word windows and byte strings that repeat, near copies."""

import random
from fractions import Fraction

import pytest

from slipstream.llm import jaccard, packed, substring, suffix
from slipstream.llm.components import components
from slipstream.llm.queries import prepare
from tests.llm import brute
from tests.llm.conftest import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()]


def test_covers():
    for v, members in substring.COVERS.items():
        assert {(a - b) % v for a in members for b in members} == set(range(v))
    assert substring.period(13) == 7 and substring.period(100) == 57


@pytest.mark.parametrize("window", [1, 5, 13])
def test_word_windows(edge_docs, edge_rows, window):
    found = substring.remove_repeats(edge_docs, window)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(brute.repeated_words(edge_rows, window), key=repr)
    assert {"lang", "id", "row", "score"} <= set(found.columns) and found.where("id = 7 AND row = 'r'").count() == len(edge_rows)


def test_word_windows_of_documents(small):
    docs, rows = small
    found = substring.remove_repeats(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(brute.repeated_words(rows), key=repr)


@pytest.mark.parametrize("length", [30, 100])
def test_byte_strings(edge_docs, edge_rows, length):
    found = suffix.remove_repeats(edge_docs, length)
    want = sorted(brute.repeated_bytes(edge_rows, length), key=repr)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == want


def test_byte_strings_of_documents(small):
    docs, rows = small
    found = suffix.remove_repeats(docs)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(brute.repeated_bytes(rows), key=repr)


def test_large_buckets_are_sorted_in_parts(small, monkeypatch):
    docs, rows = small
    monkeypatch.setattr(suffix, "SORTED", 3000)
    monkeypatch.setattr(suffix, "KEPT", 10_000)
    found = suffix.remove_repeats(docs.where("doc_id < 60"))
    assert rows_of(found, "doc_id", "n_removed") == sorted(((r[0], r[2]) for r in brute.repeated_bytes([r for r in rows if r[0] < 60])), key=repr)


@pytest.mark.parametrize("words, threshold", [(3, Fraction(9, 10)), (1, Fraction(1, 2))])
def test_links(edge_docs, edge_rows, words, threshold):
    found = jaccard.link(edge_docs, words, threshold)
    want, groups = brute.linked(edge_rows, words, threshold)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    with_shingles = {g for g, w in zip(groups, want) if w[1]}
    assert found.where("component IS NOT NULL").select("component").distinct().count() == len(with_shingles)


def test_links_under_null_and_equal_keys(spark):
    def text(name, *changed):
        return " ".join(f"{name}{k}x" if k in changed else f"{name}{k}" for k in range(120))

    rows = [(None, text("a", 20, 40)), (None, text("a")), (5, text("a", 80, 100))]  # the first and third are linked by the second
    rows += [(9, text("b")), (9, text("b", 50)), (None, text("c")), (None, text("c", 50)), (None, text("c", 50))]
    found = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, Fraction(9, 10))
    want, groups = brute.linked(rows, 3, Fraction(9, 10))
    assert [w[2] for w in want] == [5, 5, 5, 9, 9, None, None, None] and len(set(groups)) == 3
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert found.select("component").distinct().count() == 3


def test_links_of_documents(small, monkeypatch):
    docs, rows = small
    monkeypatch.setattr(jaccard, "MEMBERS", 3)  # nodes of several blocks
    found = jaccard.link(docs, 5, Fraction(4, 5))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(brute.linked(rows, 5, Fraction(4, 5))[0], key=repr)


def test_no_documents(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    assert suffix.remove_repeats(no_docs).count() == 0
    assert jaccard.link(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (70, 100), (9, 9), (200, 201), (200, 201)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 1 for i in range(1, 41)} | {50: 50, 70: 50, 100: 50, 200: 200, 201: 200}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmaps_never_lose_a_pair():
    """Every pair at the threshold passes the traversal of trees of any shape."""
    import random

    import numpy as np

    rng, t = random.Random(1), Fraction(4, 5)
    base = [rng.getrandbits(64) for _ in range(60)]
    sets = []
    for _ in range(120):
        own = set(base[: rng.randint(5, 60)]) - set(rng.sample(base, rng.randint(0, 6)))
        sets.append(np.array(sorted(own | {rng.getrandbits(64) for _ in range(rng.randint(0, 5))}), np.uint64))
    maps = jaccard._folded([jaccard.bitmap(s) for s in sets])
    tree = jaccard.Tree(np.array([len(s) for s in sets]), maps, np.arange(len(sets)))
    found = {frozenset(p) for left, right in jaccard.traverse(tree, tree, t) for p in zip(left.tolist(), right.tolist())}
    windows = jaccard.Windows(t)
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if shared * 5 >= (len(sets[i]) + len(sets[j]) - shared) * 4 and len(np.setxor1d(sets[i], sets[j])):
                assert frozenset((i, j)) in found
                assert np.isin(jaccard.keys(sets[i], windows), jaccard.keys(sets[j], windows)).any()


def test_rows_without_a_key_keep_to_themselves(spark, monkeypatch):
    """Texts under a null key whose names would be one number, one of them with a repeated string: the other loses nothing."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    passage = " ".join(word() for _ in range(30))
    rows = [(1, passage)]
    for k in range(60):
        own = " ".join(word() for _ in range(40))
        rows.append((None if k % 3 else 7, own + " " + passage + word() if k % 4 == 1 else own))
    rows += [(None, rows[5][1]), (None, passage + " " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix.remove_repeats(docs)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(brute.repeated_bytes(rows), key=repr)
    found = substring.remove_repeats(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(brute.repeated_words(rows), key=repr)
    # many rows without a key are dealt out over many blocks
    many = spark.range(500).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('text ', id) AS text").withColumn("id", packed.named_column("doc_id", "text"))
    assert many.select(packed.block_column("id", 65)).distinct().count() > 50
    with pytest.raises(Exception, match="2\\^62"):
        suffix.remove_repeats(spark.createDataFrame([(2**62, "x")], "doc_id long, text string")).collect()


def test_sets_of_one_name_are_named_anew(spark, small, monkeypatch):
    """A hash under which all sets of one size share a name: the second hash shows it."""
    import numpy as np

    real = jaccard._name
    monkeypatch.setattr(jaccard, "_name", lambda own, salt: real(own, salt) if salt > 1 else np.array([len(own) // 50], np.uint64))
    docs, rows = small
    found = jaccard.link(docs, 5, Fraction(4, 5))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(brute.linked(rows, 5, Fraction(4, 5))[0], key=repr)


def test_one_common_shingle_brings_nobody_together():
    """Of small sets that share one shingle few share a node; pairs at the threshold always do."""
    import numpy as np

    rng = np.random.default_rng(4)
    for t, sizes in ((Fraction(4, 5), (8, 10, 12)), (Fraction(9, 10), (10, 14, 20, 30))):
        for size in sizes:
            windows = jaccard.Windows(t)
            assert all(pairs for *_, pairs in windows.of(size))
            common = rng.integers(0, 2**63, 1, dtype=np.uint64)
            counts: dict[int, int] = {}
            for _ in range(2000):
                own = np.sort(np.concatenate([common, rng.integers(0, 2**63, size - 1, dtype=np.uint64)]))
                for k in np.unique(jaccard.keys(own, windows)).tolist():
                    counts[k] = counts.get(k, 0) + 1
            assert max(counts.values()) <= 25
    for _ in range(3000):
        t = Fraction(int(rng.integers(6, 10)), 10)
        windows = jaccard.Windows(t)
        a = rng.integers(0, 2**63, int(rng.integers(2, 30)), dtype=np.uint64)
        b = np.concatenate([a[int(rng.integers(0, 3)) :], rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if len(b) and shared * t.denominator >= (len(a) + len(b) - shared) * t.numerator and len(np.setxor1d(a, b)):
            assert np.isin(jaccard.keys(a, windows), jaccard.keys(b, windows)).any()
