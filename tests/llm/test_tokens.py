"""Token counts, BPE ids and decodings against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest

from slipstream.llm import bpe, token_count
from tests.llm.conftest import rows_of

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def texts(edge_rows):
    rng = random.Random(2)
    strange = ["x<|startoftext|>y  ᲊ z", "a\x1cb c\u0085d", "'s'S 're  \n\n x", "é" * 300, "²½ 𝔘nicode İstanbul ΑΣ. Σ", "é Å", "İ'LL"]
    runs = ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (3, 40, 400)]
    return [t or "" for _, t in edge_rows] + strange + runs


@pytest.mark.parametrize("name", FILES)
def test_ids_and_decoding(name, texts):
    content = open(public_tokenizers.path(name)).read()
    own, lib = bpe.Tokenizer(content, bpe._ahead(content)), library(name)
    ids = own.encode(texts)
    for text, got in zip(texts, ids):
        want = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want
        assert own.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_window_and_cache_do_not_matter(texts):
    content = open(public_tokenizers.path(FILES[0])).read()
    ahead = bpe._ahead(content)
    own = bpe.Tokenizer(content, ahead)
    words = [b"etaoinshr" * (ahead // 9 + 40), b"a" * (ahead + 100)]  # a few windows beyond the lookahead
    narrow = bpe.Encoder(own.vocabulary, ahead, window=64)
    assert narrow.encode(words) == own.encoder.encode(words)
    small = bpe.Tokenizer(content, ahead, cached=50)
    assert [small.encode([t])[0] for t in texts] == own.encode(texts)


def test_lookahead_of_a_small_list():
    """Tokens that end the lookahead before the end of a text do not change when the text goes on."""
    merges = [("b", "c"), ("a", "b"), ("ab", "ab"), ("c", "a"), ("bc", "a")]
    ahead = bpe.lookahead(merges)

    def encode(text):
        parts = list(text)
        while True:
            ranks = [merges.index(p) if p in merges else 99 for p in zip(parts, parts[1:])]
            if not ranks or min(ranks) == 99:
                return parts
            k = ranks.index(min(ranks))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def stable(text):
        out, end = [], 0
        for token in encode(text):
            end += len(token)
            if end <= len(text) - ahead:
                out.append(token)
        return out

    rng = random.Random(0)
    for _ in range(2000):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        head = stable(text)
        assert encode(text + "".join(rng.choice("abc") for _ in range(8)))[: len(head)] == head


def test_round_trip(edge_docs, edge_rows, no_docs):
    found = bpe.round_trip(edge_docs, public_tokenizers.path(FILES[1]))
    lib = library(FILES[1])
    want = []
    for i, t in edge_rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    assert rows_of(found, "doc_id", "ids", "decoded") == sorted(want, key=repr)
    assert bpe.round_trip(no_docs, public_tokenizers.path(FILES[1])).count() == 0


@pytest.mark.parametrize("name", [*FILES, "piece_bpe_32k.model"])
def test_counts(edge_docs, edge_rows, name, no_docs):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(lib.encode(t))
    else:
        own = library(name)
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    found = token_count.count_tokens(edge_docs, path, limit=100, sample_rows=5, cached=200)
    want = [(i, len((t or "").encode()), n := count(t or ""), n > 100) for i, t in edge_rows]
    assert rows_of(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_count.count_tokens(no_docs, path).count() == 0


def test_tables_are_packed():
    lengths = {" the": 1, "é\n": 2, "": 0}
    assert token_count.unpack(token_count.pack(lengths)) == lengths
    assert token_count.unpack(token_count.pack({})) == {}


def test_words_of_very_different_lengths_in_one_text():
    """Blocks are cut by rows and width: a very long word does not widen those beside it."""
    import tracemalloc

    import public_tokenizers

    content = open(public_tokenizers.path("word_bpe_49k.json")).read()
    own = bpe.Tokenizer(content, 4619)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(110)) for _ in range(1500)] + ["".join(rng.choice("abcdefghij") for _ in range(8800))]
    tracemalloc.start()
    found = own.encoder.encode([w.encode() for w in words])
    assert tracemalloc.get_traced_memory()[1] < 250 << 20
    tracemalloc.stop()
    assert found[-1] == own.encoder.encode([words[-1].encode()])[0] and all(found)
