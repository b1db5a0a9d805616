"""Token counts per document by a two-tier lookup of pre-token lengths, without any shuffle of pre-tokens.

A byte-level BPE model encodes each pre-token by itself, so the count of a text is the sum of the counts of its
pre-tokens. The first tier is a broadcast table of frequent pre-tokens with their lengths, the second a cache in each
Python worker that is filled by the tokenizer itself. Both only save work: the counts are the same with either empty.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import unicode_classes as uc

FREQUENT = 50_000  # entries of the broadcast table
SAMPLE_ROWS = 2_000  # documents whose pre-tokens fill it
CACHED = 400_000  # entries of a worker's cache, the table included


def pack(lengths: dict[str, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A table of lengths as one blob with the ends of its keys."""
    keys = [k.encode() for k in lengths]
    ends = np.cumsum([len(k) for k in keys], dtype=np.int64)
    return b"".join(keys), ends, np.fromiter(lengths.values(), np.uint32, len(keys))


def unpack(packed: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    blob, ends, counts = packed
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return {blob[a:b].decode(): int(n) for a, b, n in zip(starts, ends, counts)}


class _Lengths(dict):
    """Pre-token -> number of tokens; misses are encoded once and kept until the cache is full."""

    def __init__(self, model, frequent: dict[str, int], limit: int):
        super().__init__(frequent)
        self._model, self._frequent, self._limit, self._signs = model, frequent, limit, uc.byte_alphabet()

    def __missing__(self, word: str) -> int:
        if len(self) >= self._limit:
            self.clear()
            self.update(self._frequent)
        signs = self._signs
        found = self[word] = len(self._model.tokenize("".join([signs[b] for b in word.encode()])))
        return found


class _ByteLevelCounter:
    """Counts for a byte-level file of the tokenizers library."""

    def __init__(self, content: str, packed, limit: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in json.loads(content)["added_tokens"]]
        self.lengths = _Lengths(self.library.model, unpack(packed), limit)
        self.words = uc.spaced_words

    def count(self, text: str) -> int:
        if any(s in text for s in self.special) or not uc.all_known(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.lengths.__getitem__, self.words(text)))


class _WholeTextCounter:
    """Counts by the library alone, for files that are not byte-level BPE with its usual pattern."""

    def __init__(self, content, piece: bool):
        if piece:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.count = lambda text: len(model.encode(text))
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(content)
            model.no_truncation()
            model.no_padding()
            self.count = lambda text: len(model.encode(text, add_special_tokens=False).ids)


def _is_byte_level(content: str) -> bool:
    spec = json.loads(content)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not model.get("dropout")
    )


_WORKER: dict = {}  # the counter that a worker process keeps from task to task


def _counter(key: str, shared, plain: bool, piece: bool, cached: int):
    if key not in _WORKER:
        _WORKER.clear()
        content, packed = shared.value
        _WORKER[key] = _ByteLevelCounter(content, packed, cached) if plain else _WholeTextCounter(content, piece)
    return _WORKER[key]


def frequent_lengths(docs: DataFrame, content: str, text: str, rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> dict[str, int]:
    """Lengths of the pre-tokens met most often in about ``rows`` documents; a warm start, not a statistic of the corpus."""
    total = docs.count()
    if not total:
        return {}
    sample = docs.select(F.col(text).alias("t")).sample(min(1.0, rows / total), seed=7)

    def tally(batches):
        words, counts = uc.spaced_words, Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(words(value.as_py() or ""))
            if len(counts) > 4 * entries:
                counts = Counter(dict(counts.most_common(entries)))
        best = counts.most_common(entries)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["w", "n"])

    found = (
        sample.mapInArrow(tally, "w string, n bigint")
        .groupBy("w")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "w")
        .limit(entries)
        .select("w")
        .collect()  # bounded by entries
    )
    counter = _ByteLevelCounter(content, pack({}), limit=2 * entries)
    return {row.w: counter.lengths[row.w] for row in found}


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 512, sample_rows: int = SAMPLE_ROWS, cached: int = CACHED
) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to every document.

    ``tokenizer`` is the path of a ``.json`` file of the tokenizers library or a ``.model`` file of sentencepiece.
    Counts are without begin, end or added special tokens; special strings inside a text count as that library treats
    them by default. A null or empty text has no bytes and no tokens. Columns of the same names are replaced, all others
    are kept, rows are neither merged nor dropped.
    """
    context = docs.sparkSession.sparkContext
    piece = tokenizer.endswith(".model")
    content = Path(tokenizer).read_bytes() if piece else Path(tokenizer).read_text()
    plain = not piece and _is_byte_level(content)
    packed = pack(frequent_lengths(docs, content, text, sample_rows)) if plain else None
    shared = context.broadcast((content, packed))  # one vocabulary file and at most FREQUENT entries
    key = uuid.uuid4().hex

    @F.arrow_udf("bigint")
    def n_tokens(column: pa.Array) -> pa.Array:
        count = _counter(key, shared, plain, piece, cached).count
        return pa.array([count(value) if value else 0 for value in column.to_pylist()], pa.int64())

    value = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("n_bytes", F.octet_length(value).cast("bigint"))
        .withColumn("n_tokens", n_tokens(value))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
