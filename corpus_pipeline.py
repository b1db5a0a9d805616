"""A pipeline from raw documents to token ids: five stages, each one operator over all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the documents
of the next one. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm import arrow, bpe, decontaminate, jaccard, language, suffix
from slipstream.llm.queries import held_out, prepare
from slipstream.session import staged

LANGUAGE_CLAIM = (0.4, 12.0)  # a text of n characters is rejected if `language.claim` is under the first less the second / n
TOKENIZER = "word_bpe_49k.json"
REPEAT_BYTES = 100  # strings of this many bytes that also start earlier are cut, as in op7; 51 words of one byte are 101 bytes


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: null texts, texts without letters, and texts that no learned language claims.

    The fewer characters a text has, the less its claim tells, so the least claim falls with their number, by one rule for
    texts of every length. With nothing to learn from, only null texts and texts without letters go.
    """
    prepare(spark)
    model = language.train(docs.where(~held_out()))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.claim(docs, model, "_claim").where("_claim IS NOT NULL")
    least, slack = LANGUAGE_CLAIM
    found = found.where(F.col("_claim") >= F.lit(least) - F.lit(slack) / F.char_length("text"))
    return found.select(*docs.columns)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the one with the smallest id (null ids last, then by its text's hash).

    Near copies share at least 0.8 of their five-word shingles, over any number of links. Texts without words all stay.
    """
    prepare(spark)
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    found = jaccard.link(hashed.select("doc_id", "text", "_hash"), words=5, threshold=Fraction(4, 5))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_hash")).alias("f")
    chosen = found.where("component IS NOT NULL").groupBy("component").agg(first).select("f.doc_id", "f._hash")
    same = hashed["doc_id"].eqNullSafe(chosen["doc_id"]) & hashed["_hash"].eqNullSafe(chosen["_hash"])
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = hashed.where(words).join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_hash"])
    return kept.unionByName(hashed.where(~words)).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of `REPEAT_BYTES` bytes that also start earlier out of the texts; a text of which nothing is left goes.

    A character that is cut through goes as a whole. ``n_chars`` is counted anew where a text changes.
    """
    prepare(spark)
    found = suffix.remove_repeats(docs.withColumn("_null", F.col("text").isNull()), REPEAT_BYTES)
    cut = F.col("n_removed") > 0
    whole = arrow.extended(found, {"text": T.StringType()}, lambda: _characters, "kept", "_null")
    out = whole.where(~cut | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _characters(column: pa.Array, null: pa.Array) -> list[pa.Array]:
    texts = [None if n else b.decode("utf-8", "ignore") for b, n in zip(column.to_pylist(), null.to_pylist())]
    return [pa.array(texts, pa.string())]


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which an item of ``benchmark`` occurs with at most one edit in ten bytes."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (binary, little-endian unsigned 32-bit), and digests of them and of their decoding."""
    import public_tokenizers

    prepare(spark)
    found = bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", decontaminate_benchmark),
    ("bpe", encode),
]

ORACLE_SQL = None  # kernels, edit distances and merges are beyond SQL; tests/llm compares every stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
