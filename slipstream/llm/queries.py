"""Registered queries of the operators in this package, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Arrow batches small enough that a batch of very long texts stays far below a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # what an execution has shuffled goes when it ends: stages that write and read back never hold two exchanges of texts
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def _query(name: str, sql: str | None = None):
    def wrap(function):
        QUERIES[name] = lambda spark, sf_dir: function(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op5_token_counts")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.token_count import count_tokens

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, _tokenizer("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@_query("op10_bpe_round_trip")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.bpe import round_trip

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, _tokenizer("word_bpe_49k.json")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def held_out(column="doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@_query("op1_quality")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm import quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").cast("double").alias("label"))
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@_query("op6_language")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm import language

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~held_out()))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query("op3_fingerprints")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm import fingerprint

    found = fingerprint.compare_neighbours(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    written = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return found.withColumns(written)


@_query("op9_main_text")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.html_text import main_text

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", "n_chars")


@_query("op4_substring_dedup")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.substring import remove_repeats

    found = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@_query("op7_suffix_dedup")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.suffix import remove_repeats

    found = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op8_decontamination")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.decontaminate import leaks

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


@_query("op2_jaccard_join")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fractions import Fraction

    from slipstream.llm.jaccard import link

    return link(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, threshold=Fraction(9, 10)).drop("component")


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@_query(
    "op12_line_dedup",
    f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    k AS (SELECT doc_id, lines, list_transform(lines, lambda x: translate(trim(x, {_SPACE}), '{_UPPER}', '{_LOWER}')) AS keys FROM d),
    c AS (SELECT key FROM (SELECT doc_id, unnest(list_distinct(keys)) AS key FROM k) AS u WHERE key <> '' GROUP BY key HAVING count(*) >= 10),
    e AS (SELECT doc_id, unnest(lines) AS line, unnest(keys) AS key, generate_subscripts(lines, 1) AS i FROM k)
    SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
      sha256(coalesce(string_agg(e.line, chr(10) ORDER BY e.i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
    FROM e LEFT JOIN c ON e.key = c.key GROUP BY doc_id""",
)
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.line_dedup import LineIndex, drop_common

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = drop_common(docs, LineIndex(spark, least=10).insert(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@_query("op11_vector_codes", vector_codes.twin())
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@_query("op13_conversation_repair")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slipstream.llm.conversation import damaged, repair

    return repair(damaged(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
