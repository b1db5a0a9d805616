"""Text cleaning, tokens and word counts, as column expressions and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English function words left out of phrases.
PHRASE_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself "
    "it its itself they them their theirs themselves what which who whom this that these those am is are was were be "
    "been being have has had having do does did doing would should could ought i'm you're he's she's it's we're "
    "they're i've you've we've they've i'd you'd he'd she'd we'd they'd i'll you'll he'll she'll we'll they'll isn't "
    "aren't wasn't weren't hasn't haven't hadn't doesn't don't didn't won't wouldn't shan't shouldn't can't cannot "
    "couldn't mustn't let's that's who's what's here's there's when's where's why's how's a an the and but if or "
    "because as until while of at by for with about against between into through during before after above below to "
    "from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very"
).split()


def words(text: Column) -> Column:
    """Lower-case words of letters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def squish(text: Column) -> Column:
    """Single spaces inside, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{P}", "")


def strip_prefix(text: Column, word: str) -> Column:
    """Remove a leading word and the space after it."""
    return F.regexp_replace(text, rf"^{word}\s+", "")


def strip_corner_words(text: Column) -> Column:
    return F.regexp_replace(text, r"\bcorners?\b", "")


def joined_text(*parts: Column, sep: str = " ") -> Column:
    """Lower-case concatenation in which a missing part reads "NA"."""
    return F.lower(F.concat_ws(sep, *[F.coalesce(p, F.lit("NA")) for p in parts]))


def phrase(text: Column, stop_words: Sequence[str] = PHRASE_STOP_WORDS) -> Column:
    """A text as one category: stop words and punctuation removed, words joined by underscores."""
    longest_first = sorted(stop_words, key=lambda w: (-len(w), w))
    kept = F.regexp_replace(F.lower(text), rf"\b({'|'.join(longest_first)})\b", "")
    return F.replace(squish(strip_punctuation(kept)), F.lit(" "), F.lit("_"))


def word_count(text: Column) -> Column:
    """Number of pieces between runs of white space."""
    return F.size(F.split(text, r"\s+"))


def word_frequency(df: DataFrame, column: str, word: str = "word", out: str = "n") -> DataFrame:
    """How often each word occurs; combined before the shuffle, so frequent words do not pile up."""
    return df.select(F.explode(words(F.col(column))).alias(word)).groupBy(word).agg(F.count("*").alias(out))


def stop_words_found(df: DataFrame, columns: Sequence[str], stop_words: Sequence[str] = PHRASE_STOP_WORDS) -> DataFrame:
    """Stop words that occur in any of the text columns."""
    texts = df.select(F.explode(F.array(*columns)).alias("text")).where(F.col("text").isNotNull())
    found = texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    # the list is a literal of fixed length, so the filter runs before the distinct and its shuffle
    return found.where(F.col("word").isin(list(stop_words))).distinct()


def mean_words(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean number of words of each text column, missing texts left out."""
    return df.agg(*[F.avg(F.when(F.col(c).isNotNull(), word_count(F.col(c)))).alias(c) for c in columns])


def document_frequency(df: DataFrame, column: str) -> DataFrame:
    """Documents that contain each word, and the smoothed inverse document frequency.

    Words are made distinct inside a document before the shuffle, so a count is enough after it.
    """
    seen = df.select(F.explode(F.array_distinct(words(F.col(column)))).alias("word"))
    counted = seen.groupBy("word").agg(F.count("*").alias("df"))
    documents = df.agg(F.count("*")).scalar()
    return counted.select("word", "df", (F.log((documents + 1) / (F.col("df") + 1)) + 1).alias("idf"))
