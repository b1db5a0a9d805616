"""Feature pipelines: TF-IDF over word n-grams, categories, scaled numbers, assembled into one vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.functions.encoders import INFREQUENT

WORD = r"(?U)\b\w\w+\b"  # fixed value: words of two or more characters


class SmoothIdf(Estimator, HasInputCol, HasOutputCol):
    """Weights ln((N + 1) / (df + 1)) + 1, fitted on counts and applied to sparse vectors in place."""

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        fitted = IDF(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(df)
        return ElementwiseProduct(
            scalingVec=Vectors.dense(fitted.idf.toArray() + 1.0),
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
        )


def _ngram_statement(out: str, longest: int) -> str:
    parts = ", ".join(f"`{out}_w{n}`" for n in range(1, longest + 1))
    return f"SELECT *, concat({parts}) AS `{out}_terms` FROM __THIS__"


def ngram_statements(out: str, longest: str) -> list[str]:
    """The statements of all n-gram lengths up to the one of a given statement, to search over."""
    n = longest.count(f"`{out}_w")
    return [_ngram_statement(out, k) for k in range(1, n + 1)]


def tfidf_stages(
    column: str, out: str, max_features: int = 500, max_ngram: int = 1, stop_words: bool = True
) -> list:
    """Stages from a text column to unit-length TF-IDF vectors of word n-grams 1 to ``max_ngram``."""
    stages = [RegexTokenizer(inputCol=column, outputCol=f"{out}_w1", pattern=WORD, gaps=False, toLowercase=True)]
    if stop_words:
        stages[0].setOutputCol(f"{out}_all")
        stages.append(StopWordsRemover(inputCol=f"{out}_all", outputCol=f"{out}_w1"))
    terms = f"{out}_w1"
    if max_ngram > 1:
        sizes = range(2, max_ngram + 1)
        stages += [NGram(n=n, inputCol=f"{out}_w1", outputCol=f"{out}_w{n}") for n in sizes]
        stages.append(SQLTransformer(statement=_ngram_statement(out, max_ngram)))
        terms = f"{out}_terms"
    return stages + [
        CountVectorizer(inputCol=terms, outputCol=f"{out}_tf", vocabSize=max_features),
        SmoothIdf(inputCol=f"{out}_tf", outputCol=f"{out}_idf"),
        Normalizer(inputCol=f"{out}_idf", outputCol=out, p=2.0),
    ]


def category_stages(columns: Sequence[str], one_hot: bool = True) -> tuple[list, list[str]]:
    """Index categories alphabetically, unseen ones last; one-hot unless trees take the index as it is."""
    if not columns:
        return [], []
    coded = [f"{c}_code" for c in columns]
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep")
    ]
    if not one_hot:
        return stages, coded
    hot = [f"{c}_hot" for c in columns]
    return stages + [OneHotEncoder(inputCols=coded, outputCols=hot, dropLast=False)], hot


def number_stages(columns: Sequence[str], out: str = "numbers", scaled: bool = True) -> tuple[list, list[str]]:
    """Numbers as one vector, brought to mean 0 and deviation 1 when ``scaled``."""
    if not columns:
        return [], []
    raw = VectorAssembler(inputCols=list(columns), outputCol=f"{out}_raw" if scaled else out)
    if not scaled:
        return [raw], [out]
    return [raw, StandardScaler(inputCol=f"{out}_raw", outputCol=out, withMean=True, withStd=True)], [out]


def feature_stages(
    numbers: Sequence[str] = (),
    categories: Sequence[str] = (),
    text: str | None = None,
    one_hot: bool = True,
    scaled: bool = True,
    **tfidf,
) -> list:
    """Stages that end in a ``features`` vector; columns not named here are left out."""
    stages, parts = [], []
    if text is not None:
        stages += tfidf_stages(text, "tfidf", **tfidf)
        parts.append("tfidf")
    more, names = category_stages(categories, one_hot)
    stages, parts = stages + more, parts + names
    more, names = number_stages(numbers, scaled=scaled)
    stages, parts = stages + more, parts + names
    return stages + [VectorAssembler(inputCols=parts, outputCol="features")]


def category_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Level of each code, per indexed column."""
    labels = {}
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            labels |= dict(zip(stage.getInputCols(), map(list, stage.labelsArray)))
    return labels


def feature_names(model: PipelineModel, scored: DataFrame) -> list[str]:
    """Name of each position of the ``features`` vector, from the column metadata and the vocabulary."""
    vocabulary = [s.vocabulary for s in model.stages if isinstance(s, CountVectorizerModel)]
    meta = scored.schema["features"].metadata["ml_attr"]
    names = [""] * meta["num_attrs"]
    for group in meta.get("attrs", {}).values():
        for attribute in group:
            names[attribute["idx"]] = attribute.get("name", "")
    for i, name in enumerate(names):
        if name.startswith("tfidf_") and vocabulary:
            names[i] = f"tfidf_{vocabulary[0][int(name.rsplit('_', 1)[1])]}"
        elif name.startswith("numbers_"):
            # scaling forgets the names and leaves positions
            rest = name.removeprefix("numbers_")
            raw = next(s for s in model.stages if isinstance(s, VectorAssembler) and "numbers" in s.getOutputCol())
            names[i] = raw.getInputCols()[int(rest)] if rest.isdigit() else rest
    return [n or f"feature_{i}" for i, n in enumerate(names)]


def bucket_rare(df: DataFrame, columns: Sequence[str], frequent: dict[str, DataFrame]) -> DataFrame:
    """Replace rare and unseen levels by one bucket, using the levels fitted on the training rows."""
    for c in columns:
        levels = frequent[c].withColumnRenamed("__level", "__l")
        # at most 1 / min_frequency levels
        df = df.join(F.broadcast(levels), F.col(c) == F.col("__l"), "left")
        df = df.withColumn(c, F.coalesce("__l", F.lit(INFREQUENT))).drop("__l")
    return df
