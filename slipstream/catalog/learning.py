"""Evaluation, model and source queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.catalog import field
from slipstream.catalog.field import table
from slipstream.catalog.registry import Registry
from slipstream.models import boosting, classifiers, evaluation, features, penalty_path
from slipstream.operators import sampling
from slipstream.plans import modelling
from slipstream.session import fresh_folder, staged
from slipstream.sources import ingest, readers, sinks

registry = Registry()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

# --- evaluation ----------------------------------------------------------------------------------------

_SCORED = """s AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
  CAST(o_totalprice AS DOUBLE) / 600000 AS p FROM orders)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderstatus = 'F' AS INT) AS y", "CAST(o_totalprice AS DOUBLE) / 600000 AS p"
    )


_CUTS = evaluation.evenly_spaced(0.3, 0.7, 101)
_F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END"


@registry.add(
    "threshold_sweep",
    "d:threshold i:tp fp fn d:f1",
    f"""WITH {_SCORED}, t AS (SELECT unnest([{", ".join(f"{c!r}::DOUBLE" for c in _CUTS)}]) AS threshold),
    c AS (SELECT threshold, sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS tp,
      sum(CASE WHEN p >= threshold AND y = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p < threshold AND y = 1 THEN 1 ELSE 0 END) AS fn
      FROM s, t GROUP BY 1) SELECT *, {_F1} AS f1 FROM c""",
)
def threshold_sweep(spark, sf_dir):
    return evaluation.threshold_sweep(_scored(spark, sf_dir), "y", "p", _CUTS)


@registry.add(
    "best_threshold",
    "d:threshold f1",
    f"""WITH {_SCORED}, t AS (SELECT unnest([{", ".join(f"{c!r}::DOUBLE" for c in evaluation.thresholds(0.35, 0.65, 0.025))}]) AS threshold),
    c AS (SELECT threshold, sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS tp,
      sum(CASE WHEN p >= threshold AND y = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p < threshold AND y = 1 THEN 1 ELSE 0 END) AS fn
      FROM s, t GROUP BY 1) SELECT threshold, {_F1} AS f1 FROM c ORDER BY f1 DESC, threshold LIMIT 1""",
)
def best_threshold(spark, sf_dir):
    cuts = evaluation.thresholds(0.35, 0.65, 0.025)
    return evaluation.best_threshold(evaluation.threshold_sweep(_scored(spark, sf_dir), "y", "p", cuts))


@registry.add(
    "confusion",
    "i:y yhat n d:share",
    f"""WITH {_SCORED}, c AS (SELECT y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS yhat, count(*) AS n FROM s GROUP BY 1, 2)
    SELECT *, n / sum(n) OVER () AS share FROM c""",
)
def confusion(spark, sf_dir):
    classed = _scored(spark, sf_dir).selectExpr("y", "CAST(p >= 0.5 AS INT) AS yhat")
    return evaluation.confusion(classed, "y", "yhat")


@registry.add(
    "class_metrics",
    "i:tp fp fn tn d:accuracy f1",
    f"""WITH {_SCORED}, c AS (SELECT count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp,
      count(*) FILTER (p < 0.5 AND y = 1) AS fn, count(*) FILTER (p < 0.5 AND y = 0) AS tn FROM s)
    SELECT *, (tp + tn) / (tp + fp + fn + tn) AS accuracy, {_F1} AS f1 FROM c""",
)
def class_metrics(spark, sf_dir):
    classed = _scored(spark, sf_dir).selectExpr("y", "CAST(p >= 0.5 AS INT) AS yhat")
    return evaluation.class_metrics(classed, "y", "yhat")


@registry.add(
    "auc",
    "d:auc",
    f"""WITH {_SCORED}, r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM s)
    SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))::DOUBLE AS auc FROM r""",
)
def auc(spark, sf_dir):
    return evaluation.roc_auc(_scored(spark, sf_dir), "y", "p")


@registry.add(
    "logloss_brier",
    "d:log_loss brier",
    f"""WITH {_SCORED}, c AS (SELECT y, p, greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE) AS q FROM s)
    SELECT avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS log_loss, avg((p - y) * (p - y)) AS brier FROM c""",
)
def logloss_brier(spark, sf_dir):
    return evaluation.probability_metrics(_scored(spark, sf_dir), "y", "p")


@registry.add(
    "roc_points",
    "d:threshold fpr tpr",
    f"""WITH {_SCORED}, c AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1)
    SELECT p * 600000 AS threshold, sum(neg) OVER w / sum(neg) OVER () AS fpr, sum(pos) OVER w / sum(pos) OVER () AS tpr FROM c
    WINDOW w AS (ORDER BY p DESC)""",
)
def roc_points(spark, sf_dir):
    """The thresholds are given as prices, which have two digits, so that rounding meets no tie."""
    return evaluation.roc_points(_scored(spark, sf_dir), "y", "p").withColumn("threshold", F.col("threshold") * 600000)


@registry.add(
    "calibration",
    "i:bin d:mean_predicted share_positive i:n",
    f"""WITH {_SCORED} SELECT least(floor(p * 10), 9) AS bin, avg(p) AS mean_predicted, avg(y) AS share_positive, count(*) AS n
    FROM s GROUP BY 1""",
)
def calibration(spark, sf_dir):
    return evaluation.calibration(_scored(spark, sf_dir), "y", "p")


@registry.add(
    "rank_configs",
    "s:p_brand d:mean_test_score std_test_score i:rank_test_score",
    """SELECT *, rank() OVER (ORDER BY mean_test_score DESC) AS rank_test_score FROM (
      SELECT p_brand, avg(p_size) AS mean_test_score, stddev_pop(p_size) AS std_test_score FROM part GROUP BY 1)""",
)
def rank_configs(spark, sf_dir):
    return evaluation.rank_configurations(table(spark, sf_dir, "part"), "p_brand", "p_size")


@registry.add(
    "best_config",
    "s:worst best",
    """SELECT arg_min(p_brand, m) AS worst, arg_max(p_brand, m) AS best FROM (
      SELECT p_brand, avg(p_size) + max(p_partkey) / 1e9 AS m FROM part GROUP BY 1)""",
)
def best_config(spark, sf_dir):
    means = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.expr("avg(p_size) + max(p_partkey) / 1e9D AS m"))
    return means.agg(F.min_by("p_brand", "m").alias("worst"), F.max_by("p_brand", "m").alias("best"))


@registry.add(
    "top_k",
    "i:p_partkey d:p_retailprice",
    "SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15",
)
def top_k(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(15)


@registry.add(
    "abs_top_k",
    "i:s_suppkey s:s_name d:s_acctbal",
    "SELECT * FROM supplier ORDER BY abs(s_acctbal) DESC, s_name LIMIT 10",
)
def abs_top_k(spark, sf_dir):
    return evaluation.top_by_magnitude(table(spark, sf_dir, "supplier"), "s_acctbal", "s_name", 10)


# --- models: is a document of good quality? ------------------------------------------------------------

# Budgets of the registered fits: words in a vocabulary, trees, steps and shape of the network, drawn configurations, folds.
MAX_FEATURES, TREES, STEPS, HIDDEN, DRAWS, FOLDS = 500, 20, 100, [32, 16], 4, 3

_NUMBERS = ["n_chars", "n_lines", "n_digits", "mean_word"]
_CATEGORIES = ["lang", "source"]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a few numbers, a stratum and stratified folds."""
    labels = table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "CAST(quality AS DOUBLE) AS label", "concat_ws('_', quality, toxic) AS Stratify"
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    # texts are looked through after the join, so only those with a label
    joined = documents.join(labels, "doc_id").selectExpr(
        "doc_id", "text", "lang", "source", "CAST(n_chars AS DOUBLE) AS n_chars",
        "CAST(size(split(text, '\\\\n')) AS DOUBLE) AS n_lines",
        "CAST(length(regexp_replace(text, '[^0-9]', '')) AS DOUBLE) AS n_digits",
        "CAST(n_chars AS DOUBLE) / size(split(text, '\\\\s+')) AS mean_word",
        "label", "Stratify",
    )
    split = sampling.stratified_split(joined, ["Stratify"], "doc_id", 0.2)
    folded = sampling.stratified_folds(split, ["Stratify", "is_test"], "doc_id", FOLDS)
    return staged(classifiers.with_class_weights(folded), "labelled")


def _train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("is_test = 0"), df.where("is_test = 1")


def _linear(train: DataFrame) -> Pipeline:
    stages = features.feature_stages(_NUMBERS, _CATEGORIES, "text", max_features=MAX_FEATURES, max_ngram=2)
    return Pipeline(stages=[*stages, classifiers.logistic(strength=1.0, rows=train.count(), maxIter=50)])


def _bayes() -> Pipeline:
    return Pipeline(stages=[*features.feature_stages(text="text", max_features=MAX_FEATURES), classifiers.naive_bayes(0.5)])


def _trees(validation: str | None = None, trees: int = TREES, **more) -> Pipeline:
    stages = features.feature_stages(_NUMBERS, _CATEGORIES, one_hot=False, scaled=False)
    return Pipeline(stages=[*stages, classifiers.boosted_trees(trees, validation, maxDepth=3, maxBins=64, seed=42, **more)])


def _fit_and_score(spark: SparkSession, sf_dir: str, pipeline) -> DataFrame:
    train, test = _train_test(_documents(spark, sf_dir))
    return classifiers.scored(classifiers.fitted(pipeline(train), train), test)


_SCORES = "i:doc_id label d:p i:prediction"


@registry.add("lr_fit", _SCORES)
def lr_fit(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, _linear)


@registry.add("nb_fit", _SCORES)
def nb_fit(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, lambda _: _bayes())


@registry.add("gbt_fit", _SCORES)
def gbt_fit(spark, sf_dir):
    """Trees that stop early on a stratified slice of the training rows."""
    train, test = _train_test(_documents(spark, sf_dir))
    sliced = sampling.stratified_split(train, ["Stratify"], "doc_id", 0.15, seed=7, out="held")
    sliced = sliced.withColumn("held", F.col("held") == 1)
    return classifiers.scored(_trees("held").fit(sliced), test)


@registry.add(
    "penalised_trees",
    "i:doc_id label b:is_share",
    """SELECT doc_id, quality AS label, true AS is_share FROM (SELECT *, count(*) OVER (PARTITION BY quality, toxic) AS n,
      row_number() OVER (PARTITION BY quality, toxic ORDER BY md5(doc_id || '-42')) AS r FROM labels JOIN documents USING (doc_id))
    WHERE r <= floor(n * 0.2 + 0.5)""",
)
def penalised_trees(spark, sf_dir):
    """Second-order trees with native categories that stop with patience; the score of every test row is a probability."""
    train, test = _train_test(_documents(spark, sf_dir))
    sliced = sampling.stratified_split(train, ["Stratify"], "doc_id", 0.15, seed=7, out="held").withColumn("held", F.col("held") == 1)
    settings = boosting.Settings(trees=TREES, depth=3, l1=0.1, min_gain=0.01, rows=0.8, columns=0.8, patience=5)
    model = boosting.fit(sliced, settings, _NUMBERS, _CATEGORIES, key="doc_id", weight=classifiers.WEIGHT, held="held")
    return model.score(test).withColumn("is_share", F.expr("p > 0 AND p < 1"))


_STUMP = boosting.Settings(trees=1, depth=1, step=1.0, l1=5.0, l2=2.0, min_curvature=10.0)
_STUMP_NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@registry.add(
    "best_stump",
    "s:column d:cut gain left_value right_value",
    f"""WITH r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity, l_discount, l_tax FROM lineitem),
    g AS (SELECT *, avg(y) OVER () - y AS g, avg(y) OVER () * (1 - avg(y) OVER ()) AS h FROM r),
    c AS (SELECT name AS "column", v, sum(g) AS g, sum(h) AS h FROM (UNPIVOT g ON {", ".join(_STUMP_NUMBERS)} INTO NAME name VALUE v) GROUP BY 1, 2),
    s AS (SELECT "column", v AS cut, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p - sum(g) OVER w AS gr, sum(h) OVER p - sum(h) OVER w AS hr
      FROM c WINDOW p AS (PARTITION BY "column"), w AS (PARTITION BY "column" ORDER BY v)),
    t AS (SELECT *, greatest(abs(gl) - 5, 0) AS tl, greatest(abs(gr) - 5, 0) AS tr, greatest(abs(gl + gr) - 5, 0) AS tp FROM s WHERE hl >= 10 AND hr >= 10)
    SELECT "column", cut, tl * tl / (hl + 2) + tr * tr / (hr + 2) - tp * tp / (hl + hr + 2) AS gain,
      -sign(gl) * tl / (hl + 2) AS left_value, -sign(gr) * tr / (hr + 2) AS right_value
    FROM t ORDER BY gain DESC, "column" LIMIT 1""",
)
def best_stump(spark, sf_dir):
    """The first split of second-order trees over the order lines, as one row."""
    lines = table(spark, sf_dir, "lineitem").withColumn("label", F.expr("CAST(l_returnflag = 'R' AS DOUBLE)"))
    model = boosting.fit(lines, _STUMP, _STUMP_NUMBERS, key="l_orderkey")
    tree = model.trees[0]
    if tree.left[0] < 0:
        return spark.createDataFrame([], "column string, cut double, gain double, left_value double, right_value double")
    codes = [k for k in range(1, boosting.BINS) if tree.sets[0][k >> 3] >> (k & 7) & 1]
    name = model.codes.names[tree.column[0]]
    row = (name, model.codes.numbers[name][max(codes) - 1], float(tree.gain[0]), *(float(tree.value[k]) for k in (tree.left[0], tree.right[0])))
    return spark.createDataFrame([row], "column string, cut double, gain double, left_value double, right_value double")


@registry.add("mlp_fit", _SCORES)
def mlp_fit(spark, sf_dir):
    train, test = _train_test(_documents(spark, sf_dir))
    net = classifiers.EncodedNetwork(features.feature_stages(_NUMBERS, _CATEGORIES), hidden=HIDDEN, maxIter=STEPS, seed=42)
    return classifiers.scored(net.fit(train), test)


@registry.add("random_search", "i:config s:params d:mean_test_score std_test_score i:rank_test_score")
def random_search(spark, sf_dir):
    train, _ = _train_test(_documents(spark, sf_dir))
    stages = features.feature_stages(_NUMBERS, _CATEGORIES, "text", max_features=MAX_FEATURES)
    pipeline = Pipeline(stages=[*stages, classifiers.logistic(maxIter=15)])
    last, counts = pipeline.getStages()[-1], next(s for s in pipeline.getStages() if s.hasParam("vocabSize"))
    space = {
        last.regParam: classifiers.log_uniform(1e-4, 1.0),
        last.elasticNetParam: classifiers.choice(0.0, 1.0),
        counts.vocabSize: classifiers.integer(50, MAX_FEATURES),
    }
    return classifiers.random_search(train, pipeline, space, n=DRAWS, folds=FOLDS, scoring="f1")[1]


@registry.add("linear_search", "i:config s:params d:mean_test_score std_test_score i:rank_test_score")
def linear_search(spark, sf_dir):
    """The whole budget of the linear job, 300 settings on 5 folds, over the labelled documents: all in the same passes."""
    train, _ = _train_test(_documents(spark, sf_dir))
    folded = staged(sampling.stratified_folds(train.drop("fold"), ["Stratify"], "doc_id", 5), "folded")
    inputs = penalty_path.Inputs("text", _NUMBERS, _CATEGORIES, {})
    space = modelling.LINEAR_SPACE | {"ngrams": classifiers.integer(1, 3)}
    drawn = [penalty_path.Linear(**c) for c in classifiers.draw_configurations(space, 300)]
    return penalty_path.search(folded, drawn, inputs, weight=classifiers.WEIGHT)[1]


@registry.add("oof_stack", "i:doc_id is_test label d:text_p")
def oof_stack(spark, sf_dir):
    train, test = _train_test(_documents(spark, sf_dir))
    stages = features.feature_stages(text="text", max_features=MAX_FEATURES)
    pipeline = Pipeline(stages=[*stages, classifiers.logistic(rows=train.count(), weighted=False, maxIter=30)])
    inside, outside = classifiers.stacked_text(train, test, pipeline, "text_p", folds=FOLDS)
    return inside.unionByName(outside)


@registry.add("importance", "s:feature elojel d:coefficient")
def importance(spark, sf_dir):
    train, _ = _train_test(_documents(spark, sf_dir))
    return evaluation.top_by_magnitude(classifiers.importance(classifiers.fitted(_linear(train), train), train), "coefficient", "feature", 15)


@registry.add("tree_importance", "s:feature d:coefficient")
def tree_importance(spark, sf_dir):
    train, _ = _train_test(_documents(spark, sf_dir))
    return evaluation.top_by_magnitude(classifiers.importance(_trees().fit(train), train), "coefficient", "feature", 10)


@registry.add("permutation_importance", "s:Feature d:Importance")
def permutation_importance(spark, sf_dir):
    train, test = _train_test(_documents(spark, sf_dir))
    model = _trees().fit(train)
    return classifiers.permutation_importance(model, test, "doc_id", [*_NUMBERS, *_CATEGORIES])


@registry.add("model_size", "s:model i:parameters leaves splits")
def model_size(spark, sf_dir):
    train, _ = _train_test(_documents(spark, sf_dir))
    sizes = [{"model": n, **classifiers.model_size(classifiers.fitted(p, train))} for n, p in (("linear", _linear(train)), ("trees", _trees()))]
    rows = [(s["model"], s["parameters"], s.get("leaves"), s.get("splits")) for s in sizes]
    return spark.createDataFrame(rows, "model string, parameters long, leaves long, splits long")


@registry.add(
    "category_codes",
    "s:column level i:code",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS level, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM documents WHERE {c} IS NOT NULL)"
        for c in _CATEGORIES
    ),
)
def category_codes(spark, sf_dir):
    stages, _ = features.category_stages(_CATEGORIES, one_hot=False)
    model = Pipeline(stages=stages).fit(table(spark, sf_dir, "documents").select(*_CATEGORIES))
    rows = [(c, level, i) for c, levels in features.category_labels(model).items() for i, level in enumerate(levels)]
    return spark.createDataFrame(rows, "column string, level string, code long")


# --- sources and sinks: written and read back -------------------------------------------------------------


@registry.add(
    "partitioned_sink",
    "i:year n d:total",
    "SELECT year(o_orderdate) AS year, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1",
)
def partitioned_sink(spark, sf_dir):
    path = fresh_folder(spark, "orders")
    sinks.write_parquet(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), path, ["year"])
    back = readers.read_parquet(spark, path, ["year", "o_totalprice"], lenient=True)
    return back.groupBy("year").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@registry.add("csv_sink", "i:p_partkey s:p_name d:p_retailprice", "SELECT * FROM part")
def csv_sink(spark, sf_dir):
    path = fresh_folder(spark, "report")
    sinks.write_report(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"), path)
    return readers.read_lookup(spark, path, "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE")


@registry.add(
    "json_metrics",
    "i:rows d:share",
    "SELECT count(*) AS rows, avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS share FROM orders",
)
def json_metrics(spark, sf_dir):
    path = fresh_folder(spark, "metrics")
    found = table(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.expr("avg(CAST(o_orderstatus = 'F' AS INT)) AS share"))
    sinks.write_metrics(spark, found.head().asDict(), path)
    return spark.read.json(path)


@registry.add(
    "multi_file_scan",
    "i:Season n d:total",
    "SELECT 2018 + l_linenumber AS \"Season\", count(*) AS n, sum(l_quantity) AS total FROM lineitem GROUP BY 1",
)
def multi_file_scan(spark, sf_dir):
    """One folder per season, read back in one scan; the season is that of the folder."""
    path = fresh_folder(spark, "seasons")
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity")
    sinks.write_parquet(lines.withColumn("Season", F.expr("2018 + l_linenumber")), path, ["Season"])
    return readers.read_seasons(spark, path).groupBy("Season").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@registry.add(
    "skipped_files",
    "s:file",
    "SELECT 'broken-' || l_linenumber || '.parquet' AS file FROM lineitem GROUP BY l_linenumber HAVING l_linenumber % 3 = 0 UNION ALL SELECT 'cut.parquet'",
)
def skipped_files(spark, sf_dir):
    """Files that a lenient scan leaves out: some that hold no table, and one that is cut off; an empty table is none of them."""
    path = fresh_folder(spark, "landed")
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity")
    sinks.write_parquet(lines, path, [])
    sinks.write_parquet(lines.where("l_quantity < 0"), f"{path}/empty", [])
    broken = lines.groupBy("l_linenumber").count().where("l_linenumber % 3 = 0").collect()  # line numbers are few
    for r in broken:
        sinks.write_bytes(spark, b"no table" * r["count"], f"{path}/broken-{r['l_linenumber']}.parquet")
    sinks.write_bytes(spark, b"PAR1" + bytes(40), f"{path}/cut.parquet")
    assert readers.read_parquet(spark, path, ["l_quantity"], lenient=True, schema="l_quantity DOUBLE").count() == lines.count()
    return readers.unreadable(spark, [path, f"{path}/empty"]).select(F.regexp_extract("path", "[^/]*$", 0).alias("file"))


@registry.add(
    "feather_scan",
    "i:event_id user_id d:value",
    "SELECT * FROM events",
)
def feather_scan(spark, sf_dir):
    """Events landed as feather files, one for each task that holds some, and read back."""
    path = fresh_folder(spark, "feather")
    sinks.write_feather(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), path)
    return readers.read_feather(spark, f"{path}/*.feather")


@registry.add(
    "round_arrivals",
    "i:Season Round rows",
    """SELECT 2018 + (r // 20) % 8 AS "Season", (r // 20) // 8 + 1 AS "Round", sum(n) AS rows FROM (
      SELECT c_custkey AS r, count(user_id) AS n FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1) GROUP BY 1, 2""",
)
def round_arrivals(spark, sf_dir):
    """Telemetry rows of each expected round, rounds without any included."""
    race_no = F.floor(F.col("c_custkey") / field.CARS)
    expected = table(spark, sf_dir, "customer").select(
        (F.lit(2018) + race_no % 8).cast("int").alias("Season"), (F.floor(race_no / 8) + 1).cast("int").alias("Round")
    ).distinct()
    return ingest.rows_per_round(field.telemetry(spark, sf_dir), expected)
