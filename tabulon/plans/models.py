"""Classifiers on the census rows and the embeddings: fit, score, tune, explain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import evaluate as M
from tabulon.operators import explain as O
from tabulon.operators import features as K
from tabulon.operators import models as L
from tabulon.operators import tuning as N
from tabulon.operators.ordered import exact_quantiles
from tabulon.plans import standins as S
from tabulon.plans.features import _SLOTS, _TRAIN, CATEGORICAL, NUMERIC, census_parts, embedding_vectors
from tabulon.plans.registry import query, r4
from tabulon.session import settle


def embedding_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two classes of embedding rows, as train and test."""
    rows = embedding_vectors(spark, sf_dir).withColumn("label", (F.col("label") % 2).cast("double"))
    train, test = K.hash_split(K.as_vector(rows, "v").drop("v"), "id")
    return train, test


def _report(model, test: DataFrame) -> DataFrame:
    """All measures of one model on new rows."""
    return _measures(settle(L.score(model, test, ["id"])))


def _measures(scored: DataFrame) -> DataFrame:
    return M.binary_report(scored).select(
        "*",
        M.area_under_roc(scored, score="probability").scalar().alias("auc"),
        M.area_under_pr(scored, score="probability").scalar().alias("aupr"),
        M.accuracy(scored).scalar().alias("accuracy"),
    )


def logistic_model(train: DataFrame, **params):
    """Fitted with the positive rate of the train rows as its threshold; the rows are cached for both."""
    cached = train.persist()
    try:
        return L.fit(L.logistic(10, L.threshold_from_rate(cached), **params), cached)
    finally:
        cached.unpersist()


@query("l01_logistic_report")
def logistic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, _ = census_parts(spark, sf_dir)
    return _report(logistic_model(train), test)


@query("l02_rate_threshold", S.with_sql(S.CENSUS_SQL) + f"""
SELECT {r4('''avg(CASE WHEN income = (SELECT income FROM census WHERE
  ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 100 < 70 GROUP BY 1 ORDER BY count(*) DESC, income LIMIT 1)
  THEN 0 ELSE 1 END)''')} AS threshold FROM census WHERE ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 100 < 70""")
def rate_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positive rate of the train rows as the model carries it; class 1 is the rarer income."""
    train, _, _ = census_parts(spark, sf_dir)
    threshold = logistic_model(train).getThreshold()
    return spark.createDataFrame([(threshold,)], "threshold double").select(tidy(F.col("threshold")).alias("threshold"))


@query("l03_model_best_threshold")
def model_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    return M.best_threshold(L.score(logistic_model(train), train, ["id"]), score="probability")


@query("l04_boosted_report")
def boosted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, _ = census_parts(spark, sf_dir)
    return _report(L.fit(L.boosted_trees(10), train), test)


@query("l05_forest_report")
def forest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = embedding_parts(spark, sf_dir)
    return M.classification_report(L.score(L.fit(L.random_forest(10), train), test, ["id"]))


@query("l06_tree_report")
def tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = embedding_parts(spark, sf_dir)
    return M.classification_report(L.score(L.fit(L.decision_tree(), train), test, ["id"]))


@query("l07_scored_rows")
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, _ = census_parts(spark, sf_dir)
    return L.score(logistic_model(train), test, ["id"])


@query("l08_model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = embedding_parts(spark, sf_dir)
    fitted = {
        "logistic": L.fit(L.logistic(10), train),
        "tree": L.fit(L.decision_tree(), train),
        "forest": L.fit(L.random_forest(10), train),
        "boosted": L.fit(L.boosted_trees(10), train),
    }
    return L.compare_models(fitted, test)


_LINEAR = """scored AS (SELECT id, label, 1 / (1 + exp(-(-3.25::DOUBLE + age * 0.05::DOUBLE + hours_per_week * 0.04::DOUBLE))) AS probability
  FROM (SELECT *, CASE WHEN income = (SELECT income FROM census GROUP BY 1 ORDER BY count(*) DESC, income LIMIT 1) THEN 0 ELSE 1 END
    AS label FROM census))"""


def _given_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census rows under given coefficients; class 1 is the rarer income."""
    census = S.census(spark, sf_dir)
    common = K.frequency_index(census, "income").where("index = 0").select("income")
    labelled = census.withColumn("label", (F.col("income") != common.scalar()).cast("int"))
    return L.linear_scores(labelled, {"age": 0.05, "hours_per_week": 0.04}, -3.25)


@query("l07_given_coefficients", S.with_sql(S.CENSUS_SQL, _LINEAR) + f"""
SELECT id, label, {r4('probability')} AS probability, CASE WHEN probability > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM scored""")
def given_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _given_scores(spark, sf_dir)
    return scored.select("id", "label", tidy(F.col("probability")).alias("probability"), "prediction")


@query("l01_given_coefficients_report", S.with_sql(S.CENSUS_SQL, _LINEAR) + f"""
, c AS (SELECT count(*) FILTER (label = 1 AND probability > 0.5) AS tp, count(*) FILTER (label = 0 AND probability > 0.5) AS fp,
  count(*) FILTER (label = 1 AND probability <= 0.5) AS fn, count(*) FILTER (label = 0 AND probability <= 0.5) AS tn FROM scored),
r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS place FROM scored)
SELECT tp, fp, fn, tn, {r4('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {r4('tp / (tp + fp)')} AS precision, {r4('tp / (tp + fn)')} AS recall,
  {r4('(SELECT sum(place) FROM r WHERE label = 1) / ((tp + fn) * (fp + tn)) - (tp + fn + 1) / (2.0 * (fp + tn))')} AS auc FROM c""")
def given_coefficients_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion, accuracy, precision, recall and ROC area of given coefficients."""
    scored = settle(_given_scores(spark, sf_dir).select("id", "label", "probability", "prediction"))
    report = M.binary_report(scored)
    wide = M.confusion_counts(scored).select(
        "*", M.accuracy(scored).scalar().alias("accuracy"), report.select("precision").scalar().alias("precision"),
        report.select("recall").scalar().alias("recall"), M.area_under_roc(scored, score="probability").scalar().alias("auc"),
    )
    return wide.select("tp", "fp", "fn", "tn", *[tidy(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "auc")])


_STUMP = """rows_ AS (SELECT id, CAST(hours_per_week AS INTEGER) AS x, label FROM (SELECT *, CASE WHEN income =
    (SELECT income FROM census GROUP BY 1 ORDER BY count(*) DESC, income LIMIT 1) THEN 0 ELSE 1 END AS label FROM census)),
v AS (SELECT x, count(*) AS n, sum(label) AS y FROM rows_ GROUP BY x),
t AS (SELECT (x + lead(x) OVER w) / 2.0 AS cut, sum(n) OVER w AS n0, sum(y) OVER w AS y0, sum(n) OVER () AS n, sum(y) OVER () AS y
  FROM v WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, 2.0::DOUBLE * y0 / n0 * (n0 - y0) AS i0, 2.0::DOUBLE * (y - y0) / (n - n0) * ((n - n0) - (y - y0)) AS i1,
  2.0::DOUBLE * y / n * (n - y) AS i FROM t WHERE cut IS NOT NULL AND n0 < n),
best AS (SELECT * FROM g ORDER BY (i - i0 - i1) DESC, cut LIMIT 1)"""


def _stump(spark: SparkSession, sf_dir: str):
    """A tree of one split on the hours, with a bin for every value, and the rows it was fitted on."""
    census = S.census(spark, sf_dir)
    common = K.frequency_index(census, "income").where("index = 0").select("income")
    rows = census.select("id", F.array("hours_per_week").alias("v"), (F.col("income") != common.scalar()).cast("double").alias("label"))
    rows = K.as_vector(rows, "v").drop("v")
    return L.fit(L.decision_tree(maxDepth=1, maxBins=128), rows), rows


@query("l06_stump_scores", S.with_sql(S.CENSUS_SQL, _STUMP) + f"""
SELECT id, label::DOUBLE AS label, {r4('CASE WHEN x <= cut THEN y0 / n0 ELSE (y - y0) / (n - n0) END')} AS probability FROM rows_, best""")
def stump_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scored by a tree of one split."""
    model, rows = _stump(spark, sf_dir)
    return L.score(model, rows, ["id"]).select("id", "label", tidy(F.col("probability")).alias("probability"))


@query("o06_stump_nodes", S.with_sql(S.CENSUS_SQL, _STUMP) + f"""
SELECT side, CAST(rows AS BIGINT) AS rows, CAST(positives AS DOUBLE) AS positives, {r4('2 * positives / rows * (1 - positives / rows)')} AS impurity,
  cut::DOUBLE AS threshold FROM (SELECT 'all' AS side, n AS rows, y AS positives, cut FROM best UNION ALL
  SELECT 'left', n0, y0, NULL FROM best UNION ALL SELECT 'right', n - n0, y - y0, NULL FROM best)""")
def stump_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nodes of a tree of one split."""
    model, _ = _stump(spark, sf_dir)
    nodes = O.tree_nodes(model, spark)
    side = F.element_at(F.array(F.lit("all"), F.lit("left"), F.lit("right")), F.col("id") + 1)
    inner = F.when(F.col("left").isNotNull(), F.col("threshold"))
    return nodes.select(
        side.alias("side"), F.col("rows").cast("bigint").alias("rows"), F.col("class_counts")[1].cast("double").alias("positives"),
        tidy(F.col("impurity")).alias("impurity"), inner.alias("threshold"),
    )


# ------------------------------------------------------------------ tuning


def _search(spark: SparkSession, sf_dir: str, kind: str):
    """A two-fold search over the whole grid on the census rows, and the rows kept back."""
    train, test, fitted = census_parts(spark, sf_dir)
    if kind == "boosted":
        return _boosted_search(train, fitted), test
    estimator = L.logistic()
    return N.cross_validate(estimator, N.logistic_grid(estimator), N.fold_by_hash(train, "id", 2)), test


def _boosted_search(train: DataFrame, fitted):
    """A two-fold search over the boosted trees; equal rows of a fold are one weighted row, which all trees read.

    Rows are counted by their raw columns, so that the features are made once for each kind of row.
    """
    raw = N.pooled(N.fold_by_hash(train.drop("label", "features"), "id", 2), ["fold", *CATEGORICAL, *NUMERIC, "income"])
    rows = K.apply_pipeline(fitted, raw, ["fold", "weight"])
    estimator = L.boosted_trees(weightCol="weight")
    return N.cross_validate_at_once(estimator, N.boosted_grid(estimator), rows, weight="weight")


def winner_report(model, test: DataFrame) -> DataFrame:
    """All measures and the confusion counts of the model that won, on rows it has not seen; its scores are written once."""
    scored = settle(L.score(model.bestModel, test, ["id"]))
    counts = M.confusion_counts(scored)
    return _measures(scored).select("*", *[counts.select(c).scalar().alias(c) for c in ("tp", "fp", "fn", "tn")])


@query("l07_tuned_logistic_report")
def tuned_logistic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winner_report(*_search(spark, sf_dir, "logistic"))


@query("l07_tuned_boosted_report")
def tuned_boosted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winner_report(*_search(spark, sf_dir, "boosted"))


@query("l07_tuned_scored_rows")
def tuned_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, prediction and probability of the logistic model that won, for every row kept back."""
    found, test = _search(spark, sf_dir, "logistic")
    return L.score(found.bestModel, test, ["id"])


@query("n03_boosted_best_params")
def boosted_best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.best_params(spark, _search(spark, sf_dir, "boosted")[0])


@query("n01_logistic_grid")
def logistic_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 combinations with their two-fold score on the census rows."""
    train, _, _ = census_parts(spark, sf_dir)
    folded = N.fold_by_hash(train, "id", 2)
    estimator = L.logistic()
    return N.grid_results(spark, N.cross_validate(estimator, N.logistic_grid(estimator), folded))


@query("n02_boosted_cross_validation")
def boosted_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two depths by two lengths of boosting, 10 and 100 rounds."""
    train, _, fitted = census_parts(spark, sf_dir)
    return N.grid_results(spark, _boosted_search(train, fitted))


@query("n03_best_params")
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    folded = N.fold_by_hash(train, "id", 2)
    estimator = L.logistic()
    return N.best_params(spark, N.cross_validate(estimator, N.logistic_grid(estimator), folded))


@query("n04_tree_grid")
def tree_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = embedding_parts(spark, sf_dir)
    folded = N.fold_by_hash(train, "id", 2)
    estimator = L.decision_tree()
    params = N.tree_grid(estimator)
    return N.grid_results(spark, N.cross_validate(estimator, params, folded))


@query("n04_forest_grid")
def forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = embedding_parts(spark, sf_dir)
    folded = N.fold_by_hash(train, "id", 2)
    estimator = L.random_forest()
    params = N.tree_grid(estimator)
    return N.grid_results(spark, N.cross_validate(estimator, params, folded))


@query("n07_elbow", """
WITH s AS (SELECT l_linenumber AS k, sum(l_quantity) AS sse FROM lineitem GROUP BY 1),
e AS (SELECT min(k) AS x0, max(k) AS x1, arg_min(sse, k) AS y0, arg_max(sse, k) AS y1 FROM s),
d AS (SELECT k, sse, abs((y1 - y0) * k - (x1 - x0) * sse + x1 * y0 - y1 * x0)
  / sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS distance FROM s, e)
SELECT k, round(sse, 2) AS sse, round(distance, 4) + 0.0::DOUBLE AS distance,
  row_number() OVER (ORDER BY distance DESC, k) = 1 AS elbow FROM d""")
def elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bend of a falling curve: quantity by line number."""
    curve = S.table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(F.sum("l_quantity").alias("sse"))
    out = N.elbow(curve)
    return out.select("k", F.round("sse", 2).alias("sse"), tidy(F.col("distance")).alias("distance"), "elbow")


# ------------------------------------------------------------------ explanation


@query("o01_coefficients")
def coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    return O.coefficients(logistic_model(train), train)


_NAMES = " UNION ALL ".join(
    [f"SELECT place, slot, '{c}_vec_' || value AS feature FROM slots WHERE column_name = '{c}'" for c in CATEGORICAL]
    + [f"SELECT {10 + i}, 0, '{n}'" for i, n in enumerate(NUMERIC)]
)


@query("o02_slot_names", S.with_sql(S.CENSUS_SQL, _TRAIN, _SLOTS) + f"""
SELECT CAST(row_number() OVER (ORDER BY place, slot) - 1 AS INTEGER) AS slot, feature FROM ({_NAMES})""")
def slot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    return O.slot_table(train)


@query("o03_boosted_importances")
def boosted_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    return O.importances(L.fit(L.boosted_trees(10), train), train)


@query("o03_forest_importances")
def forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = census_parts(spark, sf_dir)
    return O.importances(L.fit(L.random_forest(10), train), train)


@query("o03_tuned_forest_importances")
def tuned_forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of the forest that won the grid search."""
    train, _, _ = census_parts(spark, sf_dir)
    estimator = L.random_forest()
    params = N.tree_grid(estimator)
    found = N.cross_validate(estimator, params, N.fold_by_hash(train, "id", 2))
    return O.importances(found.bestModel, train)


@query("c07_grid_times_rows", S.with_sql(S.CENSUS_SQL) + """
SELECT g.point, count(*) AS n, round(sum(hours_per_week * g.point), 2) AS total
FROM census, (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) g(point) GROUP BY 1""")
def grid_times_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row at every grid point, by exploding a literal array: nothing is joined."""
    points = F.array(F.lit(0.0), F.lit(0.5), F.lit(1.0))
    spread = S.census(spark, sf_dir).select("hours_per_week", F.explode(points).alias("point"))
    return spread.groupBy("point").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("hours_per_week") * F.col("point")), 2).alias("total")
    )


def _percentile_grid(df: DataFrame, column: str, points: int) -> list[float]:
    """Percentiles of a column as grid points: ``points`` numbers, whatever the size of the table."""
    shares = [i / (points - 1) for i in range(points)]
    row = exact_quantiles(df, column, shares, names=[f"p{i}" for i in range(points)]).first()
    return sorted(set(row))


def _dependence(spark: SparkSession, sf_dir: str, columns: dict[str, int]) -> DataFrame:
    train, test, fitted = census_parts(spark, sf_dir)
    model = L.fit(L.random_forest(10), train)
    grids = {c: _percentile_grid(test, c, points) for c, points in columns.items()}
    return O.partial_dependence(fitted, model, test.drop("features", "label"), grids)


@query("o04_partial_dependence")
def partial_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dependence(spark, sf_dir, {"hours_per_week": 10})


@query("o05_partial_dependence_pair")
def partial_dependence_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dependence(spark, sf_dir, {"hours_per_week": 6, "age": 6})


@query("o06_tree_nodes")
def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = embedding_parts(spark, sf_dir)
    return O.tree_nodes(L.fit(L.decision_tree(), train), spark)


@query("o07_param_docs")
def param_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the model fitted on the census rows."""
    train, _, _ = census_parts(spark, sf_dir)
    return O.param_docs(logistic_model(train), spark)
