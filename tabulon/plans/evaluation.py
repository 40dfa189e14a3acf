"""Measures over scored orders, and over two labelings of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import evaluate as M
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4

_S = S.with_sql(S.SCORED_SQL)


def _tidied(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, tidy(F.col(c)))
    return df


_RANKS = """, k AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk
  FROM scored), t AS (SELECT sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n, sum(CASE WHEN label = 1 THEN rk END) AS s
  FROM k)"""


@query("m01_area_under_roc", _S + _RANKS + f" SELECT {r4('(s - p * (p + 1) / 2) / (p * n)')} AS auc FROM t")
def area_under_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.area_under_roc(S.scored(spark, sf_dir)), "auc")


_STEPS = """, g AS (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM scored GROUP BY 1),
t AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS p FROM g)"""


@query("m02_area_under_pr", _S + _STEPS + f"""
, c AS (SELECT score, tp / p AS recall, tp / (tp + fp) AS prec FROM t),
w AS (SELECT recall - coalesce(lag(recall) OVER (ORDER BY score DESC), 0) AS width,
  (prec + coalesce(lag(prec) OVER (ORDER BY score DESC), prec)) / 2 AS height FROM c)
SELECT {r4('sum(width * height)')} AS aupr FROM w""")
def area_under_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.area_under_pr(S.scored(spark, sf_dir)), "aupr")


@query("l03_f_by_threshold", _S + _STEPS + f"""
SELECT score AS threshold, {r4('2 * tp / (2 * tp + fp + (p - tp))')} AS f_measure FROM t""")
def f_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.f_measure_by_threshold(S.scored(spark, sf_dir)), "f_measure")


@query("l03_best_threshold", _S + _STEPS + f"""
SELECT threshold, {r4('f')} AS f_measure FROM (SELECT score AS threshold, 2 * tp / (2 * tp + fp + (p - tp)) AS f FROM t)
ORDER BY f DESC, threshold DESC LIMIT 1""")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.best_threshold(S.scored(spark, sf_dir)), "f_measure")


@query("m03_accuracy", _S + f"SELECT {r4('avg(CASE WHEN label = prediction THEN 1 ELSE 0 END)')} AS accuracy FROM scored")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.accuracy(S.scored(spark, sf_dir)), "accuracy")


@query("m04_confusion", _S + "SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(S.scored(spark, sf_dir))


@query("m04_confusion_matrix", _S + """
SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1
FROM scored GROUP BY 1""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion_matrix(S.scored(spark, sf_dir), [0, 1])


_CELLS = """, c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
  count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn FROM scored)"""


@query("m05_binary_report", _S + _CELLS + f"""
SELECT {r4('2 * tp / (2 * tp + fp + fn)')} AS f1, {r4('tp / (tp + fp)')} AS precision, {r4('tp / (tp + fn)')} AS recall,
  {r4('fp / (fp + tn)')} AS fpr, {r4('tp / (tp + fn)')} AS tpr FROM c""")
def binary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.binary_report(S.scored(spark, sf_dir)), "f1", "precision", "recall", "fpr", "tpr")


@query("m06_classification_report", _S + f"""
, cls AS (SELECT c AS class,
    (SELECT count(*) FROM scored WHERE label = c AND prediction = c)::DOUBLE AS tp,
    (SELECT count(*) FROM scored WHERE label = c)::DOUBLE AS sup,
    (SELECT count(*) FROM scored WHERE prediction = c)::DOUBLE AS pred FROM (VALUES (0), (1)) v(c)),
x AS (SELECT CAST(class AS VARCHAR) AS class, tp / pred AS precision, tp / sup AS recall, 2 * tp / (sup + pred) AS f1, sup, tp
  FROM cls)
SELECT class, {r4('precision')} AS precision, {r4('recall')} AS recall, {r4('f1')} AS f1, sup::BIGINT AS support FROM x
UNION ALL SELECT 'accuracy', {r4('sum(tp) / sum(sup)')}, {r4('sum(tp) / sum(sup)')}, {r4('sum(tp) / sum(sup)')},
  sum(sup)::BIGINT FROM x
UNION ALL SELECT 'macro avg', {r4('avg(precision)')}, {r4('avg(recall)')}, {r4('avg(f1)')}, sum(sup)::BIGINT FROM x
UNION ALL SELECT 'weighted avg', {r4('sum(precision * sup) / sum(sup)')}, {r4('sum(recall * sup) / sum(sup)')},
  {r4('sum(f1 * sup) / sum(sup)')}, sum(sup)::BIGINT FROM x""")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.classification_report(S.scored(spark, sf_dir)), "precision", "recall", "f1")


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500.0).alias("forecast")
    )


@query("m07_mean_squared_error", f"""
SELECT {r4('avg((l_extendedprice - l_quantity * 1500.0::DOUBLE) * (l_extendedprice - l_quantity * 1500.0::DOUBLE) / 1e6)')}
  AS mse FROM lineitem""")
def mean_squared_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In squared thousands."""
    thousands = _errors(spark, sf_dir).select((F.col("actual") / 1e3).alias("actual"), (F.col("forecast") / 1e3).alias("forecast"))
    return _tidied(M.mean_squared_error(thousands, "actual", "forecast"), "mse")


@query("m08_smape", f"""
SELECT {r4('''avg(200 * abs(l_quantity * 1500.0::DOUBLE - l_extendedprice) / (l_quantity * 1500.0::DOUBLE + l_extendedprice))''')}
  AS smape FROM lineitem""")
def smape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(M.smape(_errors(spark, sf_dir), "actual", "forecast"), "smape")


_AGREE = """, j AS (SELECT quality AS a, toxic AS b FROM labels),
c AS (SELECT a, b, count(*)::DOUBLE AS n FROM j GROUP BY 1, 2),
ra AS (SELECT a, sum(n) AS m FROM c GROUP BY 1), rb AS (SELECT b, sum(n) AS m FROM c GROUP BY 1),
t AS (SELECT (SELECT sum(n) FROM c) AS n, (SELECT sum(n * (n - 1) / 2) FROM c) AS pc,
  (SELECT sum(m * (m - 1) / 2) FROM ra) AS pa, (SELECT sum(m * (m - 1) / 2) FROM rb) AS pb,
  (SELECT sum(c.n / s.n * ln(s.n * c.n / (ra.m * rb.m))) FROM c JOIN ra USING (a) JOIN rb USING (b),
    (SELECT sum(n) AS n FROM c) s) AS mi,
  (SELECT -sum(m / s.n * ln(m / s.n)) FROM ra, (SELECT sum(n) AS n FROM c) s) AS ha,
  (SELECT -sum(m / s.n * ln(m / s.n)) FROM rb, (SELECT sum(n) AS n FROM c) s) AS hb)"""


@query("m11_labeling_agreement", "WITH x AS (SELECT 1)" + _AGREE + f"""
SELECT {r4('(pc - pa * pb / (n * (n - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2))')} AS adjusted_rand,
  {r4('mi')} AS mutual_information, {r4('2 * mi / (ha + hb)')} AS v_measure, {r4('pc / sqrt(pa * pb)')} AS fowlkes_mallows
FROM t""")
def labeling_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.labeling_agreement(S.table(spark, sf_dir, "labels"), "quality", "toxic")
    return _tidied(out, "adjusted_rand", "mutual_information", "v_measure", "fowlkes_mallows")
