"""Measures of classifiers, forecasts and labelings, as plain aggregations.

Scores are grouped by value before anything is ordered, so equal scores cost
one row and no window spans the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expressions import symmetric_error
from tabulon.operators.ordered import RUN_ROWS, running_totals, with_group_values
from tabulon.session import settle


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    positive = F.col(label) == 1
    return settle(
        df.groupBy(F.col(score).alias("score")).agg(
            F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
        )
    )


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score", run_rows: int = RUN_ROWS) -> DataFrame:
    """Chance that a positive outranks a negative; ties count half."""
    ranked = running_totals(_by_score(df, label, score), [], ["score"], {"upto": "neg"}, run_rows)
    wins = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2.0))
    return ranked.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def threshold_counts(df: DataFrame, label: str = "label", score: str = "score", run_rows: int = RUN_ROWS) -> DataFrame:
    """Counts when every score at or above a threshold is called positive, one row per threshold."""
    scores = _by_score(df, label, score)
    ranked = running_totals(scores, [], [F.desc("score")], {"tp": "pos", "fp": "neg"}, run_rows)
    all_pos = scores.agg(F.sum("pos")).scalar()
    return ranked.select(F.col("score").alias("threshold"), "pos", "neg", "tp", "fp", (all_pos - F.col("tp")).alias("fn"))


def area_under_pr(df: DataFrame, label: str = "label", score: str = "score", run_rows: int = RUN_ROWS) -> DataFrame:
    """Trapezoids under precision against recall, from recall 0 at the first precision."""
    t = threshold_counts(df, label, score, run_rows)
    tp, fp = F.col("tp"), F.col("fp")
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - F.col("pos"), tp - F.col("pos") + fp - F.col("neg")), precision)
    total = tp + F.col("fn")
    step = F.try_divide(F.col("pos") * (precision + before) / 2.0, total)
    return t.agg(F.sum(step).alias("aupr"))


def f_measure_by_threshold(df: DataFrame, label: str = "label", score: str = "score", run_rows: int = RUN_ROWS) -> DataFrame:
    t = threshold_counts(df, label, score, run_rows)
    f = F.lit(2.0) * F.col("tp") / (F.lit(2.0) * F.col("tp") + F.col("fp") + F.col("fn"))
    return t.select("threshold", f.alias("f_measure"))


def best_threshold(df: DataFrame, label: str = "label", score: str = "score", run_rows: int = RUN_ROWS) -> DataFrame:
    """The threshold of the largest F-measure; the higher threshold wins a tie."""
    best = F.max(F.struct("f_measure", "threshold"))
    return f_measure_by_threshold(df, label, score, run_rows).agg(best.alias("b")).select("b.threshold", "b.f_measure")


def positive_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    cells = [F.count_if(F.col(prediction) == F.lit(c)).alias(f"predicted_{c}") for c in classes]
    return df.groupBy(F.col(label).alias("label")).agg(*cells)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def binary_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1, precision, recall, false and true positive rate of class 1."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(tp, tp + fn).alias("tpr"),
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: true and false positives and negatives of class 1. Rows without a label are not counted."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    cells = confusion(df, label, prediction)
    # Each cell counts once for its true class and once for its predicted class.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"),
                         F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    counts = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    classes = counts.select(
        "class",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, support + predicted).alias("f1"),
        "support",
        "tp",
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    averages = classes.agg(
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support")).alias("macro"),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures],
                 total.alias("support")).alias("weighted"),
        F.struct(F.lit("accuracy").alias("class"),
                 *[_ratio(F.sum("tp"), total).alias(m) for m in measures], total.alias("support")).alias("accuracy"),
    )
    extra = averages.select(F.explode(F.array("accuracy", "macro", "weighted")).alias("r")).select("r.*")
    return classes.drop("tp").unionByName(extra)


def mean_squared_error(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    error = F.col(actual) - F.col(forecast)
    return df.agg(F.avg(error * error).alias("mse"))


def smape(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    return df.agg(F.avg(symmetric_error(actual, forecast)).alias("smape"))


def labeling_agreement(df: DataFrame, truth: str, found: str) -> DataFrame:
    """Adjusted Rand, mutual information, V-measure and Fowlkes–Mallows of two labelings.

    Works on the contingency table: pairs of labels with their counts.
    """
    cells = settle(df.groupBy(F.col(truth).alias("a"), F.col(found).alias("b")).agg(F.count(F.lit(1)).alias("n")))

    def choose2(c: Column) -> Column:
        return c.cast("double") * (c - 1) / 2.0

    def margin(key: str) -> DataFrame:
        sizes = cells.groupBy(key).agg(F.sum("n").alias("m"))
        m = F.col("m").cast("double")
        return sizes.agg(
            F.sum(choose2(F.col("m"))).alias(f"pairs_{key}"), F.sum(m * F.log(m)).alias(f"mlogm_{key}")
        )

    inner = cells.agg(
        F.sum("n").cast("double").alias("n"),
        F.sum(choose2(F.col("n"))).alias("pairs"),
        F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("nlogn"),
    )
    wide = with_group_values(with_group_values(inner, margin("a"), []), margin("b"), [])
    n, pa, pb = F.col("n"), F.col("pairs_a"), F.col("pairs_b")
    expected = F.try_divide(pa * pb, choose2(n))
    entropy_a = F.log(n) - F.col("mlogm_a") / n
    entropy_b = F.log(n) - F.col("mlogm_b") / n
    mutual = F.log(n) + (F.col("nlogn") - F.col("mlogm_a") - F.col("mlogm_b")) / n
    return wide.select(
        F.coalesce(F.try_divide(F.col("pairs") - expected, (pa + pb) / 2.0 - expected), F.lit(1.0)).alias("adjusted_rand"),
        mutual.alias("mutual_information"),
        F.coalesce(F.try_divide(2 * mutual, entropy_a + entropy_b), F.lit(1.0)).alias("v_measure"),
        _ratio(F.col("pairs"), F.sqrt(pa * pb)).alias("fowlkes_mallows"),
    )
