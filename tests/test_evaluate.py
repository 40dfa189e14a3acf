import math

import pytest

from tabulon.operators import evaluate as M, tuning

# Label, score, prediction at 0.5; two pairs of tied scores.
ROWS = [(1, 0.9, 1), (1, 0.8, 1), (0, 0.8, 1), (1, 0.6, 1), (0, 0.4, 0), (1, 0.4, 0), (0, 0.2, 0), (0, 0.1, 0)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "label int, score double, prediction int")


def test_area_under_roc_counts_ties_half(scored):
    wins = sum((p > n) + 0.5 * (p == n) for l, p, _ in ROWS if l for m, n, _ in ROWS if not m)
    assert M.area_under_roc(scored).first()["auc"] == pytest.approx(wins / 16)


def test_areas_agree_with_the_library_evaluator(scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = scored.withColumn("label", scored["label"].cast("double")).withColumn("rawPrediction", scored["score"])
    for metric, found in (("areaUnderROC", M.area_under_roc(scored)), ("areaUnderPR", M.area_under_pr(scored))):
        expected = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(df)
        assert found.first()[0] == pytest.approx(expected)


def test_best_threshold(scored):
    row = M.best_threshold(scored).first()
    assert row["threshold"] == 0.4 and row["f_measure"] == pytest.approx(8 / 10)
    counts = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in M.threshold_counts(scored).collect()}
    assert counts[0.8] == (2, 1, 2) and counts[0.1] == (4, 4, 0)


def test_reports(scored):
    row = M.binary_report(scored).first()
    assert (row["precision"], row["recall"], row["fpr"]) == (0.75, 0.75, 0.25)
    assert M.accuracy(scored).first()[0] == 0.75
    report = {r["class"]: r for r in M.classification_report(scored).collect()}
    assert report["1"]["support"] == 4 and report["0"]["f1"] == 0.75 and report["weighted avg"]["recall"] == 0.75
    matrix = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in M.confusion_matrix(scored, [0, 1]).collect()}
    assert matrix == {0: (3, 1), 1: (1, 3)}


def test_report_covers_classes_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "label int, prediction int")
    report = {r["class"]: r for r in M.classification_report(df).collect()}
    assert report["2"]["precision"] == 0.0 and report["0"]["recall"] == 1.0
    assert report["macro avg"]["recall"] == pytest.approx(1 / 3)


def test_one_class_only_gives_null_area(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.6)], "label int, score double")
    assert M.area_under_roc(df).first()[0] is None


def test_labelings(spark):
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 7), (1, 7)], "a int, b int")
    row = M.labeling_agreement(same, "a", "b").first()
    assert row["adjusted_rand"] == 1.0 and row["v_measure"] == pytest.approx(1.0)
    assert row["mutual_information"] == pytest.approx(math.log(2)) and row["fowlkes_mallows"] == 1.0


def test_elbow(spark):
    sweep = spark.createDataFrame([(2, 100.0), (3, 40.0), (4, 30.0), (5, 25.0)], "k int, sse double")
    assert [r["k"] for r in tuning.elbow(sweep).where("elbow").collect()] == [3]


def test_grid_sizes():
    from tabulon.operators import models as L

    pytest.importorskip("pyspark")
    lr, gbt, tree = L.logistic(), L.boosted_trees(), L.decision_tree()
    assert len(tuning.logistic_grid(lr)) == 18 and len(tuning.boosted_grid(gbt)) == 4
    assert len(tuning.tree_grid(tree)) == 60


def test_forest_queries_search_the_whole_grid(spark, monkeypatch):
    """Both forest searches try all combinations; boosting runs ten rounds in both of its queries."""
    from tabulon.plans import models as P

    grids, rounds = [], []
    table = lambda *_: ("train", "test", None)
    monkeypatch.setattr(P, "census_parts", table)
    monkeypatch.setattr(P, "embedding_parts", lambda *_: ("train", "test"))
    monkeypatch.setattr(P.N, "fold_by_hash", lambda *_: "folded")
    found = type("Found", (), {"bestModel": None})
    monkeypatch.setattr(P.N, "cross_validate", lambda estimator, params, folded: grids.append(len(params)) or found)
    monkeypatch.setattr(P.N, "grid_results", lambda *_: None)
    monkeypatch.setattr(P.O, "importances", lambda *_: None)
    monkeypatch.setattr(P.L, "compare_models", lambda *_: None)
    monkeypatch.setattr(P.L, "fit", lambda estimator, _: rounds.append(estimator.getMaxIter()) if estimator.hasParam("stepSize") else None)
    P.forest_grid(None, "")
    P.tuned_forest_importances(None, "")
    P.boosted_importances(None, "")
    P.model_comparison(None, "")
    assert grids == [60, 60] and rounds == [10, 10]
