import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon import session
from tabulon.operators import explain as O, features as K, models as L, tuning as N


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        a, b, kind = rng.normal(), rng.normal(), "abc"[i % 3]
        rows.append((i, float(a), float(b), kind, "yes" if a + (kind == "a") > 0.8 else "no"))
    return spark.createDataFrame(rows, "id bigint, a double, b double, kind string, answer string").cache()


@pytest.fixture(scope="module")
def parts(table):
    train, test = K.hash_split(table, "id")
    fitted = K.feature_pipeline(["kind"], ["a", "b"], "answer").fit(train)
    keep = ["id", "a", "b", "kind"]
    return K.apply_pipeline(fitted, train, keep), K.apply_pipeline(fitted, test, keep), fitted


def test_split_is_a_partition_and_ignores_layout(table):
    train, test = K.hash_split(table, "id")
    assert train.count() + test.count() == 600 and train.join(test, "id").count() == 0
    again, _ = K.hash_split(table.repartition(5), "id")
    assert sorted(r["id"] for r in again.collect()) == sorted(r["id"] for r in train.collect())


def test_scale_and_back(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, flat double")
    limits = K.column_limits(df, ["x", "flat"])
    scaled = K.scale(df, limits, ["x", "flat"])
    assert sorted(r["x_scaled"] for r in scaled.collect()) == [0.0, 0.5, 1.0]
    assert {r["flat_scaled"] for r in scaled.collect()} == {0.0}
    back = K.unscale(scaled, limits, "x_scaled", "x", "y")
    assert all(r["x"] == pytest.approx(r["y"]) for r in back.collect())


def test_components_are_orthogonal_and_ordered(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)) * np.array([3, 2, 1, 0.5]) + 7
    df = K.as_vector(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>"), "v")
    scores = np.array([(r["pc1"], r["pc2"]) for r in K.principal_scores(df, "features", 2).orderBy("id").collect()])
    assert np.allclose(scores.mean(0), 0, atol=1e-9)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(scores.var(0, ddof=1), values[:2])
    table = K.explained_variance(df, "features").orderBy("component").collect()
    assert np.allclose([r["variance"] for r in table], values)


def test_classifiers_learn_and_explain(spark, parts):
    train, test, fitted = parts
    names = O.slot_names(train)
    assert names[-2:] == ["a", "b"] and len(names) == 5
    model = L.fit(L.logistic(20, L.threshold_from_rate(train)), train)
    scored = L.score(model, test, ["id"])
    assert scored.where(F.col("label") == F.col("prediction")).count() / scored.count() > 0.85
    table = {r["feature"]: r["coefficient"] for r in O.coefficients(model, train).collect()}
    assert "(intercept)" in table and table["a"] > abs(table["b"])
    forest = L.fit(L.random_forest(10), train)
    weights = O.importances(forest, train).collect()
    assert weights[0]["feature"] == "a" and sum(r["importance"] for r in weights) == pytest.approx(1.0)
    effect = O.partial_dependence(fitted, forest, test.drop("features", "label"), {"a": [-2.0, 0.0, 2.0]})
    rows = {r["a"]: r for r in effect.collect()}
    assert rows[-2.0]["mean_probability"] < rows[2.0]["mean_probability"]
    assert rows[0.0]["rows"] == test.count()
    pair = O.partial_dependence(fitted, forest, test.drop("features", "label"), {"a": [-1.0, 1.0], "b": [0.0, 1.0]})
    assert pair.count() == 4
    ranking = L.compare_models({"logistic": model, "forest": forest}, test).collect()
    assert len(ranking) == 2 and ranking[0]["accuracy"] >= ranking[1]["accuracy"]


def test_children_hold_the_rows_of_their_parent(spark, parts):
    train, _, _ = parts
    for estimator in (L.decision_tree(maxDepth=4), L.random_forest(3, maxDepth=3)):
        nodes = {(r["tree"], r["id"]): r for r in O.tree_nodes(L.fit(estimator, train), spark).collect()}
        inner = [r for r in nodes.values() if r["left"] is not None]
        assert inner
        for r in inner:
            children = [nodes[(r["tree"], r["left"])], nodes[(r["tree"], r["right"])]]
            assert sum(c["rows"] for c in children) == r["rows"]
            assert sum(sum(c["class_counts"]) for c in children) == pytest.approx(sum(r["class_counts"]))


def test_cross_validation_picks_the_best_average(spark, parts):
    train, _, _ = parts
    folded = N.fold_by_hash(train, "id", 3)
    assert folded.select("fold").distinct().count() == 3
    estimator = L.logistic()
    model = N.cross_validate(estimator, N.grid(estimator, regParam=[0.01, 5.0], elasticNetParam=[0.0, 1.0]), folded, 3)
    results = N.grid_results(spark, model).collect()
    assert len(results) == 4 and [r["score"] for r in results if r["best"]] == [max(r["score"] for r in results)]
    assert {r["param"]: r["value"] for r in N.best_params(spark, model).collect()}["regParam"] == "0.01"


def test_winner_report_against_sql_over_the_scores(spark, parts):
    import duckdb

    from tabulon.plans.models import winner_report

    train, test, _ = parts
    estimator = L.boosted_trees()
    found = N.cross_validate(estimator, N.grid(estimator, maxDepth=[1, 3], maxIter=[2]), N.fold_by_hash(train, "id", 2))
    rows = L.score(found.bestModel, test, ["id"]).toPandas()  # noqa: F841
    tp, fp, fn, tn, auc = duckdb.sql("""SELECT count(*) FILTER (label = 1 AND prediction = 1), count(*) FILTER (label = 0 AND prediction = 1),
      count(*) FILTER (label = 1 AND prediction = 0), count(*) FILTER (label = 0 AND prediction = 0),
      (SELECT avg(CASE WHEN a.probability > b.probability THEN 1 WHEN a.probability = b.probability THEN 0.5 ELSE 0 END)
       FROM rows a, rows b WHERE a.label = 1 AND b.label = 0) FROM rows""").fetchall()[0]
    got = winner_report(found, test).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (tp, fp, fn, tn) and tp + fp + fn + tn == test.count()
    assert got["auc"] == pytest.approx(auc) and got["accuracy"] == pytest.approx((tp + tn) / test.count())
    assert got["precision"] == pytest.approx(tp / (tp + fp)) and got["recall"] == pytest.approx(tp / (tp + fn))


def test_given_coefficients_equal_the_model(spark, parts):
    train, test, _ = parts
    model = L.fit(L.logistic(20, 0.4), train.select("label", "a", "b").transform(lambda d: K.as_vector(d.withColumn("v", F.array("a", "b")), "v")))
    a, b = model.coefficients.toArray()
    own = K.as_vector(test.withColumn("v", F.array("a", "b")).drop("features"), "v")
    expected = {r["id"]: (r["probability"], r["prediction"]) for r in L.score(model, own, ["id"]).collect()}
    for r in L.linear_scores(test, {"a": a, "b": b}, model.intercept, 0.4).collect():
        assert r["probability"] == pytest.approx(expected[r["id"]][0]) and r["prediction"] == expected[r["id"]][1]
    empty = spark.createDataFrame([(None,)], "a double")
    assert L.linear_scores(empty, {"a": 1.0}).first()["prediction"] is None


def test_param_docs(spark):
    rows = {r["param"]: r for r in O.param_docs(L.boosted_trees(10), spark).collect()}
    assert rows["maxIter"]["value"] == "10" and rows["maxIter"]["doc"]


def test_encoder_with_many_values_equals_the_pipeline(spark):
    rng = np.random.default_rng(5)
    kinds = [f"w{v}" for v in (rng.zipf(1.3, 4000) % 900)]
    rows = [(i, k, "xy"[i % 2], float(i % 13), "no" if i % 3 else "yes") for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "id bigint, many string, few string, x double, answer string").repartition(4)
    plain = K.feature_pipeline(["many", "few"], ["x"], "answer").fit(df)
    expected = {r["id"]: (r["label"], r["features"].toArray()) for r in plain.transform(df).collect()}
    for hot in (20, 10_000):
        encoder = K.FrequencyEncoder(df, ["many", "few"], ["x"], "answer", hot_values=hot)
        got = encoder.transform(df, "id").collect()
        assert len(got) == len(rows)
        for r in got:
            label, features = expected[r["id"]]
            assert r["label"] == label and np.array_equal(r["features"].toArray(), features)
        names = [r["feature"] for r in encoder.slots().orderBy("slot").collect()]
        assert names == O.slot_names(plain.transform(df))
        odd = spark.createDataFrame([(1, "never", None, 2.0, "no"), (2, None, "x", 3.0, "other"), (3, "w1", "y", None, None)], df.schema)
        a, b, c = encoder.transform(odd, "id").orderBy("id").collect()
        assert a["features"].indices.tolist() == [encoder.width - 1] and a["label"] == 0.0 and a["many_vec"].numNonzeros() == 0
        assert len(b["features"].indices) == 2 and b["label"] is None and b["many_index"] == encoder.sizes["many"]
        assert c["features"] is None and c["label"] is None
        assert encoder.transform(df.limit(0), "id").count() == 0


def test_encoder_learns_like_the_pipeline(spark):
    rng = np.random.default_rng(6)
    rows = [(i, f"v{i % 7}", float(rng.normal()), "yes" if i % 7 < 2 else "no") for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, kind string, x double, answer string")
    train = K.FrequencyEncoder(df, ["kind"], ["x"], "answer", hot_values=3).transform(df, "id")
    scored = L.score(L.fit(L.logistic(20), train), train, ["id"])
    assert scored.where("label = prediction").count() == 400


class FakeContext:
    def __init__(self, master, active=None):
        self.master, self.active = master, active

    def getCheckpointDir(self):
        return self.active

    def setCheckpointDir(self, path):
        self.active = path


class FakeSession:
    def __init__(self, master, configured=None):
        self.sparkContext = FakeContext(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_shared_folder_comes_from_the_session():
    cluster = FakeSession("spark://somewhere", "hdfs://shared/checkpoints")
    assert session.shared_root(cluster) == "hdfs://shared/checkpoints"
    assert cluster.sparkContext.active == "hdfs://shared/checkpoints"
    with pytest.raises(RuntimeError):
        session.shared_root(FakeSession("yarn"))
    assert session.shared_root(FakeSession("local[2]")).startswith("/")


@pytest.mark.parametrize("grids", [{"hours_per_week": [10.0, 37.5, 40.0, 60.0]}, {"hours_per_week": [20.0, 45.0], "age": [25.0, 40.0, 61.5]}])
def test_partial_dependence_by_leaves_equals_scoring_every_row(spark, sf_dir, grids):
    from tabulon.plans.models import census_parts

    train, test, fitted = census_parts(spark, sf_dir)
    raw = test.drop("features", "label")
    for estimator in (L.random_forest(5), L.decision_tree()):
        model = L.fit(estimator, train)
        fast = {tuple(r[c] for c in grids): (r["mean_probability"], r["rows"]) for r in O.partial_dependence(fitted, model, raw, grids).collect()}
        slow = {tuple(r[c] for c in grids): (r["mean_probability"], r["rows"]) for r in O.dependence_by_rows(fitted, model, raw, grids).collect()}
        assert set(fast) == set(slow)
        for k, (p, n) in slow.items():
            assert fast[k][0] == pytest.approx(p, abs=1e-9) and fast[k][1] == n


def test_boosted_search_on_pooled_rows_is_that_on_all_rows(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from tabulon.operators import models as L, tuning as N

    x = F.pmod(F.xxhash64("id"), F.lit(9)).cast("double")
    y = F.pmod(F.xxhash64(F.col("id") + 1000), F.lit(5)).cast("double")
    noisy = (x + y + F.pmod(F.xxhash64(F.col("id") + 5000), F.lit(7)) > 9).cast("double")
    rows = spark.range(900).select("id", array_to_vector(F.array(x, y)).alias("features"), noisy.alias("label"))
    folded = N.fold_by_hash(rows, "id", 2)
    pooled = N.pooled(folded, ["fold", "label", "features"])
    assert pooled.count() <= 2 * 2 * 45 and pooled.agg(F.sum("weight")).first()[0] == 900
    plain, weighted = L.boosted_trees(), L.boosted_trees(weightCol="weight")
    a = N.cross_validate(plain, N.grid(plain, maxDepth=[2, 3], maxIter=[3]), folded).avgMetrics
    b = N.cross_validate(weighted, N.grid(weighted, maxDepth=[2, 3], maxIter=[3]), pooled, weight="weight").avgMetrics
    assert [round(m, 6) for m in a] == [round(m, 6) for m in b]


def test_search_at_once_equals_the_one_by_one_search(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from tabulon.operators import models as L, tuning as N

    x = F.pmod(F.xxhash64("id"), F.lit(9)).cast("double")
    noisy = (x + F.pmod(F.xxhash64(F.col("id") + 5000), F.lit(7)) > 7).cast("double")
    rows = N.fold_by_hash(spark.range(600).select("id", array_to_vector(F.array(x)).alias("features"), noisy.alias("label")), "id", 2)
    pooled = N.pooled(rows.repartition(16), ["fold", "label", "features"])
    trees = L.boosted_trees(weightCol="weight")
    grid = N.grid(trees, maxDepth=[1, 3], maxIter=[2, 4])
    a = N.cross_validate(trees, grid, pooled, weight="weight")
    b = N.cross_validate_at_once(trees, grid, pooled, weight="weight")
    assert [round(m, 9) for m in a.avgMetrics] == [round(m, 9) for m in b.avgMetrics]
    assert N.best_params(spark, a).collect() == N.best_params(spark, b).collect()
    assert [r["params"] for r in N.grid_results(spark, a).collect()] == [r["params"] for r in N.grid_results(spark, b).collect()]
    scores = [{r["id"]: round(r["probability"], 9) for r in L.score(m.bestModel, rows, ["id"]).collect()} for m in (a, b)]
    assert scores[0] == scores[1]
    # A job has a task for each partition: small tables have one.
    assert N._packed(pooled, pooled.count()).rdd.getNumPartitions() == 1
    with pytest.raises(ValueError, match="empty"):
        N.cross_validate_at_once(trees, grid, pooled.where("fold = 0"), weight="weight")


def test_boosted_search_counts_rows_before_their_features(spark, sf_dir):
    from tabulon.operators import tuning as N
    from tabulon.plans import models as P
    from tabulon.plans.features import census_parts

    seen = []

    def fits(estimator, params, df, **options):
        seen.append((df, len(params)))

    train, _, fitted = census_parts(spark, sf_dir)
    before, N.cross_validate_at_once = N.cross_validate_at_once, fits
    try:
        P._boosted_search(train, fitted)
    finally:
        N.cross_validate_at_once = before
    rows, params = seen[0]
    assert params == 4 and rows.agg({"weight": "sum"}).first()[0] == train.count()
    counts = lambda df: sorted((r["label"], r["fold"], str(r["features"]), r["n"]) for r in df.collect())
    expected = N.fold_by_hash(train, "id", 2).groupBy("fold", "label", "features").count().withColumnRenamed("count", "n")
    assert counts(rows.groupBy("fold", "label", "features").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "n")) == counts(expected)
