"""Feature preparation on the census rows, the embeddings and the response matrix."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import hash_percent, tidy
from tabulon.operators import features as K
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4
from tabulon.session import settle

CATEGORICAL = ["education", "marital_status", "occupation"]
NUMERIC = ["age", "hours_per_week"]
_C = S.with_sql(S.CENSUS_SQL)


def census_parts(spark: SparkSession, sf_dir: str):
    """Train and test rows with features fitted on the train part alone."""
    census = S.census(spark, sf_dir)
    train, test = K.hash_split(census, "id")
    fitted = K.feature_pipeline(CATEGORICAL, NUMERIC, "income").fit(train)
    keep = ["id", *CATEGORICAL, *NUMERIC, "income"]
    return K.apply_pipeline(fitted, train, keep), K.apply_pipeline(fitted, test, keep), fitted


def census_encoder(spark: SparkSession, sf_dir: str) -> K.FrequencyEncoder:
    """The same features from tables of values, fitted on the train part."""
    return K.FrequencyEncoder(K.hash_split(S.census(spark, sf_dir), "id")[0], CATEGORICAL, NUMERIC, "income")


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label"
    )


_INDEX = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count, row_number() OVER (ORDER BY count DESC, {c}) - 1 AS index "
    f"FROM (SELECT {c}, count(*) AS count FROM census GROUP BY 1)"
    for c in CATEGORICAL
)


@query("k01_frequency_index", _C + _INDEX)
def frequency_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    census, parts = S.census(spark, sf_dir), None
    for c in CATEGORICAL:
        part = K.frequency_index(census, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "count", "index")
        parts = part if parts is None else parts.unionByName(part)
    return parts


_TRAIN = """train AS (SELECT * FROM census WHERE ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 100 < 70)"""
_SLOTS = "slots AS (" + " UNION ALL ".join(
    f"SELECT {i} AS place, '{c}' AS column_name, {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS slot "
    f"FROM train GROUP BY {c}"
    for i, c in enumerate(CATEGORICAL)
) + ")"


@query("k02_one_hot", S.with_sql(S.CENSUS_SQL, _TRAIN, _SLOTS) + " UNION ALL ".join(
    f"SELECT id, '{c}' AS column_name, CAST(slot AS INTEGER) AS slot, 1.0::DOUBLE AS ones FROM census LEFT JOIN slots "
    f"ON column_name = '{c}' AND value = {c}" for c in CATEGORICAL))
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot that is set in each one-hot vector, and the sum of the vector."""
    encoded = census_encoder(spark, sf_dir).transform(S.census(spark, sf_dir), "id")
    cells = [
        F.struct(F.lit(c).alias("column_name"), vector_to_array(f"{c}_vec").alias("v")) for c in CATEGORICAL
    ]
    long = encoded.select("id", F.explode(F.array(*cells)).alias("cell"))
    ones = F.aggregate("cell.v", F.lit(0.0), lambda s, x: s + x)
    slot = (F.array_position("cell.v", F.lit(1.0)) - 1).cast("int")
    return long.select("id", "cell.column_name", slot.alias("slot"), ones.alias("ones"))


@query("k03_assembled_features", S.with_sql(S.CENSUS_SQL, _TRAIN, _SLOTS) + """
, y AS (SELECT income, row_number() OVER (ORDER BY count(*) DESC, income) - 1 AS label FROM train GROUP BY 1)
SELECT id, label::DOUBLE AS label, (SELECT count(*) + 2 FROM slots)::INTEGER AS width, age, hours_per_week
FROM train JOIN y USING (income)""")
def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, vector width, and the two numbers that stand at its end."""
    train, _ = K.hash_split(S.census(spark, sf_dir), "id")
    v = vector_to_array("features")
    return census_encoder(spark, sf_dir).transform(train, "id").select(
        "id", "label", F.size(v).alias("width"), F.element_at(v, -2).alias("age"), F.element_at(v, -1).alias("hours_per_week")
    )


@query("k04_pipeline_rows", _C + """
SELECT id, education, marital_status, occupation, age, hours_per_week, income FROM census""")
def pipeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original columns come through the fitted pipeline for train and test rows alike."""
    encoder, added = census_encoder(spark, sf_dir), [f"{c}_{kind}" for c in CATEGORICAL for kind in ("index", "vec")]
    train, test = K.hash_split(S.census(spark, sf_dir), "id")
    both = encoder.transform(train, "id").unionByName(encoder.transform(test, "id"))
    return both.drop("features", "label", *added)


@query("k05_hash_split", _C + """
SELECT id, CASE WHEN ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 100 < 70 THEN 'train' ELSE 'test' END
  AS part FROM census""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = K.hash_split(S.census(spark, sf_dir).select("id"), "id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("k05_random_split")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = K.random_split(S.census(spark, sf_dir).select("id"), [0.7, 0.3], seed=100)
    return parts[0].withColumn("part", F.lit("train")).unionByName(parts[1].withColumn("part", F.lit("test")))


@query("k06_scaled_pair", S.with_sql(S.STORE_SQL) + f"""
, l AS (SELECT min(discount) AS d0, max(discount) - min(discount) AS dw, min(profit) AS p0, max(profit) - min(profit) AS pw
  FROM store)
SELECT id, {r4('(discount - d0) / dw')} AS discount, {r4('(profit - p0) / pw')} AS profit FROM store, l""")
def scaled_pair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_pair(spark, sf_dir).select("id", tidy(F.col("discount")).alias("discount"), tidy(F.col("profit")).alias("profit"))


def scaled_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount and profit scaled to [0, 1], with the category beside them."""
    store = settle(S.store(spark, sf_dir))
    limits = K.column_limits(store, ["discount", "profit"])
    return K.scale(store, limits, ["discount", "profit"]).select(
        "id", "category", F.col("discount_scaled").alias("discount"), F.col("profit_scaled").alias("profit")
    )


@query("k07_principal_scores")
def principal_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.principal_scores(K.as_vector(embedding_vectors(spark, sf_dir), "v"), "features", 2).select("id", "pc1", "pc2")


_AXES = """l AS (SELECT avg(discount) AS mx, avg(profit / 100) AS my, atan2(2 * covar_samp(discount, profit / 100),
  var_samp(discount) - var_samp(profit / 100)) / 2 AS t FROM store),
u AS (SELECT mx, my, CASE WHEN greatest(cos(t), sin(t)) >= -least(cos(t), sin(t)) THEN t ELSE t + pi() END AS t1,
  CASE WHEN greatest(-sin(t), cos(t)) >= -least(-sin(t), cos(t)) THEN t ELSE t + pi() END AS t2 FROM l)"""


@query("k07_principal_scores_2d", S.with_sql(S.STORE_SQL, _AXES) + f"""
SELECT id, {r4('(discount - mx) * cos(t1) + (profit / 100 - my) * sin(t1)')} AS pc1,
  {r4('(profit / 100 - my) * cos(t2) - (discount - mx) * sin(t2)')} AS pc2 FROM store, u""")
def principal_scores_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = S.store(spark, sf_dir).select("id", F.array("discount", F.col("profit") / 100).alias("v"))
    scores = K.principal_scores(K.as_vector(pair, "v"), "features", 2)
    return scores.select("id", tidy(F.col("pc1")).alias("pc1"), tidy(F.col("pc2")).alias("pc2"))


_VAR2 = """l AS (SELECT var_samp(discount) AS a, var_samp(profit / 100) AS b, covar_samp(discount, profit / 100) AS c FROM store),
e AS (SELECT (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS v1, (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS v2
  FROM l)"""


@query("k08_explained_variance_2d", S.with_sql(S.STORE_SQL, _VAR2) + f"""
SELECT 1 AS component, {r4('v1 / (v1 + v2)')} AS ratio, {r4('v1')} AS variance FROM e
UNION ALL SELECT 2, {r4('v2 / (v1 + v2)')}, {r4('v2')} FROM e""")
def explained_variance_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = S.store(spark, sf_dir).select(F.array("discount", F.col("profit") / 100).alias("v"))
    out = K.explained_variance(K.as_vector(pair, "v"), "features")
    return out.withColumn("ratio", tidy(F.col("ratio"))).withColumn("variance", tidy(F.col("variance")))


@query("k08_explained_variance")
def explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.explained_variance(K.as_vector(embedding_vectors(spark, sf_dir), "v"), "features")
