"""Clusters of customers by the offers they took, and of embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import clustering as C
from tabulon.operators import density as D
from tabulon.operators import features as K
from tabulon.operators import neighbours as B
from tabulon.operators import profile, tuning
from tabulon.plans import standins as S
from tabulon.plans.aggregates import response_matrix
from tabulon.plans.features import embedding_vectors
from tabulon.plans.registry import query, r4
from tabulon.session import settle


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, the 0/1 row over all offers as ``v``, and the same as ``features``."""
    cells = F.array(*[f"offer_{o}" for o in S.OFFERS])
    rows = response_matrix(spark, sf_dir).select("customer", cells.alias("v"))
    return settle(rows).withColumn("features", array_to_vector("v"))


def label_centres(spark: SparkSession, sf_dir: str) -> list[list[float]]:
    """Mean embedding of each label: as many rows as labels."""
    means = embedding_vectors(spark, sf_dir).groupBy("label").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("c")
    )
    return [row["c"] for row in means.orderBy("label").collect()]


_CENTRES = """u AS (SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings),
m AS (SELECT label, i, avg(x) AS c FROM u GROUP BY 1, 2),
d AS (SELECT u.id, m.label AS centre, sum((u.x - m.c) * (u.x - m.c)) AS sq FROM u JOIN m ON u.i = m.i GROUP BY 1, 2),
a AS (SELECT id, arg_min(centre, sq) AS cluster, min(sq) AS sq_distance FROM d GROUP BY 1)"""


@query("p01_assign_given_centres", S.with_sql(_CENTRES) + f"""
SELECT id, CAST(cluster AS INTEGER) AS cluster, {r4('sq_distance')} AS sq_distance FROM a""")
def assign_given_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = C.assign(embedding_vectors(spark, sf_dir), "v", label_centres(spark, sf_dir))
    return placed.select("id", "cluster", tidy(F.col("sq_distance")).alias("sq_distance"))


@query("m09_inertia_given_centres", S.with_sql(_CENTRES) + f"SELECT {r4('sum(sq_distance)')} AS sse FROM a")
def inertia_given_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = C.assign(embedding_vectors(spark, sf_dir), "v", label_centres(spark, sf_dir))
    return C.inertia(placed).select(tidy(F.col("sse")).alias("sse"))


_PAIRS = """p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS other, b.vec_id <> a.vec_id AS differs,
    {distance} AS d FROM embeddings a CROSS JOIN embeddings b),
g AS (SELECT id, own, other, sum(d) AS s, count(*) AS n FROM p GROUP BY 1, 2, 3),
ab AS (SELECT id, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM g GROUP BY 1, 2),
sil AS (SELECT id, own AS label, coalesce((b - a) / greatest(a, b), 0.0) AS s FROM ab)"""
_EUCLID = _PAIRS.format(distance="list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])")
_SQUARED = _PAIRS.format(
    distance="list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2"
)


@query("m10_silhouette_rows", S.with_sql(_EUCLID) + f"SELECT id, label, {r4('s')} AS silhouette FROM sil")
def silhouette_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.silhouette(embedding_vectors(spark, sf_dir), "id", "v", "label")
    return out.select("id", F.col("label").cast("int").alias("label"), tidy(F.col("silhouette")).alias("silhouette"))


@query("m10_silhouette_mean", S.with_sql(_EUCLID) + f"SELECT {r4('avg(s)')} AS silhouette FROM sil")
def silhouette_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.silhouette(embedding_vectors(spark, sf_dir), "id", "v", "label")
    return out.agg(tidy(F.avg("silhouette")).alias("silhouette"))


@query("m10_squared_silhouette", S.with_sql(_SQUARED) + f"SELECT id, label, {r4('s')} AS silhouette FROM sil")
def squared_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.squared_silhouette(embedding_vectors(spark, sf_dir), "id", "v", "label")
    return out.select("id", F.col("label").cast("int").alias("label"), tidy(F.col("silhouette")).alias("silhouette"))


_TWO = """t AS (SELECT vec_id, embedding::DOUBLE[] AS v, 'label' AS labeling, label AS c FROM embeddings
  UNION ALL SELECT vec_id, embedding::DOUBLE[], 'parity', label % 2 FROM embeddings),
g AS (SELECT a.vec_id, a.labeling, a.c AS own, b.c AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n
  FROM t a JOIN t b ON a.labeling = b.labeling GROUP BY 1, 2, 3, 4),
ab AS (SELECT vec_id, labeling, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM g GROUP BY 1, 2, 3)"""


@query("m10_silhouettes_of_labelings", S.with_sql(_TWO) + f"""
SELECT labeling, count(DISTINCT own) AS clusters, {r4('avg(coalesce((b - a) / greatest(a, b), 0.0))')} AS silhouette
FROM ab GROUP BY 1""")
def silhouettes_of_labelings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two labelings measured with one round of distances."""
    rows = embedding_vectors(spark, sf_dir).withColumn("parity", F.col("label") % 2)
    out = B.mean_silhouettes(rows, "id", "v", ["label", "parity"])
    return out.withColumn("silhouette", tidy(F.col("silhouette")))


@query("p01_kmeans_sizes")
def kmeans_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cluster_sizes(C.kmeans(responses(spark, sf_dir), 5, seed=5)).orderBy("cluster")


@query("p02_labels_per_k")
def labels_per_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = K.principal_scores(responses(spark, sf_dir), "features", 2).drop("features", "v")
    placed = scores.withColumn("features", array_to_vector(F.array("pc1", "pc2")))
    return C.label_per_k(placed, range(2, 11), seed=42).drop("features")


_PROFILE = S.with_sql(S.OFFERS_SQL, S.TRANSACTIONS_SQL, """n AS (SELECT customer, CAST(count(DISTINCT offer_id) % 4 AS INTEGER)
  AS cluster FROM transactions GROUP BY 1)""")


@query("p03_cluster_profile", _PROFILE + " UNION ALL ".join(
    f"SELECT n.cluster, '{c}' AS kind, CAST(o.{c} AS VARCHAR) AS item, count(*) AS value FROM transactions t "
    f"JOIN offers o USING (offer_id) LEFT JOIN n USING (customer) GROUP BY 1, 3" for c in ("campaign", "varietal", "origin")))
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by campaign, varietal and origin per given customer group: one join, three kinds."""
    bought = S.transactions(spark, sf_dir)
    groups = bought.groupBy("customer").agg((F.countDistinct("offer_id") % 4).cast("int").alias("cluster"))
    labeled = bought.join(S.offers(spark, sf_dir), "offer_id").join(groups, "customer", "left")
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("item")) for c in ("campaign", "varietal", "origin")]
    return labeled.select("cluster", F.inline(F.array(*kinds))).groupBy("cluster", "kind", "item").agg(F.count(F.lit(1)).alias("value"))


@query("n05_k_sweep")
def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sweep_k(responses(spark, sf_dir), "customer", range(2, 11), seed=5)


@query("n05_silhouette_sweep")
def silhouette_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sweep_k(responses(spark, sf_dir), "customer", range(2, 12), seed=42, with_silhouette=True)


@query("n07_elbow_of_sweep")
def elbow_of_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.elbow(C.sweep_k(responses(spark, sf_dir), "customer", range(2, 11), seed=5))


@query("n06_gap_statistic")
def gap_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.gap_statistic(responses(spark, sf_dir), range(2, 11), references=3)


@query("p04_spectral_clusters")
def spectral_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = C.similarity_edges(responses(spark, sf_dir), "customer", "v", 10)
    return C.spectral_clusters(edges, range(2, 11))


@query("p04_spectral_silhouettes")
def spectral_silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses(spark, sf_dir)
    edges = C.similarity_edges(rows, "customer", "v", 10)
    labels = C.spectral_columns(edges, range(2, 11)).withColumnRenamed("id", "customer")
    return B.mean_silhouettes(rows.join(labels, "customer"), "customer", "v", [f"clusters_{k}" for k in range(2, 11)])


@query("p05_agglomerative")
def agglomerative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.agglomerative(responses(spark, sf_dir), "customer", "v", range(2, 11))


_WARD = """pts AS (SELECT CAST(s_nationkey AS BIGINT) AS id, avg(s_acctbal) / 1000 AS x, count(*)::DOUBLE AS y FROM supplier GROUP BY 1),
s AS (SELECT list({'w': 1.0::DOUBLE, 'x': x, 'y': y, 'm': [id]} ORDER BY id) AS cl FROM pts
  UNION ALL
  SELECT list_append(list_filter(cl, lambda c, i: i <> p.i AND i <> p.j), {'w': cl[p.i].w + cl[p.j].w,
    'x': (cl[p.i].w * cl[p.i].x + cl[p.j].w * cl[p.j].x) / (cl[p.i].w + cl[p.j].w),
    'y': (cl[p.i].w * cl[p.i].y + cl[p.j].w * cl[p.j].y) / (cl[p.i].w + cl[p.j].w), 'm': list_concat(cl[p.i].m, cl[p.j].m)})
  FROM (SELECT cl, list_min(flatten(list_transform(range(1, len(cl)), lambda i: list_transform(range(i + 1, len(cl) + 1), lambda j:
    {'c': cl[i].w * cl[j].w / (cl[i].w + cl[j].w) * ((cl[i].x - cl[j].x) ** 2 + (cl[i].y - cl[j].y) ** 2), 'i': i, 'j': j})))) AS p
    FROM s WHERE len(cl) > 2)),
c AS (SELECT len(cl) AS k, unnest(cl).m AS m FROM s WHERE len(cl) <= 4),
n AS (SELECT k, m, row_number() OVER (PARTITION BY k ORDER BY list_min(m)) - 1 AS number FROM c),
u AS (SELECT k, number, unnest(m) AS nation FROM n)"""


@query("p05_ward_of_nations", f"WITH RECURSIVE {_WARD} " + "SELECT nation, " + ", ".join(
    f"CAST(max(number) FILTER (k = {k}) AS INTEGER) AS clusters_{k}" for k in (2, 3, 4)) + " FROM u GROUP BY 1")
def ward_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by mean balance and number of suppliers."""
    table = S.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("bigint").alias("nation"))
    points = table.agg(F.array(F.avg("s_acctbal") / 1000, F.count(F.lit(1)).cast("double")).alias("v"))
    return C.agglomerative(points, "nation", "v", [2, 3, 4])


@query("p05_agglomerative_silhouettes")
def agglomerative_silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses(spark, sf_dir)
    labels = C.agglomerative(rows, "customer", "v", range(2, 11))
    return B.mean_silhouettes(rows.join(labels, "customer"), "customer", "v", [f"clusters_{k}" for k in range(2, 11)])


@query("p05_bisecting")
def bisecting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.bisecting_kmeans(responses(spark, sf_dir), 5).select("customer", "cluster")


def _density_sql(points: str, key: str, distance: str, eps: float, least: int) -> str:
    return f"""WITH RECURSIVE {points},
nb AS (SELECT a.{key} AS a, b.{key} AS b FROM pts a CROSS JOIN pts b WHERE {distance} <= {eps}),
cr AS (SELECT a FROM nb GROUP BY 1 HAVING count(*) >= {least}),
ce AS (SELECT nb.a, nb.b FROM nb JOIN cr x ON nb.a = x.a JOIN cr y ON nb.b = y.a),
reach AS (SELECT a, a AS b FROM cr UNION SELECT r.a, ce.b FROM reach r JOIN ce ON r.b = ce.a),
lab AS (SELECT a, min(b) AS label FROM reach GROUP BY 1),
bord AS (SELECT nb.a, min(l.label) AS label FROM nb JOIN lab l ON nb.b = l.a WHERE nb.a NOT IN (SELECT a FROM cr) GROUP BY 1)
SELECT p.{key} AS {key}, p.{key} IN (SELECT a FROM cr) AS core, coalesce(l.label, o.label, -1) AS label
FROM pts p LEFT JOIN lab l ON p.{key} = l.a LEFT JOIN bord o ON p.{key} = o.a"""


@query("p06_density_2d", _density_sql(
    "pts AS (SELECT s_suppkey, s_acctbal / 1000 AS x, s_nationkey::DOUBLE AS y FROM supplier)", "s_suppkey",
    "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))", 1.3, 4))
def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = S.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.array(F.col("s_acctbal") / 1000, F.col("s_nationkey").cast("double")).alias("v")
    )
    return D.density_clusters(points, "s_suppkey", "v", eps=1.3, min_samples=4)


_RESPONSE_POINTS = S.TRANSACTIONS_SQL + """,
offs AS (SELECT unnest(range(1, 32)) AS o),
cu AS (SELECT DISTINCT customer FROM transactions),
pts AS (SELECT customer, list(CASE WHEN t.offer_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END ORDER BY o) AS v
  FROM (SELECT * FROM cu CROSS JOIN offs) g LEFT JOIN (SELECT DISTINCT customer AS c, offer_id FROM transactions) t
  ON g.customer = t.c AND g.o = t.offer_id GROUP BY 1)"""


@query("p06_density_responses", _density_sql(_RESPONSE_POINTS, "customer", "list_distance(a.v, b.v)", 3.1, 4))
def density_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.density_clusters(responses(spark, sf_dir), "customer", "v", eps=3.1, min_samples=4)


def _density_row(found: DataFrame, **settings) -> DataFrame:
    return found.agg(
        F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("clusters"),
        F.count_if("core").alias("core_rows"),
        F.count_if(F.col("label") == -1).alias("noise"),
    ).select(*[F.lit(v).alias(n) for n, v in settings.items()], "clusters", "core_rows", "noise")


@query("p06_density_sweep")
def density_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters, core rows, noise and silhouette for six radii and three neighbour counts."""
    base, parts, names, labels = responses(spark, sf_dir), None, [], None
    settings = [(eps, 5) for eps in (2.0, 2.4, 2.8, 3.2, 3.6, 4.0)] + [(3.1, least) for least in (2, 4, 8)]
    for i, (eps, least) in enumerate(settings):
        found = settle(D.density_clusters(base, "customer", "v", eps, least))
        part = _density_row(found, labeling=f"setting_{i}", eps=eps, min_samples=least)
        parts = part if parts is None else parts.unionByName(part)
        column = found.select("customer", F.col("label").alias(f"setting_{i}"))
        labels = column if labels is None else labels.join(column, "customer")
        names.append(f"setting_{i}")
    scored = B.mean_silhouettes(labels.join(base.select("customer", "v"), "customer"), "customer", "v", names)
    return parts.join(scored.select("labeling", "silhouette"), "labeling", "left").drop("labeling")


#: The dampings compared.
DAMPINGS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


@query("p07_affinity_propagation")
def affinity_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.affinity_propagation(responses(spark, sf_dir), "customer", "v", damping=0.5)


@query("p07_damping_sweep")
def damping_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sweep_damping(responses(spark, sf_dir), "customer", "v", DAMPINGS)


@query("p08_gaussian_mixture")
def gaussian_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = K.principal_scores(responses(spark, sf_dir), "features", 2).drop("features")
    placed = scores.withColumn("features", array_to_vector(F.array("pc1", "pc2")))
    return C.gaussian_mixture(placed, 4).select("customer", "cluster")


@query("p04_nearest_rows", """
WITH p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS INTEGER) AS rank, neighbour,
  round(d, 4) + 0.0::DOUBLE AS distance FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbour) <= 5""")
def nearest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbour graph that spectral clustering and affinity propagation stand on."""
    found = B.nearest(embedding_vectors(spark, sf_dir), "id", "v", 5)
    return found.select("id", "rank", "neighbour", tidy(F.col("distance")).alias("distance"))
