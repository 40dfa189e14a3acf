import glob
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulon.functions import vectors
from tabulon.operators import affinity, clustering as C, density as D, evaluate as M, neighbours as B, pivots, ward
from tabulon.session import scratch_path

BLOBS = [(x + dx, y + dy) for x, y in ((0, 0), (10, 0), (0, 10)) for dx, dy in ((0, 0), (0.5, 0), (0, 0.5), (0.5, 0.5), (0.25, 0.25))]


def points(spark, values, extra=()):
    rows = [(i, [float(v) for v in p], i // 5) for i, p in enumerate([*values, *extra])]
    return spark.createDataFrame(rows, "id bigint, v array<double>, truth int")


def brute_density(x, eps, least):
    x = np.asarray(x, dtype=float)
    close = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = close.sum(1) >= least
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        todo, label[i] = [i], i
        while todo:
            for j in np.flatnonzero(close[todo.pop()] & core):
                if label[j] < 0:
                    label[j] = i
                    todo.append(j)
    for i in np.flatnonzero(~core):
        near = label[close[i] & core]
        label[i] = near.min() if len(near) else -1
    return core, label


def test_planted_blobs(spark):
    df = points(spark, BLOBS, [(50, 50)])
    found = D.density_clusters(df, "id", "v", eps=1.0, min_samples=3)
    labels = {r["id"]: r["label"] for r in found.collect()}
    assert labels[15] == -1 and {labels[i] for i in range(5)} == {0} and set(labels.values()) == {0, 5, 10, -1}
    features = points(spark, BLOBS).withColumn("features", array_to_vector("v"))
    agreement = M.labeling_agreement(C.kmeans(features, 3), "truth", "cluster").first()
    assert agreement["adjusted_rand"] == 1.0
    ward = C.agglomerative(points(spark, BLOBS), "id", "v", [2, 3]).join(points(spark, BLOBS), "id")
    assert M.labeling_agreement(ward, "truth", "clusters_3").first()["adjusted_rand"] == 1.0


@pytest.mark.parametrize("width,eps,least", [(1, 0.02, 4), (2, 0.6, 4), (3, 1.2, 3), (6, 2.3, 4)])
def test_density_matches_brute_force_over_many_blocks(spark, width, eps, least):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(160, width))
    x[:60] = np.round(x[:60], 1) * 0.2  # a hot region with copies
    if width == 2:
        x[60:100] = rng.uniform(0, 1, size=(40, 2)) + [[3.0, 0.0]]  # two dense areas just out of reach
        x[100:140] = rng.uniform(0, 1, size=(40, 2)) + [[4.62, 0.0]]
    df = points(spark, x.tolist())
    core, label = brute_density(x, eps, least)
    found = {r["id"]: (r["core"], r["label"]) for r in D.density_clusters(df, "id", "v", eps, least, block_rows=15).collect()}
    assert len(found) == 160
    assert [found[i][0] for i in range(160)] == core.tolist()
    assert [found[i][1] for i in range(160)] == label.tolist()


def test_long_chain_is_one_cluster(spark):
    df = points(spark, [(i * 0.9,) for i in range(300)])
    found = D.density_clusters(df, "id", "v", eps=1.0, min_samples=2, block_rows=10)
    assert found.where("label = 0").count() == 300


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_silhouette_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(0)
    x, c = rng.normal(size=(40, 3)), np.array([0] * 15 + [1] * 24 + [2])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    expected = []
    for i in range(40):
        own = c == c[i]
        if own.sum() == 1:
            expected.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        expected.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, x[i].tolist(), int(c[i])) for i in range(40)], "id bigint, v array<double>, c int")
    found = {r["id"]: r["silhouette"] for r in B.silhouette(df, "id", "v", "c", block_rows).collect()}
    assert [found[i] for i in range(40)] == pytest.approx(expected, abs=1e-9)


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    df = points(spark, x.tolist())
    found = B.nearest(df, "id", "v", 3, block_rows=9).collect()
    assert len(found) == 150
    for r in found:
        assert np.argsort(d[r["id"]])[r["rank"] - 1] == r["neighbour"]


def brute_ward(x, w, ks):
    """One cheapest merge at a time."""
    n, w, c, label, out = len(x), w.astype(float).copy(), x.astype(float).copy(), np.arange(len(x)), {}
    alive = np.ones(n, bool)

    def cost_to(i):
        gap = ((c - c[i]) ** 2).sum(1) * w * w[i] / (w + w[i])
        gap[i] = np.inf
        gap[~alive] = np.inf
        return gap

    cost = np.stack([cost_to(i) for i in range(n)])
    for left in range(n, 0, -1):
        if left in ks:
            out[left] = label.copy()
        if left == 1:
            return out
        i, j = sorted(divmod(int(np.argmin(cost)), n))
        c[i] = (w[i] * c[i] + w[j] * c[j]) / (w[i] + w[j])
        w[i] += w[j]
        alive[j] = False
        label[label == j] = i
        cost[j, :] = cost[:, j] = np.inf
        cost[i, :] = cost[:, i] = cost_to(i)


@pytest.mark.parametrize("size,finish,block_rows", [(260, 110, 40), (900, None, 10_000), (1100, None, 10_000)])
def test_ward_matches_one_by_one_merging(spark, size, finish, block_rows):
    """Rounds of mutual nearest pairs in Spark, then in one table; copies are one weighted point."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(size, 5)) + rng.integers(0, 4, size=(size, 1)) * 2
    copies = [0, 0, 0, 7, 9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*x.tolist(), *x[copies].tolist()])], "id bigint, v array<double>")
    ks = [2, 3, 7, 10]
    weights = np.ones(size) + np.bincount(copies, minlength=size)
    expected = brute_ward(x, weights, ks)
    found = ward.labels(df, "id", "v", ks, finish=finish, block_rows=block_rows).orderBy("id").collect()
    assert len(found) == size + len(copies)
    for k in ks:
        pairs = {(a, r[f"clusters_{k}"]) for a, r in zip([*expected[k], *expected[k][copies]], found)}
        assert len(pairs) == k
        firsts = [min(r["id"] for r in found if r[f"clusters_{k}"] == n) for n in range(k)]
        assert firsts == sorted(firsts)


def test_ward_with_ties_and_few_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, size=(200, 9)).astype(float)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id bigint, v array<double>")
    found = ward.labels(df, "id", "v", [2, 5], finish=60, block_rows=50).collect()
    assert len(found) == 200 and {r["clusters_5"] for r in found} == set(range(5))
    few = C.agglomerative(points(spark, [(0, 0), (0, 0), (5, 5)]), "id", "v", [2, 4]).orderBy("id").collect()
    assert [r["clusters_2"] for r in few] == [0, 0, 1] and [r["clusters_4"] for r in few] == [0, 0, 1]
    none = points(spark, [(0, 0)]).where("false")
    assert C.agglomerative(none, "id", "v", [2]).count() == 0


def dense_affinity(s, damping, rounds):
    n = len(s)
    r, a = np.zeros((n, n)), np.zeros((n, n))
    for _ in range(rounds):
        m = a + s
        first = m.argmax(1)
        best = m.max(1)
        m[np.arange(n), first] = -np.inf
        second = m.max(1)
        rival = np.repeat(best[:, None], n, 1)
        rival[np.arange(n), first] = second
        r = damping * r + (1 - damping) * (s - rival)
        rp = np.maximum(r, 0)
        np.fill_diagonal(rp, np.diag(r))
        new = rp.sum(0)[None] - rp
        diagonal = np.diag(new).copy()
        new = np.minimum(new, 0)
        np.fill_diagonal(new, diagonal)
        a = damping * a + (1 - damping) * new
    return np.flatnonzero(np.diag(r) + np.diag(a) > 0)


def test_affinity_matches_the_dense_algorithm(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.3, size=(6, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    s = -((x[:, None] - x[None]) ** 2).sum(-1)
    off = s[~np.eye(len(x), dtype=bool)]
    np.fill_diagonal(s, np.median(off))
    expected = dense_affinity(s, 0.5, 200)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    found = C.affinity_propagation(df, "id", "v", 0.5).collect()
    assert len(found) == len(x) and all(r["converged"] for r in found)
    assert sorted({r["exemplar"] for r in found}) == expected.tolist()
    for r in found:
        near = expected[np.argmin(((x[expected] - x[r["id"]]) ** 2).sum(1))]
        assert near == r["exemplar"]


def test_affinity_keeps_few_pairs(spark, monkeypatch):
    """Rows in many strips, two dampings at once: as the dense algorithm, without a list of all pairs."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.6, size=(20, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    s = -((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(s, np.median(s[~np.eye(len(x), dtype=bool)]))
    asked, paths = [], []
    monkeypatch.setattr(affinity, "STRIP_ROWS", 7)
    monkeypatch.setattr(C, "nearest", lambda *a, **k: asked.append(a[3]) or B.nearest(*a, **k))
    monkeypatch.setattr(affinity, "scratch_path", lambda spark, name: paths.append(scratch_path(spark, name)) or paths[-1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    found = C.affinity_sweep(df, "id", "v", [0.5, 0.7], max_iter=30).collect()
    assert len(found) == 2 * len(x) and set(asked) == {1}
    for damping in (0.5, 0.7):
        assert sorted({r["exemplar"] for r in found if r["damping"] == damping}) == dense_affinity(s, damping, 30).tolist()
    kept = spark.read.schema(affinity.STEP).parquet(paths[0]).where("row is not null").selectExpr("sum(length(row)) / 8 n").first()["n"]
    assert 0 < kept < len(x) * len(x)


def test_affinity_rounds_leave_no_shuffles(spark):
    """What the rounds shuffle goes with each round, whenever the driver collects garbage; settings stay as they were."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in disks.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}
    rows = spark.createDataFrame([(i, [float(i % 7), float(i)]) for i in range(30)], "i bigint, v array<double>").checkpoint()
    made, before, setting = [], files(), spark.conf.get(name)
    for rounds in (5, 20):
        affinity.exemplars(rows, [0.5, 0.9], -4.0, rounds, 100)
        made.append(len(files() - before))
        before = files()
    assert made[1] <= made[0] + 3 and spark.conf.get(name) == setting


def test_affinity_ends_one_damping_before_another(spark, monkeypatch):
    """A damping that has ended keeps no pairs; groups of columns and the few that fill none are read alike."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.4, size=(25, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    s = -((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(s, np.median(s[~np.eye(len(x), dtype=bool)]))
    kept, run = [], affinity._step
    monkeypatch.setattr(affinity, "STRIP_ROWS", 40)
    monkeypatch.setattr(affinity, "_step", lambda dampings, live, *rest: kept.append(list(live)) or run(dampings, live, *rest))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    found = C.affinity_sweep(df, "id", "v", [0.5, 0.9], max_iter=200).collect()
    assert [0, 1] in kept and kept[-1] in ([0], [1]) and all(r["converged"] for r in found)
    for damping in (0.5, 0.9):
        assert sorted({r["exemplar"] for r in found if r["damping"] == damping}) == dense_affinity(s, damping, 200).tolist()


def test_affinity_median_and_shift(spark):
    """Whole numbers and others; the shift of a pair is that of Spark's hash, a null key keeps the hash of the row."""
    rng = np.random.default_rng(5)
    for x in (rng.integers(0, 4, (33, 10)).astype(float), rng.normal(size=(34, 11)) + 50):
        seeds = np.zeros(len(x), np.int64)
        left = {"chunk": 0, "code": seeds.tobytes(), "seed": seeds.tobytes(), "named": (seeds == 0).tobytes(), "v": x.tobytes()}
        fixed = spark.createDataFrame([left], affinity.PACKED).withColumn("block", F.lit(0).cast("bigint"))
        off = -((x[:, None] - x[None]) ** 2).sum(-1)[~np.eye(len(x), dtype=bool)]
        assert np.isclose(affinity._median(fixed, len(x), len(off)), np.median(off), rtol=1e-12)
    keys = [0, 1, -5, 1 << 40, None]
    pairs = spark.createDataFrame([(a, b) for a in keys for b in keys], "i bigint, k bigint")
    rows = pairs.selectExpr("xxhash64(i) seed", "coalesce(k, 0) code", "k is not null named", "1.0D + pmod(xxhash64(i, k), 1000) * 1e-12D f").toPandas()
    got = affinity.shift(*[rows[c].to_numpy() for c in ("seed", "code", "named")])
    assert got.tolist() == rows["f"].tolist()


def test_affinity_with_a_row_without_key(spark):
    rows = [(i, v) for i, (_, v) in enumerate(points(spark, BLOBS).select("id", "v").collect())] + [(None, [0.0] * 2)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    found = C.affinity_propagation(df, "id", "v", 0.5, max_iter=10).collect()
    assert len(found) == len(rows) and [r["id"] for r in found if r["exemplar"] is None] == [None]


def test_spectral_splits_two_groups(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.2, size=(15, 2)) for c in ((0, 0), (4, 4))])
    df = spark.createDataFrame([(i, v.tolist(), i // 15) for i, v in enumerate(x)], "id bigint, v array<double>, truth int")
    edges = C.similarity_edges(df, "id", "v", 20, gamma=0.05)
    found = C.spectral_clusters(edges, [2], max_iter=20).join(df, "id")
    assert M.labeling_agreement(found, "truth", "cluster").first()["adjusted_rand"] > 0.8


def test_a_far_row_stays_in_the_graph(spark):
    df = spark.createDataFrame([(i, [float(i % 5), 0.0]) for i in range(10)] + [(99, [1e4, 1e4])], "id bigint, v array<double>")
    edges = C.similarity_edges(df, "id", "v", 3)
    assert edges.where("(src = 99 or dst = 99) and weight > 0").count() == 3
    assert C.spectral_clusters(edges, [2]).select("id").distinct().count() == 11


def test_affinity_says_when_it_did_not_settle(spark):
    df = points(spark, BLOBS)
    assert not C.affinity_propagation(df, "id", "v", 0.5, max_iter=5).first()["converged"]
    with pytest.raises(ValueError):
        C.affinity_propagation(df, "id", "v", 0.5, neighbours=3)


def test_sweep_and_gap(spark):
    df = points(spark, BLOBS).withColumn("features", array_to_vector("v"))
    sweep = {r["k"]: r for r in C.sweep_k(df, "id", [2, 3, 4], with_silhouette=True).collect()}
    assert sweep[3]["sse"] < 3 < sweep[2]["sse"] and sweep[3]["silhouette"] > 0.9
    gaps = {r["k"]: r["chosen"] for r in C.gap_statistic(df, [2, 3, 4], 2).collect()}
    assert gaps[3]


def test_assign_prefers_the_lower_number_on_ties(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 0.0])], "id int, v array<double>")
    rows = {r["id"]: (r["cluster"], r["sq_distance"]) for r in C.assign(df, "v", [[1.0, 0.0], [-1.0, 0.0], [3.0, 1.0]]).collect()}
    assert rows == {1: (0, 1.0), 2: (2, 1.0)}


def test_connected_labels(spark):
    nodes = spark.range(6).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(5, 4), (4, 3), (1, 0)], "a bigint, b bigint")
    labels = {r["node"]: r["label"] for r in D.connected_labels(nodes, edges).collect()}
    assert labels == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 3}


@pytest.mark.parametrize("width", [2, 12])
def test_nearest_by_pivots(spark, monkeypatch, width):
    """Exact over many cells, also with a filter and ties; clustered rows visit few cells."""
    rng = np.random.default_rng(width)
    x = np.round(rng.normal(size=(30, width)) * 20, 0)[rng.integers(0, 30, 600)] + np.round(rng.normal(size=(600, width)) * 0.3, 2)
    rows = [(i, v, i % 3 > 0) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, ok boolean")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for among in (None, "ok"):
        found = B.nearest(df, "id", "v", 4, among=among, cell_rows=25).collect()
        got = {(r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in found}
        assert len(got) == 2400
        for i in range(600):
            order = [j for j in np.lexsort((np.arange(600), d[i])) if j != i and (among is None or j % 3 > 0)][:4]
            assert [got[i, k + 1][0] for k in range(4)] == order
            assert np.allclose([got[i, k + 1][1] for k in range(4)], d[i, order])
    base = df.select(df["id"].alias("key"), "v")
    index = pivots.PivotIndex(base, 25)
    cells = index.placed.select("cell").distinct().count()
    assert cells > 15
    reach = index.place(base).selectExpr("*", "2.0D AS reach")
    assert index.visits(reach, "reach").count() < 600 * cells / 10
    empty = df.where("false")
    assert B.nearest(empty, "id", "v", 2).count() == 0


def test_silhouette_measures_only_clusters_that_can_be_nearest(spark):
    """Exact with clusters left out: own and nearest ones are a small part of all pairs."""
    rng = np.random.default_rng(6)
    c = rng.integers(0, 20, 400)
    x = rng.normal(size=(20, 3))[c] * 40 + rng.normal(size=(400, 3))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    df = spark.createDataFrame([(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), c))], "id bigint, v array<double>, c int")
    base = df.selectExpr("id AS key", "v", "CAST(c AS BIGINT) AS c0")
    visits = B._possible_clusters(base, ["c0"])
    sizes = np.bincount(c)
    assert sum(sizes[r["other"]] for r in visits.collect()) < 400 * 400 / 5
    found = {r["id"]: r["silhouette"] for r in B.silhouette(df, "id", "v", "c", 30).collect()}
    for i in range(400):
        means = np.array([d[i, c == k].sum() / (sizes[k] - (k == c[i])) for k in range(20)])
        a, b = means[c[i]], np.delete(means, c[i]).min()
        assert found[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
    assert B._possible_clusters(base.selectExpr("key", "v", "key % 2 AS c0"), ["c0"]) is None


def test_squared_silhouettes_in_several_passes(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=3) + 4 * (i % 11)).tolist(), i % 11) for i in range(300)] + [(300, [99.0, 0.0, 0.0], 50)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, c int")
    x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    expected = []
    for i in range(len(x)):
        own = c == c[i]
        a = d[i, own].sum() / max(own.sum() - 1, 1)
        b = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        expected.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
    for at_once in (4, 5, 10_000):
        got = [r["silhouette"] for r in B.squared_silhouette(df, "id", "v", "c", at_once).orderBy("id").collect()]
        assert got == pytest.approx(expected)
    assert B.squared_silhouette(df.limit(0), "id", "v", "c").count() == 0


def test_rounds_of_ward_keep_tables_small(spark, capsys):
    """Neither the partitions nor the estimated size may multiply from round to round."""
    rng = np.random.default_rng(3)
    rows = [(i, 1.0, v, None, None, None) for i, v in enumerate(rng.normal(size=(150, 4)).tolist())]
    live = spark.createDataFrame(rows, "id bigint, w double, c array<double>, cost double, drawn bigint, other bigint")
    for _ in range(3):
        live, _ = ward._round(live, 10_000)
    live.explain("cost")
    units = re.findall(r"sizeInBytes=\S+ (\w+)", capsys.readouterr().out)
    assert set(units) <= {"B", "KiB"} and live.rdd.getNumPartitions() <= 16


@pytest.mark.parametrize("reach", [2.0, 3.0, 5.0**0.5])
def test_whole_numbers_within_reach(reach):
    """Exact at the limit, without measuring again: whole numbers, and others that are."""
    rng = np.random.default_rng(4)
    for x in (rng.integers(0, 2, size=(90, 31)).astype(float), rng.integers(0, 2, size=(90, 31)) * 0.1, rng.normal(size=(90, 2))):
        d = np.sqrt(((x[:40, None] - x[None]) ** 2).sum(-1))
        got = np.concatenate([close for _, close in vectors.within_tiles(x[:40], x, reach)])
        assert (got == (d <= reach)).all()
        assert np.allclose(np.concatenate([m for _, m in vectors.distance_tiles(x[:40], x)]), d, atol=1e-7)


def test_core_links_of_dense_blocks_span_every_cluster(spark):
    """Binary vectors with many pairs at the limit, copies and noise, against brute force."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, size=(220, 12)) * (rng.random((220, 1)) < 0.8) + np.eye(12)[rng.integers(0, 12, 220)] * 4
    core, label = brute_density(x, 1.0, 4)
    assert 1 < len(set(label[core]))
    found = {r["id"]: (r["core"], r["label"]) for r in D.density_clusters(points(spark, x.tolist()), "id", "v", 1.0, 4, block_rows=50).collect()}
    assert [found[i] for i in range(220)] == list(zip(core.tolist(), label.tolist()))


def test_many_ties_go_to_the_smaller_keys(spark):
    """More rows at the same distance than any fixed number of spare candidates, told apart only by rounding."""
    x = [[0.0] * 12, *[v for v in (np.array(list(itertools.permutations([0.1, 0.3, 0.7])))[:, [0, 1, 2] * 4] * 1.1).tolist() for _ in range(12)]]
    x += [list(np.roll(v, 1)) for v in x[1:]]
    found = B.nearest(points(spark, x), "id", "v", 3).where("id = 0").orderBy("rank").collect()
    d = np.sqrt((np.array(x) ** 2).sum(1))
    order = [i for i in np.lexsort((np.arange(len(x)), d)) if i][:3]
    assert [r["neighbour"] for r in found] == order


def test_silhouettes_of_several_labelings_with_copies_and_nulls(spark):
    """One round of distances for all labelings; copies are one weighted point; rows without a cluster are in none."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(30, 10))
    x = base[rng.integers(0, 30, 120)]
    a, b = rng.integers(0, 3, 120), rng.integers(0, 4, 120)
    rows = [(i, x[i].tolist(), int(a[i]), int(b[i]) if b[i] < 3 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, a int, b int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    found = {(r["id"], r["labeling"]): r["silhouette"] for r in B.silhouettes(df, "id", "v", ["a", "b"], 25).collect()}
    assert len(found) == 240
    for name, c in (("a", a), ("b", b)):
        for i in range(120):
            if name == "b" and c[i] == 3:
                assert found[i, name] == 0.0
                continue
            own = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
            other = min(d[i, c == k].mean() for k in range(3) if k != c[i])
            assert found[i, name] == pytest.approx((other - own) / max(own, other), abs=1e-6)


def test_ward_compares_blocks_in_small_tables():
    import tracemalloc

    rng = np.random.default_rng(3)
    left, right = (rng.integers(0, 2, (n, 31)).astype(float) for n in (1000, 10_000))
    weights = rng.integers(1, 4, 11_000).astype(float)
    tracemalloc.start()
    cost, _, other = ward._nearest(np.arange(1000), weights[:1000], left, np.arange(1000, 11_000), weights[1000:], right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6
    for i in range(0, 1000, 97):
        exact = weights[i] * weights[1000:] / (weights[i] + weights[1000:]) * ((left[i] - right) ** 2).sum(axis=1)
        assert cost[i] == pytest.approx(exact.min()) and exact[other[i] - 1000] == pytest.approx(exact.min())


def test_comparisons_in_passes_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    wide = spark.createDataFrame([(i, [float(v) for v in rng.integers(0, 4, 6)]) for i in range(260)], "id bigint, v array<double>")
    labels = wide.withColumns({"a": F.col("id") % 3, "b": F.col("id") % 7})

    def answers():
        ended = [
            B.nearest(wide, "id", "v", 4, block_rows=60, cell_rows=40),
            ward.labels(wide, "id", "v", [2, 5], finish=20, block_rows=60),
            D.density_clusters(wide, "id", "v", 1.6, 3, block_rows=60),
            B.silhouettes(labels, "id", "v", ["a", "b"], block_rows=60),
        ]
        return [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()) for df in ended]

    expected, kept = answers(), []
    write = B.written
    monkeypatch.setattr(B, "written", lambda df: kept.append(1) or write(df))
    monkeypatch.setattr(B, "PASS_ROWS", 1200)
    assert answers() == expected
    assert len(kept) > 5


def test_visits_of_nearest_rows_go_in_passes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    far = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=12)]) for i in range(200)], "id bigint, v array<double>")
    whole = pivots.PivotIndex.visits
    sizes = []

    def visited(self, targets, reach, columns=None):
        found = whole(self, targets, reach, columns)
        sizes.append((len(found.columns), found.count()))
        return found

    monkeypatch.setattr(pivots.PivotIndex, "visits", visited)
    expected = sorted(tuple(r) for r in B.nearest(far, "id", "v", 3, cell_rows=25).collect())
    once = max(n for _, n in sizes)
    sizes.clear()
    monkeypatch.setattr(B, "PASS_ROWS", 300)
    assert sorted(tuple(r) for r in B.nearest(far, "id", "v", 3, cell_rows=25).collect()) == expected
    written = [n for width, n in sizes if width > 1]
    assert sum(written) == once and max(written) < 2 * 300
