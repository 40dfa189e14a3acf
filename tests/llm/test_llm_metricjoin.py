"""Range join of vectors against all pairs: background, clusters, copies, borders, messy rows."""

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import metricjoin, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, g string, node int, cell string, key int, weight int, v string, copy int"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, g, "g", 1, "c", 2, 3, "v", 4) for k, v, g in rows], SCHEMA)


def drawn(seed, width, groups=2, spread=120):
    r = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        for x in r.normal(size=(spread, width)):
            rows.append((x, g))
        for size in (1, 3, 40, 70):
            centre = r.normal(size=width)
            for step in r.normal(size=(size, width)) * r.uniform(0.02, 0.3):
                rows.append((centre + step, g))
        chain = r.normal(size=width)
        turn = r.normal(size=width)
        for k in range(25):
            rows.append((chain * math.cos(k * 0.2) + turn * math.sin(k * 0.2), g))
    order = r.permutation(len(rows))
    return [(int(k), [float(np.float32(x)) for x in rows[i][0]], rows[i][1]) for k, i in enumerate(order)]


def same(found, rows, limit=0.93):
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found.collect())
    assert got == sorted(brute.vector_links(rows, limit))


@pytest.mark.parametrize("width,limit", [(2, 0.93), (8, 0.93), (64, 0.93), (3, 0.5)])
def test_links_match_all_pairs(spark, monkeypatch, width, limit):
    """Several rounds of pivots, closed cells and guests, blocks of a few vectors."""
    monkeypatch.setattr(metricjoin, "CELL", 30)
    monkeypatch.setattr(metricjoin, "BLOCK", 25)
    monkeypatch.setattr(metricjoin, "MOST_BLOCK", 40)
    rows = drawn(width, width)
    same(metricjoin.linked(vectors(spark, rows), limit), rows, limit)


def test_pivots_close_cells(spark, monkeypatch):
    """Clusters leave the common cell, so that fewer pairs are compared; the hot one is not compared at all."""
    monkeypatch.setattr(metricjoin, "CELL", 30)
    r = np.random.default_rng(4)
    centre = r.normal(size=16)
    rows = [(k, (centre + x).tolist(), 0) for k, x in enumerate(r.normal(size=(300, 16)) * 0.02)]
    rows += [(1000 + k, x.tolist(), 0) for k, x in enumerate(r.normal(size=(100, 16)))]
    table = spark.createDataFrame([("0:16", k, 1, v) for k, v, _ in rows], metricjoin.VECTOR)
    dealt = metricjoin._cells(table, math.acos(0.93)).collect()
    own = [x for x in dealt if x["own"]]
    assert len(own) == 400 and sum(x["dense"] for x in own) >= 300
    assert len(dealt) < 700
    same(metricjoin.linked(vectors(spark, rows), 0.93), [(k, [float(np.float32(x)) for x in v], g) for k, v, g in rows])


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (None, [1.0, 0.0], 0),
        (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0, 0.0], 0),
        (12, [-1.0, -0.0], 0), (13, [1e-30, 0.0], 0), (14, [3e38, 1e38], 0), (15, [1.0, 0.0], 1), (15, [0.0, 1.0], 1), (16, [0.0, 1.0], 1),
    ]
    rows = [(k, v and [x if x is None else float(np.float32(x)) for x in v], g) for k, v, g in rows]
    show = lambda x: tuple((y is None, y) for y in x)
    found = metricjoin.linked(vectors(spark, rows), 0.93).collect()
    want = brute.vector_links(rows, 0.93)
    assert sorted((tuple(r) for r in found), key=show) == sorted(want, key=show)
    assert metricjoin.linked(vectors(spark, rows).where(F.lit(False)), 0.93).count() == 0
    with pytest.raises(ValueError):
        metricjoin.linked(vectors(spark, rows), 0.0)


def test_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(queries.op12_embedding_near_dedup(spark, folder), rows)
