"""Periodic runs against brute force: many alphabets, messy rows, the planted query."""

import random

import brute
import numpy as np
import pytest
from corpora import documents, filler

from tabulon.llm import periods, queries
from tabulon.llm.hashing import U64, before, mix


def drawn(r):
    """Words over few letters: random, repeated pieces with cut ends, Fibonacci words with slips."""
    size, letters, kind = r.randint(0, 160), r.choice([1, 2, 2, 3, 5, 30]), r.random()
    if kind < 0.4:
        return [r.randrange(letters) for _ in range(size)]
    if kind < 0.7:
        out = []
        while len(out) < size:
            out += [r.randrange(letters) for _ in range(r.randint(1, 12))] * r.randint(1, 6)
            out = out[: len(out) - r.choice([0, 0, 1, 2, 3])]
        return out
    a, b = [0], [0, 1]
    for _ in range(r.randint(2, 9)):
        a, b = b, b + a
    out = b * r.randint(1, 3)
    for _ in range(r.randint(0, 3)):
        out[r.randrange(len(out))] = r.randrange(3)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(seed):
    r = random.Random(seed)
    for _ in range(60):
        texts = [drawn(r) for _ in range(8)]
        words = mix(np.array([x + 7 for t in texts for x in t], dtype=U64))
        row, *found = periods.runs_of(words, before(np.array([len(t) for t in texts])))
        got = [[] for _ in texts]
        for k, *run in zip(row.tolist(), *(x.tolist() for x in found)):
            got[k].append(tuple(run))
        assert got == [brute.runs(t) for t in texts]


def test_a_long_text_of_one_word():
    row, start, length, period = periods.runs_of(np.full(200_000, 5, U64), np.array([0, 200_000]))
    assert (row.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [200_000], [1])


def test_wavelet_tree_matches_sorting():
    r = np.random.default_rng(3)
    for n in (1, 5, 64, 200):
        values = r.permutation(3 * n)[:n]
        tree = periods.WaveletTree(values)
        lo = r.integers(0, n + 1, 300)
        hi = np.minimum(n, lo + r.integers(0, n + 1, 300))
        limit = r.integers(0, 4 * n + 2, 300)
        want = [min((v for v in values[a:b].tolist() if v >= c), default=-1) for a, b, c in zip(lo, hi, limit)]
        assert tree.successor(lo, hi, limit, -1).tolist() == want


def test_messy_rows(spark, messy, messy_rows, nothing):
    tail = " ".join(["again and again"] * 9)
    extra = [(20, tail), (20, tail), (21, filler(5, 50) + " " + tail), (22, "w " * 5000), (None, tail)]
    rows = messy_rows + extra
    got = periods.periodic_runs(documents(spark, rows)).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    have = [(r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got]
    want = []
    for i, t in rows:
        w = brute.words(t)
        found = brute.runs(w) if len(w) < 10_000 else []
        want.append((i, len(w), tuple(found), brute.without_runs(w, found)))
    assert sorted(have, key=key) == sorted(want, key=key)
    assert sum(bool(x[2]) for x in want) >= 5
    assert periods.periodic_runs(nothing).count() == 0


def test_the_query_on_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    with_runs = 0
    for i, t in rows:
        w = brute.with_repeats(i, t)
        found = brute.runs(w)
        with_runs += bool(found)
        r = got[i]
        best = max(found, key=lambda x: (x[1], -x[0], -x[2])) if found else (None,) * 3
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r["collapsed_sha256"] == brute.sha(brute.without_runs(w, found))
    assert with_runs >= 10
