"""Whitening and hard negatives against brute force and on edge cases."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from compare import differences, oracle_connection
from pyspark.sql import functions as F

from pavilion.llm import hard_negatives, queries, whitening

FOLDER = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def exact_covariance(x):
    """Covariance of distinct whole-number vectors as fractions, and the sums."""
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(d)]
    mean = [Fraction(t, n) for t in s]
    return [[sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n for j in range(d)] for i in range(d)], n, s


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    x = {r.vec_id: [math.floor(64 * float(c)) + 1000000 for c in r.embedding] for r in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))))
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s).astype(np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    found = queries.op12_refined_whitening(spark, FOLDER).collect()
    assert len(found) == 16 * len(x)
    told = {(r.vec_id, r.component): r for r in found}
    signs = {}
    for i, v in x.items():
        white = (np.array(v) - s / n) @ vectors / np.sqrt(values)
        deviation = sum((n * a - b) ** 2 for a, b in zip(v, s.tolist(), strict=True))
        for c in range(16):
            r = told[i, c + 1]
            sign = signs.setdefault(c, 1 if r.whitened * white[c] > 0 else -1)
            assert abs(r.whitened * sign - white[c]) < 1e-8
            assert r.n == n and r.deviation == deviation
            assert abs(r.explained - values[c] / (centred**2).sum() * n) < 1e-12
            assert r.identity_error < 1e-10


def test_whitening_at_the_edges(spark):
    kind = "vec_id long, embedding array<double>, x string, z string"
    rows = [
        (1, [0.5, 1.0, 2.0], "", ""), (2, [0.5, -1.0, 2.0], "", ""), (2, [0.5, -1.0, 2.0], "", ""), (3, None, "", ""),
        (4, [0.5, None, 1.0], "", ""), (5, [NAN, 0.0, 1.0], "", ""), (6, [INF, 0.0, 1.0], "", ""), (7, [], "", ""),
        (8, [1.0], "", ""), (None, [0.5, 3.0, 2.0], "", ""), (9, [1e300, 0.0, 0.0], None, None),
    ]
    df = spark.createDataFrame(rows, kind)
    found = whitening.whitened(df).collect()
    assert len(found) == 4 * 3 and {r.n for r in found} == {3}
    assert sorted((r.vec_id or 0) for r in found) == sorted([1, 2, 2, 0] * 3)
    assert {r.whitened is None for r in found if r.component > 1} == {True}
    assert {r.explained for r in found} == {1.0, 0.0} and found[0].identity_error < 1e-12
    by_id = {r.vec_id: r.whitened for r in found if r.component == 1}
    # -64, 64 and 192 around 64, at a variance of 2 / 3 * 128 ** 2.
    assert abs(by_id[1]) < 1e-12 and abs(abs(by_id[2]) - math.sqrt(1.5)) < 1e-12 and abs(by_id[2] + by_id[None]) < 1e-12
    assert whitening.whitened(df.where("false")).count() == 0
    assert whitening.whitened(df.where("embedding IS NULL")).count() == 0
    one = whitening.whitened(df.where("vec_id = 1")).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in one] == [(None, None, 0, 0.0)] * 3
    with pytest.raises(ValueError, match="component"):
        whitening.whitened(df.withColumnRenamed("vec_id", "component"), id_column="component")


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(i, [float(i * 2**40), float(-i * i)]) for i in range(50)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = {i: [64 * int(a) + 10**6, 64 * int(b) + 10**6] for i, (a, b) in rows}
    s = [sum(v[k] for v in x.values()) for k in range(2)]
    for r in found:
        assert int(r.deviation) == sum((50 * a - b) ** 2 for a, b in zip(x[r.vec_id], s, strict=True))


def rotation(rng, d):
    return np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.longdouble)


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 1], [5, 5, 5, 1, 1], [1, 1 + 1e-9, 1 + 2e-9, 1e-6, 0], [2 + 1e-12, 2, 1 + 1e-7, 1, 1 - 1e-7], [0, 0, 0, 0, 0],
        [1e9, 1e9 + 1e-3, 1, 1e-3, 1e-9],
    ],
)
def test_refinement_of_clustered_values(values):
    rng = np.random.default_rng(1)
    q = rotation(rng, len(values))
    for _ in range(3):  # orthonormal beyond double precision
        q = q + q @ ((np.eye(len(values)) - q.T @ q) / 2)
    a = q @ np.diag(np.array(values, dtype=np.longdouble)) @ q.T
    a = (a + a.T) / 2
    x, found = whitening.eigenvectors(a)
    size = max(values) or 1
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(found - np.sort(np.array(values, dtype=np.longdouble))[::-1]).max() < 1e-17 * size
    assert np.abs(a @ x - x * found).max() < 1e-16 * size
    # Vectors whose value stands apart by a part in a million and more are found to double precision.
    for i, v in enumerate(found):
        gap = min(abs(v - w) for j, w in enumerate(found) if j != i)
        if gap > 1e-6 * size:
            own = q[:, int(np.abs(np.array(values) - float(v)).argmin())]
            assert 1 - abs(own @ x[:, i]) < 1e-15


def test_refinement_beats_single_precision():
    rng = np.random.default_rng(2)
    y = rng.integers(-50, 50, (400, 32))
    cov, _, _ = exact_covariance(y.tolist())
    a = np.array([[np.longdouble(c.numerator) / np.longdouble(c.denominator) for c in row] for row in cov])
    x, values = whitening.eigenvectors(a)
    assert np.abs(a @ x - x * values).max() < 1e-15 * values[0]
    off = x.T @ a @ x
    assert np.abs(off - np.diag(np.diag(off))).max() < 1e-15 * values[0]


# ---- hard negatives ---------------------------------------------------------


def brute_force(rows, anchors, scale=256, k=5, m=10, window=(30, 90)):
    usable = [(i, lab, [math.floor(scale * c) for c in v]) for i, lab, v in rows]
    out = set()
    for a, (ai, alab, ax) in enumerate(usable):
        if not anchors(ai):
            continue
        scores = [(sum(p * q for p, q in zip(ax, x, strict=True)), i, lab) for b, (i, lab, x) in enumerate(usable) if b != a]
        for p, pi, _ in sorted((t for t in scores if t[2] == alab), key=lambda t: (-t[0], t[1]))[:k]:
            inside = [t for t in scores if t[2] != alab and window[0] * p <= 100 * t[0] <= window[1] * p]
            for rank, (s, i, _) in enumerate(sorted(inside, key=lambda t: (-t[0], t[1]))[:m], 1):
                out.add((ai, pi, rank, i, p, s))
    return out


def test_hard_negatives_of_the_table(spark):
    name = "op13_hyperplane_negatives"
    assert differences(queries.QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), queries.ORACLES[name]) == []


@pytest.mark.parametrize("sizes", [(16, 32, 4, 8), (4, 1 << 20, 1000, 1)])
def test_small_leaves_hot_leaves_and_ties(spark, monkeypatch, sizes):
    """Clusters, a third of the rows equal, and scores that tie; many leaves and parts, or blocks of a single row."""
    for name, value in zip(("LEAF_ROWS", "PART_ROWS", "BLOCK_ROWS", "ANCHORS"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 6))
    rows = [(i, int(rng.integers(3)), (centres[i % 12] + 0.2 * rng.standard_normal(6)).round(1).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 3, [0.5, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 25 == 0, sample=300)
    found = [tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(found) == len(set(found)) and set(found) == brute_force(rows, lambda i: i % 25 == 0)


def test_the_tree_leaves_out_what_windows_cannot_reach(monkeypatch):
    """In few dimensions most leaves are never searched, and none that holds a row of the window."""
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 16)
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.standard_normal((4000, 3))).astype(np.float64)
    tree = hard_negatives._fitted(x.astype(np.int64), len(x), float((x * x).sum(axis=1).max()))
    branch, leaf = tree.leaves(x)
    told = []
    for key in sorted(set(zip(branch.tolist(), leaf.tolist(), strict=True))):
        here = x[(branch == key[0]) & (leaf == key[1])]
        away = np.zeros((len(here), len(tree.points[-1]) + tree.widest))
        away[:, : len(tree.points[-1])] = tree.distances(-1, here)
        away[:, len(tree.points[-1]) : len(tree.points[-1]) + len(tree.points[key[0]])] = tree.distances(key[0], here)
        told.append(type("Row", (), {"branch": key[0], "leaf": key[1], "least": away.min(axis=0), "most": away.max(axis=0)}))
    hard_negatives._measured(tree, told)
    searched = 0
    for a in x[:50]:
        scores = np.sort(x @ a)[::-1]
        least, most = np.array([scores[20]]), np.array([scores[10]])
        reached = {(b, n) for b, n, _ in tree.open_leaves(a[None, :], least, most)}
        inside = (x @ a >= least) & (x @ a <= most)
        assert set(zip(branch[inside].tolist(), leaf[inside].tolist(), strict=True)) <= reached
        searched += len(reached)
    assert searched < 0.7 * 50 * len(told)


def test_hard_negatives_at_the_edges(spark):
    kind = "vec_id long, label int, embedding array<float>, row string, score string"
    rows = [
        (0, 1, [1.0, 0.0], "", ""), (1, 1, [0.5, 0.5], "", ""), (2, 2, [0.25, 0.0], "", ""), (3, 2, [0.25, 1.0], "", ""),
        (4, None, [0.25, 0.0], "", ""), (5, 2, None, "", ""), (6, 2, [0.25, NAN], "", ""), (7, 2, [0.25, None], "", ""),
        (None, 2, [0.25, 0.0], "", ""), (8, 2, [0.25], "", ""), (9, 2, [], "", ""), (10, 2, [-INF, 0.0], "", ""),
    ]
    df = spark.createDataFrame(rows, kind)
    anchor = F.col("vec_id") == 0
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = lambda d: sorted(tuple(r) for r in hard_negatives.hard_negatives(d, anchor).select(columns).collect())
    assert found(df) == [(0, 1, 1, 2, 32768, 16384), (0, 1, 2, 3, 32768, 16384)]
    assert found(df.where("false")) == [] and found(df.where("vec_id > 0")) == [] and found(df.where("label = 1")) == []
    # A copy of the anchor is its positive, and an anchor itself.
    twice = df.where("vec_id IN (0, 2)").unionAll(df.where("vec_id = 0"))
    assert found(twice) == []  # 65536 would need a score of 19661 at least
    near = spark.createDataFrame([(0, 1, [1.0]), (0, 1, [1.0]), (2, 2, [0.5])], "vec_id long, label int, embedding array<double>")
    assert found(near) == [(0, 0, 1, 2, 65536, 32768)] * 2
    with pytest.raises(ValueError, match="too large"):
        found(spark.createDataFrame([(0, 1, [1e9])], "vec_id long, label int, embedding array<double>"))
