"""Boosting of many fits at once against a plain NumPy version of one fit."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from snapmart.operators import boosting
from snapmart.operators.boosting import Fit, Grower
from snapmart.operators.model import fold_areas


def _data(n=240, features=5, seed=4):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, features)).round(1)
    x[:, 3] = rnd.integers(0, 2, n)
    x[:, 4] = 7.0  # constant: never split on
    y = (x[:, 0] + 0.7 * x[:, 3] + rnd.normal(size=n) > 0).astype(float)
    return x, y, rnd.integers(0, 3, n), rnd.integers(0, (1 << 31) - 1, n)


def _frame(spark, x, y, fold, draw):
    rows = [([float(v) for v in a], float(b), int(c), int(d)) for a, b, c, d in zip(x, y, fold, draw)]
    df = spark.createDataFrame(rows, "x array<double>, label double, fold int, draw long").repartition(3)
    return df.select(array_to_vector("x").alias("inputs"), "label", "fold", "draw")


def _plain(x, y, draw, setting, seed, bins=64):
    """(base, trees): node by node and cut by cut, over the rows of one fit; a tree is as in ``tree_list``."""
    p = dict(boosting.DEFAULTS) | setting
    base = math.log(y.mean() / (1 - y.mean()))
    margin, trees = np.full(len(y), base), []

    def pull(g):
        return math.copysign(max(abs(g) - p["l1"], 0.0), g)

    def score(g, h):
        return pull(g) ** 2 / (h + p["l2"])

    def grow(rows, used, depth, g, h):
        total_g, total_h = g[rows & used].sum(), h[rows & used].sum()
        best = None
        for j in columns if depth else []:
            for cut in cuts[j]:
                left, right = rows & used & (x[:, j] <= cut), rows & used & (x[:, j] > cut)
                lg, lh, rg, rh = g[left].sum(), h[left].sum(), g[right].sum(), h[right].sum()
                if min(lh, rh) < p["minHessian"] or not left.any() or not right.any():
                    continue
                gain = score(lg, lh) + score(rg, rh) - score(total_g, total_h)
                if gain > p["minGain"] and (best is None or gain > best[0] + 1e-12):
                    best = gain, j, cut
        if best is None:
            weight = -pull(total_g) / (total_h + p["l2"]) * p["stepSize"]
            margin[rows] += weight
            return weight
        _, j, cut = best
        return [j, cut, grow(rows & (x[:, j] <= cut), used, depth - 1, g, h), grow(rows & (x[:, j] > cut), used, depth - 1, g, h)]

    cuts = all_cuts
    for t in range(p["maxIter"]):
        columns = boosting.tree_features(seed, t, p["columnShare"], x.shape[1])
        a, b = boosting.row_factors(seed, t)
        used = np.array([(int(d) * a + b) % ((1 << 31) - 1) < p["subsamplingRate"] * ((1 << 31) - 1) for d in draw])
        chance = 1 / (1 + np.exp(-margin))
        trees.append(grow(np.ones(len(y), bool), used, p["maxDepth"], chance - y, chance * (1 - chance)))
    return base, trees


all_cuts: list = []


def _same(a, b):
    if isinstance(a, list) != isinstance(b, list):
        return False
    if not isinstance(a, list):
        return a == pytest.approx(b, abs=1e-7)
    return a[:2] == b[:2] and _same(a[2], b[2]) and _same(a[3], b[3])


SETTINGS = [
    {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3},
    {"maxIter": 2, "maxDepth": 1, "stepSize": 1.0, "l2": 0.5, "minHessian": 0.0},
    {"maxIter": 4, "maxDepth": 2, "stepSize": 0.1, "l1": 1.0, "l2": 2.0, "minGain": 0.1, "minHessian": 5, "subsamplingRate": 0.6, "columnShare": 0.6},
    {"maxIter": 3, "maxDepth": 3, "stepSize": 0.5, "l1": 0.1, "columnShare": 0.4, "subsamplingRate": 0.8},
]


@pytest.mark.parametrize("cells, renewed", [(1 << 24, 10), (1, 1)])
def test_all_fits_equal_a_plain_version_of_each(spark, monkeypatch, cells, renewed):
    global all_cuts
    monkeypatch.setattr(boosting, "CELLS", cells)  # 1: a pass for every fit
    monkeypatch.setattr(boosting, "RENEWED", renewed)
    x, y, fold, draw = _data()
    data = boosting.binned(_frame(spark, x, y, fold, draw), x.shape[1], ["fold"], bins=16)
    all_cuts = data.cuts
    for j in range(x.shape[1]):
        ordered = sorted(x[:, j])
        assert data.cuts[j] == sorted({ordered[math.ceil(i / 16 * len(y)) - 1] for i in range(1, 16)})
    fits = [Fit(s, f) for s in SETTINGS for f in (0, 2)]
    grower = Grower(data, fits, 88, "fold")
    grower.grow()
    for i, fit in enumerate(fits):
        seen = fold != fit.fold
        base, trees = _plain(x[seen], y[seen], draw[seen], fit.setting, 88)
        assert grower.forest.base[i] == pytest.approx(base)
        found = boosting.tree_list(grower.forest, i, data.cuts)
        assert all(_same(a, b) for a, b in zip(found, trees)), (i, found, trees)
        assert found[len(trees):] == [0.0] * (4 - len(trees))


def test_areas_of_unseen_folds_and_the_saved_model(spark, tmp_path):
    x, y, fold, draw = _data(seed=9)
    rows = _frame(spark, x, y, fold, draw)
    data = boosting.binned(rows, x.shape[1], ["fold"])
    grower = Grower(data, [Fit(SETTINGS[0], f) for f in range(3)] + [Fit(SETTINGS[3], f) for f in range(3)], 88, "fold")
    grower.grow()
    areas = fold_areas(grower, 3)
    for i, fit in enumerate(grower.fits):
        made = boosting.grown_model(grower, i)
        path = str(tmp_path / f"model{i}")
        made.write().save(path)
        scored = boosting.BoostedTrees.load(path).transform(rows).filter(F.col("fold") == fit.fold).select("label", "probability").collect()
        pos, neg = ([r.probability for r in scored if r.label == v] for v in (1, 0))
        wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert areas[i] == pytest.approx(wins / len(pos) / len(neg))
        assert len(json.loads(made.getOrDefault(made.trees))) == fit.maxIter


def test_one_class_and_no_split(spark):
    x, _, fold, draw = _data(n=30)
    data = boosting.binned(_frame(spark, x, np.ones(30), fold, draw), x.shape[1])
    grower = Grower(data, [Fit({"maxIter": 2})], 1)
    grower.grow()
    assert all(not isinstance(t, list) for t in boosting.tree_list(grower.forest, 0, data.cuts))


def test_shares_of_rows_and_features():
    draws = [random.Random(1).randrange((1 << 31) - 1) for _ in range(1)] + list(range(0, 1 << 31, 1 << 17))
    for t in range(3):
        a, b = boosting.row_factors(88, t)
        used = sum((d * a + b) % ((1 << 31) - 1) < 0.6 * ((1 << 31) - 1) for d in draws) / len(draws)
        assert abs(used - 0.6) < 0.05
        assert len(boosting.tree_features(88, t, 0.6, 52)) == 31 and boosting.tree_features(88, t, 0.001, 52)
    assert boosting.tree_features(88, 0, 0.6, 52) != boosting.tree_features(88, 1, 0.6, 52)
