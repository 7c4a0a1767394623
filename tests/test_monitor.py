import math
import random
from datetime import date
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from snapmart.functions.stats import exact_p, histogram_bin, kolmogorov_p
from snapmart.operators import monitor, profile

from conftest import rows


def scores(spark, n=3000, digits=2):
    draw = random.Random(7)
    data = [(draw.choice("ab"), round(draw.random() ** 3, digits), draw.randint(0, 1)) for _ in range(n)]
    data += [("single", 0.5, 1), ("single", 0.7, 1)]
    return data, spark.createDataFrame(data, "g string, model_predictions double, label int")


def brute_auc(pairs):
    pos, neg = [p for p, y in pairs if y == 1], [p for p, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_by_group(spark):
    data, df = scores(spark)
    got = dict(rows(monitor.auc(df, by=["g"])))
    for g in ["a", "b", "single"]:
        assert got[g] == pytest.approx(brute_auc([(p, y) for h, p, y in data if h == g]))


def test_auc_over_many_ranges(spark):
    """One range per few values, as on data that fills many tasks."""
    _, df = scores(spark, 2000, 6)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = monitor.auc(df.filter("g != 'single'")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ready = df.filter("g != 'single'").select(F.col("model_predictions").alias("rawPrediction"), F.col("label").cast("double"))
    assert got == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(ready))


def test_metrics(spark):
    data, df = scores(spark)
    got = dict(rows(monitor.metrics_table(df.filter("g = 'a'"))))
    p = np.array([s for g, s, _ in data if g == "a"])
    y = np.array([t for g, _, t in data if g == "a"])
    guess = p >= 0.5
    tp, fp, fn = (guess & (y == 1)).sum(), (guess & (y == 0)).sum(), (~guess & (y == 1)).sum()
    assert got["F1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert got["Precision"] == pytest.approx(tp / (tp + fp))
    assert got["Recall"] == pytest.approx(tp / (tp + fn))
    assert got["Brier"] == pytest.approx(((p - y) ** 2).mean())
    assert got["Pred_Mean"] == pytest.approx(p.mean())
    assert got["Positive_Rate"] == pytest.approx(guess.mean())
    assert set(got) == {"AUC", "F1", "Precision", "Recall", "Brier", "Pred_Mean", "Positive_Rate"}


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "model_predictions double, label int")
    got = monitor.classification_metrics(df).first()
    assert (got.F1, got.Precision, got.Recall) == (0.0, 0.0, 0.0)


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x in points)


def panel(spark):
    draw = random.Random(11)
    data = []
    for i in range(1500):
        now = i % 3 == 0
        x = draw.gauss(0.3 if now else 0, 1)
        data.append((now, None if i % 10 == 0 else x, float(draw.randint(0, 5)), None if now else 1.0, 2.5))
    return data, spark.createDataFrame(data, "now boolean, x double, ties double, lost double, flat double")


def test_ks(spark):
    data, df = panel(spark)
    sides = ~F.col("now"), F.col("now")
    got = {r.feature: r for r in monitor.ks_drift(df, ["x", "ties", "lost", "flat"], *sides, p_value="exact").collect()}
    law = {r.feature: r for r in monitor.ks_drift(df, ["x", "ties", "lost", "flat"], *sides).collect()}
    for i, c in enumerate(["x", "ties", "lost", "flat"], 1):
        a = [r[i] for r in data if not r[0] and r[i] is not None]
        b = [r[i] for r in data if r[0] and r[i] is not None]
        assert (got[c].n_baseline, got[c].n_current) == (len(a), len(b))
        if a and b:
            assert got[c].ks == pytest.approx(brute_ks(a, b))
            assert got[c].p_value == pytest.approx(exact_p(brute_ks(a, b), len(a), len(b)))
            assert law[c].ks == got[c].ks and law[c].p_value == pytest.approx(got[c].p_value, abs=0.02)
            assert got[c].drifted == (got[c].p_value < 0.05)
        else:
            assert (got[c].ks, got[c].p_value, got[c].drifted) == (None, None, None)
    assert got["x"].drifted and got["flat"].p_value == 1.0


def test_exact_p_counts_all_orders():
    for n, m in [(1, 1), (2, 3), (3, 3), (4, 6), (5, 5)]:
        gaps = []
        for first in combinations(range(n + m), n):
            i = j = 0
            worst = 0.0
            for k in range(n + m):
                i, j = (i + 1, j) if k in first else (i, j + 1)
                worst = max(worst, abs(i / n - j / m))
            gaps.append(worst)
        for d in sorted(set(gaps)):
            wanted = sum(g >= d - 1e-12 for g in gaps) / len(gaps)
            assert exact_p(d, n, m) == pytest.approx(wanted)


def test_large_sample_p_is_near_the_exact_one(spark):
    cases = [(d, n, m) for n, m in [(2000, 2000), (1500, 4000)] for d in (0.01, 0.02, 0.03, 0.04, 0.05)]
    df = spark.createDataFrame(cases, "d double, n long, m long")
    got = df.select("d", "n", "m", kolmogorov_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(exact_p(r.d, r.n, r.m), abs=0.02)


def test_empty_frame(spark):
    df = spark.createDataFrame([], "x double, model_predictions double, label int, now boolean")
    assert monitor.ks_drift(df, ["x"], F.col("now"), ~F.col("now")).first()["ks"] is None
    assert tuple(monitor.population_stability(df, F.col("now"), ~F.col("now")).first()) == (0, 0, None)


def brute_psi(expected, actual, shared):
    edges = np.histogram_bin_edges(expected, 10)
    if shared:
        e, a = (np.histogram(np.clip(v, edges[0], edges[-1]), edges)[0] / len(v) for v in (expected, actual))
    else:
        e, a = (np.histogram(v, 10)[0] / len(v) for v in (expected, actual))
    return sum((x - y) * math.log(x / y) for x, y in zip(e, a) if x and y)


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("digits", [1, 2, 3, 9])
def test_psi_equals_numpy(spark, shared, digits):
    draw = random.Random(digits)
    data = [(i % 3 == 0, round(draw.random() ** (2 if i % 3 else 1), digits)) for i in range(2000)]
    df = spark.createDataFrame(data + [(True, None)], "now boolean, model_predictions double")
    got = monitor.population_stability(df, ~F.col("now"), F.col("now"), edges="shared" if shared else "independent").first()
    a, b = [p for now, p in data if not now], [p for now, p in data if now]
    assert (got.n_baseline, got.n_current) == (len(a), len(b))
    assert got.psi == pytest.approx(brute_psi(a, b, shared))


def test_psi_of_constant_and_one_sided_samples(spark):
    df = spark.createDataFrame([(True, 0.4), (False, 0.4), (False, 0.4)], "now boolean, model_predictions double")
    assert monitor.population_stability(df, ~F.col("now"), F.col("now")).first().psi == 0.0
    one_sided = monitor.population_stability(df, ~F.col("now"), F.lit(False)).first()
    assert tuple(one_sided) == (2, 0, None)


def test_bins_equal_numpy_on_edges(spark):
    values = [round(i * 0.01, 2) for i in range(101)] + [i / 30 for i in range(31)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(histogram_bin(F.col("v"), F.lit(0.0), F.lit(1.0), 10)).collect()]
    edges = np.linspace(0, 1, 11)
    assert got == list(np.minimum(np.searchsorted(edges, values, side="right") - 1, 9))


def test_errors_by_snapshot(spark):
    days = [date(2024, 1, 1), date(2024, 2, 1)]
    df = spark.createDataFrame(
        [(days[0], 0.25, 1), (days[0], 0.25, 0), (days[1], 1.0, 1)], "snapshot_date date, model_predictions double, label int"
    )
    assert rows(monitor.concept_drift(df)) == [(days[0], 0.5), (days[1], 0.0)]
    assert [tuple(r) for r in profile.count_by_snapshot(df).collect()] == [(days[0], 2), (days[1], 1)]


def test_key_coverage(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "k string, d int")
    right = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1)], "k string, d int")
    assert tuple(profile.key_coverage(left, right, ["k", "d"]).first()) == (4, 3, 4, 3, 4)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x"), (4, "y")], "a int, `b c` string")
    assert rows(profile.null_profile(df)) == [("a", 1, 25.0), ("b c", 2, 50.0)]
    assert tuple(profile.null_counts(df).first()) == (1, 2)


def test_dirty_value_reports(spark):
    df = spark.createDataFrame([("28",), ("28_",), ("-5",), ("150",), ("150",), (None,)], "Age string")
    assert rows(profile.not_matching(df, "Age", "^[0-9]+$")) == [("-5",), ("28_",)]
    assert [r[0] for r in profile.out_of_range(df, "Age", 0, 100).collect()] == [-5, 150]
