import math
import random

from snapmart.operators.quantiles import approximate_quantiles, exact_quantiles

from conftest import rows

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]


def sample():
    draw = random.Random(5)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 else f"g{i % 5}"
        data.append(
            (group, float(draw.randint(0, 9)), draw.lognormvariate(0, 9), None if i % 7 else draw.uniform(-1, 1))
        )
    data += [("one", 3.0, float("inf"), None), ("odd", -0.0, float("-inf"), float("nan")), ("odd", 1.0, 1e308, None),
             ("odd", 2.0, -1e308, 0.0), (None, 1.0, 2.0, 3.0)]
    return data


def brute_force(data):
    wanted = set()
    for group in {r[0] for r in data}:
        for i, c in enumerate(["few", "wide", "gaps"], 1):
            values = sorted(r[i] for r in data if r[0] == group and r[i] is not None and not math.isnan(r[i]))
            for p in PROBABILITIES:
                if values:
                    wanted.add((group, c, p, values[max(1, math.ceil(p * len(values))) - 1] + 0.0))
    return wanted


def test_exact_equals_sorting(spark):
    data = sample()
    df = spark.createDataFrame(data, "g string, few double, wide double, gaps double")
    got = exact_quantiles(df, ["g"], ["few", "wide", "gaps"], PROBABILITIES)
    found = {(r.g, r.column, r.probability, r.value + 0.0) for r in got.collect()}
    assert found == brute_force(data)
    assert got.count() == len(found)


def test_approximate_ranks(spark):
    df = spark.range(10_001).selectExpr("cast(id as double) as v", "cast(null as double) as none", "id % 2 as g")
    got = rows(approximate_quantiles(df, ["g"], ["v", "none"], [0.25, 0.75]))
    assert [(g, c, p) for g, c, p, _ in got] == [(0, "v", 0.25), (0, "v", 0.75), (1, "v", 0.25), (1, "v", 0.75)]
    assert all(abs(v - p * 10_000) <= 110 for _, _, p, v in got)
