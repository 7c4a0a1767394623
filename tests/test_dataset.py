import random
from datetime import date

import numpy as np
import pytest

from snapmart.operators import dataset

from conftest import rows


def test_window_dates():
    w = dataset.TrainingWindow(date(2024, 9, 1))
    assert (w.train_test_start, w.train_test_end) == (date(2023, 7, 1), date(2024, 6, 30))
    assert (w.oot_start, w.oot_end) == (date(2024, 7, 1), date(2024, 8, 31))
    assert dataset.months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert dataset.months_before(date(2024, 1, 15), 13) == date(2022, 12, 15)


def test_temporal_split(spark):
    w = dataset.TrainingWindow(date(2024, 9, 1))
    days = [date(2023, 6, 30), date(2023, 7, 1), date(2024, 6, 30), date(2024, 7, 1), date(2024, 8, 31), date(2024, 9, 1)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    assert rows(dataset.temporal_split(df, w), "snapshot_date", "period") == [
        (days[1], "train_test"), (days[2], "train_test"), (days[3], "oot"), (days[4], "oot"),
    ]


def test_training_frame_drops_gaps(spark):
    w = dataset.TrainingWindow(date(2024, 9, 1))
    day = date(2024, 1, 1)
    labels = spark.createDataFrame(
        [("l1", "a", 1, day), ("l2", "b", 0, day), ("l3", "c", 0, day), ("l4", "a", 0, date(2020, 1, 1))],
        "loan_id string, Customer_ID string, label int, snapshot_date date",
    )
    feats = spark.createDataFrame(
        [("a", 1.0, day), ("b", None, day), ("a", 2.0, date(2020, 1, 1))], "Customer_ID string, x double, snapshot_date date"
    )
    assert rows(dataset.training_frame(labels, feats, w), "loan_id", "x") == [("l1", 1.0)]


def labelled(spark, sizes):
    data = [(f"{label}-{i}", "c", date(2024, 1, 1), label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "loan_id string, Customer_ID string, snapshot_date date, label int")


@pytest.mark.parametrize("sizes", [{0: 50, 1: 50}, {0: 997, 1: 13}, {0: 3, 1: 2}, {0: 1}, {0: 10, 1: 11, 2: 12}])
def test_split_sizes(spark, sizes):
    df = dataset.stratified_split(labelled(spark, sizes))
    assert df.count() == sum(sizes.values())
    n = sum(sizes.values())
    train = n - int(np.ceil(n * (1 - 0.8)))
    got = {label: 0 for label in sizes}
    for label, split in rows(df, "label", "split"):
        got[label] += split == "train"
    assert sum(got.values()) == train
    assert all(abs(got[label] - train * size / n) < 1 for label, size in sizes.items())


def test_split_depends_on_key_and_seed_only(spark):
    df = labelled(spark, {0: 300, 1: 100})
    first = rows(dataset.stratified_split(df))
    assert first == rows(dataset.stratified_split(df.repartition(7)))
    assert first != rows(dataset.stratified_split(df, seed=89))


def test_copies_of_a_key_stay_together(spark):
    many = labelled(spark, {0: 100}).union(labelled(spark, {0: 1}).crossJoin(spark.range(50)).drop("id"))
    sides = dataset.stratified_split(many).select("loan_id", "split").distinct()
    assert sides.count() == 100


def test_split_statistics(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("train", 0), ("test", 1)], "split string, label int")
    assert rows(dataset.split_statistics(df)) == [("test", 1, 1.0), ("train", 3, 0.33)]


def test_folds_are_even_and_stratified(spark):
    df = labelled(spark, {0: 100, 1: 8})
    folded = dataset.stratified_folds(df, 3)
    counts = {(r.fold, r.label): r["count"] for r in folded.groupBy("fold", "label").count().collect()}
    assert sum(counts.values()) == 108
    assert all(counts[f, 0] in (33, 34) and counts[f, 1] in (2, 3) for f in range(3))
    assert rows(folded) == rows(dataset.stratified_folds(df.repartition(7), 3))


def test_preprocessing(spark):
    draw = random.Random(3)
    data = [(draw.choice(["A", "B", "_", None]), draw.uniform(0, 9), 4.0, i % 2 == 0, "s") for i in range(200)]
    df = spark.createDataFrame(data, "mix string, x double, flat double, flag boolean, snapshot string")
    fitted = dataset.fit_preprocessor(df, ["mix"], ["x", "flat"])
    assert fitted.names == ["x", "flat", "flag", "mix_A", "mix_B"]
    out = fitted.input_columns(df)
    assert out.columns == ["mix", "snapshot", "x", "flat", "flag", "mix_A", "mix_B"]
    x = np.array([r[1] for r in data])
    got = out.collect()
    assert [r["x"] for r in got] == pytest.approx(list((x - x.mean()) / x.std()))
    assert {r["flat"] for r in got} == {0.0}
    assert [(r["mix_A"], r["mix_B"]) for r in got] == [(int(m == "A"), int(m == "B")) for m, *_ in data]
    assert [r["flag"] for r in got] == [int(f) for *_, f, _ in data]


def test_unknown_levels_have_no_indicator(spark):
    df = spark.createDataFrame([("A", None), ("B", None)], "c string, void string")
    fitted = dataset.fit_preprocessor(df, ["c", "void"], [])
    assert fitted.names == ["c_A", "c_B"]
    new = spark.createDataFrame([("C", "x"), ("B", None), (None, None)], "c string, void string")
    made = fitted.input_columns(new).select("c_A", "c_B").collect()
    assert [tuple(r) for r in made] == [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


def test_many_levels_are_fitted_and_empty_columns_are_errors(spark):
    df = spark.range(12_000).selectExpr("cast(id as string) as c", "cast(null as double) as x")
    assert len(dataset.fit_preprocessor(df, ["c"], []).names) == 12_000
    with pytest.raises(ValueError, match="no values"):
        dataset.fit_preprocessor(df, [], ["x"])
