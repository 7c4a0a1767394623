import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from snapmart import schemas as S
from snapmart.operators import boosting, model
from snapmart.operators.dataset import TrainingWindow, fit_preprocessor
from snapmart.plans import monitoring, training
from snapmart.plans.layout import Mart
from snapmart.session import materialize, work_folder
from snapmart.sources.snapshots import read_table, write_snapshots

from conftest import rows

WINDOW = TrainingWindow(date(2024, 9, 1))
SPACE = {"maxIter": [2], "maxDepth": [2], "stepSize": [0.1, 0.3]}


def stores(spark):
    """A label and a feature store of 14 months in which one column decides the label."""
    draw = random.Random(2)
    months = [date(2023 + (6 + m) // 12, (6 + m) % 12 + 1, 1) for m in range(14)]
    labels, feats = [], []
    for i in range(600):
        numbers = [draw.gauss(0, 1) for _ in S.NUMERIC_INPUTS]
        day = months[i % 14]
        labels.append((f"l{i}", f"c{i}", int(numbers[0] + draw.gauss(0, 0.3) > 0), "90dpd_7mob", day))
        feats.append((f"c{i}", *numbers, draw.choice(["Good", "Bad", "_"]), "it's", draw.choice(["a\\b", "x"]), day))
    names = ", ".join(f"{c} double" for c in S.NUMERIC_INPUTS) + ", " + ", ".join(f"{c} string" for c in S.CATEGORICAL_INPUTS)
    return (
        spark.createDataFrame(labels, "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"),
        spark.createDataFrame(feats, f"Customer_ID string, {names}, snapshot_date date"),
    )


def test_saved_stages_make_the_inputs(spark, tmp_path):
    _, feats = stores(spark)
    fitted = fit_preprocessor(feats)
    assert [n for n in fitted.names if n.startswith("Credit_Mix")] == ["Credit_Mix_Bad", "Credit_Mix_Good"]
    assert fitted.names[-1] == "Occupation_x" and len(fitted.names) == len(S.NUMERIC_INPUTS) + 5
    path = str(tmp_path / "stages")
    model.save_model(PipelineModel(fitted.stages), path)
    again = model.load_model(path).transform(feats).orderBy("Customer_ID").select("inputs").collect()
    assert again == fitted.transform(feats).orderBy("Customer_ID").select("inputs").collect()


def work_tables_left(spark):
    folder = Path(work_folder(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    return sorted(p.name for p in folder.glob("*"))


def test_draws_are_distinct_and_repeatable():
    draws = model.draw_settings(model.SEARCH_SPACE, 100, 42)
    assert len({tuple(d.items()) for d in draws}) == 100
    assert draws == model.draw_settings(model.SEARCH_SPACE, 100, 42)
    assert len(model.draw_settings(SPACE, 100, 42)) == 2


def test_train_score_monitor(spark, tmp_path):
    mart = Mart(str(tmp_path))
    labels, feats = stores(spark)
    write_snapshots(labels, mart.gold("label_store"))
    write_snapshots(feats, mart.gold("feature_store"))
    before = work_tables_left(spark)
    name = training.run_training(spark, mart, WINDOW, draws=2, folds=2, space=SPACE)
    assert work_tables_left(spark) == before
    assert name == "gbt_credit_model_2024_09_01"
    training.run_training(spark, mart, WINDOW, draws=1, folds=2, space=SPACE)
    assert spark.read.parquet(mart.model("registry")).count() == 1
    training.run_training(spark, mart, WINDOW, draws=2, folds=2, space=SPACE)
    record = spark.read.parquet(mart.model("registry")).first()
    assert record.data_config == {"train_test_period_months": 12.0, "oot_period_months": 2.0, "train_test_ratio": 0.8}
    assert record.results["auc_search"] > 0.8
    assert record.data_dates["oot_end_date"] == date(2024, 8, 31)
    assert sum(v for k, v in record.data_stats.items() if k.startswith("rows")) == 600
    assert record.results["auc_oot"] > 0.8
    assert record.results["gini_oot"] == pytest.approx(2 * record.results["auc_oot"] - 1, abs=6e-4)
    assert set(record.hp_params) == set(SPACE)

    days = [date(2024, 7, 1), date(2024, 8, 1)]
    training.run_scoring(spark, mart, name, days)
    training.run_scoring(spark, mart, name, days[1:])
    predictions = read_table(spark, mart.gold("model_predictions"))
    assert sorted(predictions.columns) == ["Customer_ID", "model_name", "model_predictions", "snapshot_date"]
    assert predictions.count() == feats.filter(F.col("snapshot_date").isin(days)).count()
    assert predictions.filter("model_predictions between 0 and 1").count() == predictions.count()

    report = dict(monitoring.performance_report(spark, mart, name).collect())
    assert report["AUC"] > 0.8
    drift = monitoring.drift_reports(spark, mart, *days)
    plan = drift["feature_drift"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [snapshot_date" in plan and "PartitionFilters: []" not in plan
    assert drift["feature_drift"].count() == 6
    assert drift["prediction_stability"].first().psi >= 0
    assert drift["concept_drift"].count() == 2
    assert drift["label_counts"].count() == 14


def test_search_is_the_same_again_and_the_best_of_all_settings(spark):
    """Every setting cross-validated by itself, fold by fold, against the one search."""
    labels, feats = stores(spark)
    train = labels.join(feats, ["Customer_ID", "snapshot_date"])
    fitted = fit_preprocessor(train)
    space = {"maxIter": [2], "maxDepth": [1], "stepSize": [0.3], "l2": [1.0], "subsamplingRate": [0.7], "minHessian": [1, 60]}
    first = model.random_search(train, fitted, space=space, draws=5, folds=2)
    again = model.random_search(train.repartition(5), fitted, space=space, draws=5, folds=2)
    assert first[1:] == again[1:]
    assert first[0].stages[-1].getOrDefault("trees") == again[0].stages[-1].getOrDefault("trees")
    settings, folded = model.draw_settings(space, 5, 42), model.stratified_folds(train, 2, seed=42)
    # Cuts are those of all rows, as in the search.
    data = model.prepare(folded, fitted, keep=["fold"])
    unseen = [materialize(fitted.transform(folded.filter(F.col("fold") == f)).select("inputs", "label"), "unseen") for f in range(2)]
    means = []
    for setting in settings:
        areas = []
        for fold in range(2):
            grower = model.Grower(data, [model.Fit(setting, fold)], 88, "fold")
            grower.grow()
            got = model.boosting.grown_model(grower).transform(unseen[fold]).select("label", "probability").collect()
            pos, neg = ([r.probability for r in got if r.label == v] for v in (1, 0))
            areas.append(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg))
        means.append(sum(areas) / 2)
    assert first[2] == pytest.approx(max(means)) and first[1] == settings[means.index(max(means))]
    days = [r[0] for r in feats.select("snapshot_date").distinct().collect()]
    scores = [rows(model.score_snapshots(m, feats, days, "m")) for m in (first[0], again[0])]
    assert scores[0] == scores[1]


def test_the_space_has_nine_parameters():
    assert set(model.SEARCH_SPACE) == set(boosting.DEFAULTS) and len(boosting.DEFAULTS) == 9
    assert len(model.draw_settings(model.SEARCH_SPACE, 10_000, 1)) == 1728
