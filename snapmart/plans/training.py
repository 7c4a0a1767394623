"""Label and feature stores to a saved model, its registry row, and predictions."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.operators import model as M
from snapmart.operators.dataset import (
    TrainingWindow,
    fit_preprocessor,
    split_statistics,
    stratified_split,
    temporal_split,
    training_frame,
)
from snapmart.operators.monitor import auc_and_gini
from snapmart.plans.layout import Mart
from snapmart.session import materialize, work_tables
from snapmart.sources.snapshots import read_table, write_snapshots

ALGORITHM = "gbt"


def split_frame(labels: DataFrame, features: DataFrame, window: TrainingWindow) -> DataFrame:
    """The training frame with ``split``: train, test or oot.

    The frame is written once, because the search reads it many times.
    """
    frame = materialize(temporal_split(training_frame(labels, features, window), window), "training-frame")
    in_time = stratified_split(frame.filter("period = 'train_test'").drop("period"))
    later = frame.filter("period = 'oot'").drop("period").withColumn("split", F.lit("oot"))
    return in_time.unionByName(later)


def train(
    labels: DataFrame, features: DataFrame, window: TrainingWindow, draws: int = 100, folds: int = 3, **search
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The best model, its registry row, and the scored rows of all splits."""
    rows = materialize(split_frame(labels, features, window), "split-frame")
    fitted = fit_preprocessor(rows.filter("split = 'train'"))
    model, settings, search_auc = M.random_search(rows.filter("split = 'train'"), fitted, draws=draws, folds=folds, **search)
    scored = M.with_probability(model, rows)
    record = M.registry_record(
        rows.sparkSession,
        ALGORITHM,
        window,
        split_statistics(rows),
        auc_and_gini(scored, "model_predictions", "label", ["split"]),
        settings,
        search_auc=search_auc,
    )
    return model, record, scored


def run_training(spark: SparkSession, mart: Mart, window: TrainingWindow, **search) -> str:
    """Train on the gold tables; saves the model and writes its registry row over one of the same name and version.

    Gives the model's name.
    """
    labels, features = read_table(spark, mart.gold("label_store")), read_table(spark, mart.gold("feature_store"))
    name = f"{ALGORITHM}_credit_model_{window.train_date:%Y_%m_%d}"
    with work_tables(spark):
        model, record, _ = train(labels, features, window, **search)
        M.save_model(model, mart.model(name))
        write_snapshots(record, mart.model("registry"), partition_columns=("model_name", "model_version"))
    return name


def run_scoring(spark: SparkSession, mart: Mart, model_name: str, snapshots: list) -> None:
    """Score the given snapshots; each (model, snapshot) is a partition of its own."""
    predictions = M.score_snapshots(
        M.load_model(mart.model(model_name)), read_table(spark, mart.gold("feature_store")), snapshots, model_name
    )
    write_snapshots(predictions, mart.gold("model_predictions"), partition_columns=("model_name", "snapshot_date"))
