"""Monitoring of stored predictions against stored labels and features."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.operators import monitor
from snapmart.operators.profile import count_by_snapshot
from snapmart.plans.layout import Mart
from snapmart.schemas import SNAPSHOT
from snapmart.sources.snapshots import read_table

# The features whose distribution is watched.
WATCHED = ["Annual_Income", "Num_of_Loan", "Credit_History_Age", "fe_1_5m_avg", "fe_2_5m_avg", "fe_3_5m_avg"]


def performance_report(spark: SparkSession, mart: Mart, model_name: str) -> DataFrame:
    """Quality metrics of one model as (Metric, Value) rows."""
    predictions, labels = (read_table(spark, mart.gold(t)) for t in ("model_predictions", "label_store"))
    return monitor.metrics_table(monitor.labelled_predictions(predictions, labels, model_name))


def drift_reports(spark: SparkSession, mart: Mart, baseline, current, watched=WATCHED) -> dict[str, DataFrame]:
    """Label counts, concept drift, and feature drift and prediction stability between two snapshots.

    Feature drift and stability read only the partitions of the two snapshots; concept drift joins only the keys, the
    prediction and the label of all of them.
    """
    predictions, features, labels = (
        read_table(spark, mart.gold(t)) for t in ("model_predictions", "feature_store", "label_store")
    )
    days = [F.lit(d).cast("date") for d in (baseline, current)]
    both = [t.filter(F.col(SNAPSHOT).isin(days)) for t in (predictions, features, labels)]
    merged = monitor.monitoring_frame(both[0], both[1].select(*monitor.KEYS, *watched), both[2])
    then, now = (F.col(SNAPSHOT) == d for d in days)
    # Rows without features are no rows of the monitored frame; only their keys are needed to leave them out.
    keyed = predictions.join(features.select(*monitor.KEYS), monitor.KEYS)
    errors = keyed.join(labels.select(*monitor.KEYS, "label"), monitor.KEYS)
    return {
        "label_counts": count_by_snapshot(labels),
        "feature_drift": monitor.ks_drift(merged, watched, then, now),
        "prediction_stability": monitor.population_stability(merged, then, now),
        "concept_drift": monitor.concept_drift(errors),
    }
