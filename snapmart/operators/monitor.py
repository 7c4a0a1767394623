"""Prediction monitoring: quality metrics, distribution drift, population stability."""

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.functions.stats import exact_p_column, histogram_bin, kolmogorov_p
from snapmart.operators.ranges import by_range, earlier_parts, within_part
from snapmart.schemas import ENTITY, SNAPSHOT

KEYS = [ENTITY, SNAPSHOT]


def labelled_predictions(predictions: DataFrame, labels: DataFrame, model_name: str | None = None) -> DataFrame:
    """Predictions with the label of the same customer and snapshot, of one model or of all."""
    if model_name is not None:
        predictions = predictions.filter(F.col("model_name") == model_name)
    return predictions.join(labels, KEYS, "inner")


def monitoring_frame(predictions: DataFrame, features: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with their features and labels."""
    return predictions.join(features, KEYS, "inner").join(labels.select(*KEYS, "label"), KEYS, "inner")


def auc(
    df: DataFrame, score: str = "model_predictions", label: str = "label", by: list[str] | None = None
) -> DataFrame:
    """Exact area under the ROC curve per group; tied scores count half. Null for a group with a single class.

    Scores are counted before anything is ordered, and the ordered counts are summed range by range.
    """
    groups = by or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    positive = (F.col(label) == 1).cast("bigint")
    counts = (
        rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*groups, F.col(score).alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )
    seen = F.sum("neg").over(within_part(groups, "score"))
    pairs = F.col("pos").cast("double") * (seen - F.col("neg") / 2)
    parts = (
        by_range(counts, groups, "score")
        .select(*groups, "part", "pos", "neg", pairs.alias("pairs"))
        .groupBy(*groups, "part")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs"))
    )
    before = F.coalesce(F.sum("neg").over(earlier_parts(groups)), F.lit(0))
    all_pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    won = F.sum(F.col("pairs") + F.col("pos").cast("double") * F.col("before"))
    result = (
        parts.select("*", before.alias("before")).groupBy(*groups).agg(F.try_divide(won, all_pairs).alias("auc"))
    )
    return result if by else result.drop("_all")


def auc_and_gini(df: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """AUC per group, and Gini = 2 AUC - 1 to three decimals."""
    return auc(df, score, label, by).withColumn("gini", F.round(2 * F.col("auc") - 1, 3))


def classification_metrics(
    df: DataFrame, score: str = "model_predictions", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """One row: F1, precision, recall (0 where undefined), Brier score, mean prediction, positive rate."""
    guess = F.col(score) >= threshold
    actual = F.col(label) == 1
    counts = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).agg(
        F.count_if(guess & actual).alias("tp"),
        F.count_if(guess & ~actual).alias("fp"),
        F.count_if(~guess & actual).alias("fn"),
        F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("Brier"),
        F.avg(score).alias("Pred_Mean"),
        F.avg(guess.cast("double")).alias("Positive_Rate"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        share(2 * tp, 2 * tp + fp + fn).alias("F1"),
        share(tp, tp + fp).alias("Precision"),
        share(tp, tp + fn).alias("Recall"),
        "Brier",
        "Pred_Mean",
        "Positive_Rate",
    )


def metrics_table(df: DataFrame, score: str = "model_predictions", label: str = "label") -> DataFrame:
    """All quality metrics as (Metric, Value) rows."""
    area = auc(df, score, label).select(F.lit("AUC").alias("Metric"), F.col("auc").alias("Value"))
    other = classification_metrics(df, score, label)
    return area.unionByName(other.unpivot([], other.columns, "Metric", "Value"))


def concept_drift(df: DataFrame, score: str = "model_predictions", label: str = "label") -> DataFrame:
    """Mean absolute prediction error per snapshot."""
    return with_prediction_error(df, score, label).groupBy(SNAPSHOT).agg(
        F.avg("prediction_error").alias("prediction_error")
    )


def with_prediction_error(df: DataFrame, score: str = "model_predictions", label: str = "label") -> DataFrame:
    return df.withColumn("prediction_error", F.abs(F.col(label) - F.col(score)))


def ks_drift(
    df: DataFrame,
    features: list[str],
    baseline: Column,
    current: Column,
    alpha: float = 0.05,
    p_value: str = "law",
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature between the baseline and the current rows.

    ``baseline`` and ``current`` are conditions on the rows. Nulls are dropped; a feature without values on one
    side has a null statistic. P-values follow one corrected large-sample law at every size; ``p_value="exact"`` counts
    all orders of two small samples without ties instead, in time that grows with the square of their size.
    """
    values = (
        df.filter(baseline | current)
        .select(
            baseline.cast("bigint").alias("base"),
            current.cast("bigint").alias("curr"),
            *[F.col(c).cast("double").alias(c) for c in features],
        )
        .unpivot(["base", "curr"], features, "feature", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    counts = values.groupBy("feature", "value").agg(
        F.sum(F.coalesce("base", F.lit(0))).alias("base"), F.sum(F.coalesce("curr", F.lit(0))).alias("curr")
    )
    # One row per feature name.
    sizes = counts.groupBy("feature").agg(F.sum("base").alias("n_baseline"), F.sum("curr").alias("n_current"))
    shares = by_range(counts, ["feature"], "value").join(F.broadcast(sizes), "feature")
    frame = within_part(["feature"], "value")
    gap = F.try_divide(F.sum("base").over(frame), F.col("n_baseline")) - F.try_divide(
        F.sum("curr").over(frame), F.col("n_current")
    )
    parts = (
        shares.select("feature", "part", "base", "curr", "n_baseline", "n_current", gap.alias("gap"))
        .groupBy("feature", "part", "n_baseline", "n_current")
        .agg(
            F.max("gap").alias("high"),
            F.min("gap").alias("low"),
            F.sum("base").alias("base"),
            F.sum("curr").alias("curr"),
        )
    )
    earlier = earlier_parts(["feature"])
    offset = F.try_divide(F.coalesce(F.sum("base").over(earlier), F.lit(0)), F.col("n_baseline")) - F.try_divide(
        F.coalesce(F.sum("curr").over(earlier), F.lit(0)), F.col("n_current")
    )
    furthest = F.greatest(F.abs(F.col("offset") + F.col("high")), F.abs(F.col("offset") + F.col("low")))
    statistics = (
        parts.select("*", offset.alias("offset"))
        .groupBy("feature", "n_baseline", "n_current")
        .agg(F.max(furthest).alias("ks"))
    )
    listed = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    result = listed.join(statistics, "feature", "left").select(
        "feature",
        "ks",
        F.coalesce("n_baseline", F.lit(0)).alias("n_baseline"),
        F.coalesce("n_current", F.lit(0)).alias("n_current"),
    )
    if p_value == "exact":
        p = exact_p_column("ks", "n_baseline", "n_current")
    else:
        p = kolmogorov_p(F.col("ks"), F.col("n_baseline"), F.col("n_current"))
    return result.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < alpha)


def population_stability(
    df: DataFrame,
    baseline: Column,
    current: Column,
    score: str = "model_predictions",
    bins: int = 10,
    edges: str = "independent",
) -> DataFrame:
    """Population stability index of the scores, over equal-width bins; bins empty on one side are skipped.

    ``independent`` cuts each sample's own range into bins; ``shared`` uses the baseline's range for both and
    counts values beyond it in the outer bins.
    """
    samples = F.array(F.when(baseline, F.lit("baseline")), F.when(current, F.lit("current")))
    tagged = F.explode(F.array_compact(samples))
    rows = (
        df.filter(F.col(score).isNotNull() & (baseline | current))
        .select(tagged.alias("sample"), F.col(score).cast("double").alias("score"))
        .filter(~F.isnan("score"))
    )
    # One row per sample.
    ends = F.min("score").alias("low"), F.max("score").alias("high")
    if edges == "shared":
        limits = rows.filter(F.col("sample") == "baseline").agg(*ends)
        limits = limits.select(F.explode(F.array(F.lit("baseline"), F.lit("current"))).alias("sample"), "low", "high")
    else:
        limits = rows.groupBy("sample").agg(*ends)
    clipped = F.greatest(F.least(F.col("score"), F.col("high")), F.col("low"))
    binned = rows.join(F.broadcast(limits), "sample").select(
        "sample", histogram_bin(clipped, F.col("low"), F.col("high"), bins).alias("bin")
    )
    is_base = F.col("sample") == "baseline"
    per_bin = binned.groupBy("bin").agg(F.count_if(is_base).alias("e"), F.count_if(~is_base).alias("a"))
    totals = per_bin.agg(
        F.sum("e").alias("n_baseline"),
        F.sum("a").alias("n_current"),
        F.collect_list(F.struct("e", "a")).alias("cells"),
    )
    expected = F.try_divide("cell.e", "n_baseline")
    actual = F.try_divide("cell.a", "n_current")
    term = (expected - actual) * F.ln(F.try_divide(expected, actual))
    filled = (F.col("cell.e") > 0) & (F.col("cell.a") > 0)
    return (
        totals.select("n_baseline", "n_current", F.explode_outer("cells").alias("cell"))
        .groupBy("n_baseline", "n_current")
        .agg(F.sum(F.when(filled, term).otherwise(F.lit(0.0))).alias("psi"))
        .select(
            F.coalesce("n_baseline", F.lit(0)).alias("n_baseline"),
            F.coalesce("n_current", F.lit(0)).alias("n_current"),
            F.when((F.col("n_baseline") > 0) & (F.col("n_current") > 0), F.col("psi")).alias("psi"),
        )
    )
