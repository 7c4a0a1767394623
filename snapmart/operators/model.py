"""Gradient-boosted classifier: search, fit, persist, register, score."""

import itertools
import random
from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapmart.operators import boosting
from snapmart.operators.boosting import Fit, Grower
from snapmart.operators.dataset import Preprocessor, TrainingWindow, stratified_folds
from snapmart.operators.monitor import auc
from snapmart.schemas import ENTITY, SNAPSHOT
from snapmart.session import work_tables

KEYS = ("loan_id", ENTITY, SNAPSHOT)

# The search space.
SEARCH_SPACE = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "columnShare": [0.6, 0.8],
    "minGain": [0.0, 0.1],
    "minHessian": [1, 3, 5],
    "l1": [0.0, 0.1, 1.0],
    "l2": [1.0, 1.5, 2.0],
}


def prepare(df: DataFrame, fitted: Preprocessor, keys: Sequence[str] = KEYS, keep: Sequence[str] = ()) -> boosting.Binned:
    """The binned inputs, the label, a number drawn for each row by its key, and the columns to keep."""
    rows = fitted.transform(df).select(
        "inputs", F.col("label").cast("double").alias("label"), boosting.row_draw(keys).alias("draw"), *keep
    )
    return boosting.binned(rows, len(fitted.names), keep)


def fit(train: DataFrame, fitted: Preprocessor, seed: int = 88, keys: Sequence[str] = KEYS, **params) -> PipelineModel:
    """A model of one setting; see ``boosting.DEFAULTS`` for its parameters."""
    with work_tables(train.sparkSession):
        grower = Grower(prepare(train, fitted, keys), [Fit(params)], seed)
        grower.grow()
        return PipelineModel([*fitted.stages, boosting.grown_model(grower)])


def draw_settings(space: dict[str, list], draws: int, seed: int) -> list[dict]:
    """``draws`` different settings of the space, or all of them if there are fewer."""
    everything = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(everything, min(draws, len(everything)))


def fold_areas(grower: Grower, folds: int) -> dict[int, float | None]:
    """Exact AUC of each fit over the fold that it did not see; fit i left out fold ``i % folds``."""
    unseen = F.transform(
        F.sequence(F.col("fold").cast("int"), F.lit(len(grower.fits) - 1), F.lit(folds)),
        lambda i: F.struct(i.alias("fit"), F.get("margins", i).alias("score")),
    )
    scored = boosting.margins_of(grower, ["label", "fold"]).select("label", F.inline(unseen))
    return {r["fit"]: r["auc"] for r in auc(scored, "score", "label", ["fit"]).collect()}  # one row per fit


def random_search(
    train: DataFrame,
    fitted: Preprocessor,
    keys: Sequence[str] = KEYS,
    space: dict[str, list] = SEARCH_SPACE,
    draws: int = 100,
    folds: int = 3,
    seed: int = 42,
    model_seed: int = 88,
) -> tuple[PipelineModel, dict, float]:
    """Best of ``draws`` random settings by cross-validated AUC, refitted on all rows.

    Gives the model, its settings and its mean AUC over the folds. Folds have equal shares of each label and follow from
    the row's key. The fits of all settings and folds grow together; of equally good settings the first drawn one wins.
    """
    settings = draw_settings(space, draws, seed)
    with work_tables(train.sparkSession):
        data = prepare(stratified_folds(train, folds, keys=keys, seed=seed), fitted, keys, ["fold"])
        grower = Grower(data, [Fit(s, fold) for s in settings for fold in range(folds)], model_seed, "fold")
        grower.grow()
        areas = fold_areas(grower, folds)
        means = []
        for i in range(len(settings)):
            known = [a for a in (areas.get(i * folds + f) for f in range(folds)) if a is not None]
            means.append(sum(known) / len(known) if known else float("-inf"))
        best = max(range(len(settings)), key=means.__getitem__)
        final = Grower(data, [Fit(settings[best])], model_seed)
        final.grow()
        return PipelineModel([*fitted.stages, boosting.grown_model(final)]), settings[best], means[best]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_probability(model: PipelineModel, df: DataFrame, column: str = "model_predictions") -> DataFrame:
    """All columns of ``df`` and the probability of the positive class."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("probability").alias(column))


def score_snapshots(model: PipelineModel, features: DataFrame, snapshots: list, model_name: str) -> DataFrame:
    """Prediction rows for the given snapshots; feature rows with any gap are not scored."""
    days = [F.lit(s).cast("date") for s in snapshots]
    complete = features.filter(F.col(SNAPSHOT).isin(days)).na.drop("any")
    return with_probability(model, complete).select(
        ENTITY, SNAPSHOT, F.lit(model_name).alias("model_name"), "model_predictions"
    )


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("data_dates", T.MapType(T.StringType(), T.DateType())),
        T.StructField("data_config", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("data_stats", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("results", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("hp_params", T.MapType(T.StringType(), T.StringType())),
    ]
)


def registry_record(
    spark: SparkSession,
    name: str,
    window: TrainingWindow,
    split_stats: DataFrame,
    split_auc: DataFrame,
    settings: dict,
    train_share: float = 0.8,
    search_auc: float | None = None,
) -> DataFrame:
    """One row that describes a trained model: dates, window lengths, split sizes and rates, AUC and Gini per split, the
    search's mean AUC, settings.

    ``split_stats`` and ``split_auc`` have one row per split.
    """
    dates: dict[str, date] = {
        "model_train_date": window.train_date,
        "oot_start_date": window.oot_start,
        "oot_end_date": window.oot_end,
        "train_test_start_date": window.train_test_start,
        "train_test_end_date": window.train_test_end,
    }
    config = {
        "train_test_period_months": float(window.train_test_months),
        "oot_period_months": float(window.oot_months),
        "train_test_ratio": train_share,
    }
    stats, results = {}, {} if search_auc is None else {"auc_search": search_auc}
    for r in split_stats.collect():
        stats[f"rows_{r['split']}"] = float(r["rows"])
        stats[f"positive_rate_{r['split']}"] = r["positive_rate"]
    for r in split_auc.collect():
        results[f"auc_{r['split']}"] = r["auc"]
        results[f"gini_{r['split']}"] = r["gini"]
    version = f"credit_model_{window.train_date:%Y_%m_%d}"
    params = {k: str(v) for k, v in settings.items()}
    return spark.createDataFrame([(name, version, dates, config, stats, results, params)], REGISTRY_SCHEMA)
