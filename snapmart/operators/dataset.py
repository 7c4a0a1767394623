"""Training data: time windows, label-feature join, splits, preprocessing."""

import calendar
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.schemas import CATEGORICAL_INPUTS, ENTITY, NUMERIC_INPUTS, SNAPSHOT
from snapmart.sources.snapshots import between_snapshots


def months_before(day: date, months: int) -> date:
    """The same day of an earlier month, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = index // 12, index % 12 + 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class TrainingWindow:
    """Dates around a training date: a train-and-test period, then an out-of-time period up to the day before."""

    train_date: date
    train_test_months: int = 12
    oot_months: int = 2

    @property
    def oot_start(self) -> date:
        return months_before(self.train_date, self.oot_months)

    @property
    def oot_end(self) -> date:
        return self.train_date - timedelta(days=1)

    @property
    def train_test_start(self) -> date:
        return months_before(self.oot_start, self.train_test_months)

    @property
    def train_test_end(self) -> date:
        return self.oot_start - timedelta(days=1)


def training_frame(labels: DataFrame, features: DataFrame, window: TrainingWindow) -> DataFrame:
    """Labels of the window with their features; rows with any gap are dropped.

    A label without features has gaps only, so this is an inner join.
    """
    first, last = window.train_test_start, window.oot_end
    joined = between_snapshots(labels, first, last).join(
        between_snapshots(features, first, last), [ENTITY, SNAPSHOT], "inner"
    )
    return joined.na.drop("any")


def temporal_split(df: DataFrame, window: TrainingWindow) -> DataFrame:
    """Adds ``period``: ``train_test`` or ``oot``; rows outside both periods are left out."""

    def inside(first, last):
        return F.col(SNAPSHOT).between(F.lit(first), F.lit(last))

    period = F.when(inside(window.oot_start, window.oot_end), "oot").when(
        inside(window.train_test_start, window.train_test_end), "train_test"
    )
    return df.withColumn("period", period).filter(F.col("period").isNotNull())


def _row_order(keys: list[str], seed: int) -> Column:
    """A random-looking text order of the rows that depends on their key and the seed only."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def stratified_split(
    df: DataFrame, label: str = "label", keys=("loan_id", ENTITY, SNAPSHOT), train_share: float = 0.8, seed: int = 88
) -> DataFrame:
    """Adds ``split``: ``train`` or ``test``, with the label's distribution kept in both.

    The test side gets ``ceil(n * (1 - train_share))`` rows, and the labels share the train side by largest
    remainder. Which rows of a label go to train follows from a hash of ``keys``, which should identify a row;
    rows with equal keys stay on one side. No row is shuffled: small histograms of the hash lead to one threshold
    per label, and only the rows in the threshold's histogram cell (1/65,536 of them) are ordered.
    """
    ordered = df.withColumn("_order", _row_order(list(keys), seed)).withColumn("_cell", F.substring("_order", 1, 4))
    cells = ordered.groupBy(label, "_cell").agg(F.count("*").alias("rows"))
    quotas = _train_quotas(cells.groupBy(label).agg(F.sum("rows").alias("rows")), label, train_share)
    running = Window.partitionBy(label).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    edge_cells = (
        cells.withColumn("below", F.coalesce(F.sum("rows").over(running), F.lit(0)))
        .join(F.broadcast(quotas), label)
        .filter("quota > below and quota <= below + rows")
        .select(label, "_cell", "quota", "below")
    )
    # One row per label value on the broadcast side, here and below.
    at_edge = ordered.join(F.broadcast(edge_cells), [label, "_cell"]).groupBy(label, "_order", "quota", "below")
    upto = Window.partitionBy(label).orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    thresholds = (
        at_edge.agg(F.count("*").alias("rows"))
        .withColumn("seen", F.col("below") + F.sum("rows").over(upto))
        .filter(F.col("seen") >= F.col("quota"))
        .groupBy(label)
        .agg(F.min("_order").alias("_threshold"))
    )
    split = F.when(F.col("_order") <= F.col("_threshold"), "train").otherwise("test")
    return (
        ordered.join(F.broadcast(thresholds), label, "left")
        .withColumn("split", split)
        .select(*df.columns, "split")
    )


def _train_quotas(sizes: DataFrame, label: str, train_share: float) -> DataFrame:
    """Train rows per label: proportional shares rounded down, the rest to the largest remainders."""
    # One row per label, so they fit into one value.
    whole = sizes.agg(F.collect_list(F.struct(F.col(label).alias("label"), "rows")).alias("all"), F.sum("rows").alias("total"))
    # A product that is whole but for rounding is not rounded up.
    wanted = F.col("total") - F.ceil(F.col("total") * F.lit(1 - train_share) - F.lit(1e-9))

    def part(x: Column) -> Column:
        share = x["rows"] / F.col("total") * F.col("wanted")
        return F.struct((F.floor(share) - share).alias("less"), x["label"].alias("label"), F.floor(share).alias("base"))

    parts = whole.withColumn("wanted", wanted).select("wanted", F.array_sort(F.transform("all", part)).alias("parts"))
    spare = F.col("wanted") - F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["base"])
    shares = parts.select(spare.alias("spare"), F.posexplode("parts").alias("place", "part"))
    quota = F.col("part.base") + F.when(F.col("place") < F.col("spare"), 1).otherwise(0)
    return shares.select(F.col("part.label").alias(label), quota.alias("quota"))


def split_statistics(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows and positive rate (two decimals) of each split."""
    return df.groupBy(split).agg(F.count("*").alias("rows"), F.round(F.avg(label), 2).alias("positive_rate"))


def stratified_folds(
    df: DataFrame, folds: int, label: str = "label", keys=("loan_id", ENTITY, SNAPSHOT), seed: int = 42
) -> DataFrame:
    """Adds ``fold``, 0 to ``folds - 1``, of equal sizes and with the label's distribution kept in each.

    Folds are split off one after another: of those still to make, the first gets its share of each label.
    """
    parts, rest = [], df
    for fold in range(folds - 1):
        halves = stratified_split(rest, label, keys, 1 / (folds - fold), seed + fold)
        parts.append(halves.filter("split = 'train'").drop("split").withColumn("fold", F.lit(fold)))
        rest = halves.filter("split = 'test'").drop("split")
    parts.append(rest.withColumn("fold", F.lit(folds - 1)))
    return reduce(DataFrame.unionByName, parts)


def model_inputs(df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """The categories, numbers and flags among the columns of ``df`` that a model reads.

    Flags are the boolean columns; every other column beside the declared inputs is left out.
    """
    kinds = dict(df.dtypes)
    return (
        [c for c in CATEGORICAL_INPUTS if c in kinds],
        [c for c in NUMERIC_INPUTS if c in kinds],
        [c for c, kind in df.dtypes if kind == "boolean"],
    )


@dataclass(frozen=True)
class Preprocessor:
    """Fitted preprocessing as stages of Spark ML, which are saved with the model; ``names`` has the inputs in order.

    Numbers are standardised, flags are 0 and 1, categories become one indicator per known level.
    """

    stages: list
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns that the stages make, among them the vector ``inputs``."""
        for stage in self.stages:
            df = stage.transform(df)
        return df

    def input_columns(self, df: DataFrame) -> DataFrame:
        """``df`` with one column for each entry of the vector of inputs."""
        vector = vector_to_array("inputs")
        made = self.transform(df).withColumn("inputs", vector)
        return made.select(
            *[c for c in df.columns if c not in self.names], *[F.col("inputs")[i].alias(c) for i, c in enumerate(self.names)]
        )


def fit_preprocessor(
    df: DataFrame, categorical: list[str] | None = None, numeric: list[str] | None = None, flags: list[str] | None = None
) -> Preprocessor:
    """Levels of the categories in alphabetical order, means and population deviations of the numbers.

    Fit on the train split and use the result for every other frame; fitting on each frame apart gives
    per-frame scaling. A lone ``_`` counts as missing; missing and unknown levels have no indicator. A constant column
    is only centred. Inputs that are not named are those of ``model_inputs``.
    """
    found = model_inputs(df)
    categorical, numeric, flags = (f if given is None else given for f, given in zip(found, (categorical, numeric, flags)))
    moments = df.agg(
        F.count("*"),
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in numeric],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_scale") for c in numeric],
    ).first()
    if empty := [c for c in numeric if moments[f"{c}_mean"] is None]:
        raise ValueError(f"no values in {empty}")
    made = [
        f"(CAST(`{c}` AS DOUBLE) - ({moments[f'{c}_mean']!r}D)) / {moments[f'{c}_scale'] or 1.0!r}D AS `in_{i}`"
        for i, c in enumerate(numeric)
    ]
    made += [f"CAST(`{c}` AS INT) AS `in_{len(numeric) + i}`" for i, c in enumerate(flags)]
    made += [f"nullif(CAST(`{c}` AS STRING), '_') AS `level_{i}`" for i, c in enumerate(categorical)]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")] if made else []
    names, inputs = [*numeric, *flags], [f"in_{i}" for i in range(len(numeric) + len(flags))]
    if categorical:
        texts = stages[0].transform(df)
        numbered = [f"number_{i}" for i in range(len(categorical))]
        indexer = StringIndexer(
            inputCols=[f"level_{i}" for i in range(len(categorical))], outputCols=numbered,
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ).fit(texts)
        # A column without any level has no indicator.
        some = [i for i, levels in enumerate(indexer.labelsArray) if levels]
        hot = [f"hot_{i}" for i in some]
        stages.append(indexer)
        if some:
            # The number behind the last level stands for missing and unknown ones, and is dropped.
            stages.append(OneHotEncoder(inputCols=[numbered[i] for i in some], outputCols=hot).fit(indexer.transform(texts)))
        names += [f"{categorical[i]}_{level}" for i in some for level in indexer.labelsArray[i]]
        inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol="inputs"))
    return Preprocessor(stages, names)
