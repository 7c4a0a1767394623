"""Exact quantiles of many columns per group, without gathering a group anywhere.

Values are counted first; the counts are ordered over many tasks, and each wanted rank is found from the totals of the
parts before it. The steps are the same at every size, and ties and hot values cost nothing.
"""

from pyspark.sql import DataFrame, Window, functions as F

from snapmart.operators.ranges import by_range, earlier_parts, within_part
from snapmart.session import materialize


def exact_quantiles(df: DataFrame, by: list[str], columns: list[str], probabilities: list[float]) -> DataFrame:
    """The sample value at rank ``ceil(p * n)`` for each group, column and probability.

    Nulls and NaN are not counted. The result has the columns ``by``, ``column``, ``probability`` and ``value``;
    a column without values in a group has no row there.
    """
    values = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(by, columns, "column", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    keys = [*by, "column"]
    # Stored: a part's number holds only within one run of the range partitioning.
    counts = materialize(
        by_range(values.groupBy(*keys, "value").agg(F.count("*").alias("copies")), keys, "value")
        .withColumn("upto", F.sum("copies").over(within_part(keys, "value"))),
        "value-counts",
    )
    # One row per group and part that it reaches into, with the ranks that lie there.
    parts = counts.groupBy(*keys, "part").agg(F.max("upto").alias("inside"))
    below = F.coalesce(F.sum("inside").over(earlier_parts(keys)), F.lit(0))
    whole = F.sum("inside").over(Window.partitionBy(*keys))
    ranks = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("probability"),
                F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("n"))).cast("bigint").alias("rank"),
            )
            for p in probabilities
        ]
    )
    targets = (
        parts.select(*keys, "part", "inside", below.alias("below"), whole.alias("n"))
        .select(*keys, "part", "inside", "below", F.inline(ranks))
        .filter((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("inside")))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), "below", "probability", "rank")
    )
    same = F.col("part") == F.col("_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    upto = F.col("below") + F.col("upto")
    hit = (F.col("rank") <= upto) & (F.col("rank") > upto - F.col("copies"))
    return counts.join(targets, same).filter(hit).select(*keys, "probability", "value")


def approximate_quantiles(
    df: DataFrame, by: list[str], columns: list[str], probabilities: list[float], relative_error: float = 0.01
) -> DataFrame:
    """Sample values whose rank is off by at most ``relative_error``: one scan, one bounded sketch per group."""
    accuracy = int(round(1 / relative_error))
    usable = {c: F.col(c).cast("double") for c in columns}
    sketches = df.groupBy(*by).agg(
        *[
            F.percentile_approx(F.when(~F.isnan(v), v), [float(p) for p in probabilities], accuracy).alias(c)
            for c, v in usable.items()
        ]
    )
    pairs = F.arrays_zip(
        F.array(*[F.lit(float(p)) for p in probabilities]).alias("probability"), F.col("picked").alias("value")
    )
    return (
        sketches.unpivot(by, columns, "column", "picked")
        .filter(F.col("picked").isNotNull())
        .select(*by, "column", F.inline(pairs).alias("probability", "value"))
    )
