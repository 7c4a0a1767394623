"""Summaries per snapshot that are stored and merged: quantiles, and distinct and shared keys.

A summary of each snapshot is kept as a small binary value in a snapshot table. Late or corrected snapshots rewrite their own
summaries only, and answers over any set of snapshots come from merging, without reading the rows again.
"""

from pyspark.sql import DataFrame, functions as F

from snapmart.schemas import SNAPSHOT

#: Size parameter of quantile sketches, and the rank error (as a share of the rows) that it keeps with 99 % confidence.
QUANTILE_SIZE, RANK_ERROR = 400, 0.01
#: Key sketches keep up to 2^KEY_BITS hashes.
KEY_BITS = 14


def quantile_sketches(df: DataFrame, columns: list[str], by: str = SNAPSHOT, size: int = QUANTILE_SIZE) -> DataFrame:
    """``column, sketch, by``: one summary per snapshot and column; nulls and NaN are not counted."""
    values = {c: F.col(c).cast("double") for c in columns}
    wide = df.groupBy(by).agg(*[F.kll_sketch_agg_double(F.when(~F.isnan(v), v), size).alias(c) for c, v in values.items()])
    return wide.unpivot(by, columns, "column", "sketch").select("column", "sketch", by)


def merged_quantiles(sketches: DataFrame, probabilities: list[float], by: list[str] = ()) -> DataFrame:
    """``by, column, n, probability, value`` over all snapshots in ``sketches``; no row for a column without values.

    The share of rows at or below a value differs from the probability by at most ``RANK_ERROR``.
    """
    merged = sketches.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double("sketch")).where("n > 0")
    asked = [
        F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probabilities
    ]
    return counted.select(*by, "column", "n", F.inline(F.array(*asked)))


def rank_shares(df: DataFrame, quantiles: DataFrame, columns: list[str]) -> DataFrame:
    """``quantiles`` with ``below`` and ``upto``: the exact shares of rows less than, and at most, each value."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "x")
    counts = values.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("column", "x").agg(F.count("*").alias("copies"))
    # A few quantiles for each column.
    compared = counts.join(F.broadcast(quantiles), "column")
    less, same = F.when(F.col("x") < F.col("value"), F.col("copies")), F.when(F.col("x") == F.col("value"), F.col("copies"))
    shares = compared.groupBy(*quantiles.columns).agg(
        F.coalesce(F.sum(less), F.lit(0)).alias("below"), F.coalesce(F.sum(same), F.lit(0)).alias("equal"), F.sum("copies").alias("rows")
    )
    return shares.select(
        *quantiles.columns, (F.col("below") / F.col("rows")).alias("below"), ((F.col("below") + F.col("equal")) / F.col("rows")).alias("upto")
    )


def key_sketches(df: DataFrame, keys: list[str], by: str = SNAPSHOT, bits: int = KEY_BITS) -> DataFrame:
    """``sketch, by``: one summary of the different keys of each snapshot; keys with a null are left out."""
    known = df.na.drop("any", subset=keys)
    text = F.concat_ws("|", *[F.concat(F.char_length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in keys])
    return known.groupBy(by).agg(F.theta_sketch_agg(text, bits).alias("sketch")).select("sketch", by)


def key_error(bits: int = KEY_BITS) -> float:
    """Three standard deviations of an estimate, as a share of the keys of both sides together."""
    return 3 / 2 ** (bits / 2)


def coverage_estimates(left: DataFrame, right: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """``measure, keys``: estimates of the different keys of two stored tables of summaries, those in both and in one only.

    The error is at most ``key_error`` of the keys of both sides together; below 2^bits keys the numbers are exact.
    """

    def merged(sketches: DataFrame, name: str) -> DataFrame:
        return sketches.agg(F.theta_union_agg("sketch", bits).alias(name))

    both = merged(left, "a").join(F.broadcast(merged(right, "b")), how="left", on=F.lit(True))
    measures = {
        "left_keys": F.col("a"),
        "right_keys": F.col("b"),
        "matched_keys": F.theta_intersection("a", "b"),
        "left_only_keys": F.theta_difference("a", "b"),
        "right_only_keys": F.theta_difference("b", "a"),
        "all_keys": F.theta_union("a", "b", bits),
    }
    named = [F.struct(F.lit(n).alias("measure"), F.theta_sketch_estimate(s).cast("long").alias("keys")) for n, s in measures.items()]
    return both.select(F.inline(F.array(*named)))
