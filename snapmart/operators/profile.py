"""Data-quality reports: null profiles, dirty values, key coverage, histories."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapmart.functions.columns import whole_number
from snapmart.schemas import ENTITY, SNAPSHOT


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls in each column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number and percentage of nulls, from a single aggregation."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    counts = df.agg(F.count("*").alias("_rows"), *nulls)
    percent = F.try_divide(F.col("null_count"), F.col("_rows")) * 100
    return counts.unpivot(["_rows"], df.columns, "column_name", "null_count").select(
        "column_name", "null_count", percent.alias("null_percent")
    )


def not_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text does not match a pattern; null texts are neither."""
    return df.filter(~F.col(column).rlike(pattern))


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Distinct numeric values outside the closed range, sorted; text that is not a number is ignored."""
    value = whole_number(F.col(column))
    return (
        df.select(value.alias(column))
        .filter((F.col(column) < low) | (F.col(column) > high))
        .distinct()
        .orderBy(column)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def entity_history(df: DataFrame, entity, key: str = ENTITY) -> DataFrame:
    """All rows of one entity in date order."""
    return df.filter(F.col(key) == entity).orderBy(SNAPSHOT)


def count_by_snapshot(df: DataFrame) -> DataFrame:
    return df.groupBy(SNAPSHOT).agg(F.count("*").alias("count")).orderBy(SNAPSHOT)


def key_coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and distinct keys of both sides, and the rows an inner join would give, without joining.

    Both sides are counted per key in one shuffle, so repeated keys cost nothing.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select(*keys, one.alias("l"), none.alias("r")).unionByName(
        right.select(*keys, none.alias("l"), one.alias("r"))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    whole_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return per_key.agg(
        F.sum("l").alias("left_rows"),
        F.count_if(F.col("l") > 0).alias("left_keys"),
        F.sum("r").alias("right_rows"),
        F.count_if(F.col("r") > 0).alias("right_keys"),
        F.sum(F.when(whole_key, F.col("l") * F.col("r"))).alias("matched_rows"),
    )
