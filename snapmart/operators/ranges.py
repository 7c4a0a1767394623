"""Ordering large groups over many tasks."""

from pyspark.sql import DataFrame, Window, functions as F


def by_range(counts: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Adds ``part``: rows of a lower part sort before rows of a higher one within each group.

    Spark samples the rows and cuts them into ranges of equal size, so a group or a crowded stretch of values
    that holds much of the data is spread over many tasks. Rows should be distinct in (groups, value) already.
    """
    return counts.repartitionByRange(*groups, value).withColumn("part", F.spark_partition_id())


def within_part(groups: list[str], value: str) -> Window:
    """Running frame over one part, up to and including the current value."""
    window = Window.partitionBy(*groups, "part").orderBy(value)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def earlier_parts(groups: list[str]) -> Window:
    """Frame over the parts before the current one; there are only as many as partitions."""
    return Window.partitionBy(*groups).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
