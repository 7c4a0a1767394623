"""Beta-binomial shrinkage as DataFrame expressions: empirical priors by moments, posterior bounds."""

from pyspark.sql import Column, DataFrame, functions as F

# The correlation of outcomes within one group is kept inside these limits, so that a prior always exists.
LEAST_CORRELATION, MOST_CORRELATION = 0.01, 0.95


def strength(groups: DataFrame, bad: str, total: str, mean: str, name: str) -> DataFrame:
    """One row: the pseudo-count of the prior whose mean for each group is column ``mean``.

    ``groups`` has one row per group; groups without outcomes say nothing. For beta-binomial counts the expected value of
    n (p - m)^2 is m (1 - m) (1 + (n - 1) rho); solving the sums for rho gives the prior's weight 1 / rho - 1.
    Without any information (no group with two outcomes) the prior counts as one outcome.
    """
    n, m = F.col(total).cast("double"), F.col(mean)
    spread = m * (1 - m)
    sums = groups.where(F.col(total) > 0).agg(
        F.sum(n * F.pow(F.try_divide(F.col(bad), n) - m, F.lit(2.0))).alias("_seen"),
        F.sum(spread).alias("_noise"),
        F.sum(spread * (n - 1)).alias("_unit"),
    )
    rho = F.when(F.col("_unit") > 0, F.try_divide(F.col("_seen") - F.col("_noise"), F.col("_unit"))).otherwise(F.lit(0.5))
    rho = F.greatest(F.lit(LEAST_CORRELATION), F.least(F.lit(MOST_CORRELATION), rho))
    return sums.select((1 / rho - 1).alias(name))


def posterior_mean(bad: Column, total: Column, mean: Column, weight: Column) -> Column:
    return (weight * mean + bad) / (weight + total)


def lower_bound(bad: Column, total: Column, mean: Column, weight: Column, z: float) -> Column:
    """The posterior mean less ``z`` posterior standard deviations."""
    p = posterior_mean(bad, total, mean, weight)
    return p - z * F.sqrt(p * (1 - p) / (weight + total + 1))
