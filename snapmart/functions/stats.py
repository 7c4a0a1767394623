"""Statistical expressions: equal-width histogram bins and Kolmogorov-Smirnov p-values."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def histogram_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin of ``value`` in [low, high], the last bin closed on both sides.

    The bin from the division is corrected by comparing with the edges ``low + i * step`` themselves, so values
    that lie on an edge fall as an edge array would have them. An empty range is widened by 0.5 on each side.
    """
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    stop = F.when(flat, high + 0.5).otherwise(high)
    step = (stop - start) / bins
    last = F.lit(bins - 1)
    guess = F.least(F.floor((value - start) / (stop - start) * bins).cast("int"), last)
    lower = F.when(value < start + guess * step, -1).otherwise(0)
    raised = (guess < last) & (value >= start + (guess + 1) * step)
    return guess + lower + F.when(raised, 1).otherwise(0)


def kolmogorov_p(statistic: Column, n: Column, m: Column, terms: int = 40) -> Column:
    """Large-sample p-value of the two-sample statistic.

    The Kolmogorov series, with the effective sample size ``n*m/(n+m)`` corrected to order 1/n after
    J. Vrbik, "Small-sample corrections to Kolmogorov-Smirnov test statistic" (2018).
    """
    n, m = n.cast("double"), m.cast("double")
    size = F.nullif(F.round(F.try_divide(n * m, n + m)), F.lit(0.0))
    z = statistic * F.sqrt(size)
    corrected = z + 1 / (6 * F.sqrt(size)) + (z - 1) / (4 * size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * corrected * corrected),
    )
    # Below this the series needs more terms, and the p-value is 1 to more than 15 digits.
    p = F.when(corrected < 0.18, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return F.when(size.isNotNull() & statistic.isNotNull(), p)


def _chance_of_staying_below(statistic: float, n: int, m: int) -> float:
    """P(D < statistic) for samples of n and m without ties.

    Draws the pooled sample in order, one value per step. ``chance[i]`` is the probability that i of the values
    drawn so far came from the first sample and that the two distributions stayed closer than the statistic.
    """
    gap = round(statistic * n * m)
    first = np.arange(n + 1)
    chance = np.zeros(n + 1)
    chance[0] = 1.0
    for drawn in range(n + m):
        left = n + m - drawn
        from_first = chance * (n - first) / left
        chance = chance * (m - (drawn - first)) / left
        chance[1:] += from_first[:-1]
        chance[np.abs(first * m - (drawn + 1 - first) * n) >= gap] = 0.0
    return float(chance[n])


def exact_p(statistic: float, n: int, m: int) -> float:
    if statistic <= 0:
        return 1.0
    return min(1.0, max(0.0, 1.0 - _chance_of_staying_below(statistic, min(n, m), max(n, m))))


@F.pandas_udf(T.DoubleType())
def exact_p_column(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact two-sample p-values, one per row of a result table (one row per feature)."""
    return pd.Series(
        [None if pd.isna(d) else exact_p(d, int(a), int(b)) for d, a, b in zip(statistic, n, m)], dtype="float64"
    )
