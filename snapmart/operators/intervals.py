"""Join of two tables by key and overlapping time spans, without comparing all rows of a key.

Time is cut into bins. Each span is repeated for the bins that it reaches into, rows meet by key and bin, and a pair that
shares several bins is given by one of them: the first that both reach. So a key with very many rows is spread over its
bins, and what is still large there is split by Spark as the join runs, as both sides come from stored tables or plain scans.
"""

from pyspark.sql import Column, DataFrame, functions as F



def _in_bins(rows: DataFrame, side: str, span: tuple[str, str], bin_days: int) -> DataFrame:
    """``rows`` once for each bin; spans with a null end, or that end before they start, overlap nothing."""
    first, last = (F.unix_date(F.col(c).cast("date")) for c in span)

    def bin_of(day: Column) -> Column:
        return F.floor(day / bin_days).cast("int")

    sound = rows.where(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull() & (first <= last))
    made = sound.withColumns({f"_from_{side}": first, f"_to_{side}": last, f"_first_{side}": bin_of(first)})
    return made.withColumn("_bin", F.explode(F.sequence(bin_of(first), bin_of(last))))


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], bin_days: int = 31
) -> DataFrame:
    """All pairs of rows with equal keys whose spans of days share a day, both ends included.

    A span is named by its first and last day's columns; for points in time both are the same column. Other columns must not
    have the same names on both sides. ``bin_days`` should be about as long as the usual span: longer bins hold more pairs that
    do not overlap, shorter ones repeat the spans more often.
    """
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    a, b = _in_bins(left, "a", left_span, bin_days), _in_bins(right, "b", right_span, bin_days)
    met = a.join(b, [*keys, "_bin"])
    overlap = (F.col("_from_a") <= F.col("_to_b")) & (F.col("_from_b") <= F.col("_to_a"))
    owner = F.col("_bin") == F.greatest("_first_a", "_first_b")
    return met.where(overlap & owner).select(
        *keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys]
    )
