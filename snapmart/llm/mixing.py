"""Mixing sources to target weights: whole copies first, then a Pareto order sample of exactly the words still wanted.

Sources share a number of words by weight. None gets more than ``most`` times its own words; what is over goes to the
others by weight. Within a source a document's expected copies follow its odds, the binary digits of its length, up to
``most``; the whole part of the expectation is taken for certain. The rest is an inclusion probability; documents are
ranked by u / (1 - u) over p / (1 - p), with u a fixed random number of the document, and taken in that order until the
source has its words. The last one is taken in part, so each source comes to its target, rounded to a word.

Rates follow from counts by source and length class. The order is cut into ranges over many tasks, so no source passes
through one; the rates reach the documents in a join whose hot sources Spark splits.

Defined cases: a null text has no words, and a document without words is never taken. A null source is a source of its own,
behind all others; an empty name is another. The random number comes from key and seed, that of a row without a key from its
text; equal numbers are ordered by length and a hash of key and text, so that only repeated rows are interchangeable. Other
columns stay, but for those named like a result. Texts of any length are only counted. An empty table, or one without words, gives targets of 0.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.operators.ranges import by_range, earlier_parts, within_part
from snapmart.session import materialize

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 52


def _random(key: str, text: str, seed: int) -> Column:
    """A number between 0 and 1, neither included, that depends on the key and the seed only."""
    of = F.coalesce(F.col(key).cast("string"), F.col(text), F.lit(""))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), of)), 1, _DIGITS // 4), 16, 10).cast("long")
    return (drawn.cast("double") + 0.5) / float(1 << _DIGITS)


def _running(rows: DataFrame, groups: list[str], value: str, sums: Sequence[str]) -> DataFrame:
    """``rows`` in ranges, with ``upto_x`` for each x of ``sums``: the sum over the group up to and including the row.

    Rows that are equal in ``value`` add up one after the other, in any order. What earlier parts of a group add up to
    is known per part; a cut between two parts goes through one group, so that table has fewer rows than parts.
    """
    ranged = materialize(by_range(rows, groups, value), "mix-ranged")
    earlier = ranged.groupBy(*groups, "part").agg(*[F.sum(c).alias(c) for c in sums]).select(
        *groups, "part", *[F.sum(c).over(earlier_parts(groups)).alias(f"before_{c}") for c in sums]
    )
    earlier = earlier.where(F.col(f"before_{sums[0]}").isNotNull())
    inside = ranged.select("*", *[F.sum(c).over(within_part(groups, value)).alias(f"upto_{c}") for c in sums])
    joined = inside.join(F.broadcast(earlier), [*groups, "part"], "left")
    joined = joined.withColumns({f"upto_{c}": F.coalesce(f"before_{c}", F.lit(0)) + F.col(f"upto_{c}") for c in sums})
    return joined.drop("part", *[f"before_{c}" for c in sums])


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source`` (a struct that puts null last) and ``words`` of each source, with its ``target`` words.

    In the order of the most that a source can give per weight, the ones before the level of the water are full, and the
    others get the level times their weight.
    """
    ranked = _running(sources.withColumn("one", F.lit(1).cast("long")), [], "source", ["one"])
    steps = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    full = F.col("words") * most
    weighed = ranked.withColumn("weight", F.get(steps, F.pmod(F.col("upto_one") - 1, F.lit(len(weights))).cast("int")))
    weighed = weighed.select("source", "words", "weight", full.alias("full"))
    weighed = materialize(weighed.withColumn("filled", F.struct((full / F.col("weight")).alias("at"), "source")), "mix-sources")
    summed = _running(weighed, [], "filled", ["full", "weight"])
    everything = weighed.agg(F.sum("words").alias("all_words"), F.sum("weight").alias("all_weight"))
    rest = F.col("all_words") * F.lit(float(share)) - (F.col("upto_full") - F.col("full"))
    level = rest / (F.col("all_weight") - (F.col("upto_weight") - F.col("weight")))
    levels = summed.join(F.broadcast(everything), how="left", on=F.lit(True)).withColumn("level", level)
    # The first source that the level does not fill.
    found = levels.where(F.col("level") <= F.col("filled.at")).agg(F.min_by("level", "filled").alias("level"))
    target = F.least(F.col("full").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("full").cast("double")))
    return weighed.join(F.broadcast(found), how="left", on=F.lit(True)).select("source", "words", target.alias("target"))


def _rates(classes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``source, words, target, rate, wanted``: expected copies per odds, and words to take beyond the certain copies.

    ``classes`` has the words of each source by odds, a few dozen rows per source. Classes of high odds are full first.
    """
    high = Window.partitionBy("source").orderBy(F.col("odds").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("source")
    joined = classes.withColumnRenamed("words", "class_words").join(targets, "source")
    spread = F.col("class_words") * F.col("odds")
    before = joined.withColumns(
        {
            "full_words": F.coalesce(F.sum("class_words").over(high), F.lit(0)),
            "open_odds": F.sum(spread).over(every) - F.coalesce(F.sum(spread).over(high), F.lit(0)),
        }
    )
    rate = F.try_divide(F.col("target") - most * F.col("full_words"), F.col("open_odds"))
    rates = before.withColumn("rate", rate)
    fits = F.col("rate") * F.col("odds") <= most
    found = rates.where(F.col("odds") > 0).groupBy("source", "words", "target").agg(
        F.coalesce(F.max_by(F.when(fits, F.col("rate")), F.when(fits, F.col("odds"))), F.lit(float(most))).alias("rate")
    )
    certain = F.floor(F.least(F.lit(float(most)), F.col("rate") * F.col("odds")))
    sums = joined.join(found.select("source", "rate"), "source").groupBy("source").agg(
        F.sum(certain * F.col("class_words")).alias("certain_words")
    )
    wanted = F.greatest(F.round("target").cast("long") - F.col("certain_words"), F.lit(0))
    return found.join(sums, "source").select("source", "words", "target", "rate", wanted.alias("wanted"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
    share: float = SHARE, most: int = MOST, seed: int = 1,
) -> DataFrame:
    """``docs`` without its text, with ``size, source_size, target, certain, inclusion, taken``.

    ``taken`` counts the words that the mix takes of a document: its certain copies, and all or the first words of one more.
    """
    made = ("size", "source_size", "target", "certain", "inclusion", "taken")
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    names = [c for c in docs.columns if c not in (*made, text)]
    sized = docs.select(
        F.struct(F.col(source).isNull().alias("none"), F.coalesce(F.col(source), F.lit("")).alias("name")).alias("_llm_source"),
        _random(key, text, seed).alias("_llm_u"), words.alias("_llm_size"), F.struct(*names).alias("_llm_row"),
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("_llm_id"),
    )
    # Binary digits, counted without logarithms; no word, no odds.
    sized = sized.withColumn("_llm_odds", F.when(F.col("_llm_size") > 0, F.length(F.bin("_llm_size"))).otherwise(0).cast("long"))
    sized = materialize(sized, "mix-sized")
    classes = materialize(
        sized.groupBy(F.col("_llm_source").alias("source"), F.col("_llm_odds").alias("odds")).agg(F.sum("_llm_size").alias("words")),
        "mix-classes",
    )
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("words")), weights, share, most)
    targets = materialize(targets, "mix-targets")
    rates = _rates(classes, targets, most).select(F.col("source").alias("_llm_source"), "rate", "wanted")
    settings = targets.select(F.col("source").alias("_llm_source"), "words", "target").join(rates, "_llm_source", "left")
    rated = sized.join(materialize(settings, "mix-rates"), "_llm_source")
    copies = F.least(F.lit(float(most)), F.coalesce("rate", F.lit(0.0)) * F.col("_llm_odds"))
    rated = rated.withColumn("_llm_certain", F.floor(copies)).withColumn("_llm_p", copies - F.floor(copies))
    drawn = F.try_divide(F.col("_llm_u") / (1 - F.col("_llm_u")), F.col("_llm_p") / (1 - F.col("_llm_p")))
    ordered = rated.withColumns(
        {
            "_llm_order": F.struct(F.coalesce(drawn, F.lit(float("inf"))).alias("q"), "_llm_size", "_llm_id"),
            "_llm_open": F.when(F.col("_llm_p") > 0, F.col("_llm_size")).otherwise(0),
        }
    )
    summed = _running(ordered, ["_llm_source"], "_llm_order", ["_llm_open"])
    before = F.col("upto__llm_open") - F.col("_llm_open")
    more = F.greatest(F.lit(0), F.least("_llm_open", F.coalesce("wanted", F.lit(0)) - before))
    return summed.select(
        *[F.col("_llm_row")[c].alias(c) for c in names], F.col("_llm_size").alias("size"), F.col("words").alias("source_size"),
        "target", F.col("_llm_certain").cast("long").alias("certain"), F.col("_llm_p").alias("inclusion"),
        (F.col("_llm_certain") * F.col("_llm_size") + more).cast("long").alias("taken"),
    )
