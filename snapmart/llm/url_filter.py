"""URL filters: explicit rules first, then the empirical-Bayes reputation of the host.

Pages that a rule decides are the labelled outcomes. Their block rates are shrunk from suffix to registered domain to
host, each level's posterior mean being the next level's prior mean. A page without a rule is blocked if the lower
posterior bound of its host's block rate reaches the threshold.

Defined cases: a null url, or one without ``://``, has empty host and path and no rule. Hosts without labelled pages
take the prior of their domain, suffix or the whole table. Without any labelled page nothing is blocked. Repeated rows
count as often as they occur, and each is returned. Columns of the input other than the url are not touched; those
named like a result column are replaced.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm import beta
from snapmart.llm.common import salted_left_join

ALLOW, BLOCK = "allow", "block"
# Suffixes of more than one label, under which names are registered.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where these are a known long suffix."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``struct<rule, verdict>``; null where none fits.

    A rule is (verdict, text); its text up to the first ``/`` is a host, the rest a path prefix. It fits that host and
    all its subdomains. ``rules`` is a stated list, evaluated within the scan: no join, no shuffle.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        chosen = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def reputation(pages: DataFrame, z: float) -> DataFrame:
    """``host, bound``: the lower posterior bound of each host's block rate.

    ``pages`` has ``host`` and ``verdict``. Rows are counted per host before anything else is shuffled; the levels above
    are sums of these counts.
    """
    hosts = pages.groupBy("host").agg(
        F.count(F.when(F.col("verdict") == BLOCK, 1)).alias("bad"), F.count("verdict").alias("n")
    )
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    sums = [F.sum("bad").alias("bad"), F.sum("n").alias("n")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    root = suffixes.agg(*sums).select(F.coalesce(F.col("bad") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)).alias("mean"))

    # The whole table's rate and each level's prior weight are one row each.
    suffixes = suffixes.join(F.broadcast(root), how="left", on=F.lit(True))
    suffixes = _shrunk(suffixes).select("suffix", F.col("p").alias("mean"))
    domains = _shrunk(domains.join(suffixes, "suffix")).select("suffix", "domain", F.col("p").alias("mean"))
    hosts = hosts.join(domains, ["suffix", "domain"])
    weight = beta.strength(hosts, "bad", "n", "mean", "w")
    return hosts.join(F.broadcast(weight), how="left", on=F.lit(True)).select(
        "host", beta.lower_bound(F.col("bad"), F.col("n"), F.col("mean"), F.col("w"), z).alias("bound")
    )


def _shrunk(level: DataFrame) -> DataFrame:
    weight = beta.strength(level, "bad", "n", "mean", "w")
    return level.join(F.broadcast(weight), how="left", on=F.lit(True)).withColumn(
        "p", beta.posterior_mean(F.col("bad"), F.col("n"), F.col("mean"), F.col("w"))
    )


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", z: float = 1.645, threshold: float = 0.5
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``."""
    at, below = host_of(F.col(url)), path_of(F.col(url))
    judged = pages.withColumns({"host": at, "path": below})
    judged = judged.withColumn("_llm_rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.withColumns({"rule": F.col("_llm_rule.rule"), "verdict": F.col("_llm_rule.verdict")}).drop("_llm_rule")
    bounds = reputation(judged.select("host", "verdict"), z).withColumnRenamed("bound", "_llm_bound")
    own = F.when(F.col("_llm_bound") >= threshold, BLOCK).otherwise(ALLOW)
    joined = salted_left_join(judged, bounds, "host")  # one host may have much of the table
    return joined.withColumn("verdict", F.coalesce("verdict", own)).drop("_llm_bound")
