"""Quality rules with host-level verdicts, all in DataFrame functions.

Each document is measured inside its row (arrays of its words and lines), so measuring shuffles nothing. Rule failures
are then counted per host, shrunk by a beta prior fitted to all hosts, and a host whose failure rate is high beyond
doubt takes its documents with it.

Defined cases: a null text has no words, and fails for being short; a null host counts as one host of its own; repeated
rows are measured, counted and returned each; an empty table gives an empty result. Extra columns stay; those named like
a result column are replaced. Windows are compared by 64-bit hashes within one document.
"""

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm import beta
from snapmart.llm.common import salted_left_join

SPACE = r"[\x20\x09-\x0D]+"
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 5


def _removed(text: Column, letters: str) -> Column:
    """How many of ``letters`` the text has."""
    return (F.char_length(text) - F.char_length(F.translate(text, letters, ""))).cast("long")


def _twice(hashes: Column) -> Column:
    """Ascending places of the values found at least twice; sorting by value makes equal ones neighbours."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def found(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

        repeated = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    # One-element arrays name a value for use in a lambda, so that it is computed once.
    return F.get(F.transform(F.array(placed), found), F.lit(0))


def _covered(places: Column) -> Column:
    """Words in windows starting at the ascending ``places``: each adds what the next one does not cover."""
    step = lambda s: F.aggregate(
        F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, b: a + b,
    )
    return F.get(F.transform(F.array(places), step), F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda s: F.translate(s, _SPACES, "") != "")
    windows = F.when(
        F.size("_llm_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_llm_words") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("_llm_words"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    # Most texts repeat nothing, which a set of hashes shows cheaply; only the others are sorted.
    repeats = F.when(F.size(F.array_distinct("_llm_windows")) < F.size("_llm_windows"), _covered(_twice(F.col("_llm_windows"))))
    short = F.col("n_words") < 10
    repetitive = 100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    return (
        docs.withColumns({"_llm_words": words, "_llm_lines": lines})
        .withColumn("_llm_windows", windows)
        .withColumns(
            {
                "n_words": F.size("_llm_words").cast("long"),
                "word_chars": (F.char_length(body) - _removed(body, _SPACES)).cast("long"),
                "n_symbols": _removed(body, _SYMBOLS),
                "n_dup_lines": (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(repeats, F.lit(0)).cast("long"),
            }
        )
        .drop("_llm_words", "_llm_lines", "_llm_windows")
        .withColumn("base_failed", short | repetitive)
    )


def host_verdicts(measured: DataFrame, host: str, z: float, threshold: float) -> DataFrame:
    """``_host, host_failed``: one row per host, counted before the shuffle."""
    hosts = measured.groupBy(F.coalesce(F.col(host), F.lit("")).alias("_llm_host")).agg(
        F.count(F.when(F.col("base_failed"), 1)).alias("bad"), F.count(F.lit(1)).alias("n")
    )
    overall = hosts.agg((F.sum("bad") / F.sum("n")).alias("mean"))
    hosts = hosts.join(F.broadcast(overall), how="left", on=F.lit(True))
    weight = beta.strength(hosts, "bad", "n", "mean", "w")
    bound = beta.lower_bound(F.col("bad"), F.col("n"), F.col("mean"), F.col("w"), z)
    return hosts.join(F.broadcast(weight), how="left", on=F.lit(True)).select(
        "_llm_host", (bound >= threshold).alias("_llm_host_failed")
    )


def judge(measured: DataFrame, host: str = "source", z: float = 1.645, threshold: float = 0.5) -> DataFrame:
    """``measured`` with ``kept``: neither the document's own rules nor its host failed.

    ``measured`` is read twice, so let it be a stored table.
    """
    verdicts = host_verdicts(measured, host, z, threshold)
    keyed = measured.withColumn("_llm_host", F.coalesce(F.col(host), F.lit("")))
    joined = salted_left_join(keyed, verdicts, "_llm_host")  # one host may have much of the table
    return joined.withColumn("kept", ~(F.col("base_failed") | F.col("_llm_host_failed"))).drop("_llm_host", "_llm_host_failed")
