"""Column expressions for cleaning. All of them give null, never an error, on malformed input."""

from pyspark.sql import Column, functions as F

# Placeholder tokens of the sources and their replacements.
BAD_SSN, BLANK_SSN = "#F%$D@*&8", "000-00-0000"
BAD_OCCUPATION, NO_OCCUPATION = "_______", "Unemployed"
BAD_BEHAVIOUR, UNKNOWN_BEHAVIOUR = "!@9#%8", "Unknown"
YES_WORDS = ["yes", "y"]
NO_WORDS = ["no", "n"]
MISSING_WORDS = ["nm", "not mentioned", "na", "none", ""]
YEARS_PATTERN = r"(\d+)\s+Years"
MONTHS_PATTERN = r"(\d+)\s+Months"


# What Spark reads as a number, after the spaces around it.
WHOLE_PATTERN = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
REAL_PATTERN = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?[df]?|nan|inf|infinity)\s*$"


def replace_token(c: Column, token: str, replacement: str) -> Column:
    return F.when(c == token, F.lit(replacement)).otherwise(c)


def strip_underscores(c: Column) -> Column:
    return F.regexp_replace(c, "_", "")


def whole_number(c: Column) -> Column:
    """Text as an integer; a fraction, such as the ``.0`` of exported nullable integers, is cut off.

    Here and below a pattern is tried first, because a failing ``try_cast`` raises and catches an error inside,
    once per dirty value.
    """
    return _digits(c, WHOLE_PATTERN).try_cast("int")


def real_number(c: Column, type_name: str = "float") -> Column:
    return F.when(c.rlike(REAL_PATTERN), c.try_cast(type_name))


def number_from_text(c: Column) -> Column:
    return real_number(strip_underscores(c))


def _digits(text: Column, pattern: str) -> Column:
    """The pattern's first group, or null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def within(c: Column, low, high) -> Column:
    """The value if it lies in the closed range, else null."""
    return F.when((c >= low) & (c <= high), c)


def age(c: Column) -> Column:
    return within(whole_number(strip_underscores(c)), 0, 100)


def history_months(c: Column) -> Column:
    """Months in a text such as ``5 Years and 3 Months``; null without a years part."""
    text = strip_underscores(c)
    years = _digits(text, YEARS_PATTERN).try_cast("int").cast("bigint")
    months = _digits(text, MONTHS_PATTERN).try_cast("int")
    return (years * 12 + F.coalesce(months, F.lit(0))).try_cast("int")


def yes_no(c: Column) -> Column:
    word = F.trim(F.lower(c))
    return (
        F.when(word.isin(YES_WORDS), F.lit("Yes"))
        .when(word.isin(NO_WORDS), F.lit("No"))
        .when(word.isin(MISSING_WORDS), F.lit(None).cast("string"))
        .otherwise(word)
    )


def date_in_file_name(name: Column) -> Column:
    """Date of a file called ``..._YYYY_MM_DD.csv`` or ``.parquet`` in any letter case; null otherwise."""
    digits = F.regexp_replace(
        F.regexp_extract(name, r"(?i)(\d{4}_\d{2}_\d{2})\.(?:csv|parquet)$", 1), "_", "-"
    )
    return digits.try_cast("date")
