"""Cleaning of raw snapshot tables into typed silver tables."""

from pyspark.sql import DataFrame, functions as F

from snapmart.functions import columns as C
from snapmart.operators.quantiles import approximate_quantiles, exact_quantiles
from snapmart.schemas import ATTRIBUTE_TYPES, FINANCIAL_NUMBERS, SNAPSHOT
from snapmart.session import materialize


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that exist, malformed values to null; other columns pass through."""

    def cast(name, kind):
        if kind == "string" and types[name] == "int":
            return C.whole_number(F.col(name))
        if kind == "string" and types[name] in ("float", "double"):
            return C.real_number(F.col(name), types[name])
        return F.col(name).try_cast(types[name])

    return df.select(*[cast(c, kind).alias(c) if c in types else F.col(c) for c, kind in df.dtypes])


def clean_attributes(raw: DataFrame) -> DataFrame:
    """Typed customer attributes: placeholders replaced, ages outside 0 to 100 emptied."""
    fixes = {
        "SSN": C.replace_token(F.col("SSN"), C.BAD_SSN, C.BLANK_SSN),
        "Occupation": C.replace_token(F.col("Occupation"), C.BAD_OCCUPATION, C.NO_OCCUPATION),
        "Age": C.age(F.col("Age").cast("string")),
    }
    return cast_columns(raw.withColumns(fixes), ATTRIBUTE_TYPES)


def numbers_from_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns as 32-bit floats; stray underscores are removed from those that are text."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns(
        {c: C.number_from_text(F.col(c)) if c in text else F.col(c).try_cast("float") for c in columns}
    )


def outlier_bounds(
    df: DataFrame, columns: list[str], by: list[str], method: str = "exact", fences: float = 1.5
) -> DataFrame:
    """One row per group with ``<column>_low`` and ``<column>_high``, the quartiles widened by ``fences`` IQRs.

    ``exact`` uses the sample values at ranks ``ceil(n/4)`` and ``ceil(3n/4)``; ``approx`` lets the rank be off
    by 1 %, for a single scan.
    """
    find = {"exact": exact_quantiles, "approx": approximate_quantiles}[method]
    quartiles = find(df, by, columns, [0.25, 0.75])
    q1, q3 = (F.max(F.when(F.col("probability") == p, F.col("value"))) for p in (0.25, 0.75))
    wide = quartiles.groupBy(*by).pivot("column", columns).agg(q1.alias("q1"), q3.alias("q3"))
    reach = f"{float(fences)!r}D * (`{{c}}_q3` - `{{c}}_q1`)"
    ends = [f"`{{c}}_q1` - {reach} AS `{{c}}_low`", f"`{{c}}_q3` + {reach} AS `{{c}}_high`"]
    return wide.select(*by, *[F.expr(end.format(c=c)) for c in columns for end in ends])


def drop_outliers(
    df: DataFrame, columns: list[str], by=(SNAPSHOT,), method: str = "exact", fences: float = 1.5
) -> DataFrame:
    """Empty the values outside their group's IQR fences; a column without any value stays empty."""
    by = list(by)
    bounds = materialize(outlier_bounds(df, columns, by, method, fences), "outlier-bounds")
    kept = {c: C.within(F.col(c), F.col(f"{c}_low"), F.col(f"{c}_high")) for c in columns}
    return df.join(bounds, by, "left").select(*[kept[c].alias(c) if c in kept else F.col(c) for c in df.columns])


def clean_numeric(df: DataFrame, columns: list[str], by=(SNAPSHOT,), method: str = "exact") -> DataFrame:
    """Underscores removed, cast to float, outliers per group emptied: all columns together."""
    return drop_outliers(materialize(numbers_from_text(df, columns), "typed-numbers"), columns, by, method)


def normalize_financial_texts(df: DataFrame) -> DataFrame:
    """Credit history in months (moved last), payment words normalised; absent columns are skipped."""
    fixes = {
        "Payment_of_Min_Amount": lambda c: C.yes_no(c),
        "Payment_Behaviour": lambda c: C.replace_token(c, C.BAD_BEHAVIOUR, C.UNKNOWN_BEHAVIOUR),
        SNAPSHOT: lambda c: c.try_cast("date"),
    }
    history = "Credit_History_Age"
    kept = [
        fixes[c](F.col(c)).alias(c) if c in fixes else F.col(c) for c in df.columns if c != history
    ]
    if history in df.columns:
        kept.append(C.history_months(F.col(history)).alias(history))
    return df.select(*kept)


def type_financials(raw: DataFrame) -> DataFrame:
    """Financial rows with normalised texts and 32-bit numbers, outliers still in."""
    texts = normalize_financial_texts(raw)
    return numbers_from_text(texts, [c for c in FINANCIAL_NUMBERS if c in texts.columns])


def drop_financial_outliers(typed: DataFrame, method: str = "exact") -> DataFrame:
    """Typed financial rows with the outliers of each snapshot emptied; reads its input several times."""
    return drop_outliers(typed, [c for c in FINANCIAL_NUMBERS if c in typed.columns], method=method)


def clean_financials(raw: DataFrame, method: str = "exact") -> DataFrame:
    """Typed once and stored, as the outlier search reads its input several times."""
    return drop_financial_outliers(materialize(type_financials(raw), "typed-financials"), method)


def underscores_to_null(df: DataFrame) -> DataFrame:
    """A lone ``_`` becomes null in every text column."""
    text = [name for name, kind in df.dtypes if kind == "string"]
    return df.replace("_", None, subset=text) if text else df


def null_shares(df: DataFrame) -> dict[str, float]:
    """Percentage of nulls per column; one aggregation, and a single row comes to the driver."""
    row = df.agg(
        F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    ).first()
    rows = row["rows"]
    return {c: (rows - row[f"n_{i}"]) / rows * 100 if rows else 0.0 for i, c in enumerate(df.columns)}


def drop_sparse_columns(df: DataFrame, max_null_percent: float = 5.0) -> DataFrame:
    """Drop every column with more than ``max_null_percent`` nulls over all snapshots."""
    return df.drop(*[c for c, share in null_shares(df).items() if share > max_null_percent])
