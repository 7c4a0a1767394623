"""Loan delinquency: payment status per snapshot, default labels, bad rates."""

from pyspark.sql import DataFrame, functions as F

from snapmart.operators.clean import cast_columns
from snapmart.schemas import ENTITY, LOAN_TYPES, SNAPSHOT


def add_delinquency(raw: DataFrame) -> DataFrame:
    """Typed loan rows with months on book, missed instalments, first missed date and days past due.

    Amounts are 32-bit, and their ratio is taken in double precision before rounding up. A loan with an
    overdue amount but no due amount has zero missed instalments and unknown days past due.
    """
    loans = cast_columns(raw, LOAN_TYPES)
    overdue, due = F.col("overdue_amt").cast("double"), F.col("due_amt").cast("double")
    missed = F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))
    loans = loans.select("*", F.col("installment_num").alias("mob"), missed.alias("installments_missed"))
    first_missed = F.when(
        F.col("installments_missed") > 0, F.add_months(SNAPSHOT, -F.col("installments_missed"))
    )
    loans = loans.select("*", first_missed.alias("first_missed_date"))
    dpd = F.when(F.col("overdue_amt") > 0, F.datediff(SNAPSHOT, "first_missed_date")).otherwise(F.lit(0))
    return loans.select("*", dpd.alias("dpd"))


def is_bad(dpd: int):
    """1 if the loan is at least ``dpd`` days past due, else 0, also when that is unknown."""
    return F.when(F.col("dpd") >= dpd, F.lit(1)).otherwise(F.lit(0))


def default_labels(loans: DataFrame, dpd: int = 90, mob: int = 7) -> DataFrame:
    """Label of every loan at ``mob`` months on book."""
    return loans.filter(F.col("mob") == mob).select(
        "loan_id", ENTITY, is_bad(dpd).alias("label"), F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"), SNAPSHOT
    )


def bad_rate_by_mob(loans: DataFrame, dpd: int = 90, started_before=None) -> DataFrame:
    """Share of bad loans by months on book, for loans started before a date."""
    if started_before is not None:
        loans = loans.filter(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    return loans.groupBy("mob").agg(F.avg(is_bad(dpd)).alias("bad_rate")).orderBy("mob")
