from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmart.functions import columns as C
from snapmart.operators import clean

from conftest import rows


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_age(spark):
    df = texts(spark, ["28_", "-5", "150", "", "abc", None, "0", "100", "101", "_3_4_", "28.0", "99999999999"])
    assert column(df, C.age(F.col("v"))) == [28, None, None, None, None, None, 0, 100, None, 34, 28, None]


def test_whole_number(spark):
    df = texts(spark, ["7", "7.0", "-3.7", " 12 ", "x", "", None, "9999999999.5"])
    assert column(df, C.whole_number(F.col("v"))) == [7, 7, -3, 12, None, None, None, None]


def test_tokens_match_whole_values_only(spark):
    df = texts(spark, ["_______", "______", "_______ ", None, "Lawyer"])
    got = column(df, C.replace_token(F.col("v"), C.BAD_OCCUPATION, C.NO_OCCUPATION))
    assert got == ["Unemployed", "______", "_______ ", None, "Lawyer"]
    df = texts(spark, ["#F%$D@*&8", "#F%$D@*&", "000-11-2222"])
    assert column(df, C.replace_token(F.col("v"), C.BAD_SSN, C.BLANK_SSN)) == [
        "000-00-0000", "#F%$D@*&", "000-11-2222",
    ]


def test_history_months(spark):
    cases = {
        "5 Years and 3 Months": 63, "1 Years": 12, "1 Year": None, "5_ Years": 60, "7 Months": None,
        "NA": None, "": None, None: None, "0 Years and 11 Months": 11, "999999999 Years": None,
    }
    df = texts(spark, list(cases))
    assert column(df, C.history_months(F.col("v"))) == list(cases.values())


def test_yes_no(spark):
    cases = {
        "Yes": "Yes", " y ": "Yes", "NO": "No", "n": "No", "NM": None, "Not Mentioned": None, "na": None,
        "None": None, "": None, "  ": None, None: None, " Maybe ": "maybe",
    }
    df = texts(spark, list(cases))
    assert column(df, C.yes_no(F.col("v"))) == list(cases.values())


def test_date_in_file_name(spark):
    cases = {
        "bronze_table_2024_01_31.csv": date(2024, 1, 31), "x_2024_01_31.PARQUET": date(2024, 1, 31),
        "x_2024_13_31.csv": None, "x_2024_01_31.txt": None, "x.csv": None, "2023_01_01_2024_02_03.csv": date(2024, 2, 3),
    }
    df = texts(spark, list(cases))
    assert column(df, C.date_in_file_name(F.col("v"))) == list(cases.values())


def test_real_numbers_are_what_a_cast_reads(spark):
    values = ["1", "-2.5", "+.5", "3.", "1e3", "1.5E-2", " 7 ", "2f", "3D", "x", "", None, "1_0", "--1", "1e", ".", "Infinity",
              "-inf", "1,5", "12 months"]
    df = texts(spark, values)
    cast = column(df, F.col("v").try_cast("float"))
    assert column(df, C.real_number(F.col("v"))) == cast
    assert cast[:5] == [1.0, -2.5, 0.5, 3.0, 1000.0] and cast[9:16] == [None] * 7
    assert str(column(texts(spark, ["NaN"]), C.real_number(F.col("v")))[0]) == "nan"


def test_cast_columns_tolerates_absent_and_malformed(spark):
    df = spark.createDataFrame([("1.0", "x", "2024-01-01"), ("a", "y", "soon")], "n string, other string, d string")
    out = clean.cast_columns(df, {"n": "int", "d": "date", "absent": "float"})
    assert dict(out.dtypes) == {"n": "int", "other": "string", "d": "date"}
    assert rows(out) == rows(spark.createDataFrame([(1, "x", date(2024, 1, 1)), (None, "y", None)], out.schema))


def test_underscores_to_null(spark):
    df = spark.createDataFrame([("_", "__", 1), ("a_", None, 2)], "a string, b string, n int")
    assert rows(clean.underscores_to_null(df)) == rows(
        spark.createDataFrame([(None, "__", 1), ("a_", None, 2)], df.schema)
    )


def outlier_frame(spark):
    values = [(1, float(v), None, 7.0) for v in [1, 2, 3, 4, 100]] + [(2, 5.0, None, 7.0), (3, None, 1.0, 8.0)]
    return spark.createDataFrame(values, "g int, a double, empty double, flat double")


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_drop_outliers_per_group(spark, method):
    out = clean.drop_outliers(outlier_frame(spark), ["a", "empty", "flat"], ["g"], method)
    assert rows(out) == rows(
        spark.createDataFrame(
            [(1, float(v), None, 7.0) for v in [1, 2, 3, 4]]
            + [(1, None, None, 7.0), (2, 5.0, None, 7.0), (3, None, 1.0, 8.0)],
            out.schema,
        )
    )


def test_nan_and_underscores_in_numbers(spark):
    df = spark.createDataFrame(
        [(1, "_1_", 1), (1, "2", 2), (1, "NaN", 3), (1, "x", 4), (1, "3.5", 5)], "snapshot_date int, t string, n int"
    )
    out = clean.clean_numeric(df, ["t", "n"])
    assert dict(out.dtypes)["t"] == "float"
    assert sorted(r.t for r in out.collect() if r.t is not None) == [1.0, 2.0, 3.5]


def test_drop_sparse_columns_is_strict(spark):
    df = spark.range(100).selectExpr(
        "id", "if(id < 5, null, id) as five_percent", "if(id < 6, null, id) as six_percent", "cast(null as int) as none"
    )
    assert clean.drop_sparse_columns(df).columns == ["id", "five_percent"]
    empty = df.filter("false")
    assert clean.drop_sparse_columns(empty).columns == df.columns


def test_history_moves_last_and_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("1", "2 Years", "2024-01-01")], "Customer_ID string, Credit_History_Age string, snapshot_date string")
    out = clean.clean_financials(df.withColumn("Annual_Income", F.lit("5_")))
    assert out.columns == ["Customer_ID", "snapshot_date", "Annual_Income", "Credit_History_Age"]
    assert rows(out) == [("1", date(2024, 1, 1), 5.0, 24)]
