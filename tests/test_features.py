import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from snapmart.operators import features

from conftest import rows

NAMES = ["fe_1", "fe_2"]


def clicks(spark):
    draw = random.Random(1)
    data = []
    for c in ["a", "b", "hot"]:
        for _ in range(60 if c == "hot" else 12):
            day = date(2023, 1, 1) + timedelta(days=draw.randint(0, 400))
            data.append((c, day, draw.choice([None, draw.randint(0, 9)]), draw.randint(0, 9)))
    data += [
        ("gap4", date(2023, 1, 1), 1, 1), ("gap4", date(2023, 5, 1), 3, 3),
        ("gap5", date(2023, 1, 1), 1, 1), ("gap5", date(2023, 6, 1), 3, 3),
        ("twice", date(2023, 1, 31), 1, 1), ("twice", date(2023, 1, 31), 2, 4), ("twice", date(2023, 5, 31), 9, 9),
        (None, date(2023, 1, 1), 5, 5), ("nodate", None, 5, 5), ("empty", date(2023, 1, 1), None, 1),
    ]
    return spark.createDataFrame(data, "Customer_ID string, snapshot_date date, fe_1 int, fe_2 int")


def joined_averages(df):
    """The definition: a self-join of each row with its customer's rows of the last five months."""
    c, p = df.alias("c"), df.alias("p")
    near = (
        (F.col("c.Customer_ID") == F.col("p.Customer_ID"))
        & (F.col("p.snapshot_date") >= F.add_months("c.snapshot_date", -4))
        & (F.col("p.snapshot_date") <= F.col("c.snapshot_date"))
    )
    return c.join(p, near).groupBy("c.Customer_ID", "c.snapshot_date").agg(*[F.avg(f"p.{f}").alias(f) for f in NAMES])


def close(left, right):
    assert [r[:2] for r in left] == [r[:2] for r in right]
    for a, b in zip(left, right):
        assert a[2:] == pytest.approx(b[2:])


def test_rolling_average_equals_the_self_join(spark):
    df = clicks(spark)
    got = features.rolling_month_average(df, NAMES)
    assert got.columns == ["Customer_ID", "snapshot_date", "fe_1_5m_avg", "fe_2_5m_avg"]
    close(rows(got), rows(joined_averages(df)))


def test_gap_of_five_months_starts_afresh(spark):
    got = features.rolling_month_average(clicks(spark), NAMES).filter("Customer_ID in ('gap4', 'gap5')")
    assert [r[2] for r in rows(got)] == [1.0, 2.0, 1.0, 3.0]


def _people_and_clicks(spark):
    people = [("a", date(2023, m, 1), m) for m in range(1, 4)] + [("hot", date(2023, 1, 1), 7)] * 50
    people += [("hot", date(2023, 2, 1), m) for m in range(20)] + [("unseen", date(2023, 1, 1), 1)]
    profiles = spark.createDataFrame(people, "Customer_ID string, snapshot_date date, income int")
    seen = spark.createDataFrame(
        [(c, date(2023, m, 1), float(m)) for c in ["a", "hot", "stranger", None] for m in range(1, 7)],
        "Customer_ID string, snapshot_date date, fe double",
    )
    return people, profiles, seen


def test_every_click_row_meets_all_profiles_of_its_customer(spark):
    people, profiles, seen = _people_and_clicks(spark)
    joined = features.attach_profiles(profiles, seen)
    outer = profiles.drop("snapshot_date").join(seen, "Customer_ID", "right")
    assert rows(joined, *outer.columns) == rows(outer)
    assert joined.count() == 3 * 6 + 70 * 6 + 6 + 6


def test_averages_are_reckoned_once_for_the_profile_join(spark):
    _, profiles, seen = _people_and_clicks(spark)
    joined = features.attach_profiles(profiles, features.rolling_month_average(seen, ["fe"]))
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_point_in_time_profiles_do_not_look_ahead(spark):
    people, profiles, seen = _people_and_clicks(spark)
    joined = features.attach_profiles(profiles, seen, point_in_time=True)
    expected = []
    for r in seen.collect():
        known = [(day, income) for c, day, income in people if c == r.Customer_ID and day <= r.snapshot_date]
        expected.append((r.Customer_ID, max(known)[1] if known else None, r.snapshot_date, r.fe))
    assert rows(joined, "Customer_ID", "income", "snapshot_date", "fe") == sorted(expected, key=repr)
    assert rows(features.attach_profiles(profiles, seen.filter("false"), point_in_time=True)) == []


def test_profiles_need_both_sources_and_complete_rows(spark):
    day = date(2023, 1, 1)
    money = spark.createDataFrame(
        [(str(i), None if i == 3 else float(i), None if i < 10 else 1.0, "loan", day) for i in range(40)],
        "Customer_ID string, income double, sparse double, Type_of_Loan string, snapshot_date date",
    )
    people = spark.createDataFrame(
        [(str(i), "n", 30, "s", "job", day) for i in range(30)],
        "Customer_ID string, Name string, Age int, SSN string, Occupation string, snapshot_date date",
    )
    out = features.customer_profiles(money, people)
    assert out.columns == ["Customer_ID", "snapshot_date", "income", "Occupation"]
    assert out.count() == 29
