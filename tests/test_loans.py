from datetime import date

from snapmart.operators import loans

from conftest import rows

COLUMNS = (
    "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, loan_amt double,"
    " due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date"
)


def frame(spark, cases):
    data = [
        (str(i), "c", date(2023, 1, 1), 10, mob, 1000.0, due, 0.0, overdue, 0.0, day)
        for i, (mob, due, overdue, day) in enumerate(cases)
    ]
    return loans.add_delinquency(spark.createDataFrame(data, COLUMNS))


def test_delinquency(spark):
    day = date(2023, 8, 1)
    out = frame(
        spark,
        [
            (7, 100.0, 0.0, day),
            (7, 100.0, 250.0, day),
            (7, 0.0, 50.0, day),  # nothing due: days past due unknown
            (7, None, 50.0, day),
            (7, 100.0, None, day),
            (7, 100.05, 100.05 * 11, day),  # 32-bit amounts round up to one more instalment
            (7, 100.0, 300.0, date(2023, 5, 1)),  # 89 days across February
            (7, 100.0, 100.0, date(2023, 3, 31)),  # month end is clamped
        ],
    )
    got = rows(out, "loan_id", "mob", "installments_missed", "first_missed_date", "dpd")
    assert got == [
        ("0", 7, 0, None, 0),
        ("1", 7, 3, date(2023, 5, 1), 92),
        ("2", 7, 0, None, None),
        ("3", 7, 0, None, None),
        ("4", 7, 0, None, 0),
        ("5", 7, 12, date(2022, 8, 1), 365),
        ("6", 7, 3, date(2023, 2, 1), 89),
        ("7", 7, 1, date(2023, 2, 28), 31),
    ]
    labels = loans.default_labels(out, dpd=90, mob=7)
    assert labels.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert rows(labels, "loan_id", "label") == [(str(i), int(i in (1, 5))) for i in range(8)]
    assert {r.label_def for r in loans.default_labels(out, dpd=30, mob=7).collect()} == {"30dpd_7mob"}


def test_only_the_month_on_book_is_labelled(spark):
    out = frame(spark, [(6, 100.0, 0.0, date(2023, 7, 1)), (7, 100.0, 0.0, date(2023, 8, 1))])
    assert rows(loans.default_labels(out), "loan_id") == [("1",)]


def test_bad_rate(spark):
    day = date(2023, 8, 1)
    out = frame(spark, [(1, 100.0, 400.0, day), (1, 100.0, 0.0, day), (2, 0.0, 10.0, day)])
    assert [tuple(r) for r in loans.bad_rate_by_mob(out).collect()] == [(1, 0.5), (2, 0.0)]
    assert loans.bad_rate_by_mob(out, started_before=date(2023, 1, 1)).count() == 0
