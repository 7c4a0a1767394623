"""Every registered query against its SQL counterpart, and the others for rows and schema."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert df.count() == 1500
