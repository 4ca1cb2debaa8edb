"""Every registered query equals its SQL in a second engine."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_check import connect, differences, rows_of_spark, rows_of_sql


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


#: The text operators have tests of their own.
CORE = [name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)]
EMPTY = {"silver_rerun_empty", "gold_rerun_empty"}


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry.oracle_sql())


def test_queries_leave_the_session_as_it_is(spark):
    before = spark.conf.getAll
    entry.queries()["hours_sast"](spark, SF_DIR)
    entry.entry(spark)
    assert spark.conf.getAll == before


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    got = rows_of_spark(entry.queries()[name](spark, SF_DIR))
    assert (len(got) == 0) == (name in EMPTY)
    assert differences(got, rows_of_sql(duck, entry.oracle_sql()[name])) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "age_band",
        "transaction_category",
        "transaction_count",
        "total_spend",
        "avg_spend",
        "max_spend",
        "run_date",
    ]
    assert df.count() > 0
