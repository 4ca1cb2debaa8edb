"""Gold tables on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from ledgerfall.operators import facts, gold
from ledgerfall.schemas import GOLD
from tests.rows import atm, eft, pos, silver


def table(name, df, tz=None):
    return gold.arrange(name, gold.build(name, facts.facts(df, tz)))


def rows(name, df, tz=None):
    return [tuple(r) for r in table(name, df, tz).collect()]


@pytest.mark.parametrize("name", GOLD)
def test_schema(spark, name):
    built = table(name, silver(spark))
    declared = spark.createDataFrame([], GOLD[name])
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in declared.schema]
    assert built.collect() == []


def test_spend_by_age_band(spark):
    df = silver(
        spark,
        pos(1, age=None, amount=0.01),
        pos(2, age=70, amount=0.02),
        pos(3, age=20, amount=1.005),
        pos(4, age=20, transaction_type="CREDIT"),
        pos(5, age=20, status="PENDING"),
        eft(6, age=20, amount=None),
    )
    assert rows("spend_by_age_band", df) == [
        ("18-24", "EFT", 1, None, None, None),
        ("18-24", "POS", 1, 1.01, 1.01, 1.01),
        ("65+", "POS", 2, 0.03, 0.02, 0.02),
    ]


def test_client_financial_activity(spark):
    a, b = "a" * 64, "b" * 64
    df = silver(
        spark,
        pos(1, account_number=a, amount=10.10, running_balance=50.0),
        eft(2, account_number=a, amount=0.20, transaction_type="CREDIT", running_balance=70.0, reversal_flag=True),
        atm(3, account_number=a, amount=5.0, running_balance=60.0),
        eft(4, account_number=a, amount=None, running_balance=None),
        eft(5, account_number=a, amount=99.0, status="FAILED", running_balance=999.0),
        eft(6, account_number=b, amount=1.0, transaction_type=None, reversal_flag=None),
        eft(7, account_number=None, amount=2.0),
    )
    got = {r[0]: r[1:] for r in rows("client_financial_activity", df)}
    assert got == {
        a: (4, 3, 1, 15.1, 0.2, -14.9, 5.1, 70.0, 1, 3, 2),
        b: (1, 0, 0, 0.0, 0.0, 0.0, 1.0, 100.0, 0, 1, 1),
        None: (1, 1, 0, 2.0, 0.0, -2.0, 2.0, 100.0, 0, 1, 1),
    }


def test_channel_adoption_has_all_statuses(spark):
    df = silver(
        spark,
        *(pos(i, status=s, account_number=s, amount=1.0) for i, s in enumerate(("SETTLED", "FAILED", "REVERSED", "PENDING", "FAILED", "??"))),
        pos(9, account_number=None, amount=1.0),
    )
    assert rows("channel_adoption", df) == [("MOBILE", "POS", 7, 2, 2, 1, 1, 7.0, 1.0, 5, 0.2857)]


def test_provincial_flow_keeps_null_province(spark):
    df = silver(spark, atm(1), atm(2, atm_province=None), atm(3, atm_province=None), pos(4))
    assert rows("provincial_flow", df) == [(None, "DEBIT", 2, 20.0, 10.0, 1), ("Gauteng", "DEBIT", 1, 10.0, 10.0, 1)]


def test_reversal_rates(spark):
    df = silver(spark, pos(1), pos(2), pos(3, status="FAILED"), eft(4, status=None))
    assert rows("reversal_rates", df) == [
        ("EFT", None, 1, 10.0, 1.0),
        ("POS", "FAILED", 1, 10.0, 0.3333),
        ("POS", "SETTLED", 2, 20.0, 0.6667),
    ]


def test_time_of_day_in_both_zones(spark):
    df = silver(spark, pos(1, transaction_datetime="2026-03-30 01:30:00+02:00"), pos(2, transaction_datetime="never"))
    assert [r[0] for r in rows("time_of_day", df)] == [None, 23]
    assert [r[0] for r in rows("time_of_day", df, "Africa/Johannesburg")] == [None, 1]


def test_currency_by_age(spark):
    df = silver(
        spark,
        eft(1, transaction_category="SWIFT", currency="USD", account_number="x"),
        eft(2, transaction_category="SWIFT", currency="USD", account_number="x"),
        eft(3, currency="USD"),
    )
    assert rows("currency_by_age", df) == [("25-34", "USD", 2, 20.0, 1)]


def test_mcc_spend_is_by_total_descending(spark):
    df = silver(
        spark,
        pos(1, merchant_category_code="MCC 2", amount=5.0),
        pos(2, merchant_category_code="MCC 1", amount=5.0),
        pos(3, merchant_category_code="MCC 3", amount=7.0),
        pos(4, merchant_category_code=None),
    )
    assert [r[0] for r in rows("mcc_spend", df)] == ["MCC 3", "MCC 1", "MCC 2"]


def test_totals_do_not_depend_on_row_order(spark):
    df = silver(spark, *(pos(i, amount=0.1 + i / 100) for i in range(500)))
    totals = {
        rows("mcc_spend", df.repartition(n, F.rand(n)))[0][2] for n in (1, 3, 7)
    }
    assert totals == {round(sum(10 + i for i in range(500)) / 100, 2)}


def test_amounts_may_be_text(spark):
    df = silver(spark, pos(1), pos(2)).withColumn("amount", F.lit("2.50"))
    assert rows("mcc_spend", df) == [("MCC 5411", 2, 5.0, 2.5, 2.5, 1)]


def test_sums_are_rounded_once(spark):
    df = silver(spark, *(pos(i, age=20, amount=0.004) for i in range(1000)))
    assert rows("spend_by_age_band", df) == [("18-24", "POS", 1000, 4.0, 0.0, 0.0)]
    assert [r[4] for r in rows("client_financial_activity", df)] == [4.0]


def test_averages_are_rounded_from_the_exact_quotient(spark):
    df = silver(spark, *(pos(i, age=20, amount=a) for i, a in enumerate((0.014999, 0.014999))), eft(9, age=20, amount=0.015))
    assert [r[4] for r in rows("spend_by_age_band", df)] == [0.02, 0.01]


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), float("-inf"), 1e30])
def test_amounts_that_are_no_money_count_as_missing(spark, amount):
    df = silver(spark, pos(1, age=20, amount=amount), pos(2, age=20, amount=1.0))
    assert rows("spend_by_age_band", df) == [("18-24", "POS", 2, 1.0, 1.0, 1.0)]
