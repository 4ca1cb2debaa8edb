"""Analyses against plain Python, numpy and pandas."""

import random
import statistics
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfall.operators import insights
from ledgerfall.schemas import GOLD


def clients(spark, movements, reversals=None):
    reversals = reversals or [0] * len(movements)
    df = spark.createDataFrame(
        list(zip(movements, reversals)), "net_movement double, reversal_count bigint"
    )
    return df.withColumn("total_transactions", F.lit(3).cast("bigint"))


def money(rng, n, spread=10**6):
    return [rng.randint(-spread, spread) / 100 for _ in range(n)]


@pytest.mark.parametrize(
    "movements",
    [
        [1.0],
        [1.0, 2.0],
        [-5.01, -5.0, 7.0],
        [2.5] * 9,
        [0.0, 0.0, 1.0, 1.0],
        [-(10.0**13), 10.0**13],
        [-0.01, 0.01, None],
        money(random.Random(1), 1000),
        money(random.Random(2), 1001, 10**11),
        money(random.Random(3), 300, 20) + [0.07] * 200,
    ],
)
def test_median_is_exact(spark, movements):
    got = insights.client_summary(clients(spark, movements)).first()["median_net_movement"]
    cents = statistics.median([round(m * 100) for m in movements if m is not None])
    assert got == cents / 100


def test_summary_of_nobody(spark):
    row = insights.client_summary(clients(spark, [])).first()
    assert row["total_clients"] == 0 and row["median_net_movement"] is None


def test_summary(spark):
    row = insights.client_summary(clients(spark, [1.0, 2.0, 9.0], [0, 2, 1])).first()
    assert row.asDict() == {
        "total_clients": 3,
        "avg_transactions": 3.0,
        "clients_with_reversals": 2,
        "median_net_movement": 2.0,
    }


@pytest.mark.parametrize(
    "movements",
    [money(random.Random(4), 500), [1.0, 2.0], [3.25] * 4, [0.0, 0.4, 0.39, 0.4], [-1.0, None, 1.0]],
)
def test_histogram(spark, movements):
    rows = insights.net_movement_histogram(clients(spark, movements)).collect()
    # numpy on whole cents, where its limits are as exact as ours
    cents = [round(m * 100) for m in movements if m is not None]
    span = (cents[0] - 50, cents[0] + 50) if min(cents) == max(cents) else (min(cents), max(cents))
    counts, edges = np.histogram(cents, bins=40, range=span)
    assert [r["clients"] for r in rows] == list(counts)
    assert [r["bin"] for r in rows] == list(range(40))
    assert np.allclose([r["lower"] for r in rows], edges[:-1] / 100)
    assert np.allclose([r["upper"] for r in rows], edges[1:] / 100)


def test_exposure_leaves_out_empty_groups(spark):
    both = insights.reversal_exposure(clients(spark, [1.0] * 4, [0, 1, 0, 5])).collect()
    assert {tuple(r) for r in both} == {("Has Reversals", 2, 50.0), ("No Reversals", 2, 50.0)}
    one = insights.reversal_exposure(clients(spark, [1.0] * 2)).collect()
    assert [tuple(r) for r in one] == [("No Reversals", 2, 100.0)]


def test_bands_are_fixed(spark):
    spend = spark.createDataFrame(
        [("25-34", "POS", 2, 10.0, 5.0, 6.0), ("25-34", "EFT", 1, 1.0, 1.0, 1.0), ("0-17", "POS", 1, 9.0, 9.0, 9.0)],
        GOLD["spend_by_age_band"],
    )
    total = insights.spend_by_band(spend)
    assert total.columns == ["age_band", "ATM", "POS", "EFT", "SWIFT", "DebiCheck", "RTC"]
    rows = {r["age_band"]: tuple(r)[1:] for r in total.collect()}
    assert list(rows) == ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
    assert rows["25-34"] == (0.0, 10.0, 1.0, 0.0, 0.0, 0.0)
    assert all(set(cells) == {0.0} for band, cells in rows.items() if band != "25-34")
    averages = {r["age_band"]: r["POS"] for r in insights.average_spend_by_band(spend).collect()}
    assert averages["25-34"] == 5.0 and averages["65+"] == 0.0


def test_hours_are_fixed(spark):
    tod = spark.createDataFrame(
        [(23, "POS", 4, 8.0, 2.0), (0, "ATM", 1, 2.5, 2.5), (None, "ATM", 7, 7.0, 1.0)], GOLD["time_of_day"]
    )
    volume = insights.volume_by_hour(tod).collect()
    assert [r["hour_of_day"] for r in volume] == list(range(24))
    assert volume[23]["POS"] == 4 and volume[0]["ATM"] == 1 and sum(sum(tuple(r)[1:]) for r in volume) == 5
    assert insights.spend_by_hour(tod).collect()[0]["ATM"] == 2.5


def test_channel_rates_are_of_totals(spark):
    channels = spark.createDataFrame(
        [("ATM", "ATM", 10, 0, 5, 0, 0, 0.0, 0.0, 1, 0.5), ("ATM", "POS", 90, 0, 1, 0, 0, 0.0, 0.0, 1, 0.0111),
         ("BRANCH", "POS", 100, 0, 9, 0, 0, 0.0, 0.0, 1, 0.09)],
        GOLD["channel_adoption"],
    )
    assert [tuple(r) for r in insights.failure_rate_by_channel(channels).collect()] == [("BRANCH", 0.09), ("ATM", 0.06)]
    assert [tuple(r) for r in insights.volume_by_channel(channels).collect()] == [("ATM", 100), ("BRANCH", 100)]


def test_status_tables(spark):
    rates = spark.createDataFrame(
        [("POS", "SETTLED", 1, 1.0, 0.25), ("POS", "FAILED", 3, 1.0, 0.75), ("EFT", "SETTLED", 1, 1.0, 1.0)],
        GOLD["reversal_rates"],
    )
    assert [tuple(r) for r in insights.status_mix(rates).collect()] == [("EFT", 1.0, 0.0, 0.0, 0.0), ("POS", 0.25, 0.0, 0.0, 0.75)]
    assert [tuple(r) for r in insights.failure_and_reversal_rates(rates).collect()] == [("POS", 0.75, 0.0)]


def test_top_lists_break_ties_by_code(spark):
    mcc = spark.createDataFrame(
        [(f"MCC {i:02d}", 1, float(i % 3), float(i % 2), 1.0, 1) for i in range(20)], GOLD["mcc_spend"]
    )
    by_total = [r[0] for r in insights.top_by_total_spend(mcc).collect()]
    by_average = [r[0] for r in insights.top_by_average_spend(mcc).collect()]
    order = sorted(range(20), key=lambda i: (-(i % 3), i))[:15]
    assert by_total == [f"MCC {i:02d}" for i in order]
    assert by_average == [f"MCC {i:02d}" for i in sorted(range(20), key=lambda i: (-(i % 2), i))[:15]]


def test_accounts_by_currency_adds_bands(spark):
    currency = spark.createDataFrame(
        [("18-24", "USD", 1, 1.0, 2), ("65+", "USD", 1, 1.0, 3), ("65+", "EUR", 1, 1.0, 9)], GOLD["currency_by_age"]
    )
    assert [tuple(r) for r in insights.accounts_by_currency(currency).collect()] == [("EUR", 9), ("USD", 5)]
    cells = {r["age_band"]: r.asDict() for r in insights.amount_by_band_and_currency(currency).collect()}
    assert cells["65+"]["EUR"] == 1.0 and cells["18-24"]["EUR"] == 0.0 and len(cells) == 6


def movements(spark, *values):
    rows = [(str(i), float(v), 3, i % 2) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "account_number string, net_movement double, total_transactions long, reversal_count long")


@pytest.mark.parametrize("count", [1, 2, 7, 40])
def test_median_of_amounts_of_any_size(spark, count):
    choose = random.Random(count)
    values = [0.0, -0.01, 0.01, 0.07, 1e28, -1e28, 2.0**60, 2.0**53 - 1, 8.0, 7.99, 1234567.89]
    values += [round(choose.choice((-1, 1)) * 10 ** choose.uniform(-2, 27), 2) for _ in range(60)]
    values = choose.sample(values, count)
    ordered = sorted(Decimal(repr(v)) for v in values)
    want = float((ordered[(count - 1) // 2] + ordered[count // 2]) / 2)
    assert insights.client_summary(movements(spark, *values)).first()["median_net_movement"] == want


def test_histogram_of_amounts_of_any_size(spark):
    values = [-1e27, -5e26, 0.0, 3e26, 1e27, 1e27]
    rows = insights.net_movement_histogram(movements(spark, *values), 4).collect()
    assert [r["clients"] for r in rows] == [1, 1, 2, 2]
    assert (rows[0]["lower"], rows[3]["upper"], rows[2]["lower"]) == (-1e27, 1e27, 0.0)
