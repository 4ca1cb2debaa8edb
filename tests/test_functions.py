"""Identity numbers, pseudonyms, bands, hours and money."""

import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerfall.functions import banding, identity, money
from ledgerfall.operators import minimise

DAY = date(2026, 3, 30)


@pytest.mark.parametrize(
    ("id_number", "age", "gender"),
    [
        ("8001015009087", 46, "M"),
        ("0002295009087", 26, "M"),
        ("8002305009087", None, None),
        ("2513015009087", None, None),
        ("2500015009087", None, None),
        ("240101499908x", 2, "F"),
        ("2501010000087", 101, "F"),
        ("9912314999999", 26, "F"),
        ("8003305000087", 46, "M"),
        ("8003315000087", 45, "M"),
        ("80010150090871", None, None),
        ("8001015009087\n", None, None),
        ("800101500908\n", 46, "M"),
        ("123", None, None),
        ("", None, None),
        (None, None, None),
        (" 801015009087", None, None),
        ("+801015009087", None, None),
        ("800101500x087", None, None),
    ],
)
def test_holder(spark, id_number, age, gender):
    df = spark.createDataFrame([(id_number,)], "id_number string")
    row = minimise.derive_holder(df, DAY).first()
    assert (row["age"], row["gender"]) == (age, gender)


def test_birthday_on_29_february_counts_from_1_march(spark):
    df = spark.createDataFrame([("0002295009087",)], "id_number string")
    ages = [minimise.derive_holder(df, day).first()["age"] for day in (date(2026, 2, 28), date(2026, 3, 1))]
    assert ages == [25, 26]


def test_pseudonym(spark):
    salt = spark.createDataFrame([("pépper",)], "salt string")
    df = spark.createDataFrame([("1234567890", None), ("é", "1")], "account_number string, beneficiary_account_number string")
    rows = minimise.pseudonymise(df, salt).collect()

    def expected(value):
        return None if value is None else hashlib.sha256(f"pépper{value}".encode()).hexdigest()

    assert [tuple(r) for r in rows] == [(expected("1234567890"), None), (expected("é"), expected("1"))]


@pytest.mark.parametrize("salts", [[], [(None,)], [("a",), ("b",)]])
def test_salt_must_be_one_value(spark, salts):
    df = spark.createDataFrame([("1", "2")], "account_number string, beneficiary_account_number string")
    salt = spark.createDataFrame(salts, "salt string")
    with pytest.raises(Exception, match="one non-null value|SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        minimise.pseudonymise(df, salt).collect()


def test_salt_is_not_in_the_plan(spark):
    df = spark.createDataFrame([("1", "2")], "account_number string, beneficiary_account_number string")
    salt = spark.createDataFrame([("NaClNaCl",)], "salt string")
    hashed = minimise.pseudonymise(df, salt)
    hashed.collect()
    assert "NaClNaCl" not in hashed._jdf.queryExecution().toString()


def test_salt_from_secret(spark):
    secrets = ['{"password": "p", "x": 1}', '{"x": 1}', "plain", "{broken"]
    df = spark.createDataFrame([(s,) for s in secrets], "secret string")
    rows = df.select(identity.salt_from_secret(F.col("secret"))).collect()
    assert [r[0] for r in rows] == ["p", '{"x": 1}', "plain", "{broken"]


def test_age_bands(spark):
    ages = {None: "65+", 17: "18-24", 24: "18-24", 25: "25-34", 34: "25-34", 35: "35-44", 45: "45-54", 55: "55-64", 64: "55-64", 65: "65+"}
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    rows = df.select("age", banding.age_band(F.col("age")).alias("band")).collect()
    assert {r["age"]: r["band"] for r in rows} == ages


def test_hour_in_session_and_named_zone(spark):
    df = spark.createDataFrame([("2026-03-30 01:11:05+02:00",), ("2026-03-30T23:30:00Z",), ("soon",), (None,)], "t string")
    rows = df.select(banding.hour_of_day(F.col("t")), banding.hour_of_day(F.col("t"), "Africa/Johannesburg")).collect()
    assert [tuple(r) for r in rows] == [(23, 1), (23, 1), (None, None), (None, None)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(banding.hour_of_day(F.col("t")), banding.hour_of_day(F.col("t"), "Africa/Johannesburg")).first()
        assert tuple(row) == (19, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cents_take_binary_noise_off(spark):
    values = [0.1 + 0.2, 4417.459999999999, -12.34, 0.0, 500000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert [r[0] for r in df.select(money.cents(F.col("a"))).collect()] == [30, 441746, -1234, 0, 50000000, None]


def test_divide_half_up(spark):
    cases = [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (-4, 3, -1), (7, 0, None), (None, 2, None), (2**62, 1, 2**62), (9 * 10**18, 4 * 10**18, 2)]
    df = spark.createDataFrame([(n, d) for n, d, _ in cases], "n bigint, d bigint")
    got = [r[0] for r in df.select(money.divide_half_up(F.col("n"), F.col("d"))).collect()]
    assert got == [q for *_, q in cases]


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 3), (1, 32), (3, 20000), (0, 5)], "n bigint, d bigint")
    assert [r[0] for r in df.select(money.share(F.col("n"), F.col("d"))).collect()] == [0.3333, 0.0313, 0.0002, 0.0]


@pytest.mark.parametrize("zone", ["Europe/London", "America/New_York", "UTC"])
def test_named_hour_does_not_depend_on_the_session(spark, zone):
    """Around both clock changes of the session's zone."""
    moments = [f"{day} {hour:02d}:30:00+02:00" for day in ("2026-03-29", "2026-10-25", "2026-03-08", "2026-11-01") for hour in range(24)]
    df = spark.createDataFrame([(m,) for m in moments], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = df.select("t", banding.hour_of_day(F.col("t"), "Africa/Johannesburg"), banding.hour_of_day(F.col("t"), "UTC")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r[1], r[2]) for r in got] == [(int(m[11:13]), (int(m[11:13]) - 2) % 24) for m in moments]


def test_salt_of_a_secret(spark):
    for secret in ("pepper", '{"password": "pepper"}'):
        salt = spark.createDataFrame([(secret,)], "value string")
        row = spark.range(1).select(identity.salt_value(salt).alias("s")).first()
        assert row["s"] == "pepper"


def test_totals_in_lanes_are_exact(spark):
    """Against decimals: of every size, with many digits, negative, null, in groups."""
    choose = random.Random(3)
    sizes = [10 ** choose.uniform(-7, 17.9) for _ in range(400)]
    values = [choose.choice((1, -1)) * (round(v, 2) if i % 2 else v) for i, v in enumerate(sizes)]
    values += [None, 0.0, -0.0, 1e-7, 5e-7, 0.0000005, 1.0000005, 999999999.999999, -999999999.999999, 1e9, 9.99e17, -9.99e17, 0.1]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "g int, amount double")
    exact = df.groupBy("g").agg(F.sum(money.exact(F.col("amount"))).alias("total"))
    lanes = money.in_lanes(df).groupBy("g").agg(money.total().alias("total"))
    assert sorted(map(tuple, lanes.collect())) == sorted(map(tuple, exact.collect()))
    assert lanes.schema["total"].dataType == exact.schema["total"].dataType
    none = money.in_lanes(df.where("amount IS NULL")).agg(money.total().alias("t")).first()
    assert none["t"] is None


def test_a_mean_beyond_whole_numbers(spark):
    df = spark.createDataFrame([(9.9e17,), (9.7e17,), (None,)], "amount double").selectExpr("*", "CAST(amount IS NOT NULL AS BIGINT) AS priced")
    got = money.in_lanes(df).agg(money.mean(money.total(), F.sum("priced")).alias("m")).first()["m"]
    assert got == 9.8e17
