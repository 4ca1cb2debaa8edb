"""Merged numbers of accounts against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerfall.operators import account_sets as S
from ledgerfall.sources import tables


@pytest.fixture
def store(tmp_path):
    made = []

    def write(rows):
        made.append(rows)
        return tables.stored(rows, str(tmp_path / f"t{len(made)}"))

    return write


def day(spark, seed, accounts, rows):
    choose = random.Random(seed)
    drawn = [(choose.choice("xyz"), choose.choice("pq"), choose.choice([None, *accounts])) for _ in range(rows)]
    return drawn, spark.createDataFrame(drawn, "g string, k string, account_number string")


def test_days_and_groups_merge(spark, store):
    plain, stored, dictionary = [], [], None
    for seed, accounts in ((1, range(200)), (2, range(100, 70_000, 7)), (3, range(5))):
        rows, df = day(spark, seed, [str(a) for a in accounts], 3000)
        plain += rows
        dictionary = S.extended(dictionary, df, store)
        stored.append(store(S.account_sets(df, dictionary, "g", "k")))
    for keys in (("g", "k"), ("g",), ()):
        want = {}
        for g, k, account in plain:
            if account is not None:
                want.setdefault(tuple({"g": g, "k": k}[key] for key in keys), set()).add(account)
        got = {tuple(r)[:-1]: r["unique_accounts"] for r in S.counted(S.united(stored, *keys), *keys).collect()}
        assert got == {key: len(some) for key, some in want.items()}


def test_numbers_stay_and_have_no_gaps(spark, store):
    first = S.extended(None, day(spark, 1, ["a", "b", "c"], 50)[1], store)
    before = dict(map(tuple, first.collect()))
    second = S.extended(first, day(spark, 2, [*"cdefgh"], 200)[1].repartition(5), store)
    after = dict(map(tuple, second.collect()))
    assert {name: after[name] for name in before} == before
    assert sorted(after.values()) == list(range(1, len(after) + 1)) and set(after) == set("abcdefgh")
    assert S.extended(second, second, store).count() == len(after)


def test_accounts_beyond_one_bucket(spark, store):
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("account_number"))
    found = S.account_sets(df, S.extended(None, df, store), "g")
    assert found.count() == 2 and S.counted(found, "g").first()["unique_accounts"] == 40_000


def test_nothing(spark, store):
    none = spark.createDataFrame([], "g string, account_number string")
    dictionary = S.extended(None, none, store)
    assert dictionary.count() == 0 and S.counted(S.account_sets(none, dictionary, "g"), "g").count() == 0
