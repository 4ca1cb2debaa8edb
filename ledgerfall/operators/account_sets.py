"""Sets of accounts that merge: exact numbers of accounts over groups and days, without Silver.

A number of different accounts cannot be added up: an account that is in two groups or
on two days would count twice.  So each account gets a whole number, once and for all, in a
dictionary that only grows, and a group's accounts are bitmaps over these numbers, one
of 32,768 bits per bucket of numbers in which it has any.  Bitmaps of any groups and days
are united bit by bit, and their bits counted.

Accounts per group are made different before anything is shuffled by account, so an account
with very many rows is one row per task and group.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Stores rows once and reads them back; where is up to the caller.
Store = Callable[[DataFrame], DataFrame]

DICTIONARY = "account_number string, account_id bigint"


def extended(dictionary: DataFrame | None, accounts: DataFrame, store: Store) -> DataFrame:
    """The dictionary with the accounts it does not have yet: ``account_number, account_id``.

    Numbers that were given stay.  New ones follow without gaps, from one; each part of the new
    accounts is numbered for itself, and only the parts' sizes are brought together.
    Null is no account.
    """
    new = accounts.select("account_number").where("account_number IS NOT NULL").distinct()
    if dictionary is None:
        dictionary = accounts.sparkSession.createDataFrame([], DICTIONARY)
    else:
        new = new.join(dictionary.select("account_number"), "account_number", "left_anti")
    # Numbers depend on how rows are dealt out, so they are given to rows that are stored.
    rows = store(new.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    start = dictionary.agg(F.coalesce(F.max("account_id"), F.lit(0)) + 1).scalar()
    numbered = rows.join(F.broadcast(bases), part == F.col("_part")).select(
        "account_number", (start + F.col("_base") + place).alias("account_id")
    )
    return store(dictionary.unionByName(numbered))


def account_sets(rows: DataFrame, dictionary: DataFrame, *keys: str) -> DataFrame:
    """``keys, bucket, accounts``: the accounts of each group as bitmaps.  Accounts must be in the dictionary."""
    different = rows.select(*keys, "account_number").where("account_number IS NOT NULL").distinct()
    return (
        different.join(dictionary, "account_number")
        .groupBy(*keys, F.bitmap_bucket_number("account_id").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("account_id")).alias("accounts"))
    )


def united(sets: list[DataFrame], *keys: str) -> DataFrame:
    """Sets of several days, or of finer groups, by some of their keys."""
    every = reduce(DataFrame.unionByName, (some.select(*keys, "bucket", "accounts") for some in sets))
    return every.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("accounts").alias("accounts"))


def counted(sets: DataFrame, *keys: str) -> DataFrame:
    """``keys, unique_accounts``: exact numbers of accounts.  A group without accounts has no row."""
    whole = united([sets], *keys)
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("accounts")).alias("unique_accounts"))
