"""What Gold tables are computed from: Silver with exact amounts, age band and hour."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.functions import banding, money
from ledgerfall.operators.minimise import normalise_amounts


def facts(silver: DataFrame, tz: str | None = None) -> DataFrame:
    """Silver rows in the terms Gold is stated in.

    A narrow projection; what a table does not use is pruned down to the scan.  The
    columns that are added or compared, ``STATE``, are those of a group of one row:
    groups of rows (``merged``) have the same columns, so tables can be made of either.
    """
    rows = normalise_amounts(silver).select(
        "account_number",
        "transaction_type",
        "transaction_category",
        "channel",
        "status",
        "currency",
        "atm_province",
        "merchant_category_code",
        "reversal_flag",
        banding.age_band(F.col("age")).alias("age_band"),
        banding.hour_of_day(F.col("transaction_datetime"), tz).alias("hour_of_day"),
        F.col("amount"),
        F.col("running_balance").alias("balance"),
        F.lit(1).cast("bigint").alias("entries"),
        F.col("amount").isNotNull().cast("bigint").alias("priced"),
    )
    return money.in_lanes(rows)


#: What is added of a group, and what the largest is taken of.
ADDED = ("entries", "priced", *(f"amount_{lane}" for lane in money.LANES))
LARGEST = ("amount", "balance")


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Facts by keys: each group as one row with the columns that tables are made of."""
    return rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ADDED), *(F.max(c).alias(c) for c in LARGEST))


# Aggregates over facts.


def row_count() -> Column:
    return F.sum("entries")


def count_where(condition: Column) -> Column:
    """Number of rows a condition holds for; unknown does not count."""
    return F.sum(F.when(condition, F.col("entries")).otherwise(0))


def amount_where(condition: Column) -> Column:
    """Exact amount of the rows a condition holds for; zero for the others."""
    return money.total(condition=condition)


def total() -> Column:
    return money.rounded(money.total())


def mean() -> Column:
    """Average over the rows that have an amount."""
    return money.mean(money.total(), F.sum("priced"))


def peak() -> Column:
    return money.rounded(money.exact(F.max("amount")))


def accounts() -> Column:
    """Exact number of different accounts."""
    return F.count_distinct("account_number")
