"""The eight Gold tables, from facts.

Seven of them are one grouping each and are stated as data; the per-client table
needs two steps and is a function.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfall.functions import money
from ledgerfall.operators import facts as X

SETTLED = "status = 'SETTLED'"


@dataclass(frozen=True)
class Grouping:
    """One aggregation: which facts, by what, which measures."""

    keys: tuple[str, ...]
    measures: dict[str, Callable[[], Column]]
    scope: str = "true"
    ratios: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def __call__(self, rows: DataFrame) -> DataFrame:
        return (
            rows.where(self.scope)
            .groupBy(*self.keys)
            .agg(*(measure().alias(name) for name, measure in self.measures.items()))
            .withColumns({name: ratio() for name, ratio in self.ratios.items()})
        )


def settled(rows: DataFrame) -> DataFrame:
    """Only settled transactions: confirmed economic activity."""
    return rows.where(SETTLED)


def with_status(status: str) -> Callable[[], Column]:
    return lambda: X.count_where(F.col("status") == status)


def failure_rate() -> Column:
    return money.share(F.col("failed_count"), F.col("total_transactions"))


def share_of_category() -> Column:
    """The window is over aggregated rows: a handful per category."""
    category = F.sum("transaction_count").over(Window.partitionBy("transaction_category"))
    return money.share(F.col("transaction_count"), category)


def _lanes(name: str, condition: Column | None = None) -> list[Column]:
    return [value.alias(f"{name}_{lane}") for lane, value in money.lane_sums(condition=condition).items()]


def client_financial_activity(rows: DataFrame) -> DataFrame:
    """Settled activity by account.  closing_balance is the highest balance seen.

    The first aggregation leaves one row per account, category and channel.  Only
    these go through the two exact distinct counts, for which Spark copies every
    input row three times, and an account with very many rows is spread over
    several tasks.
    """
    is_debit, is_credit = (F.col("transaction_type") == kind for kind in ("DEBIT", "CREDIT"))
    by_use = (
        settled(rows)
        .groupBy("account_number", "transaction_category", "channel")
        .agg(
            X.row_count().alias("entries"),
            X.count_where(is_debit).alias("debits"),
            X.count_where(is_credit).alias("credits"),
            X.count_where(F.col("reversal_flag")).alias("reversals"),
            *_lanes("debited", is_debit),
            *_lanes("credited", is_credit),
            *_lanes("amount"),
            F.sum("priced").alias("priced"),
            F.max("balance").alias("balance"),
        )
    )
    debited, credited = money.total("debited"), money.total("credited")
    return by_use.groupBy("account_number").agg(
        F.sum("entries").alias("total_transactions"),
        F.sum("debits").alias("debit_count"),
        F.sum("credits").alias("credit_count"),
        money.rounded(debited).alias("total_debited"),
        money.rounded(credited).alias("total_credited"),
        money.rounded(credited - debited).alias("net_movement"),
        money.mean(money.total(), F.sum("priced")).alias("avg_transaction_amount"),
        money.rounded(money.exact(F.max("balance"))).alias("closing_balance"),
        F.sum("reversals").alias("reversal_count"),
        F.count_distinct("transaction_category").alias("distinct_categories_used"),
        F.count_distinct("channel").alias("distinct_channels_used"),
    )


TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "spend_by_age_band": Grouping(
        scope=f"{SETTLED} AND transaction_type = 'DEBIT'",
        keys=("age_band", "transaction_category"),
        measures={
            "transaction_count": X.row_count,
            "total_spend": X.total,
            "avg_spend": X.mean,
            "max_spend": X.peak,
        },
    ),
    "client_financial_activity": client_financial_activity,
    "channel_adoption": Grouping(
        keys=("channel", "transaction_category"),
        measures={
            "total_transactions": X.row_count,
            "settled_count": with_status("SETTLED"),
            "failed_count": with_status("FAILED"),
            "reversed_count": with_status("REVERSED"),
            "pending_count": with_status("PENDING"),
            "total_amount": X.total,
            "avg_amount": X.mean,
            "unique_accounts": X.accounts,
        },
        ratios={"failure_rate": failure_rate},
    ),
    "provincial_flow": Grouping(
        scope=f"{SETTLED} AND transaction_category = 'ATM'",
        keys=("atm_province", "transaction_type"),
        measures={
            "transaction_count": X.row_count,
            "total_amount": X.total,
            "avg_amount": X.mean,
            "unique_accounts": X.accounts,
        },
    ),
    "reversal_rates": Grouping(
        keys=("transaction_category", "status"),
        measures={"transaction_count": X.row_count, "total_amount": X.total},
        ratios={"rate": share_of_category},
    ),
    "time_of_day": Grouping(
        scope=f"{SETTLED} AND transaction_type = 'DEBIT'",
        keys=("hour_of_day", "transaction_category"),
        measures={
            "transaction_count": X.row_count,
            "total_spend": X.total,
            "avg_spend": X.mean,
        },
    ),
    "currency_by_age": Grouping(
        scope=f"{SETTLED} AND transaction_category = 'SWIFT'",
        keys=("age_band", "currency"),
        measures={
            "transaction_count": X.row_count,
            "total_amount": X.total,
            "unique_accounts": X.accounts,
        },
    ),
    "mcc_spend": Grouping(
        scope=f"{SETTLED} AND merchant_category_code IS NOT NULL",
        keys=("merchant_category_code",),
        measures={
            "transaction_count": X.row_count,
            "total_spend": X.total,
            "avg_spend": X.mean,
            "max_spend": X.peak,
            "unique_accounts": X.accounts,
        },
    ),
}

#: Tables of which one grouping by all their keys has all they need: some thousand rows, whatever the day.
CUBE = ("status", "transaction_type", "transaction_category", "age_band", "hour_of_day")
FROM_CUBE = ("spend_by_age_band", "reversal_rates", "time_of_day")


def cube(rows: DataFrame) -> DataFrame:
    """Facts merged by the keys of ``FROM_CUBE``; these tables can be built of it."""
    return X.merged(rows, *CUBE)


def build(name: str, rows: DataFrame) -> DataFrame:
    """A Gold table, in no particular order."""
    return TABLES[name](rows)


def arrange(name: str, table: DataFrame) -> DataFrame:
    """A table in the order it is stored in.

    By its keys, or by total spend; the client table, the only one that grows
    with the number of accounts, is not sorted.
    """
    if name == "mcc_spend":
        return table.orderBy(F.desc("total_spend"), "merchant_category_code")
    definition = TABLES[name]
    return table.orderBy(*definition.keys) if isinstance(definition, Grouping) else table


def with_run_date(table: DataFrame, run_date: date) -> DataFrame:
    """A table stamped with the day it was computed for."""
    return table.withColumn("run_date", F.lit(run_date.isoformat()))
