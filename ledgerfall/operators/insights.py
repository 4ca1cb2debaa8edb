"""Analyses of Gold tables and of the validation report.

Cross tables have fixed columns, and fixed rows where the order is a scale (age
bands, hours): values that do not occur are zero, values outside the lists are
left out.
"""

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfall import vocabulary as V
from ledgerfall.functions import money


def _with_scale(df: DataFrame, key: str, values: Iterable) -> DataFrame:
    """Rows, and one marked row per value of a scale with nothing else in it.

    The marked rows make every value a group, without a join; being null, they
    change no aggregate.
    """
    literals = F.array(*(F.lit(v) for v in values))
    marked = df.sparkSession.range(1).select(F.explode(literals).alias(key), F.lit(True).alias("on_scale"))
    return df.unionByName(marked, allowMissingColumns=True)


def _cross_table(
    df: DataFrame,
    row: str,
    column: str,
    columns: Iterable,
    cell: Callable[[Column], Column],
    measure: str,
    empty: float | int = 0.0,
    rows: Iterable | None = None,
) -> DataFrame:
    """Cross table in a single aggregation, with one output column per value.

    Rows off the scale are left out after the aggregation: asking for listed keys
    before it would repeat whatever the key is computed from in a filter.
    """
    cells = (
        F.coalesce(cell(F.when(F.col(column) == value, F.col(measure))), F.lit(empty)).alias(value)
        for value in columns
    )
    if rows is None:
        return df.groupBy(row).agg(*cells).orderBy(row)
    table = _with_scale(df, row, rows).groupBy(row).agg(F.max("on_scale").alias("on_scale"), *cells)
    return table.where("on_scale").drop("on_scale").orderBy(row)


def spend_by_band(spend: DataFrame) -> DataFrame:
    """Total spend, age band by category."""
    return _cross_table(
        spend, "age_band", "transaction_category", V.CATEGORIES, F.sum, "total_spend", rows=V.AGE_BANDS
    )


def average_spend_by_band(spend: DataFrame) -> DataFrame:
    """Mean of average spend, age band by category."""
    return _cross_table(spend, "age_band", "transaction_category", V.CATEGORIES, F.avg, "avg_spend", rows=V.AGE_BANDS)


def volume_by_channel(channels: DataFrame) -> DataFrame:
    """Transactions per channel, most first."""
    return (
        channels.groupBy("channel")
        .agg(F.sum("total_transactions").alias("total_transactions"))
        .orderBy(F.desc("total_transactions"), "channel")
    )


def failure_rate_by_channel(channels: DataFrame) -> DataFrame:
    """Failed share of all transactions of a channel, highest first."""
    return (
        channels.groupBy("channel")
        .agg((F.sum("failed_count") / F.sum("total_transactions")).alias("failure_rate"))
        .orderBy(F.desc("failure_rate"), "channel")
    )


def _net_cents() -> Column:
    return money.wide_cents(F.col("net_movement"))


def net_movement_histogram(clients: DataFrame, bins: int = V.HISTOGRAM_BINS) -> DataFrame:
    """Clients by net movement, in bins of equal width from lowest to highest.

    The last bin includes its upper end.  If all values are equal the range is
    one unit around them.  Worked out in whole cents, of any size, so bin limits are
    exact.  The limits are one row, used as scalars.
    """
    cents = clients.select(_net_cents().alias("c")).where("c IS NOT NULL")
    ends = cents.agg(F.min("c").alias("low"), F.max("c").alias("high"))
    flat = F.when(F.col("low") == F.col("high"), 50).otherwise(0)
    span = ends.select(F.struct((F.col("low") - flat).alias("low"), (F.col("high") + flat).alias("high"))).scalar()
    low, high = span["low"], span["high"]
    width = high - low
    position = F.call_function("div", (F.col("c") - low) * bins, width)

    def limit(step: Column) -> Column:
        """As doubles where they are exact, else as decimals, whose quotients have six digits after the point."""
        whole = low * bins + width * step
        return F.when(F.abs(whole) < 1 << 53, whole.cast("double") / (100 * bins)).otherwise((whole / (100 * bins)).cast("double"))

    binned = cents.select(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"), F.lit(1).alias("client"))
    return (
        _with_scale(binned, "bin", range(bins))
        .groupBy("bin")
        .agg(F.count("client").alias("clients"))
        .select(
            "bin",
            limit(F.col("bin")).alias("lower"),
            limit(F.col("bin") + 1).alias("upper"),
            "clients",
        )
        .orderBy("bin")
    )


def reversal_exposure(clients: DataFrame) -> DataFrame:
    """Clients with and without reversals, and their percentage."""
    exposed = F.count_if(F.col("reversal_count") > 0)
    everyone = F.count("*")
    groups = F.array(
        F.struct(F.lit(V.HAS_REVERSALS).alias("exposure"), exposed.alias("clients")),
        F.struct(F.lit(V.NO_REVERSALS).alias("exposure"), (everyone - exposed).alias("clients")),
    )
    return (
        clients.agg(groups.alias("groups"), everyone.alias("everyone"))
        .select("everyone", F.inline("groups"))
        .where("clients > 0")
        .select("exposure", "clients", (100 * F.col("clients") / F.col("everyone")).alias("percentage"))
    )


# Amounts in whole cents are zero or at least 2**-7 in size, and less than 2**100.  With
# 52 bits of fraction and their exponent as the bits before, they are numbers below
# 2**59 in the same order.  Adding 2**60 makes them 61-bit numbers without sign.
_FRACTION, _EXPONENT = 52, 8
_OFFSET = 1 << 60
_SHIFTS = (42, 21, 0)


def _ordered(amount: Column) -> Column:
    """A whole number for a double in whole cents, in the order of the doubles; powers of two are exact."""
    size = F.abs(amount)
    rough = F.floor(F.log2(size))
    # A logarithm next to a whole number may be rounded to it.
    exponent = rough + F.when(size < F.pow(F.lit(2.0), rough), -1).when(size >= F.pow(F.lit(2.0), rough + 1), 1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), exponent) * (1 << _FRACTION)).cast("bigint") - (1 << _FRACTION)
    key = F.shiftleft((exponent + _EXPONENT).cast("bigint"), _FRACTION) + fraction
    return F.when(amount == 0, F.lit(0).cast("bigint")).when(amount < 0, -key).otherwise(key)


def _amount_of(key: Column) -> Column:
    """The double, as an exact decimal in cents, that ``_ordered`` gives the number for."""
    size = F.abs(key)
    fraction = size.bitwiseAND(F.lit((1 << _FRACTION) - 1)) + (1 << _FRACTION)
    value = fraction.cast("double") / (1 << _FRACTION) * F.pow(F.lit(2.0), F.shiftright(size, _FRACTION) - _EXPONENT)
    return F.when(key == 0, 0.0).when(key < 0, -value).otherwise(value).cast("decimal(32,2)")


def _middle_keys(values: DataFrame) -> DataFrame:
    """One row ``low, high``: the two middle values of column ``c``, whole numbers of under 2**60 in size, exactly.

    Selection from the highest bits down, as in a radix sort: count the values by
    their leading bits, find the prefixes that hold the middle ranks, go on with
    the values that begin with them, by 21 more bits.  A step is one scan and one
    aggregate of at most 2**21 groups per prefix, whatever the data, and hands one
    or two rows to the next.  A sort or an exact percentile would bring all
    distinct values to one task.
    """
    bits = values.select((F.col("c") + F.lit(_OFFSET)).alias("u"))
    siblings = Window.partitionBy("prefix")
    before = siblings.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)

    def rank_inside(rank: str) -> Column:
        inside = (F.col(rank) >= F.col("below")) & (F.col(rank) < F.col("below") + F.col("size"))
        return F.when(inside, F.col(rank) - F.col("below")).alias(rank)

    def holding_ranks(counts: DataFrame) -> DataFrame:
        """Of groups counted by digits, the one or two that hold the ranks."""
        return (
            counts.withColumn("below", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .select(F.col("digits").alias("prefix"), rank_inside("low"), rank_inside("high"))
            .where("low IS NOT NULL OR high IS NOT NULL")
        )

    size = F.count("*").alias("size")
    parent, *finer = (F.shiftright("u", shift) for shift in _SHIFTS)
    n, half = F.sum("size").over(siblings), F.lit(2)
    wanted = holding_ranks(
        bits.groupBy(parent.alias("digits"))
        .agg(size)
        .withColumn("prefix", F.lit(0))
        .withColumns({"low": F.call_function("div", n - 1, half), "high": F.call_function("div", n, half)})
    )
    for digits in finer:
        candidates = bits.select(parent.alias("prefix"), digits.alias("digits"))
        counts = candidates.join(F.broadcast(wanted), "prefix").groupBy("prefix", "low", "high", "digits").agg(size)
        wanted, parent = holding_ranks(counts), digits
    value = F.col("prefix") - F.lit(_OFFSET)
    return wanted.agg(
        F.max(F.when(F.col("low").isNotNull(), value)).alias("low"),
        F.max(F.when(F.col("high").isNotNull(), value)).alias("high"),
    )


def client_summary(clients: DataFrame) -> DataFrame:
    """One row: clients, mean transactions, median net movement, clients with reversals."""
    movements = clients.select(_ordered(F.col("net_movement")).alias("c")).where("c IS NOT NULL")
    middle = _middle_keys(movements)
    median = middle.select(((_amount_of(F.col("low")) + _amount_of(F.col("high"))) / 2).cast("double")).scalar()
    return clients.agg(
        F.count("*").alias("total_clients"),
        F.avg("total_transactions").alias("avg_transactions"),
        F.count_if(F.col("reversal_count") > 0).alias("clients_with_reversals"),
    ).withColumn("median_net_movement", median)


def status_mix(reversals: DataFrame) -> DataFrame:
    """Share of each status, by category."""
    return _cross_table(reversals, "transaction_category", "status", V.STATUSES, F.sum, "rate")


def failure_and_reversal_rates(reversals: DataFrame) -> DataFrame:
    """Shares of failed and reversed transactions, by category that has any."""
    bad = ("FAILED", "REVERSED")
    return _cross_table(
        reversals.where(F.col("status").isin(*bad)), "transaction_category", "status", bad, F.sum, "rate"
    )


def volume_by_hour(time_of_day: DataFrame) -> DataFrame:
    """Transactions, hour by category, for all hours."""
    return _cross_table(
        time_of_day,
        "hour_of_day",
        "transaction_category",
        V.CATEGORIES,
        F.sum,
        "transaction_count",
        empty=0,
        rows=range(24),
    )


def spend_by_hour(time_of_day: DataFrame) -> DataFrame:
    """Total spend, hour by category, for all hours."""
    return _cross_table(
        time_of_day, "hour_of_day", "transaction_category", V.CATEGORIES, F.sum, "total_spend", rows=range(24)
    )


def provinces_by_amount(provincial: DataFrame) -> DataFrame:
    """Cash machine flow, smallest amount first."""
    return provincial.orderBy("total_amount", "atm_province", "transaction_type")


def top_by_total_spend(mcc: DataFrame, n: int = V.TOP_MERCHANT_CATEGORIES) -> DataFrame:
    """Merchant category codes with the highest total spend."""
    return mcc.orderBy(F.desc("total_spend"), "merchant_category_code").limit(n)


def top_by_average_spend(mcc: DataFrame, n: int = V.TOP_MERCHANT_CATEGORIES) -> DataFrame:
    """Merchant category codes with the highest average spend."""
    return mcc.orderBy(F.desc("avg_spend"), "merchant_category_code").limit(n)


def amount_by_band_and_currency(currency: DataFrame) -> DataFrame:
    """Total amount, age band by currency."""
    return _cross_table(currency, "age_band", "currency", V.CURRENCIES, F.sum, "total_amount", rows=V.AGE_BANDS)


def accounts_by_currency(currency: DataFrame) -> DataFrame:
    """Accounts per currency, added over age bands.

    An account whose holder is in two bands is counted in both.
    """
    return (
        currency.groupBy("currency")
        .agg(F.sum("unique_accounts").alias("unique_accounts"))
        .orderBy(F.desc("unique_accounts"), "currency")
    )


def checks_by_category(results: DataFrame) -> DataFrame:
    """Numbers of failed and passed checks, by category."""
    return (
        results.groupBy("category")
        .agg(F.count_if(~F.col("passed")).alias("failed"), F.count_if("passed").alias("passed"))
        .orderBy("category")
    )


def checks_by_outcome(results: DataFrame) -> DataFrame:
    """Numbers of checks that passed and that failed."""
    outcome = F.when(F.col("passed"), "Passed").otherwise("Failed")
    return results.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("checks")).orderBy(F.desc("checks"))
