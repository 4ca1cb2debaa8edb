"""Exact money arithmetic.

Adding doubles gives a total that depends on the order of the rows, hence on
the partitioning.  Amounts are therefore added as decimals with six digits after
the point, and a result is rounded to cents, half up, once.  An amount's digits
beyond the sixth are rounded off; a total beyond 28 digits before the point raises.
Results go back to double at the end.

A sum of decimals of that size is several times slower than one of whole numbers.  So
an amount is taken apart into three lanes of its millionths' bits, the lanes are
added as whole numbers, and put together once per group.  A lane holds the sum of
2**39 rows of the lowest, 2**35 of the middle and at least 2**33 of the highest kind.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT, TOTAL = "decimal(24,6)", "decimal(34,6)"
#: Lanes of an amount's millionths, and what one unit of a lane is worth.
LANES = {"low": 1, "middle": 1 << 24, "high": 1 << 52}
#: Amounts of this size and above do not fit and are no amounts.
LIMIT = 1e18


def finite(amount: Column) -> Column:
    """The double amount, or null if it is not a number, infinite or too large."""
    return F.when(F.abs(amount) < LIMIT, amount)


def exact(amount: Column) -> Column:
    """Decimal of a double amount, null for null and for what is not finite."""
    return finite(amount).cast(EXACT)


def in_lanes(df: DataFrame, amount: str = "amount") -> DataFrame:
    """With the lanes of a finite double amount, ``<amount>_low`` and so on, null for null.

    Amounts of fewer than 10**9 that have no digits beyond the sixth, as money has,
    are whole millionths by multiplication; the others go by way of a decimal.
    """
    x, middle, high = F.col(amount), LANES["middle"], LANES["high"]
    scaled = F.rint(x * 1e6)
    whole = F.when((F.abs(scaled) < 1e15) & (scaled / 1e6 == x), scaled.cast("bigint"))
    unit = F.lit(high).cast("decimal(16,0)")
    large = F.col("_large")
    split = F.call_function("div", large, unit)
    rest = F.col("_rest")
    return (
        df.withColumn("_whole", whole)
        .withColumn("_large", F.when(F.col("_whole").isNull() & x.isNotNull(), exact(x) * F.lit(1_000_000)))
        .withColumns(
            {
                f"{amount}_high": F.when(large.isNotNull(), split).otherwise(F.shiftright("_whole", 52)),
                "_rest": F.when(large.isNotNull(), (large - split * unit).cast("bigint")).otherwise(
                    F.col("_whole").bitwiseAND(F.lit(high - 1))
                ),
            }
        )
        .withColumns({f"{amount}_middle": F.shiftright(rest, 24), f"{amount}_low": rest.bitwiseAND(F.lit(middle - 1))})
        .drop("_whole", "_large", "_rest")
    )


def lane_sums(amount: str = "amount", condition: Column | None = None) -> dict[str, Column]:
    """Sums of an amount's lanes, by lane; of the rows a condition holds for, zero for the others."""
    lanes = {lane: F.col(f"{amount}_{lane}") for lane in LANES}
    if condition is not None:
        lanes = {lane: F.when(condition, value).otherwise(0) for lane, value in lanes.items()}
    return {lane: F.sum(value) for lane, value in lanes.items()}


def total(amount: str = "amount", condition: Column | None = None) -> Column:
    """Exact sum of an amount that is in lanes; null if there is none."""
    whole = (
        value.cast("decimal(19,0)") * F.lit(LANES[lane]).cast("decimal(16,0)")
        for lane, value in lane_sums(amount, condition).items()
    )
    return (reduce(Column.__add__, whole) * F.lit("0.000001").cast("decimal(6,6)")).cast(TOTAL)


def rounded(value: Column) -> Column:
    """Double of an exact value, rounded half up to cents."""
    return F.round(value, 2).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Double of total / count, rounded half up to cents from the exact quotient; null without rows.

    As ``divide_half_up``, but the quotient may be beyond whole numbers of 64 bits.
    """
    size, step = F.abs(total), F.nullif(count, F.lit(0)).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    rest = size % step
    steps = ((size - rest) / step).cast("decimal(32,0)")
    cents = F.when(rest >= step - rest, steps + 1).otherwise(steps)
    return (F.when(total < 0, -cents).otherwise(cents) * F.lit("0.01").cast("decimal(3,2)")).cast("double")


def cents(amount: Column) -> Column:
    """Whole cents of a double amount that has no further digits, null for null."""
    return F.rint(amount * 100).cast("bigint")


def wide_cents(amount: Column) -> Column:
    """Whole cents of a double amount of any size, as a decimal."""
    return (amount.cast("decimal(32,2)") * 100).cast("decimal(32,0)")


def from_cents(value: Column) -> Column:
    """Double amount of whole cents."""
    return value / 100


def divide_half_up(numerator: Column, denominator: Column) -> Column:
    """Integer quotient rounded half away from zero.

    The denominator is a count: null when it is zero.  Comparing the remainder
    with what is missing to the next step avoids doubling, so there is no
    overflow the inputs did not have already.
    """
    size = F.abs(numerator)
    divisor = F.nullif(denominator, F.lit(0))
    remainder = size % divisor
    quotient = F.call_function("div", size, divisor)
    rounded = F.when(remainder >= divisor - remainder, quotient + 1).otherwise(quotient)
    return F.when(numerator < 0, -rounded).otherwise(rounded)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole of two counts, rounded half up to a number of digits."""
    scale = 10**digits
    return divide_half_up(part * scale, whole) / scale
