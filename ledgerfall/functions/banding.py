"""Bands and time buckets."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfall import vocabulary as V


def age_band(age: Column) -> Column:
    """Age band; an unknown age is below no bound and so is in the last band."""
    *bounded, last = V.AGE_BANDS
    ladder = reduce(
        lambda chain, step: chain.when(age < step[0], step[1]),
        zip(V.AGE_BAND_BOUNDS, bounded),
        F,
    )
    return ladder.otherwise(last)


def hour_of_day(moment: Column, tz: str | None = None) -> Column:
    """Hour of an ISO time with offset, in the session's zone or in a named one.

    Null if the text is not a time.
    """
    instant = moment.try_cast("timestamp")
    if tz is None:
        return F.hour(instant)
    # From the instant itself: the session's wall clock is ambiguous when summer time ends.
    since = F.make_dt_interval(secs=F.unix_seconds(instant).cast("decimal(18,6)"))
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + since
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(tz), utc))
