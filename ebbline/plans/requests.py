"""Cut-off dates from request parameters; a bad request gives an error, never a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import days, hours, ts_ntz

# fixed values: last past day a keyword covers, newest band first
PAST_DAY_KEYWORDS = ((0, "force-remove-all-days"), (1, "force-day"), (7, "force-week"), (30, "force-month"))


def cutoff_requests(requests: DataFrame, now: str) -> DataFrame:
    """``hours_to_keep`` xor ``before_date`` -> ``cutoff`` or ``error``.

    Exactly one hour to keep is refused: it passes the minimum but not the date rule.
    """
    h, d, at = F.col("hours_to_keep"), F.col("before_date"), ts_ntz(now)
    error = (
        F.when(h.isNotNull() & d.isNotNull(), "both given").when(h.isNull() & d.isNull(), "none given")
        .when(h < 1, "hours below 1").when(d > at, "date in the future")
        .when((h == 1) | (d == at), "boundary cannot be set"))
    cutoff = F.when(h.isNull(), d).otherwise(at - hours(h))
    return requests.select("*", F.when(error.isNull(), cutoff).alias("cutoff"), error.alias("error"))


def simple_retention_date(requests: DataFrame, now: str) -> DataFrame:
    """``retention_date`` xor days/hours back from now, optionally from the start of the day."""
    date, at = F.col("retention_date"), ts_ntz(now)
    back = F.col("retention_days").isNotNull() | F.col("retention_hours").isNotNull()
    error = (
        F.when(date.isNull() & ~back, "none given").when(date.isNotNull() & back, "both given")
        .when(date > at, "date in the future"))
    start = F.coalesce(date, at)
    start = F.when(F.col("round_to_day"), F.to_date(start).cast("timestamp_ntz")).otherwise(start)
    out = start - days(F.coalesce("retention_days", F.lit(0))) - hours(F.coalesce("retention_hours", F.lit(0)))
    return requests.select("*", F.when(error.isNull(), out).alias("trigger_time"), error.alias("error"))


def purge_date_guard(requests: DataFrame, now: str) -> DataFrame:
    """The later of "keep days" and "keep after"; a recent date needs the keyword of its band.

    A band runs from the day after the next smaller band; the four bands are fixed values,
    so the lookup is a CASE and not a join.
    """
    at = ts_ntz(now)
    limit = F.greatest(at - days(F.col("keep_days")), F.col("keep_after"))
    past = F.datediff(at, limit)
    needed, lower = F.when(F.lit(False), F.lit(None).cast("string")), 0
    for upper, word in PAST_DAY_KEYWORDS:
        needed = needed.when(past.between(lower, upper), F.lit(word))
        lower = upper + 1
    out = requests.withColumn("purge_before", limit).withColumn("needed_keyword", needed)
    error = (
        F.when(F.col("purge_before").isNull(), "none given").when(F.col("purge_before") > at, "date in the future")
        .when(F.col("needed_keyword").isNotNull()
              & ~F.col("needed_keyword").eqNullSafe(F.col("keyword")), "keyword needed"))
    return out.withColumn("error", error)
