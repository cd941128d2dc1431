"""Checked broadcasts, scan bounds, id slices and running maxima that never need one big task."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.entities import MAX_BROADCAST_WINDOWS
from ebbline.functions.expressions import ts_ntz
from ebbline.operators.intervals import indexed_join

MAX_DIRECT_WINDOWS = 16


@dataclass(frozen=True)
class WindowProfile:
    """One row about a set of windows: enough to size the join and bound the scan."""

    count: int
    first_previous: datetime | None
    last_target: datetime | None
    first_cursor: int | None
    max_target_id: int | None
    first_last_id: int | None
    most_of_key: int = 1

    @property
    def broadcastable(self) -> bool:
        return self.count <= MAX_BROADCAST_WINDOWS


def profile_windows(windows: DataFrame) -> WindowProfile:
    """A small aggregate over the control rows, first by key; one row reaches the driver."""
    by_key = windows.groupBy("tenant_id", "sub_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("previous_ts").alias("previous"), F.max("target_ts").alias("target"),
        F.min(F.coalesce("current_id", F.lit(0))).alias("cursor"), F.max(F.coalesce("target_id", F.lit(0))).alias("reached"),
        F.min("last_id").alias("last_id"))
    row = by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.min("previous"), F.max("target"), F.min("cursor"), F.max("reached"),
        F.min("last_id"), F.coalesce(F.max("n"), F.lit(0))).first()
    return WindowProfile(*row)


def bound_source(source: DataFrame, id_col: str, time_col: str, profile: WindowProfile, *,
                 right_closed: bool, late: bool, own_cursor: bool, watermark: int | None) -> DataFrame:
    """Literal bounds Catalyst cannot derive from a range join; they reach the Parquet scan.

    Late rows lie before the first window, so with a late marker the time bound below is
    widened to "or id past the marker" instead of dropped.
    """
    if profile.count == 0:
        return source.limit(0)
    ts, key = F.col(time_col), F.col(id_col)
    upper = ts_ntz(profile.last_target)
    lower = ts_ntz(profile.first_previous)
    bounded = source.where(ts <= upper if right_closed else ts < upper)
    in_time = ts > lower if right_closed else ts >= lower
    if late and profile.first_last_id is not None:
        in_time = in_time | (key > F.lit(profile.first_last_id))
    bounded = bounded.where(in_time)
    if own_cursor and profile.first_cursor:
        bounded = bounded.where(key >= F.lit(profile.first_cursor))
    if watermark is not None:
        bounded = bounded.where(key <= F.lit(watermark))
    return bounded


def join_windows(rows: DataFrame, windows: DataFrame, keys: list[tuple[str, str]], inside: Column, late: Column | None,
                 profile: WindowProfile, row_id: str, time: str) -> DataFrame:
    """Rows x windows on equal keys plus a range: ``inside`` the window, or ``late`` for it.

    (tenant, sub-key) is skewed, so rows are never shuffled by it alone. A few windows of each key are broadcast
    and compared directly (counted, not guessed); more go through the interval index, so a row meets the windows that
    cover it and not all of its key.
    """
    if profile.broadcastable and profile.most_of_key <= MAX_DIRECT_WINDOWS:
        on = inside if late is None else inside | late
        for left, right in keys:
            on = on & (F.col(left) == F.col(right))
        return rows.join(F.broadcast(windows), on)
    return indexed_join(rows, windows, keys, time, "_previous", "_target", inside, None if late is None else "_last", late, row_id,
                        8 * MAX_BROADCAST_WINDOWS)


def prior_max(df: DataFrame, keys: list[str], order: str, value: str, out: str, bucket: int = 4096) -> DataFrame:
    """``max(value)`` over the rows of the same key with a smaller ``order``.

    A plain window would sort all rows of a hot key in one task. Here the order is cut into
    buckets: a window inside each (key, bucket), plus the running maximum over one row per
    (key, bucket). The explicit repartition is one exchange that window, aggregate and join
    all reuse, so ``df`` is computed and shuffled once.
    """
    tagged = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(bucket))).repartition(*keys, "_bucket")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        tagged.groupBy(*keys, "_bucket").agg(F.max(value).alias("_max"))
        .select(*keys, "_bucket", F.max("_max").over(before).alias("_carry"))
    )
    return (
        tagged.withColumn("_inside", F.max(value).over(inside))
        .join(carried, [*keys, "_bucket"])
        .withColumn(out, F.greatest("_inside", "_carry"))
        .drop("_bucket", "_inside", "_carry")
    )


def running_number(df: DataFrame, keys: list[str], time: str, then: str, out: str, days: int = 16) -> DataFrame:
    """Number of a row among the rows of its key, ordered by ``time`` and ``then``.

    Numbered inside buckets of ``days``, plus the rows of the earlier buckets: a hot key is never sorted
    in one task.
    """
    tagged = df.withColumn("_bucket", F.floor(F.datediff(F.col(time), F.lit("1900-01-01")) / F.lit(days))).repartition(*keys, "_bucket")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time, then)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = tagged.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n")).select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = tagged.withColumn("_inside", F.row_number().over(inside)).join(earlier, [*keys, "_bucket"])
    return numbered.withColumn(out, (F.col("_inside") + F.col("_before")).cast("int")).drop("_bucket", "_inside", "_before")


def _day_buckets(df: DataFrame, keys: list[str], time: str, days: int) -> DataFrame:
    """``df`` by key and bucket of ``days``: one exchange that windows, aggregates and joins over it share."""
    return df.withColumn("_bucket", F.floor(F.datediff(F.col(time), F.lit("1900-01-01")) / F.lit(days))).repartition(*keys, "_bucket")


def running_sum(df: DataFrame, keys: list[str], time: str, value: str, out: str, days: int = 16) -> DataFrame:
    """``value`` summed over the rows of the key up to and with ``time``, by buckets as in ``running_number``."""
    tagged = _day_buckets(df, keys, time, days)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = tagged.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_n")).select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    summed = tagged.withColumn("_inside", F.sum(value).over(inside)).join(earlier, [*keys, "_bucket"])
    return summed.withColumn(out, F.col("_inside") + F.col("_before")).drop("_bucket", "_inside", "_before")


def next_time(df: DataFrame, keys: list[str], time: str, out: str, days: int = 16) -> DataFrame:
    """The next ``time`` of the key, which holds each time once; null for its last one. By buckets as in ``running_number``."""
    tagged = _day_buckets(df, keys, time, days)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time)
    after = Window.partitionBy(*keys).orderBy("_bucket")
    later = tagged.groupBy(*keys, "_bucket").agg(F.min(time).alias("_first")).select(
        *keys, "_bucket", F.lead("_first").over(after).alias("_after"))
    led = tagged.withColumn("_inside", F.lead(time).over(inside)).join(later, [*keys, "_bucket"])
    return led.withColumn(out, F.coalesce("_inside", "_after")).drop("_bucket", "_inside", "_after")


def id_slices(df: DataFrame, id_col: str, width: int) -> DataFrame:
    """Slices of a fixed id width: ``(slice_no, first_id, last_id, row_count)``.

    A partial aggregate per slice number; nothing is sorted or numbered globally.
    """
    slice_no = F.floor(F.col(id_col) / F.lit(width)).cast("bigint")
    return df.groupBy(slice_no.alias("slice_no")).agg(
        F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"), F.count(F.lit(1)).alias("row_count"))


def exact_slices(df: DataFrame, id_col: str, budget: int, cells: int = 4096, width: int = 65_536) -> DataFrame:
    """``slice_no, first_id, last_id, row_count``: slices of exactly ``budget`` rows in id order, the last with the rest.

    Ids are cut into at most ``cells`` ranges, whose counts are all that reaches the driver, and these into parts of ``width`` ids.
    A row's number is the rows of the earlier ranges, of the earlier parts of its range and of the earlier ids of its part, so no
    task orders more than a part. Ids are keys: a part holds no more rows than ids. Rows that share an id share a slice.
    """
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "slice_no bigint, first_id bigint, last_id bigint, row_count bigint")
    span = max(1, -(-(hi - lo + 1) // cells))
    at = F.col(id_col) - F.lit(lo)
    ids = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.floor(at / span).cast("int").alias("cell"),
                                                     F.floor((at % span) / width).cast("int").alias("part"))
    parts = ids.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets, total = {}, 0
    for cell, n in sorted(parts.groupBy("cell").agg(F.sum("n")).collect()):
        offsets[cell], total = total, total + n
    carried = F.try_element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("cell"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("cell", "part", (carried + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))
    inside = F.rank().over(Window.partitionBy("cell", "part").orderBy("id")) - 1
    numbered = ids.withColumn("inside", inside).join(starts, ["cell", "part"])
    slice_no = F.floor((F.col("start") + F.col("inside")) / budget).cast("bigint")
    return numbered.groupBy(slice_no.alias("slice_no")).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("row_count"))


def budget_slices(df: DataFrame, id_col: str, budget: int, cells: int = 4096) -> list[tuple[int, int]]:
    """The bounds of ``exact_slices`` in id order, for a run with a row budget: one pair for each slice the run makes."""
    return sorted((r.first_id, r.last_id) for r in exact_slices(df, id_col, budget, cells).select("first_id", "last_id").collect())
