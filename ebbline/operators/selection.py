"""Which rows leave: open windows, watermark, late marker, row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.entities import Entity
from ebbline.functions.expressions import to_do, ts_ntz
from ebbline.operators.sizing import (
    WindowProfile, bound_source, join_windows, next_time, profile_windows, running_number, running_sum,
)

WINDOW_TAGS = ["trigger_id", "group_id", "delete_only", "no_delay", "is_late"]


def is_open(current_id: Column, target_id: Column) -> Column:
    return target_id.isNull() | current_id.isNull() | (current_id < target_id)


def with_to_do(triggers: DataFrame) -> DataFrame:
    return triggers.withColumn(
        "to_do", to_do(F.col("is_archived"), F.col("is_finished"), F.col("is_dry_run"), F.col("is_error")))


def control_join(windows: DataFrame, groups: DataFrame, triggers: DataFrame) -> DataFrame:
    """Windows with their delete group and their trigger (filter - sync - trigger)."""
    g = groups.select("group_id", "trigger_id", "delete_after",
                      F.col("is_archived").alias("group_archived"))
    t = with_to_do(triggers).select("trigger_id", "trigger_time", "to_do")
    return windows.join(g, "group_id").join(t, "trigger_id")


def remaining_windows(windows: DataFrame, groups: DataFrame, triggers: DataFrame) -> DataFrame:
    return control_join(windows, groups, triggers).where(
        ~F.col("is_archived") & ~F.col("group_archived") & F.col("to_do")
        & is_open(F.col("current_id"), F.col("target_id")))


def open_windows(windows: DataFrame, groups: DataFrame, triggers: DataFrame, now: str, *,
                 delete_if_no_delay: bool = True, ignore_delay: bool = False) -> DataFrame:
    """Every due, open window with ``no_delay`` and ``order_no``, its number among those of its key, oldest first."""
    due = remaining_windows(windows, groups, triggers).where(F.col("trigger_time") < ts_ntz(now))
    no_delay = F.lit(delete_if_no_delay) & ((F.col("delete_after") == F.col("target_ts")) | F.lit(ignore_delay))
    return running_number(
        due.select("trigger_id", "group_id", "tenant_id", "sub_id", "delete_only", no_delay.alias("no_delay"),
                   "previous_ts", "target_ts", F.coalesce("current_id", F.lit(0)).cast("bigint").alias("current_id"),
                   "target_id"), ["tenant_id", "sub_id"], "target_ts", "group_id", "order_no")


def high_watermark(source: DataFrame, entity: Entity, last_target, max_target_id: int = 0,
                   external: bool = False) -> DataFrame:
    """One row: the highest id that had an event time up to ``last_target``.

    Raised to an id a window already targets. External sources and entities without a late
    branch use the plain maximum.
    """
    rows = source if external or not entity.late else source.where(F.col(entity.time) <= ts_ntz(last_target))
    return rows.agg(
        F.greatest(F.max(entity.id), F.lit(max_target_id).cast("bigint")).alias("watermark"))


def late_markers(windows: DataFrame) -> DataFrame:
    """Per (tenant, sub-key): the highest id a finished window reached."""
    finished = windows.where(F.col("is_archived") & (F.col("current_id") == F.col("target_id")))
    return finished.groupBy("tenant_id", "sub_id").agg(F.max("target_id").alias("last_id"))


def with_late_marker(batch: DataFrame, windows: DataFrame) -> DataFrame:
    """``last_id`` on the first window of each key only, so a late row has one window."""
    marked = batch.join(late_markers(windows), ["tenant_id", "sub_id"], "left")
    return marked.withColumn("last_id", F.when(F.col("order_no") == 1, F.col("last_id")))


def _window_side(windows: DataFrame) -> DataFrame:
    names = set(windows.columns)
    optional = {"last_id": "bigint", "current_id": "bigint", "target_id": "bigint"}
    out = windows
    for name, kind in optional.items():
        if name not in names:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def select_rows(source: DataFrame, windows: DataFrame, entity: Entity, *, watermark: int | None = None,
                profile: WindowProfile | None = None) -> DataFrame:
    """Source rows that fall in a window or are late for it, tagged with the window.

    All source columns are kept; Catalyst prunes those the caller does not use.
    """
    windows = _window_side(windows)
    profile = profile or profile_windows(windows)
    rows = bound_source(source, entity.id, entity.time, profile, right_closed=entity.right_closed,
                        late=entity.late, own_cursor=entity.own_cursor, watermark=watermark)
    w = windows.select(
        F.col("trigger_id"), F.col("group_id"), F.col("delete_only"), F.col("no_delay"),
        F.col("tenant_id").alias("_tenant"), F.col("sub_id").alias("_sub"),
        F.col("previous_ts").alias("_previous"), F.col("target_ts").alias("_target"),
        F.coalesce("current_id", F.lit(0)).alias("_cursor"), F.col("last_id").alias("_last"))
    ts, key = F.col(entity.time), F.col(entity.id)
    if entity.right_closed:
        inside, before = (ts > F.col("_previous")) & (ts <= F.col("_target")), ts <= F.col("_previous")
    else:
        inside, before = (ts >= F.col("_previous")) & (ts < F.col("_target")), ts < F.col("_previous")
    late = before & (key > F.col("_last")) if entity.late else None
    if entity.own_cursor:
        inside, late = inside & (key >= F.col("_cursor")), None if late is None else late & (key >= F.col("_cursor"))
    keys = [(entity.tenant, "_tenant")]
    if entity.sub:
        keys.append((entity.sub, "_sub"))
    joined = join_windows(rows, w, keys, inside, late, profile, entity.id, entity.time)
    return joined.withColumn("is_late", before if entity.late else F.lit(False)).drop(
        "_tenant", "_sub", "_previous", "_target", "_cursor", "_last")


def _window_key(entity: Entity) -> list[str]:
    return ["tenant_id", "sub_id"] if entity.sub else ["tenant_id"]


def _whole(windows: DataFrame) -> DataFrame:
    """The windows that can hold a row; a late marker or a cursor is one window's own and does not go with pieces."""
    if own := {"last_id", "current_id"} & set(windows.columns):
        raise ValueError(f"windows with {', '.join(sorted(own))} have no common pieces")
    return windows.where(F.col("previous_ts") < F.col("target_ts"))


def window_pieces(windows: DataFrame, entity: Entity) -> DataFrame:
    """The time that windows cover, per key, cut at every bound of a window of the key: windows for ``select_rows``.

    A row lies in one piece at most, however many windows cover it, so a selection by pieces is no larger than its
    source. A piece is known by its key and its start, which is its ``group_id``.
    """
    key = _window_key(entity)
    ends = F.array(F.struct(F.col("previous_ts").alias("at"), F.lit(1).alias("step")), F.struct(F.col("target_ts").alias("at"), F.lit(-1).alias("step")))
    bounds = _whole(windows).select(*key, F.explode(ends).alias("b")).groupBy(*key, F.col("b.at").alias("previous_ts")).agg(F.sum("b.step").alias("step"))
    pieces = next_time(running_sum(bounds, key, "previous_ts", "step", "_open"), key, "previous_ts", "target_ts").where("_open > 0")
    sub = F.col("sub_id") if entity.sub else F.lit(0).alias("sub_id")
    none = F.lit(None).cast("boolean")
    return pieces.select("tenant_id", sub, "previous_ts", "target_ts", F.col("previous_ts").alias("group_id"), F.lit(None).cast("bigint").alias("trigger_id"),
                         none.alias("delete_only"), none.alias("no_delay"))


def count_by_window(selected: DataFrame, pieces: DataFrame, windows: DataFrame, entity: Entity, by: list[str]) -> DataFrame:
    """``by, row_count``: selected rows of each window, summed over the windows with the same ``by``; none without a row.

    ``selected`` are rows by the ``pieces`` of the windows. The rows of a window are those before its target less those
    before its start, so no row is made for each pair of a row and a window.
    """
    key = _window_key(entity)
    names = [F.col(entity.tenant).alias("tenant_id")] + ([F.col(entity.sub).alias("sub_id")] if entity.sub else [])
    held = selected.groupBy(*names, F.col("group_id").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    bounds = pieces.select(*key, F.explode(F.array("previous_ts", "target_ts")).alias("at")).distinct()
    counted = bounds.join(held, [*key, "at"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    reached = running_sum(counted, key, "at", "n", "_upto").select(*key, "at", (F.col("_upto") - F.col("n")).alias("_before"))
    spans = _whole(windows).select(*key, "previous_ts", "target_ts").distinct()
    spans = spans.join(reached.withColumnsRenamed({"at": "previous_ts", "_before": "_low"}), [*key, "previous_ts"])
    spans = spans.join(reached.withColumnsRenamed({"at": "target_ts", "_before": "_high"}), [*key, "target_ts"])
    spans = spans.withColumn("row_count", F.col("_high") - F.col("_low")).where("row_count > 0").drop("_low", "_high")
    return windows.join(spans, [*key, "previous_ts", "target_ts"]).groupBy(*by).agg(F.sum("row_count").alias("row_count"))
