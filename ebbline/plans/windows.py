"""Window planning: settings + trigger time -> windows grouped by delete date; repeats and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.expressions import EPOCH, hours, prepend_history, ts_ntz
from ebbline.operators.selection import with_to_do
from ebbline.operators.sizing import prior_max

KEY = ["tenant_id", "sub_id"]


def plan_dates(settings: DataFrame) -> DataFrame:
    """Target = trigger - after_hours; delete date = target + delay_hours. Exact hours."""
    target = F.col("trigger_time") - hours(F.col("after_hours"))
    return settings.withColumn("target_ts", target).withColumn(
        "delete_after", F.col("target_ts") + hours(F.col("delay_hours")))


def previous_targets(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """Latest target that was there before each planned window.

    ``existing`` are stored windows; triggers of ``planned`` are taken in id order, as if
    added one after the other, so an earlier trigger's windows count as stored for a later one.
    """
    stored = existing.groupBy(*KEY).agg(F.max("target_ts").alias("_stored"))
    chained = prior_max(planned, KEY, "trigger_id", "target_ts", "_prior")
    return chained.join(stored, KEY, "left").withColumn("last_target", F.greatest("_prior", "_stored")).drop(
        "_prior", "_stored")


def plan_status(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds ``is_valid``: no earlier window of the key reaches the target."""
    return previous_targets(planned, existing).withColumn(
        "is_valid", F.col("last_target").isNull() | (F.col("last_target") < F.col("target_ts")))


def plan_windows(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """Valid windows ``[previous, target)``; without a previous window it starts in 1900."""
    return plan_status(planned, existing).where("is_valid").select(
        "trigger_id", *KEY, "delete_only", "delete_after", "target_ts",
        F.coalesce("last_target", ts_ntz(EPOCH)).alias("previous_ts"))


def plan_groups(planned: DataFrame) -> DataFrame:
    """Delete groups: the distinct delete dates of a trigger, numbered newest first.

    Distinct comes before the numbering: a trigger has as many dates as its policy has
    (hours, delay) pairs, so the window per trigger is small.
    """
    dates = planned.select("trigger_id", "delete_after").distinct()
    order = Window.partitionBy("trigger_id").orderBy(F.desc("delete_after"))
    return dates.withColumn("group_no", F.row_number().over(order))


def plan_counts(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """Per trigger: valid and superseded windows and the highest target."""
    return plan_status(planned, existing).groupBy("trigger_id").agg(
        F.count_if("is_valid").alias("valid_windows"), F.count_if(~F.col("is_valid")).alias("duplicate_windows"),
        F.max("target_ts").alias("target_ts"))


def repeat_next(triggers: DataFrame, batch: DataFrame, batch_target) -> DataFrame:
    """Next trigger of each repeating trigger that is being processed, or empty and due.

    A trigger that already has a later child is left out.
    """
    following = F.col("trigger_time") + hours(F.col("repeat_hours"))
    repeating = with_to_do(triggers).where(F.col("to_do") & F.col("repeats")).withColumn("next_time", following).where(
        F.col("repeat_until").isNull() | (F.col("repeat_until") >= F.col("next_time")))
    children = triggers.where(F.col("trigger_id") > F.col("parent_id")).select(F.col("parent_id").alias("trigger_id"))
    processed = batch.select("trigger_id").distinct().withColumn("_in_batch", F.lit(True))
    due_empty = (F.col("valid_windows") == 0) & (F.col("target_ts") <= ts_ntz(batch_target))
    return (
        repeating.join(children, "trigger_id", "left_anti").join(processed, "trigger_id", "left")
        .where(F.col("_in_batch").isNotNull() | due_empty)
        .select(F.col("trigger_id").alias("parent_id"), F.col("next_time").alias("trigger_time"), "repeat_hours",
                "repeat_until")
    )


def repeat_schedule(triggers: DataFrame) -> DataFrame:
    """All trigger times from the start to ``repeat_until``."""
    step = hours(F.col("repeat_hours"))
    return triggers.where(F.col("repeats") & F.col("repeat_until").isNotNull()
                          & (F.col("repeat_until") >= F.col("trigger_time"))).select(
        "trigger_id", F.posexplode(F.sequence("trigger_time", "repeat_until", step)).alias("repeat_no", "trigger_time"))


def repeat_chain(triggers: DataFrame, now, pending: bool = False) -> DataFrame:
    """Every repeat due before ``now`` of each repeating trigger, in one run: ``root_id, repeat_no, trigger_time, ..``.

    Repeat 1 follows the stored trigger, repeat n follows repeat n - 1; a trigger that already has a later child leaves its
    repeats to that child. ``is_last`` marks the repeat from which the next run goes on. ``pending`` adds the one repeat
    after ``now`` that a chain waits for once all others are archived.
    """
    step = hours(F.col("repeat_hours"))
    repeating = with_to_do(triggers).where(F.col("to_do") & F.col("repeats") & (F.col("repeat_hours") > 0))
    children = triggers.where(F.col("trigger_id") > F.col("parent_id")).select(F.col("parent_id").alias("trigger_id"))
    horizon = ts_ntz(now) + step if pending else ts_ntz(now)
    first, end = F.col("trigger_time") + step, F.least(F.coalesce("repeat_until", horizon), horizon)
    return (
        repeating.join(children, "trigger_id", "left_anti").where(first <= end)
        .select(F.col("trigger_id").alias("root_id"), "repeat_hours", "repeat_until", F.posexplode(F.sequence(first, end, step)).alias("pos", "trigger_time"))
        .where(F.col("trigger_time") < horizon)
        .select("root_id", (F.col("pos") + 1).alias("repeat_no"), "trigger_time", "repeat_hours", "repeat_until",
                ((F.col("trigger_time") + step > end) | (F.col("trigger_time") + step >= horizon)).alias("is_last")))


def chain_roots(triggers: DataFrame, written) -> DataFrame:
    """``trigger_id, root_id``: the first trigger of each chain of parents.

    Links double in length every round, so a chain of n triggers takes log2(n) rounds. ``written`` stores a round and reads it
    back. A parent is older than its child and may be missing; then the child is a root.
    """
    ids = triggers.select(F.col("trigger_id").alias("_up"))
    up = triggers.where(F.col("parent_id") < F.col("trigger_id")).select("trigger_id", F.col("parent_id").alias("_up")).join(ids, "_up", "left_semi")
    links = written(triggers.select("trigger_id").join(up, "trigger_id", "left").select("trigger_id", F.coalesce("_up", "trigger_id").alias("root_id")))
    while True:
        further = links.select(F.col("trigger_id").alias("root_id"), F.col("root_id").alias("_next"))
        links = written(links.join(further, "root_id").select("trigger_id", F.col("_next").alias("root_id"), (F.col("_next") != F.col("root_id")).alias("_moved")))
        if not links.where("_moved").limit(1).count():
            return links.select("trigger_id", "root_id")
        links = links.drop("_moved")


def chain_status(triggers: DataFrame, roots: DataFrame) -> DataFrame:
    """Per chain: its triggers, the latest time, and whether all of it is finished; only then its first trigger is."""
    return triggers.join(roots, "trigger_id").groupBy("root_id").agg(
        F.count(F.lit(1)).alias("triggers"), F.max("trigger_time").alias("last_time"), F.bool_and("is_finished").alias("is_finished"),
        F.count_if(~F.col("is_finished")).alias("unfinished"))


def run_history(triggers: DataFrame, run_id: str, at: str) -> DataFrame:
    """Trigger history with the current run first."""
    return triggers.withColumn("history", prepend_history(
        F.col("history"), F.lit(run_id), F.concat(F.lit("windows: "), F.col("window_count").cast("string")),
        ts_ntz(at)))


def new_triggers(requests: DataFrame, errors: DataFrame) -> DataFrame:
    """Trigger rows for requests, flagged as error when their policy has violations."""
    bad = errors.select("policy_id").distinct().withColumn("_bad", F.lit(True))
    return requests.join(bad, "policy_id", "left").select(
        "policy_id", "trigger_id", "trigger_time", F.coalesce("_bad", F.lit(False)).alias("is_error"),
        F.col("is_dry_run"), F.col("is_dry_run").alias("is_finished"), F.lit(False).alias("is_archived"),
        F.when(F.coalesce("_bad", F.lit(False)), "policy has violations")
        .when(F.col("is_dry_run"), "dry run").otherwise("added").alias("message"))
