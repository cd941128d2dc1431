"""Status roll-ups: window -> group -> trigger, and what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import ts_ntz
from ebbline.operators.selection import remaining_windows, with_to_do


def group_rollup(groups: DataFrame, windows: DataFrame, ledger: DataFrame, *,
                 delete_if_no_delay: bool = True) -> DataFrame:
    """Groups with no open window: archived, with first, last and count of their ledger ids.

    Without ledger ids an immediate run has nothing left to delete: deleted and synced.
    The ledger is data-sized, so it is aggregated per group before it meets the groups.
    """
    return rollup_from_partials(groups, windows, ledger_partials(ledger), delete_if_no_delay=delete_if_no_delay)


EDGES = ["first_id", "last_id", "id_count"]


def ledger_partials(ledger: DataFrame, *by: str) -> DataFrame:
    """First, last and number of the ids of each group: partial results of a run that can be merged."""
    return ledger.groupBy("group_id", *by).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("id_count"))


def merge_partials(*partials: DataFrame) -> DataFrame:
    """One partial of several over different ids: of all runs, or of what was stored and what a run added."""
    rows = partials[0].select("group_id", *EDGES)
    for other in partials[1:]:
        rows = rows.unionByName(other.select("group_id", *EDGES))
    return rows.groupBy("group_id").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.sum("id_count").alias("id_count"))


def partials_after_delete(stored: DataFrame, removed: DataFrame, ledger_left: DataFrame) -> DataFrame:
    """Stored partials after ``removed(group_id, id)`` left the ledger.

    A group that lost neither its first nor its last id only counts down. One that lost an edge is built again, from
    its own ledger rows alone; one without rows goes.
    """
    gone = ledger_partials(removed).select("group_id", *[F.col(c).alias(f"_{c}") for c in EDGES])
    met = stored.select("group_id", *EDGES).join(gone, "group_id", "left")
    lost = (F.col("_first_id") <= F.col("first_id")) | (F.col("_last_id") >= F.col("last_id"))
    kept = met.where(~F.coalesce(lost, F.lit(False))).select("group_id", "first_id", "last_id", (F.col("id_count") - F.coalesce("_id_count", F.lit(0))).alias("id_count"))
    again = ledger_partials(ledger_left.join(met.where(lost).select("group_id"), "group_id", "left_semi"))
    return kept.unionByName(again)


def rollup_from_partials(groups: DataFrame, windows: DataFrame, partials: DataFrame, *, delete_if_no_delay: bool = True) -> DataFrame:
    """``group_rollup`` from stored partials: the ledger itself is not read."""
    closed = windows.groupBy("group_id").agg(F.bool_and("is_archived").alias("all_archived")).where("all_archived")
    done = F.lit(delete_if_no_delay) & F.col("first_id").isNull()
    return (
        groups.select("group_id", "trigger_id").join(closed.select("group_id"), "group_id", "left_semi")
        .join(partials.select("group_id", *EDGES), "group_id", "left")
        .select("group_id", "trigger_id", F.lit(True).alias("is_archived"), done.alias("is_deleted"), done.alias("is_synced"),
                "first_id", "last_id", F.coalesce("id_count", F.lit(0)).cast("bigint").alias("id_count")))


def trigger_rollup(groups: DataFrame) -> DataFrame:
    """Triggers whose groups are all archived; finished when all of them are synced."""
    return (
        groups.groupBy("trigger_id")
        .agg(F.bool_and("is_archived").alias("is_archived"), F.bool_and("is_synced").alias("is_finished"))
        .where("is_archived")
        .withColumn("is_deleted", F.col("is_finished"))
        .withColumn("is_success", F.col("is_finished"))
        .withColumn("message", F.when(F.col("is_finished"), "purged").otherwise("archived"))
    )


def close_empty(triggers: DataFrame, target_ts) -> DataFrame:
    """Triggers without a valid window that the batch has passed are finished."""
    return (
        with_to_do(triggers)
        .where(F.col("to_do") & (F.col("valid_windows") == 0) & (F.col("target_ts") <= ts_ntz(target_ts)))
        .select("trigger_id", F.lit(True).alias("is_finished"),
                F.lit("finished without windows").alias("message"))
    )


def remaining_work(windows: DataFrame, groups: DataFrame, triggers: DataFrame, now: str) -> DataFrame:
    """Triggers and windows still to do, split into outstanding and upcoming."""
    due = F.col("trigger_time") < ts_ntz(now)
    counts = [F.count(F.lit(1)).alias("remaining"), F.count_if(due).alias("outstanding"),
              F.count_if(~due).alias("upcoming")]
    t = with_to_do(triggers).where("to_do").agg(*counts).select(F.lit("triggers").alias("kind"), "*")
    w = remaining_windows(windows, groups, triggers).agg(*counts).select(F.lit("windows").alias("kind"), "*")
    return t.unionByName(w)


def batch_message(batch: DataFrame) -> DataFrame:
    """One row for each trigger of the batch: ``trigger_id`` and the text ``trigger(count)``."""
    per = batch.groupBy("trigger_id").agg(F.count(F.lit(1)).alias("n"))
    return per.select("trigger_id", F.concat(F.col("trigger_id").cast("string"), F.lit("("), F.col("n").cast("string"), F.lit(")")).alias("message"))
