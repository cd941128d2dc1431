"""Delayed purge: due groups, resume, delete by ledger, hand-shake between the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import ts_ntz


def due_groups(groups: DataFrame, status: DataFrame, now: str) -> DataFrame:
    """Archived, not deleted, non-empty groups past their date, plus those deleted locally."""
    cols = ["group_id", "delete_after", "first_id", "last_id", "id_count", "is_deleted", "is_synced"]
    due = groups.where((F.col("id_count") > 0) & F.col("is_archived") & ~F.col("is_deleted")
                       & (F.col("delete_after") < ts_ntz(now))).select(*cols)
    local = groups.join(status.where("is_deleted").select("group_id"), "group_id", "left_semi").select(*cols)
    return due.unionByName(local).distinct()


def resume_point(due: DataFrame, status: DataFrame) -> DataFrame:
    """First ledger id to delete per group that is not deleted yet, and the last one deleted before, if any."""
    s = status.select("group_id", F.col("is_deleted").alias("done"), F.col("first_id").alias("s_first"),
                      F.col("last_id").alias("s_last"))
    return (
        due.join(s, "group_id", "left").where(~F.coalesce("done", F.lit(False)))
        .select("group_id", F.coalesce(F.col("s_last") + 1, "s_first", "first_id").alias("resume_id"), F.col("s_last").alias("reached_id"))
    )


def purge_ids(ledger: DataFrame, resume: DataFrame) -> DataFrame:
    """Ledger rows of due groups from their resume point on.

    No size hint: the ledger is data-sized and the groups are usually few, so Spark picks a
    broadcast from statistics or a shuffle with skew splitting for a group that holds most ids.
    """
    return ledger.join(resume, "group_id").where(F.col("id") >= F.col("resume_id")).select(*ledger.columns)


def purge_status(resume: DataFrame, purged: DataFrame, due: DataFrame | None = None) -> DataFrame:
    """Local status after the run: last id deleted so far, and deleted once nothing of the group is left.

    ``due`` are all ids that were to go; a run that was cut short purged fewer. A run that finds nothing left
    keeps the last id of the run before.
    """
    last = purged.groupBy("group_id").agg(F.max("id").alias("last_id"), F.count(F.lit(1)).alias("purged"))
    whole = (due if due is not None else purged).groupBy("group_id").agg(F.max("id").alias("_due"))
    return (
        resume.join(last, "group_id", "left").join(whole, "group_id", "left")
        .select("group_id", F.col("resume_id").alias("first_id"), F.coalesce("last_id", "reached_id").alias("last_id"),
                F.coalesce("purged", F.lit(0)).cast("bigint").alias("purged"),
                (F.col("_due").isNull() | F.coalesce(F.col("last_id") >= F.col("_due"), F.lit(False))).alias("is_deleted"))
    )


def acknowledged_status(status: DataFrame, groups: DataFrame) -> DataFrame:
    """Locally deleted groups: dropped when the archive side synced them, else kept."""
    g = groups.select("group_id", "is_synced")
    return (status.where("is_deleted").join(g, "group_id")
            .select("group_id", F.when(F.col("is_synced"), "remove").otherwise("skip").alias("action")))


def ack_groups(status: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups deleted at the source that the archive side has not closed."""
    return (
        status.where("is_deleted").select("group_id", "deleted_on")
        .join(groups.where(~F.col("is_synced")).select("group_id", "trigger_id"), "group_id")
        .select("group_id", "trigger_id", "deleted_on")
    )


def ledger_survivors(ledger: DataFrame, acked: DataFrame) -> DataFrame:
    return ledger.join(acked.select("group_id"), "group_id", "left_anti")


def purge_finish(groups: DataFrame, acked: DataFrame) -> DataFrame:
    """Triggers touched by acknowledgements: finished only when every group is synced."""
    marked = (
        groups.select("group_id", "trigger_id", "is_synced")
        .join(acked.select("group_id", "deleted_on"), "group_id", "left")
        .withColumn("acked", F.col("deleted_on").isNotNull())
    )
    return (
        marked.groupBy("trigger_id")
        .agg(F.bool_or("acked").alias("touched"), F.bool_and(F.col("is_synced") | F.col("acked")).alias("is_finished"),
             F.max("deleted_on").alias("last_deleted"))
        .where("touched")
        .select("trigger_id", "is_finished", F.when(F.col("is_finished"), F.col("last_deleted")).alias("deleted_on"),
                F.when(F.col("is_finished"), "every group purged")
                .otherwise("groups left to purge").alias("message"))
    )
