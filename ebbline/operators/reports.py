"""Run log and sizing reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import RUN_LOG_DAYS, Entity
from ebbline.functions.expressions import days, ts_ntz

CLEANUP_ERROR, ARCHIVE_ERROR = 16, 11  # lowest severity that counts as an error


def run_errors(messages: DataFrame, error_severity: int = CLEANUP_ERROR) -> DataFrame:
    """Errors per run; pre-aggregated, so a run with most of the messages is no hot group."""
    return messages.groupBy("run_id").agg(
        F.count_if(F.col("severity") >= error_severity).alias("errors"),
        F.min(F.when(F.col("severity") >= error_severity, F.col("seq"))).alias("first_error_seq"),
        F.count(F.lit(1)).alias("messages"))


def messages_visible(messages: DataFrame, level: int, error_severity: int = CLEANUP_ERROR) -> DataFrame:
    """Messages at or above the verbosity level, warnings, and everything of runs with errors.

    A flag per run is joined; no window over a run's messages.
    """
    failed = run_errors(messages, error_severity).where("errors > 0").select("run_id", F.lit(True).alias("_failed"))
    shown = (F.col("severity") >= level) | (F.col("severity") > 10) | F.coalesce("_failed", F.lit(False))
    return messages.join(failed, "run_id", "left").where(shown).drop("_failed")


def run_status(runs: DataFrame, messages: DataFrame, error_severity: int = CLEANUP_ERROR,
               check_messages: int = 1) -> DataFrame:
    """0 ok, 1 dry run, 3 bad parameters (error among the first checks), 4 failed, 255 unknown."""
    errors = run_errors(messages, error_severity)
    failed = F.coalesce("errors", F.lit(0)) > 0
    status = (
        F.when(failed & (F.col("first_error_seq") < check_messages), 3).when(failed, 4)
        .when(~F.col("is_finished"), 255).when(F.col("is_dry_run"), 1).otherwise(0))
    return runs.join(errors, runs["id"] == errors["run_id"], "left").select(
        runs["id"].alias("run_id"), F.coalesce("messages", F.lit(0)).cast("bigint").alias("messages"),
        F.coalesce("errors", F.lit(0)).cast("bigint").alias("errors"), status.cast("int").alias("status"))


def run_retention(runs: DataFrame, now: str, current_run: int, keep_days: int = RUN_LOG_DAYS) -> DataFrame:
    """Runs kept: young enough, or the current one."""
    return runs.where((F.col("start_time") >= ts_ntz(now) - days(keep_days)) | (F.col("id") == current_run))


def message_retention(messages: DataFrame, kept_runs: DataFrame) -> DataFrame:
    """Messages follow their run."""
    return messages.join(kept_runs.select(F.col("id").alias("run_id")), "run_id", "left_semi")


def run_log(runs: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages with their run, in order; a range-partitioned sort."""
    return messages.join(runs.select(F.col("id").alias("run_id"), "start_time"), "run_id").orderBy("run_id", "seq")


def volume_profile(rows: DataFrame, entity: Entity) -> DataFrame:
    """Rows per tenant, sub-key and day: what a policy would touch."""
    sub = F.col(entity.sub) if entity.sub else F.lit(0)
    return rows.groupBy(
        F.col(entity.tenant).alias("tenant_id"), sub.alias("sub_id"), F.to_date(entity.time).alias("day"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.min(entity.id).alias("first_id"), F.max(entity.id).alias("last_id"))


def duration_stats(sessions: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Count, total and mean minutes, first start and last end."""
    minutes = F.timestamp_diff("MINUTE", F.col(start), F.col(end))
    return sessions.groupBy(by).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(minutes).alias("total_minutes"),
        F.round(F.sum(minutes) / F.count(F.lit(1)), 4).alias("mean_minutes"),
        F.min(start).alias("first_start"), F.max(end).alias("last_end"))


def session_detail(sessions: DataFrame, tenants: DataFrame) -> DataFrame:
    """Sessions with their tenant's name, distinct, newest first."""
    return (
        sessions.join(tenants.select("tenant_id", F.col("name").alias("tenant")), "tenant_id")
        .select("tenant", "start_date", "end_date").distinct().orderBy(F.desc("start_date"), "tenant", "end_date"))


def report_sections(sections: dict[str, DataFrame], ranks: dict[str, int], unknown_rank: int = 99) -> DataFrame:
    """``(section, item, value)`` rows of all sections ordered by rank, unknown sections last.

    The rank is a literal per section: no join.
    """
    parts = [
        df.select(F.lit(name).alias("section"), F.lit(ranks.get(name, unknown_rank)).alias("section_rank"),
                  F.col("item").cast("string").alias("item"), F.col("value").cast("bigint").alias("value"))
        for name, df in sections.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("section_rank", "section", "item")


def change_volume(selected: dict[str, DataFrame]) -> DataFrame:
    """Rows written and removed per table and trigger of a run."""
    parts = [
        df.groupBy("trigger_id").agg(
            F.count_if(~F.col("delete_only")).alias("inserted"), F.count_if(F.col("no_delay")).alias("deleted"),
        ).select(F.lit(name).alias("table_name"), "trigger_id", "inserted", "deleted")
        for name, df in selected.items()]
    return reduce(DataFrame.unionByName, parts)


def late_rows(selected: DataFrame, entity: Entity) -> DataFrame:
    """Late rows per tenant, sub-key and day."""
    sub = F.col(entity.sub) if entity.sub else F.lit(0)
    return selected.where("is_late").groupBy(
        F.col(entity.tenant).alias("tenant_id"), sub.alias("sub_id"), F.to_date(entity.time).alias("day"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
