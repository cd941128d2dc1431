"""Copy once, remember what to delete, delete now what has no delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import Child
from ebbline.operators.idsets import not_in


def archive_rows(selected: DataFrame, archived: DataFrame, key: str, tags: list[str]) -> DataFrame:
    """Selected rows to copy: delete-only rows and rows already archived are left out.

    The archive takes part as words of 64 ids, so its ids are not shuffled one by one.
    """
    return not_in(selected.where(~F.col("delete_only")).drop(*tags), key, archived)


def archive_children(selected: DataFrame, children: DataFrame, archived: DataFrame, parent_key: str,
                     child: Child) -> DataFrame:
    """Child rows of the copied parents that are not in the child archive yet.

    Parents are unique, so the semi join ships only their ids. A parent with very many
    children is a hot key on the child side only, which AQE splits for semi and anti joins.
    """
    parents = selected.where(~F.col("delete_only")).select(F.col(parent_key).alias(child.parent_id))
    return (children.join(parents, child.parent_id, "left_semi")
            .join(archived.select(*child.key), list(child.key), "left_anti"))


def delete_ledger(selected: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """``(group_id, id)`` of rows to delete later, not listed before."""
    delayed = selected.where(~F.col("no_delay")).select("group_id", F.col(key).alias("id"))
    return not_in(delayed, "id", ledger).select("group_id", "id")


def immediate_ids(selected: DataFrame, key: str, ignore_delay: bool = False) -> DataFrame:
    return selected.where(F.col("no_delay") | F.lit(ignore_delay)).select(key)


def survivors(rows: DataFrame, gone: DataFrame, key: str, gone_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``gone``; for parents and, by parent id, for children."""
    gone_key = gone_key or key
    return rows.join(gone.select(F.col(gone_key).alias(key)), key, "left_anti")


def archive_metrics(selected: DataFrame, by: list[str]) -> DataFrame:
    """Counts logged per slice and in total: copied, delete-only, deleted now, deleted later."""
    agg = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col("delete_only")).alias("archived"),
        F.count_if(F.col("delete_only")).alias("delete_only_rows"),
        F.count_if(F.col("no_delay")).alias("deleted_now"),
        F.count_if(~F.col("no_delay")).alias("deleted_later"),
    ]
    return selected.groupBy(*by).agg(*agg) if by else selected.agg(*agg)


def advance_windows(windows: DataFrame, batch: DataFrame, watermark: int, next_id: int | None = None) -> DataFrame:
    """Windows of the batch after a slice (cursor = next id) or, without one, closed at the watermark."""
    chosen = batch.select("group_id", "tenant_id", "sub_id", F.lit(True).alias("_chosen"))
    hit = F.coalesce(F.col("_chosen"), F.lit(False))
    closing = next_id is None
    cursor = F.lit(watermark if closing else next_id).cast("bigint")
    return (
        windows.join(chosen, ["group_id", "tenant_id", "sub_id"], "left")
        .withColumn("target_id", F.when(hit, F.lit(watermark).cast("bigint")).otherwise(F.col("target_id")))
        .withColumn("current_id", F.when(hit, cursor).otherwise(F.col("current_id")))
        .withColumn("is_archived", F.col("is_archived") | (hit & F.lit(closing)))
        .drop("_chosen")
    )
