"""Direct clean-up by age, with cascade to children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.entities import Entity
from ebbline.functions.expressions import ts_ntz


def boundary(source: DataFrame, entity: Entity, cutoff) -> DataFrame:
    """One row: the highest id older than the cut-off."""
    return source.where(F.col(entity.time) < ts_ntz(cutoff)).agg(F.max(entity.id).alias("boundary_id"))


def machine_boundary(source: DataFrame, entity: Entity, machine: str, cutoff) -> DataFrame:
    return (source.where(F.col(entity.time) < ts_ntz(cutoff)).groupBy(machine)
            .agg(F.max(entity.id).alias("boundary_id")))


def expired(entity: Entity, cutoff, below_id=None) -> Column:
    """``ts < cutoff AND id <= boundary``.

    The computed boundary is the highest id with ``ts < cutoff``, so it is implied by the
    time predicate and costs no scan; a boundary the caller gives is applied as well.
    """
    gone = F.col(entity.time) < ts_ntz(cutoff)
    if below_id is not None:
        gone = gone & (F.col(entity.id) <= F.lit(below_id))
    return gone


def removed(source: DataFrame, entity: Entity, cutoff, below_id=None) -> DataFrame:
    return source.where(expired(entity, cutoff, below_id))


def kept(source: DataFrame, entity: Entity, cutoff, below_id=None) -> DataFrame:
    return source.where(~F.coalesce(expired(entity, cutoff, below_id), F.lit(False)))


def kept_children(children: DataFrame, gone: DataFrame, parent_id: str, key: str) -> DataFrame:
    """Child rows whose parent stays."""
    return children.join(gone.select(F.col(key).alias(parent_id)), parent_id, "left_anti")


def removed_children(children: DataFrame, gone: DataFrame, parent_id: str, key: str) -> DataFrame:
    return children.join(gone.select(F.col(key).alias(parent_id)), parent_id, "left_semi")


def expired_levels(source: DataFrame, entity: Entity, tenants: DataFrame, max_level: Column, cutoff) -> DataFrame:
    """Rows of the listed tenants up to a level and older than the cut-off.

    Tenants are joined on their id; a tenant list is unique per id, so this is a semi join.
    """
    old = source.where((F.col(entity.time) < ts_ntz(cutoff)) & (F.col(entity.sub) <= max_level))
    ids = tenants.select(F.col("tenant_id").alias(entity.tenant)).where(F.col(entity.tenant).isNotNull())
    return old.join(ids, entity.tenant, "left_semi")


def preview(source: DataFrame, entity: Entity, cutoff, below_id=None) -> DataFrame:
    """Dry run: rows that would go, per day."""
    return (
        removed(source, entity, cutoff, below_id)
        .groupBy(F.to_date(entity.time).alias("day"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(entity.name).alias("entity"), "day", "row_count")
    )


def totals(source: DataFrame, entity: Entity, cutoff, below_id=None) -> DataFrame:
    """Rows removed and the last id among them."""
    return removed(source, entity, cutoff, below_id).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(entity.id).cast("string").alias("last_id"),
    ).select(F.lit(entity.name).alias("entity"), "row_count", "last_id")
