"""Direct clean-up queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import LEDGER, LEDGER_DELIVERIES, LOGS, NOTIFICATIONS, QUEUE_ITEMS
from ebbline.operators import cleanup as c
from ebbline.plans.jobs import SOURCE, Store, cleanup_run
from ebbline.plans.policy import split_tenant_list
from ebbline.session import work_dir
from ebbline.sources.store import read_run
from ebbline.functions.lookups import level_id
from workload.registry import query

LOG_CUTOFF, ORDER_CUTOFF, NOTE_CUTOFF = "2024-01-21 00:00:00", "1998-06-01 00:00:00", "2024-01-25 00:00:00"

CUTOFFS = (
    (LOGS, "logs", LOG_CUTOFF), (QUEUE_ITEMS, "queue_items", ORDER_CUTOFF), (LEDGER, "ledger", LOG_CUTOFF),
    (LEDGER_DELIVERIES, "ledger_deliveries", ORDER_CUTOFF), (NOTIFICATIONS, "tenant_notifications", NOTE_CUTOFF),
)


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


def _per_entity_sql(select: str) -> str:
    return " UNION ALL ".join(
        select.format(name=name, view=name, id=entity.id, time=entity.time, cutoff=cutoff)
        for entity, name, cutoff in CUTOFFS)


@query("""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) FILTER (WHERE gone) AS removed, COUNT(*) FILTER (WHERE NOT gone) AS kept
    FROM (SELECT ts, ts < @'2024-01-21 00:00:00'
                 AND id <= (SELECT MAX(id) FROM $logs WHERE ts < @'2024-01-21 00:00:00') AS gone FROM $logs)
    GROUP BY 1""")
def cleanup_summary(t):
    """What goes and what stays with 240 hours to keep at 2024-01-31."""
    gone = c.expired(LOGS, LOG_CUTOFF)
    return t.logs.groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        F.count_if(gone).alias("removed"), F.count_if(~gone).alias("kept"))


@query(_per_entity_sql("SELECT '{name}' AS entity, CAST(MAX({id}) AS VARCHAR) AS boundary_id FROM ${view} WHERE {time} < @'{cutoff}'"))
def cleanup_boundary(t):
    return _union([
        c.boundary(getattr(t, name), entity, cutoff).select(
            F.lit(name).alias("entity"), F.col("boundary_id").cast("string").alias("boundary_id"))
        for entity, name, cutoff in CUTOFFS])


@query("SELECT machine_id, MAX(id) AS boundary_id FROM $logs WHERE ts < @'2024-01-21 00:00:00' GROUP BY machine_id")
def machine_boundary(t):
    return c.machine_boundary(t.logs, LOGS, "machine_id", LOG_CUTOFF)


@query("""
    SELECT id, tenant_id, level_id, ts FROM $logs
    WHERE NOT (ts < @'2024-01-21 00:00:00' AND id <= (SELECT MAX(id) FROM $logs WHERE ts < @'2024-01-21 00:00:00'))""")
def cleanup_logs(t):
    return c.kept(t.logs, LOGS, LOG_CUTOFF).select("id", "tenant_id", "level_id", "ts")


@query("""
    SELECT id, tenant_id, level_id, ts FROM $logs
    WHERE NOT (ts < @'2024-01-21 00:00:00' AND id <= 500)""")
def cleanup_logs_below_id(t):
    """With a boundary given by the caller."""
    return c.kept(t.logs, LOGS, LOG_CUTOFF, below_id=500).select("id", "tenant_id", "level_id", "ts")


@query("""
    WITH gone AS (
        SELECT id FROM $queue_items WHERE creation_time < @'1998-06-01 00:00:00'
        AND id <= (SELECT MAX(id) FROM $queue_items WHERE creation_time < @'1998-06-01 00:00:00'))
    SELECT 'queue_items' AS table_name, id, CAST(NULL AS INT) AS line_no, CAST(NULL AS BIGINT) AS part_key,
           CAST(NULL AS BIGINT) AS supp_key
    FROM $queue_items WHERE id NOT IN (SELECT id FROM gone)
    UNION ALL SELECT 'queue_item_events', queue_item_id, l_linenumber, l_partkey, l_suppkey
    FROM $queue_item_events WHERE queue_item_id NOT IN (SELECT id FROM gone)
    UNION ALL SELECT 'queue_item_comments', queue_item_id, l_linenumber, l_partkey, l_suppkey
    FROM $queue_item_comments WHERE queue_item_id NOT IN (SELECT id FROM gone)""")
def cleanup_queues(t):
    """Items and, explicitly, their children."""
    items = t.queue_items
    gone = c.removed(items, QUEUE_ITEMS, ORDER_CUTOFF)
    parts = [c.kept(items, QUEUE_ITEMS, ORDER_CUTOFF).select(
        F.lit("queue_items").alias("table_name"), "id", F.lit(None).cast("int").alias("line_no"),
        F.lit(None).cast("bigint").alias("part_key"), F.lit(None).cast("bigint").alias("supp_key"))]
    for child in ("queue_item_events", "queue_item_comments"):
        parts.append(c.kept_children(getattr(t, child), gone, "queue_item_id", "id").select(
            F.lit(child).alias("table_name"), F.col("queue_item_id").alias("id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key")))
    return _union(parts)


@query("""
    SELECT ledger_id, creation_time FROM $ledger WHERE NOT (creation_time < @'2024-01-21 00:00:00'
    AND ledger_id <= (SELECT MAX(ledger_id) FROM $ledger WHERE creation_time < @'2024-01-21 00:00:00'))""")
def cleanup_ledger(t):
    return c.kept(t.ledger, LEDGER, LOG_CUTOFF)


@query("""
    SELECT id, last_updated_time FROM $ledger_deliveries WHERE NOT (last_updated_time < @'1998-06-01 00:00:00'
    AND id <= (SELECT MAX(id) FROM $ledger_deliveries WHERE last_updated_time < @'1998-06-01 00:00:00'))""")
def cleanup_deliveries(t):
    return c.kept(t.ledger_deliveries, LEDGER_DELIVERIES, ORDER_CUTOFF)


@query("""
    WITH gone AS (
        SELECT id FROM $tenant_notifications WHERE creation_time < @'2024-01-25 00:00:00'
        AND id <= (SELECT MAX(id) FROM $tenant_notifications WHERE creation_time < @'2024-01-25 00:00:00'))
    SELECT 'tenant_notifications' AS table_name, id FROM $tenant_notifications WHERE id NOT IN (SELECT id FROM gone)
    UNION ALL SELECT 'user_notifications', CAST(id AS VARCHAR) FROM $user_notifications
    WHERE tenant_notification_id NOT IN (SELECT id FROM gone)""")
def cleanup_notifications(t):
    notes = t.tenant_notifications
    gone = c.removed(notes, NOTIFICATIONS, NOTE_CUTOFF)
    kept = c.kept(notes, NOTIFICATIONS, NOTE_CUTOFF).select(F.lit("tenant_notifications").alias("table_name"), "id")
    users = c.kept_children(t.user_notifications, gone, "tenant_notification_id", "id").select(
        F.lit("user_notifications").alias("table_name"), F.col("id").cast("string").alias("id"))
    return kept.unionByName(users)


@query("""
    SELECT id, tenant_id, level_id FROM $logs
    WHERE ts < @'2024-01-16 00:00:00' AND level_id <= 2
      AND (tenant_id IN (SELECT tenant_id FROM $tenants_active WHERE name LIKE 'NATION_1%' AND name NOT LIKE 'NATION_12')
           OR tenant_id IN (SELECT tenant_id FROM $tenants_active WHERE NOT is_active AND name NOT LIKE 'NATION_12'))""")
def cleanup_level(t):
    """Rows to delete by tenant list, highest level and the guarded date (15 days kept, keyword given)."""
    spark = t.spark
    lists = spark.createDataFrame([(1, "NATION_1%, #INACTIVE_TENANTS#, -NATION_12")], "list_id bigint, items string")
    chosen = split_tenant_list(lists, t.tenants_active)
    return c.expired_levels(t.logs, LOGS, chosen, level_id(F.lit("Info")), "2024-01-16 00:00:00").select("id", "tenant_id", "level_id")


@query(_per_entity_sql(
    "SELECT '{name}' AS entity, CAST(CAST({time} AS DATE) AS VARCHAR) AS day, COUNT(*) AS row_count FROM ${view} WHERE {time} < @'{cutoff}' GROUP BY 2"))
def cleanup_preview(t):
    days = _union([c.preview(getattr(t, name), entity, cutoff) for entity, name, cutoff in CUTOFFS])
    return days.withColumn("day", F.col("day").cast("string"))


@query(_per_entity_sql(
    "SELECT '{name}' AS entity, COUNT(*) AS row_count, CAST(MAX({id}) AS VARCHAR) AS last_id FROM ${view} WHERE {time} < @'{cutoff}'"))
def cleanup_totals(t):
    return _union([c.totals(getattr(t, name), entity, cutoff) for entity, name, cutoff in CUTOFFS])


def _cleanup_run(entity, name, cutoff):
    """The clean-up of one entity as a run on storage: what source and child tables hold after it, and what its log says."""
    gone = f"(SELECT {entity.id} FROM ${name} WHERE {entity.time} < @'{cutoff}')"
    parts = [f"SELECT '{name}' AS table_name, CAST({entity.id} AS VARCHAR) AS id FROM ${name} WHERE {entity.id} NOT IN {gone}"]
    parts += [f"SELECT '{c.name}', CAST({c.parent_id} AS VARCHAR) FROM ${c.name} WHERE {c.parent_id} NOT IN {gone}" for c in entity.children]
    parts.append(f"SELECT 'log', COUNT(*) || ' ' || MAX({entity.id}) FROM ${name} WHERE {entity.time} < @'{cutoff}'")

    def run(t):
        store = Store(t.spark, work_dir(t.spark, f"cleanup-{name}"), entity, period="month")
        store.create(getattr(t, name), "0", {c.name: getattr(t, c.name) for c in entity.children})
        cleanup_run(store, "0", "1", cutoff, cutoff)
        keys = {SOURCE: (name, entity.id), **{c.name: (c.name, c.parent_id) for c in entity.children}}
        log = read_run(t.spark, store.root, "messages", "1").where("seq = 1").select(
            F.lit("log").alias("table_name"), F.regexp_replace("message", r".*: ([0-9]+) \(last id (.*)\)", "$1 $2").alias("id"))
        return _union([store.rows(table, "1").select(F.lit(label).alias("table_name"), F.col(key).cast("string").alias("id"))
                       for table, (label, key) in keys.items()] + [log])

    run.__name__ = f"cleanup_run_{name}"
    return query(" UNION ALL ".join(parts))(run)


for _entity, _name, _cutoff in CUTOFFS:
    _cleanup_run(_entity, _name, _cutoff)
