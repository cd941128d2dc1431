"""Delayed purge queries on control tables derived from orders and lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.expressions import ts_ntz
from ebbline.operators import purge as p
from ebbline.operators.archive import survivors
from workload.archive import LOG_SELECTED, log_selection
from workload.registry import query

NOW = "1999-06-01 00:00:00"

DUE = """
    due AS (
        SELECT group_id, delete_after, first_id, last_id, id_count, is_deleted, is_synced FROM $c_groups
        WHERE id_count > 0 AND is_archived AND NOT is_deleted AND delete_after < @'1999-06-01 00:00:00'
        UNION
        SELECT g.group_id, g.delete_after, g.first_id, g.last_id, g.id_count, g.is_deleted, g.is_synced
        FROM $c_status s JOIN $c_groups g ON g.group_id = s.group_id WHERE s.is_deleted)"""
RESUME = DUE + """,
    resume AS (SELECT d.group_id, COALESCE(s.last_id + 1, s.first_id, d.first_id) AS resume_id, s.last_id AS reached_id FROM due d
        LEFT JOIN $c_status s ON s.group_id = d.group_id WHERE s.is_deleted IS NULL OR NOT s.is_deleted)"""


def due(t):
    return p.due_groups(t.c_groups, t.c_status, NOW)


def resume(t):
    return p.resume_point(due(t), t.c_status)


@query(f"WITH {DUE} SELECT * FROM due")
def due_groups(t):
    return due(t)


@query(f"WITH {RESUME} SELECT * FROM resume")
def resume_point(t):
    return resume(t)


def _purged(ledger: DataFrame, is_due, reached) -> DataFrame:
    """Ids of the ledger that a run deletes: groups made from the ledger, those not due yet dated after the run.

    Every other group has a status of a run that was cut short; ``reached`` is the last id it deleted, if any.
    """
    groups = ledger.groupBy("group_id").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("id_count")).select(
        "*", F.when(is_due, ts_ntz("1999-05-31 00:00:00")).otherwise(ts_ntz("1999-06-02 00:00:00")).alias("delete_after"),
        F.lit(True).alias("is_archived"), F.lit(False).alias("is_deleted"), F.lit(False).alias("is_synced"))
    status = groups.where(F.col("group_id") % 2 == 0).select(
        "group_id", F.lit(False).alias("is_deleted"), "first_id", reached.cast("bigint").alias("last_id"))
    return p.purge_ids(ledger, p.resume_point(p.due_groups(groups, status, NOW), status))


@query(f"""WITH {LOG_SELECTED},
    listed AS (SELECT tenant_id % 4 AS group_id, id FROM sel WHERE NOT no_delay),
    gone AS (SELECT l.id FROM listed l WHERE l.group_id < 3
             AND (l.group_id <> 2 OR l.id > (SELECT MIN(f.id) FROM listed f WHERE f.group_id = 2)))
    SELECT id, tenant_id, level_id, ts FROM $logs WHERE id NOT IN (SELECT id FROM gone)""")
def purge_logs(t):
    """Logs that stay after the due groups of their own ledger are deleted. Group 3 is not due, and a run
    that was cut short had deleted the first id of group 2."""
    ledger = log_selection(t).where("not no_delay").select((F.col("tenant_id") % 4).alias("group_id"), "id")
    gone = _purged(ledger, F.col("group_id") < 3, F.when(F.col("group_id") == 2, F.col("first_id")))
    return survivors(t.logs, gone, "id").select("id", "tenant_id", "level_id", "ts")


def _cascade(t, entity: str, children: list[tuple[str, str]]):
    """Survivors per table when the due groups of a ledger of the entity's rows are purged; counts per parent id."""
    ledger = getattr(t, entity).where(F.col("id") % 3 != 1).select((F.col("id") % 10).alias("group_id"), "id")
    # a run that was cut short had deleted the first id of group 2; group 4 was begun without deleting any
    gone = _purged(ledger, F.col("group_id") < 6, F.when(F.col("group_id") == 2, F.col("first_id")))
    tables = [(entity, "id")] + children
    parts = [
        survivors(getattr(t, name), gone, key, "id").groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "id", "row_count") for name, key in tables]
    return reduce(DataFrame.unionByName, parts)


def _cascade_sql(tables: list[tuple[str, str]], source: str = "$orders", key: str = "o_orderkey") -> str:
    listed = f"{key} % 3 <> 1 AND {key} % 10"
    gone = f"""SELECT {key} FROM {source} WHERE {listed} < 6
        AND NOT ({key} % 10 = 2 AND {key} <= (SELECT MIN({key}) FROM {source} WHERE {listed} = 2))"""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {key} AS id, COUNT(*) AS row_count FROM ${name} WHERE {key} NOT IN ({gone}) GROUP BY {key}"
        for name, key in tables)


@query(_cascade_sql([("queue_items", "id"), ("queue_item_events", "queue_item_id"), ("queue_item_comments", "queue_item_id")]))
def purge_queues(t):
    return _cascade(t, "queue_items", [("queue_item_events", "queue_item_id"), ("queue_item_comments", "queue_item_id")])


@query(_cascade_sql([("audit_logs", "id"), ("audit_log_entities", "audit_log_id")]))
def purge_audit(t):
    return _cascade(t, "audit_logs", [("audit_log_entities", "audit_log_id")])


@query(_cascade_sql([("jobs", "id")]))
def purge_jobs(t):
    return _cascade(t, "jobs", [])


@query(_cascade_sql([("robot_license_logs", "id")], "$events", "event_id"))
def purge_licence(t):
    return _cascade(t, "robot_license_logs", [])


@query(f"""WITH {RESUME}
    SELECT r.group_id, r.resume_id AS first_id, COALESCE(MAX(l.id), MAX(r.reached_id)) AS last_id, COUNT(l.id) AS purged, true AS is_deleted
    FROM resume r LEFT JOIN $c_ledger l ON l.group_id = r.group_id AND l.id >= r.resume_id GROUP BY r.group_id, r.resume_id""")
def purge_status(t):
    points = resume(t)
    return p.purge_status(points, p.purge_ids(t.c_ledger, points))


@query("""SELECT s.group_id, CASE WHEN g.is_synced THEN 'remove' ELSE 'skip' END AS action
    FROM $c_status s JOIN $c_groups g ON g.group_id = s.group_id WHERE s.is_deleted""")
def status_ack(t):
    return p.acknowledged_status(t.c_status, t.c_groups)


ACKED = """
    acked AS (SELECT s.group_id, g.trigger_id, s.deleted_on FROM $c_status s JOIN $c_groups g ON g.group_id = s.group_id
        WHERE s.is_deleted AND NOT g.is_synced)"""


@query(f"WITH {ACKED} SELECT * FROM acked")
def ack_groups(t):
    return p.ack_groups(t.c_status, t.c_groups)


@query(f"WITH {ACKED} SELECT group_id, id FROM $c_ledger WHERE group_id NOT IN (SELECT group_id FROM acked)")
def ledger_survivors(t):
    return p.ledger_survivors(t.c_ledger, p.ack_groups(t.c_status, t.c_groups))


@query(f"""WITH {ACKED}
    SELECT trigger_id, f AS is_finished, CASE WHEN f THEN d END AS deleted_on,
           CASE WHEN f THEN 'every group purged' ELSE 'groups left to purge' END AS message
    FROM (SELECT a.trigger_id, MAX(a.deleted_on) AS d, NOT EXISTS (SELECT 1 FROM $c_groups g WHERE g.trigger_id = a.trigger_id
                 AND NOT g.is_synced AND g.group_id NOT IN (SELECT group_id FROM acked)) AS f
          FROM acked a GROUP BY a.trigger_id)""")
def purge_finish(t):
    return p.purge_finish(t.c_groups, p.ack_groups(t.c_status, t.c_groups))
