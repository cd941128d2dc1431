"""Archive execution queries."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import AUDIT_LOGS, JOBS, LICENCE_LOGS, LOGS, QUEUE_ITEMS
from ebbline.functions.expressions import EPOCH, ts_ntz
from ebbline.operators import archive as a
from ebbline.operators import rollup as r
from ebbline.operators import selection as s
from ebbline.operators.sizing import exact_slices
from ebbline.operators.sizing import id_slices as slices
from ebbline.plans import windows as w
from ebbline.plans.policy import compile_policies, expand_keywords
from ebbline.sources.archive_table import archive_range as range_copy
from ebbline.sources.archive_table import map_columns
from workload.fixtures import NOW_LOGS
from workload.registry import query

# The stand-in views have no single child id; these columns identify a child row in them.
QUEUE_CHILD_KEY = ("queue_item_id", "l_linenumber", "l_partkey", "l_suppkey")
EVENTS = replace(QUEUE_ITEMS.children[1], key=QUEUE_CHILD_KEY)
COMMENTS = replace(QUEUE_ITEMS.children[0], key=QUEUE_CHILD_KEY)
AUDITED = replace(AUDIT_LOGS.children[0], key=("audit_log_id", "l_linenumber", "entity_id", "l_suppkey"))

BATCH_NOW = "1999-01-01 00:00:00"

OPEN = """
    open_rows AS (
        SELECT g.trigger_id, x.group_id, x.tenant_id, x.sub_id, x.delete_only, g.delete_after = x.target_ts AS no_delay, x.previous_ts,
               x.target_ts, COALESCE(x.current_id, 0) AS current_id, x.target_id, t.trigger_time,
               ROW_NUMBER() OVER (PARTITION BY x.tenant_id, x.sub_id ORDER BY x.target_ts, x.group_id) AS order_no
        FROM $c_window_rows x JOIN $c_groups g ON g.group_id = x.group_id JOIN $c_triggers t ON t.trigger_id = g.trigger_id
        WHERE NOT x.is_archived AND NOT g.is_archived AND (x.target_id IS NULL OR x.current_id IS NULL OR x.current_id < x.target_id)
          AND NOT (t.is_archived OR t.is_finished OR t.is_dry_run OR t.is_error) AND t.trigger_time < @'1999-01-01 00:00:00'),
    batch AS (SELECT * FROM open_rows)"""

# generation 2 windows of the log fixture with their late marker; generation 1 is closed
LOG_SELECTED = """
    sel AS (
        SELECT l.*, x.group_id, CASE WHEN x.group_id < 20 THEN 1 ELSE 2 END AS trigger_id, x.delete_only, x.group_id = 20 AS no_delay,
               l.ts < x.previous_ts AS is_late
        FROM $logs l JOIN $log_windows x ON x.tenant_id = l.tenant_id AND x.sub_id = l.level_id AND NOT x.is_archived
        WHERE l.id <= (SELECT MAX(id) FROM $logs WHERE ts <= @'2024-01-21 00:00:00')
          AND ((l.ts >= x.previous_ts AND l.ts < x.target_ts)
               OR (l.ts < x.previous_ts AND l.id > (SELECT last_id FROM $log_cursor))))"""


def log_batch(t):
    """The open batch with its late markers, stored like a run stores it."""
    if "log_batch" not in t._stored:
        windows = t.store("log_windows")
        batch = s.open_windows(windows, t.log_groups, t.log_triggers, NOW_LOGS)
        t.store("log_batch", s.with_late_marker(batch, windows))
    return t._stored["log_batch"]


def log_selection(t):
    return s.select_rows(t.logs, log_batch(t), LOGS, watermark=log_watermark(t))


def log_watermark(t) -> int:
    return s.high_watermark(t.logs, LOGS, "2024-01-21 00:00:00").first()[0]


@query(f"""WITH {OPEN} SELECT trigger_id, group_id, tenant_id, sub_id, delete_only, no_delay, previous_ts, target_ts, current_id,
           target_id, order_no FROM batch""")
def open_windows(t):
    return s.open_windows(t.c_window_rows, t.c_groups, t.c_triggers, BATCH_NOW)


@query(f"""WITH {OPEN} SELECT trigger_id, trigger_id || '(' || COUNT(*) || ')' AS message FROM batch GROUP BY trigger_id""")
def batch_message(t):
    return r.batch_message(s.open_windows(t.c_window_rows, t.c_groups, t.c_triggers, BATCH_NOW))


@query("""
    SELECT 'logs' AS entity, greatest(MAX(id), 100) AS watermark FROM $logs WHERE ts <= @'2024-01-21 00:00:00'
    UNION ALL SELECT 'jobs', greatest(MAX(id), 100) FROM $jobs WHERE creation_time <= @'1998-01-01 00:00:00'
    UNION ALL SELECT 'queue_items', greatest(MAX(id), 100) FROM $queue_items
    UNION ALL SELECT 'audit_logs', greatest(MAX(id), 100) FROM $audit_logs WHERE execution_time <= @'1997-01-01 00:00:00'
    UNION ALL SELECT 'robot_license_logs', greatest(MAX(id), 100) FROM $robot_license_logs WHERE end_date <= @'2024-01-15 00:00:00'""")
def high_watermark(t):
    """Every archived entity, read from the source itself."""
    targets = ((LOGS, "2024-01-21 00:00:00"), (JOBS, "1998-01-01 00:00:00"), (QUEUE_ITEMS, "1998-01-01 00:00:00"),
               (AUDIT_LOGS, "1997-01-01 00:00:00"), (LICENCE_LOGS, "2024-01-15 00:00:00"))
    parts = [s.high_watermark(getattr(t, e.name), e, target, 100).select(F.lit(e.name).alias("entity"), "watermark") for e, target in targets]
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {OPEN}, marks AS (SELECT tenant_id, sub_id, MAX(target_id) AS m FROM $c_window_rows
        WHERE is_archived AND current_id = target_id GROUP BY tenant_id, sub_id)
    SELECT b.group_id, b.tenant_id, b.sub_id, b.order_no, CASE WHEN b.order_no = 1 THEN m.m END AS last_id
    FROM batch b LEFT JOIN marks m ON m.tenant_id = b.tenant_id AND m.sub_id = b.sub_id""")
def late_marker(t):
    windows = t.store("c_window_rows")
    batch = s.open_windows(windows, t.c_groups, t.c_triggers, BATCH_NOW)
    return s.with_late_marker(batch, windows).select("group_id", "tenant_id", "sub_id", "order_no", "last_id")


@query(f"WITH {LOG_SELECTED} SELECT id, tenant_id, level_id, ts, group_id, delete_only, no_delay, is_late FROM sel")
def select_logs(t):
    return log_selection(t).select("id", "tenant_id", "level_id", "ts", "group_id", "delete_only", "no_delay", "is_late")


@query(f"WITH {LOG_SELECTED} SELECT id, tenant_id, level_id, ts, group_id FROM sel WHERE is_late")
def select_late(t):
    return log_selection(t).where("is_late").select("id", "tenant_id", "level_id", "ts", "group_id")


@query("""SELECT j.id, j.tenant_id, j.state_id, x.group_id, x.delete_only, x.no_delay FROM $jobs j
    JOIN $job_windows x ON x.tenant_id = j.tenant_id AND x.sub_id = j.state_id
    WHERE j.creation_time > x.previous_ts AND j.creation_time <= x.target_ts""")
def select_jobs(t):
    return s.select_rows(t.jobs, t.job_windows, JOBS).select("id", "tenant_id", "state_id", "group_id", "delete_only", "no_delay")


QUEUE_SELECTED = """
    sel AS (SELECT q.*, x.group_id, x.delete_only, x.no_delay FROM $queue_items q
        JOIN $queue_windows x ON x.tenant_id = q.tenant_id AND x.sub_id = q.status_id
        WHERE q.creation_time >= x.previous_ts AND q.creation_time < x.target_ts)"""
AUDIT_SELECTED = """
    sel AS (SELECT q.*, x.group_id, x.delete_only, x.no_delay FROM $audit_logs q JOIN $audit_windows x ON x.tenant_id = q.tenant_id
        WHERE q.execution_time >= x.previous_ts AND q.execution_time < x.target_ts)"""


def queue_selection(t):
    return s.select_rows(t.queue_items, t.queue_windows, QUEUE_ITEMS)


def audit_selection(t):
    return s.select_rows(t.audit_logs, t.audit_windows, AUDIT_LOGS)


@query(f"WITH {QUEUE_SELECTED} SELECT id, tenant_id, status_id, group_id, delete_only, no_delay FROM sel")
def select_queues(t):
    return queue_selection(t).select("id", "tenant_id", "status_id", "group_id", "delete_only", "no_delay")


@query(f"WITH {AUDIT_SELECTED} SELECT id, tenant_id, group_id, delete_only, no_delay FROM sel")
def select_audit(t):
    return audit_selection(t).select("id", "tenant_id", "group_id", "delete_only", "no_delay")


@query("""SELECT q.id, q.tenant_id, x.group_id, x.no_delay FROM $robot_license_logs q JOIN $licence_windows x ON x.tenant_id = q.tenant_id
    WHERE q.end_date >= x.previous_ts AND q.end_date < x.target_ts""")
def select_licence(t):
    return s.select_rows(t.robot_license_logs, t.licence_windows, LICENCE_LOGS).select("id", "tenant_id", "group_id", "no_delay")


@query("""SELECT l.id, l.tenant_id, l.level_id, x.group_id, l.ts < x.previous_ts AS is_late FROM $hot_logs l
    JOIN $many_windows x ON x.tenant_id = l.tenant_id AND x.sub_id = l.level_id
    WHERE (l.ts >= x.previous_ts AND l.ts < x.target_ts) OR (l.ts < x.previous_ts AND l.id > x.last_id)""")
def select_logs_many(t):
    """As many windows as events, all on the tenant with a third of the rows, through the interval index."""
    return s.select_rows(t.hot_logs, t.many_windows, LOGS).select("id", "tenant_id", "level_id", "group_id", "is_late")


GENERATIONS = ((JOBS, "1998-01-01 00:00:00"), (AUDIT_LOGS, "1997-01-01 00:00:00"), (LICENCE_LOGS, "2024-01-15 00:00:00"))


def next_generation(t, entity, target: str):
    """Rows for the open windows of an entity, with marker, cursor and watermark that its closed windows left."""
    windows = getattr(t, f"{entity.name}_generations")
    batch = s.with_late_marker(windows.where(~F.col("is_archived")).withColumn("order_no", F.lit(1)), windows)
    rows = getattr(t, entity.name)
    reached = batch.agg(F.coalesce(F.max("target_id"), F.lit(0))).first()[0]
    return s.select_rows(rows, batch, entity, watermark=s.high_watermark(rows, entity, target, reached).first()[0])


def generation_sql(entity, target: str) -> str:
    """``id, tenant_id, sub_id, ts, group_id, trigger_id, delete_only, no_delay, is_late`` of one entity."""
    name, ts, low, high = entity.name, f"q.{entity.time}", (">" if entity.right_closed else ">="), ("<=" if entity.right_closed else "<")
    before = "<=" if entity.right_closed else "<"
    return f"""SELECT '{name}' AS entity, q.id, q.tenant_id, x.sub_id, {ts} AS ts, x.group_id, x.trigger_id, x.delete_only, x.no_delay, {ts} {before} x.previous_ts AS is_late
        FROM ${name} q JOIN ${name}_generations x ON x.tenant_id = q.tenant_id AND x.sub_id = {f'q.{entity.sub}' if entity.sub else '0'} AND NOT x.is_archived
        JOIN ${name}_generations c ON c.tenant_id = x.tenant_id AND c.sub_id = x.sub_id AND c.is_archived
        WHERE q.id <= (SELECT greatest(MAX(z.id), (SELECT MAX(y.target_id) FROM ${name}_generations y WHERE NOT y.is_archived), 0) FROM ${name} z WHERE z.{entity.time} <= @'{target}')
          AND q.id >= COALESCE(x.current_id, 0)
          AND (({ts} {low} x.previous_ts AND {ts} {high} x.target_ts) OR ({ts} {before} x.previous_ts AND q.id > c.target_id))"""


@query(" UNION ALL ".join(f"SELECT entity, id, tenant_id, group_id, delete_only, is_late FROM ({generation_sql(e, target)})" for e, target in GENERATIONS))
def select_resumed(t):
    """Jobs, audit and licence rows: late marker from closed windows, own cursor, watermark."""
    parts = [next_generation(t, e, target).select(F.lit(e.name).alias("entity"), "id", "tenant_id", "group_id", "delete_only", "is_late")
             for e, target in GENERATIONS]
    return reduce(DataFrame.unionByName, parts)


@query("""SELECT CAST((n - 1) // 700 AS BIGINT) AS slice_no, MIN(id) AS first_id, MAX(id) AS last_id, COUNT(*) AS row_count
    FROM (SELECT id, row_number() OVER (ORDER BY id) AS n FROM $logs) GROUP BY 1""")
def budget_slices(t):
    """Slices of exactly 700 rows, the last with the rest."""
    return exact_slices(t.logs, "id", 700, width=512)


@query("""SELECT CAST(floor(id / 1000) AS BIGINT) AS slice_no, MIN(id) AS first_id, MAX(id) AS last_id, COUNT(*) AS row_count
    FROM $logs GROUP BY 1""")
def id_slices(t):
    return slices(t.logs, "id", 1000)


@query(f"""WITH {LOG_SELECTED} SELECT id, tenant_id, level_id, ts, arrived_at, machine_id, message FROM sel
    WHERE NOT delete_only AND id NOT IN (SELECT id FROM $archive_logs)""")
def archive_rows(t):
    return a.archive_rows(log_selection(t), t.archive_logs, "id", s.WINDOW_TAGS)


CHILD_SQL = """SELECT c.{cols} FROM ${child} c WHERE c.{parent} IN (SELECT id FROM sel WHERE NOT delete_only)
    AND NOT EXISTS (SELECT 1 FROM ${child} z WHERE z.{parent} = c.{parent} AND z.l_linenumber = c.l_linenumber
                    AND z.{third} = c.{third} AND z.l_suppkey = c.l_suppkey AND z.l_suppkey % 7 = 0)"""


def child_archive(children):
    """What an earlier run copied already, for the idempotence check."""
    return children.where(F.col("l_suppkey") % 7 == 0)


@query(f"WITH {QUEUE_SELECTED} " + CHILD_SQL.format(cols="queue_item_id, c.l_linenumber, c.l_partkey, c.l_suppkey, c.ts",
                                                     child="queue_item_events", parent="queue_item_id", third="l_partkey"))
def archive_item_events(t):
    rows = t.queue_item_events
    return a.archive_children(queue_selection(t), rows, child_archive(rows), "id", EVENTS)


@query(f"WITH {QUEUE_SELECTED} " + CHILD_SQL.format(cols="queue_item_id, c.l_linenumber, c.l_partkey, c.l_suppkey, c.creation_time",
                                                     child="queue_item_comments", parent="queue_item_id", third="l_partkey"))
def archive_item_comments(t):
    rows = t.queue_item_comments
    return a.archive_children(queue_selection(t), rows, child_archive(rows), "id", COMMENTS)


@query(f"WITH {AUDIT_SELECTED} " + CHILD_SQL.format(cols="audit_log_id, c.l_linenumber, c.entity_id, c.l_suppkey",
                                                     child="audit_log_entities", parent="audit_log_id", third="entity_id"))
def archive_audit_entities(t):
    rows = t.audit_log_entities
    return a.archive_children(audit_selection(t), rows, child_archive(rows), "id", AUDITED)


@query(f"WITH {LOG_SELECTED} SELECT group_id, id FROM sel WHERE NOT no_delay AND id NOT IN (SELECT id FROM $archive_logs)")
def delete_ledger(t):
    listed = t.archive_logs.withColumn("group_id", F.lit(11))
    return a.delete_ledger(log_selection(t), listed, "id")


@query(f"""WITH {QUEUE_SELECTED}, gone AS (SELECT id FROM sel WHERE no_delay)
    SELECT 'queue_items' AS table_name, id, COUNT(*) AS row_count FROM $queue_items WHERE id NOT IN (SELECT id FROM gone) GROUP BY id
    UNION ALL SELECT 'queue_item_events', queue_item_id, COUNT(*) FROM $queue_item_events WHERE queue_item_id NOT IN (SELECT id FROM gone) GROUP BY 2
    UNION ALL SELECT 'queue_item_comments', queue_item_id, COUNT(*) FROM $queue_item_comments WHERE queue_item_id NOT IN (SELECT id FROM gone) GROUP BY 2""")
def survivors_immediate(t):
    gone = a.immediate_ids(queue_selection(t), "id")
    out = a.survivors(t.queue_items, gone, "id").groupBy("id").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("queue_items").alias("table_name"), "id", "row_count")
    for child in ("queue_item_events", "queue_item_comments"):
        kept = a.survivors(getattr(t, child), gone, "queue_item_id", "id")
        out = out.unionByName(kept.groupBy(F.col("queue_item_id").alias("id")).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(child).alias("table_name"), "id", "row_count"))
    return out


@query(f"""WITH {OPEN}, mark AS (SELECT MAX(id) AS m FROM $logs)
    SELECT x.group_id, x.tenant_id, x.sub_id, CASE WHEN b.group_id IS NOT NULL THEN (SELECT m FROM mark) ELSE x.current_id END AS current_id,
           CASE WHEN b.group_id IS NOT NULL THEN (SELECT m FROM mark) ELSE x.target_id END AS target_id,
           x.is_archived OR b.group_id IS NOT NULL AS is_archived
    FROM $c_window_rows x LEFT JOIN batch b ON b.group_id = x.group_id AND b.tenant_id = x.tenant_id AND b.sub_id = x.sub_id""")
def window_close(t):
    windows = t.store("c_window_rows")
    batch = s.open_windows(windows, t.c_groups, t.c_triggers, BATCH_NOW)
    watermark = t.logs.agg(F.max("id")).first()[0]
    return a.advance_windows(windows, batch, watermark).select(
        "group_id", "tenant_id", "sub_id", "current_id", "target_id", "is_archived")


@query(f"""WITH {OPEN}, mark AS (SELECT MAX(id) AS m, MIN(id) + 100 AS n FROM $logs)
    SELECT x.group_id, x.tenant_id, x.sub_id, CASE WHEN b.group_id IS NOT NULL THEN (SELECT n FROM mark) ELSE x.current_id END AS current_id,
           CASE WHEN b.group_id IS NOT NULL THEN (SELECT m FROM mark) ELSE x.target_id END AS target_id, x.is_archived
    FROM $c_window_rows x LEFT JOIN batch b ON b.group_id = x.group_id AND b.tenant_id = x.tenant_id AND b.sub_id = x.sub_id""")
def window_advance(t):
    """After a slice the windows of the batch stay open, with their cursor at the next id."""
    windows = t.store("c_window_rows")
    batch = s.open_windows(windows, t.c_groups, t.c_triggers, BATCH_NOW)
    reached, first = t.logs.agg(F.max("id"), F.min("id")).first()
    return a.advance_windows(windows, batch, reached, first + 100).select("group_id", "tenant_id", "sub_id", "current_id", "target_id", "is_archived")


@query("""
    SELECT g.group_id, g.trigger_id, true AS is_archived, COUNT(l.id) = 0 AS is_deleted, COUNT(l.id) = 0 AS is_synced,
           MIN(l.id) AS first_id, MAX(l.id) AS last_id, COUNT(l.id) AS id_count
    FROM $c_groups g LEFT JOIN $c_ledger l ON l.group_id = g.group_id
    WHERE g.group_id NOT IN (SELECT group_id FROM $c_window_rows WHERE NOT is_archived) GROUP BY g.group_id, g.trigger_id""")
def group_rollup(t):
    return r.group_rollup(t.c_groups, t.c_window_rows, t.c_ledger)


@query("""
    SELECT g.group_id, g.trigger_id, true AS is_archived, COUNT(l.id) = 0 AS is_deleted, COUNT(l.id) = 0 AS is_synced,
           MIN(l.id) AS first_id, MAX(l.id) AS last_id, COUNT(l.id) AS id_count
    FROM $c_groups g LEFT JOIN (SELECT * FROM $c_ledger WHERE id % 7 <> 3) l ON l.group_id = g.group_id
    WHERE g.group_id NOT IN (SELECT group_id FROM $c_window_rows WHERE NOT is_archived) GROUP BY g.group_id, g.trigger_id""")
def group_rollup_incremental(t):
    """Two runs add ledger rows, a third removes some: merged partials, and only groups that lost an edge are read again."""
    ledger = t.store("c_ledger")
    stored = t.store("partials_1", r.ledger_partials(ledger.where("id % 3 = 0")))
    stored = t.store("partials_2", r.merge_partials(stored, r.ledger_partials(ledger.where("id % 3 <> 0"))))
    left = r.partials_after_delete(stored, ledger.where("id % 7 = 3"), ledger.where("id % 7 <> 3"))
    return r.rollup_from_partials(t.c_groups, t.c_window_rows, left)


@query("""
    SELECT trigger_id, true AS is_archived, f AS is_finished, f AS is_deleted, f AS is_success,
           CASE WHEN f THEN 'purged' ELSE 'archived' END AS message
    FROM (SELECT trigger_id, NOT EXISTS (SELECT 1 FROM $c_groups z WHERE z.trigger_id = g.trigger_id AND NOT z.is_synced) AS f
          FROM (SELECT DISTINCT trigger_id FROM $c_groups) g
          WHERE NOT EXISTS (SELECT 1 FROM $c_groups z WHERE z.trigger_id = g.trigger_id AND NOT z.is_archived))""")
def trigger_rollup(t):
    return r.trigger_rollup(t.c_groups)


@query("""SELECT trigger_id, true AS is_finished, 'finished without windows' AS message FROM $c_triggers
    WHERE NOT (is_archived OR is_finished OR is_dry_run OR is_error) AND valid_windows = 0 AND target_ts <= @'1998-01-01 00:00:00'""")
def close_empty(t):
    return r.close_empty(t.c_triggers, "1998-01-01 00:00:00")


@query(f"""WITH {LOG_SELECTED} SELECT CAST(floor(id / 1000) AS BIGINT) AS slice_no, COUNT(*) AS row_count,
        COUNT(*) FILTER (WHERE NOT delete_only) AS archived, COUNT(*) FILTER (WHERE delete_only) AS delete_only_rows,
        COUNT(*) FILTER (WHERE no_delay) AS deleted_now, COUNT(*) FILTER (WHERE NOT no_delay) AS deleted_later
    FROM sel GROUP BY 1""")
def archive_metrics(t):
    rows = log_selection(t).withColumn("slice_no", F.floor(F.col("id") / 1000).cast("bigint"))
    return a.archive_metrics(rows, ["slice_no"])


@query("""
    WITH t AS (SELECT * FROM $c_triggers WHERE NOT (is_archived OR is_finished OR is_dry_run OR is_error))
    SELECT 'triggers' AS kind, COUNT(*) AS remaining, COUNT(*) FILTER (WHERE trigger_time < @'1999-01-01 00:00:00') AS outstanding,
           COUNT(*) FILTER (WHERE trigger_time >= @'1999-01-01 00:00:00') AS upcoming FROM t
    UNION ALL
    SELECT 'windows', COUNT(*), COUNT(*) FILTER (WHERE trigger_time < @'1999-01-01 00:00:00'),
           COUNT(*) FILTER (WHERE trigger_time >= @'1999-01-01 00:00:00')
    FROM $c_window_rows x JOIN $c_groups g ON g.group_id = x.group_id JOIN t ON t.trigger_id = g.trigger_id
    WHERE NOT x.is_archived AND NOT g.is_archived AND (x.target_id IS NULL OR x.current_id IS NULL OR x.current_id < x.target_id)""")
def remaining_work(t):
    return r.remaining_work(t.c_window_rows, t.c_groups, t.c_triggers, BATCH_NOW)


@query("""SELECT id AS log_id, tenant_id, level_id AS level, ts FROM $logs
    WHERE ts < @'2024-01-11 00:00:00' AND ts >= @'2024-01-03 00:00:00'""")
def archive_range(t):
    rows = range_copy(t.logs, "ts", "2024-01-11 00:00:00", "2024-01-03 00:00:00")
    return map_columns(rows, "id = log_id, level_id=level, [message]=, machine_id = , arrived_at=", "id", copy_key=True)


from workload.policy import policy_oracle  # noqa: E402  (shares the policy CTEs)


@query(policy_oracle("""
    SELECT s.policy_id, l.tenant_id, l.level_id, s.delete_only, COUNT(*) AS row_count
    FROM compiled s JOIN $logs l ON l.tenant_id = s.tenant_id AND l.level_id = s.sub_id
         AND l.ts < @'2024-01-31 00:00:00' - INTERVAL '1' HOUR * s.after_hours
    GROUP BY s.policy_id, l.tenant_id, l.level_id, s.delete_only""", "compiled"))
def flagship(t):
    """Policy documents -> settings -> windows -> rows to archive or delete, per tenant and level.

    All documents are compiled and every valid policy is put in force, one trigger each.
    """
    settings = compile_policies(
        expand_keywords(t.policies_raw).select("policy_id", "after_hours", "delay_hours", "doc"), t.tenants)
    trigger = settings.select("policy_id").distinct().select("policy_id", F.col("policy_id").alias("trigger_id"),
                                                             F.expr(f"timestamp_ntz'{NOW_LOGS}'").alias("trigger_time"))
    # Each policy on its own: none has an earlier window, so all of them begin in 1900.
    plan = w.plan_dates(settings.join(trigger, "policy_id")).withColumn("previous_ts", ts_ntz(EPOCH))
    windows = t.store("flagship_windows", plan.withColumn("group_id", F.lit(1)).withColumn("no_delay", F.lit(False)))
    # The windows of all policies lie on top of each other: a row is selected once, by the piece of time it lies in.
    pieces = t.store("flagship_pieces", s.window_pieces(windows, LOGS))
    chosen = s.select_rows(t.logs, pieces, LOGS)
    counts = s.count_by_window(chosen, pieces, windows, LOGS, ["trigger_id", "tenant_id", "sub_id", "delete_only"])
    return counts.select(F.col("trigger_id").alias("policy_id"), "tenant_id", F.col("sub_id").alias("level_id"), "delete_only", "row_count")
