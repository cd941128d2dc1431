"""Views over the given tables, as SQL text both engines read.

``$name`` stands for another view or a base table; ``@'...'`` is a zone-less timestamp.
Spark turns each view into a temp view, DuckDB gets the same text as CTEs.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations")

NOW_LOGS, NOW_ORDERS = "2024-01-31 00:00:00", "2001-08-02 00:00:00"

# Policy documents; %N is the customer's nation, %H hours derived from its key. The first
# ones are valid, each of the others breaks one rule of the grammar.
POLICY_TEMPLATES = [
    '[{"tenants": ["NATION_1*", 3], "exclude": "NATION_12", "after_hours": %H, "delete_delay_hours": 48, "levels": [{"archive": ["error", 3]}, {"delete": ["trace", "debug"], "after_hours": 120, "delete_delay_hours": 0}]}, {"tenants": "#DELETED_TENANTS#", "after_hours": 24, "delete_delay_hours": 0, "exclude": ["NATION_14", 19], "levels": [{"delete": "all"}]}, {"tenants": "#OTHER_TENANTS#", "after_hours": 480, "delete_delay_hours": 24, "levels": [{"archive": "all"}]}, {"tenants": "NATION_0", "disabled": true, "levels": [{"archive": "all"}]}]',
    '[{"tenants": "nation_%N", "after_hours": %H, "levels": [{"archive": "ALL"}]}]',
    '[{"tenants": %N, "levels": [{"archive": [0, 1, "Info"], "delete_delay_hours": 12}, {"delete": 5, "after_hours": 720}], "comment": "x", "comments": ["y"]}]',
    '[{"tenants": "#ACTIVE_TENANTS#", "exclude": ["NATION_2*", %N], "after_hours": %H, "levels": [{"archive": "fatal"}, {"archive": "error", "disabled": 1}]}]',
    '[{"tenants": ["*_%N"], "disable": 0, "levels": [{"delete": "warn", "disable": false}]}, {"tenants": "#OTHER_TENANTS#", "exclude": "*7", "levels": [{"archive": "all", "after_hours": 1}]}]',
    '[{"tenants": "NATION_%N", "disabled": true, "disabled": true, "after_hours": 5, "levels": [{"archive": "all"}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": "all"}]}, 5, "text", [1], null, true]',
    '[{"tenants": "NATION_%N", "level": 1, "levels": [{"archive": "all"}]}]',
    '[{"after_hours": %H}, {"tenants": "NATION_%N"}]',
    '[{"tenants": {"a": 1}, "levels": "all"}, {"tenants": null, "after_hours": "10", "delete_delay_hours": true, "disabled": "x", "levels": {}}]',
    '[{"tenants": "NATION_%N", "after_hours": 10, "after_hours": %H, "levels": [{"archive": "all"}]}]',
    '[{"tenants": [], "exclude": [], "levels": []}]',
    '[{"tenants": ["NATION_%N", true, null, {"a": 1}], "exclude": [[1]], "levels": [{"archive": "all"}, "x", 4]}]',
    '[{"tenants": ["NATION_77", "ZZ*", 99, "NATION_%N"], "levels": [{"archive": "all"}]}]',
    '[{"tenants": "#ACTIVE_TENANTS#", "levels": [{"archive": "all"}]}, {"tenants": ["#ACTIVE_TENANTS#"], "levels": [{"delete": 0}]}, {"tenants": ["#active_tenants#"], "levels": [{"delete": 1}]}]',
    '[{"tenants": ["NATION_%N", 4], "levels": [{"archive": "all"}]}, {"tenants": "#DELETED_TENANTS#", "levels": [{"archive": "all"}]}, {"tenants": "NATION_*", "levels": [{"archive": "all"}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": "all", "keep": 1}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"after_hours": %H}, {}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": {"a": 1}, "delete": true, "after_hours": "5", "disabled": 0}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": "warn", "archive": "error", "after_hours": 1, "after_hours": 2}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": [], "delete": "warn"}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": ["warn", null, true, {"a": [1]}]}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": ["verbose", 9, "warn"], "delete": -1}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": ["warn", 4]}, {"delete": [3, "error"]}, {"delete": "WARN"}]}]',
    '[{"tenants": "NATION_%N", "levels": [{"archive": "all"}, {"delete": ["trace", 1]}]}]',
    '{"tenants": "NATION_%N"}',
    'not json',
    '[]',
    '[{"tenants": "NATION_%N", "after_hours": 12, "delete_delay_hours": 6, "levels": [{"archive": ["trace", "debug", "info"]}, {"delete": ["warn"], "delete_delay_hours": 0}]}]',
    '[{"tenants": ["NATION_1_", "NATION_%N"], "exclude": ["*3", "NATION_%N"], "after_hours": 96, "levels": [{"archive": "all", "disabled": true}, {"archive": ["warn", "error"]}]}]',
    'ALL',
    '#deleted_tenants#',
    'active_tenants',
    '[{"tenants": ["NATION_%N", "*_1*"], "exclude": ["NATION_11"], "after_hours": %H, "delete_delay_hours": 24}, {"tenants": "#OTHER_TENANTS#", "after_hours": 30}]',
    '[{"tenants": "#DELETED_TENANTS#", "after_hours": %H, "exclude": "NATION_%N"}, {"tenants": "NATION_%N", "disabled": true}]',
    '[{"tenants": ["NATION_%N", 3], "after_hours": 10}, {"tenants": [3, "NATION_4"], "after_hours": 20, "keep": 1}]',
]


def _values(rows) -> str:
    return ", ".join(f"({i}, '{doc}')" for i, doc in enumerate(rows))


def _reworded(rule: str, names: tuple[str, ...]) -> str:
    """SQL for a document with another name of the sub-rules and other sub-keys in place of log levels."""
    sql = f"""REPLACE(doc, '"levels"', '"{rule}"')"""
    for old, new in zip(("trace", "debug", "info", "warn", "error"), names):
        sql = f"""REPLACE({sql}, '"{old}"', '"{new}"')"""
    return sql


VIEWS = {
    "tenants": "SELECT n_nationkey AS tenant_id, n_name AS name, (n_regionkey = 4) AS is_deleted FROM $nation",
    "tenants_active": "SELECT tenant_id, name, (tenant_id % 3 <> 0) AS is_active, is_deleted FROM $tenants",
    "logs": """
        SELECT event_id AS id, CAST(user_id % 25 AS INT) AS tenant_id,
               CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3
                    ELSE 4 END AS level_id,
               CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL '5' DAY ELSE ts END AS ts,
               ts AS arrived_at, user_id AS machine_id, props AS message
        FROM $events""",
    "queue_items": """
        SELECT o.o_orderkey AS id, c.c_nationkey AS tenant_id,
               CASE o.o_orderstatus WHEN 'P' THEN 2 WHEN 'F' THEN 3 ELSE 4 END AS status_id,
               o.o_orderdate AS creation_time
        FROM $orders o JOIN $customer c ON c.c_custkey = o.o_custkey""",
    "queue_item_events": """
        SELECT l_orderkey AS queue_item_id, l_linenumber, l_partkey, l_suppkey, l_shipdate AS ts FROM $lineitem""",
    "queue_item_comments": """
        SELECT l_orderkey AS queue_item_id, l_linenumber, l_partkey, l_suppkey, l_shipdate AS creation_time
        FROM $lineitem WHERE l_returnflag = 'R'""",
    "jobs": """
        SELECT o_orderkey AS id, CAST(o_custkey % 25 AS INT) AS tenant_id,
               CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) + 3 AS state_id, o_orderdate AS creation_time
        FROM $orders""",
    "audit_logs": """
        SELECT o_orderkey AS id, CAST(o_custkey % 25 AS INT) AS tenant_id, o_orderdate AS execution_time
        FROM $orders""",
    "audit_log_entities": """
        SELECT l_orderkey AS audit_log_id, l_linenumber, l_partkey AS entity_id, l_suppkey FROM $lineitem""",
    "robot_license_logs": """
        SELECT event_id AS id, CAST(user_id % 25 AS INT) AS tenant_id, ts AS start_date,
               ts + INTERVAL '1' MINUTE * CAST(FLOOR(value) AS INT) AS end_date
        FROM $events""",
    "ledger": "SELECT event_id AS ledger_id, ts AS creation_time FROM $events",
    "ledger_deliveries": "SELECT o_orderkey AS id, o_orderdate AS last_updated_time FROM $orders",
    "tenant_notifications": """
        SELECT md5(CAST(doc_id AS STRING)) AS id,
               @'2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(doc_id AS INT) AS creation_time
        FROM $documents""",
    "user_notifications": """
        SELECT doc_id AS id, md5(CAST(doc_id AS STRING)) AS tenant_notification_id FROM $labels""",
    "runs": """
        SELECT conv_id AS id, @'2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(conv_id AS INT) AS start_time,
               conv_id % 5 = 0 AS is_dry_run, conv_id % 11 <> 0 AS is_finished
        FROM $conversations GROUP BY conv_id""",
    "messages": """
        SELECT conv_id AS run_id, turn AS seq,
               CASE role WHEN 'system' THEN 16 WHEN 'assistant' THEN 10 ELSE 5 END AS severity, text AS message
        FROM $conversations""",
    "archive_logs": "SELECT event_id AS id FROM $events WHERE event_id % 7 = 0",
    # --- policies: one per customer --------------------------------------------------
    "policy_templates": f"SELECT * FROM (VALUES {_values(POLICY_TEMPLATES)}) AS t(template_id, template)",
    "policies_raw": f"""
        SELECT c.c_custkey AS policy_id, c.c_nationkey AS nation_id,
               CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE CAST(c.c_custkey % 240 + 24 AS INT) END AS after_hours,
               CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE CAST(c.c_custkey % 3 * 24 AS INT) END AS delay_hours,
               REPLACE(REPLACE(t.template, '%N', CAST(c.c_nationkey AS STRING)),
                       '%H', CAST(c.c_custkey % 500 AS STRING)) AS doc
        FROM $customer c JOIN $policy_templates t ON t.template_id = c.c_custkey % {len(POLICY_TEMPLATES)}""",
    "policies": """
        SELECT policy_id, after_hours, delay_hours,
               CASE UPPER(doc)
                 WHEN 'ALL' THEN '[{"tenants": "#ACTIVE_TENANTS#", "levels": [{"archive": "all"}]}, {"tenants": "#DELETED_TENANTS#", "levels": [{"archive": "all"}]}]'
                 WHEN 'ACTIVE_TENANTS' THEN '[{"tenants": "#ACTIVE_TENANTS#", "levels": [{"archive": "all"}]}]'
                 WHEN '#DELETED_TENANTS#' THEN '[{"tenants": "#DELETED_TENANTS#", "levels": [{"archive": "all"}]}]'
                 ELSE doc END AS doc
        FROM $policies_raw""",
    # the same documents in the words of the other entities
    **{f"policies_{name}": f"""
        SELECT policy_id, after_hours, delay_hours, {doc} AS doc
        FROM (SELECT r.policy_id, r.after_hours, r.delay_hours, CASE UPPER(r.doc)
                 WHEN 'ALL' THEN '[{{"tenants": "#ACTIVE_TENANTS#"{tail}}}, {{"tenants": "#DELETED_TENANTS#"{tail}}}]'
                 WHEN 'ACTIVE_TENANTS' THEN '[{{"tenants": "#ACTIVE_TENANTS#"{tail}}}]'
                 WHEN '#DELETED_TENANTS#' THEN '[{{"tenants": "#DELETED_TENANTS#"{tail}}}]' ELSE r.doc END AS doc FROM $policies_raw r)"""
       for name, doc, tail in (
           ("jobs", _reworded("states", ("faulted", "successful", "stopped", "suspended", "resumed")), ', "levels": [{"archive": "all"}]'),
           ("queues", _reworded("status", ("failed", "successful", "abandoned", "retried", "deleted")), ', "levels": [{"archive": "all"}]'),
           ("plain", "doc", ""))},
    # --- settings and stored windows for planning: one trigger per order -------------
    "trigger_settings": """
        SELECT l.l_orderkey AS trigger_id, o.o_orderdate AS trigger_time, CAST(l.l_suppkey % 25 AS INT) AS tenant_id,
               CAST(l.l_linenumber % 6 AS INT) AS sub_id, MIN(l.l_returnflag) = 'R' AS delete_only,
               CAST(MIN(l.l_quantity) AS INT) * 24 AS after_hours, CAST(MAX(l.l_linenumber) AS INT) * 12 AS delay_hours
        FROM $lineitem l JOIN $orders o ON o.o_orderkey = l.l_orderkey
        GROUP BY l.l_orderkey, o.o_orderdate, l.l_suppkey % 25, l.l_linenumber % 6""",
    "stored_windows": """
        SELECT CAST(l_suppkey % 25 AS INT) AS tenant_id, CAST(l_linenumber % 6 AS INT) AS sub_id,
               MIN(l_shipdate) AS target_ts
        FROM $lineitem WHERE l_suppkey % 4 = 1 GROUP BY l_suppkey % 25, l_linenumber % 6""",
    # --- control tables: one trigger per order, windows from its lines ---------------
    "c_triggers": """
        SELECT o_orderkey AS trigger_id, CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey - 4 END AS parent_id,
               o_orderdate AS trigger_time, o_orderdate - INTERVAL '1' DAY AS target_ts,
               o_orderkey % 4 = 0 AS repeats, CAST(o_orderkey % 5 * 24 + 24 AS INT) AS repeat_hours,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL '9' DAY END AS repeat_until,
               o_orderkey % 13 = 0 AS is_archived, o_orderkey % 26 = 0 AS is_finished, o_orderkey % 17 = 0 AS is_dry_run,
               o_orderkey % 19 = 0 AS is_error, CASE WHEN o_orderkey % 8 = 0 THEN 0 ELSE 3 END AS valid_windows,
               '[{"runid":"' || CAST(o_orderkey AS STRING) || '","message":"added","timestamp":"2001-01-01T00:00:00"}]' AS history,
               CAST(o_custkey % 7 AS BIGINT) AS window_count
        FROM $orders""",
    "chain_triggers": """
        SELECT trigger_id, CASE WHEN trigger_id % 40 > 1 THEN trigger_id - 1 WHEN trigger_id % 40 = 1 THEN 0 END AS parent_id, trigger_time,
               trigger_id % 40 < 20 OR trigger_id % 7 < 6 AS is_finished
        FROM $c_triggers""",
    "c_windows": """
        SELECT l_orderkey * 2 + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS group_id,
               CAST(l_suppkey % 25 AS INT) AS tenant_id, CAST(l_linenumber % 6 AS INT) AS sub_id,
               MIN(l_linestatus) = 'F' AS delete_only, MAX(l_shipdate) AS target_ts,
               MAX(l_shipdate) - INTERVAL '30' DAY AS previous_ts,
               (MIN(l_partkey) % 3 = 0) OR (l_orderkey % 5 = 0) AS is_archived,
               CASE WHEN MIN(l_partkey) % 4 = 0 THEN NULL ELSE MIN(l_partkey) END AS current_id,
               CASE WHEN MIN(l_partkey) % 3 = 0 THEN MIN(l_partkey) ELSE MIN(l_partkey) + 50 END AS target_id
        FROM $lineitem
        GROUP BY l_orderkey, l_returnflag, l_suppkey % 25, l_linenumber % 6""",
    "c_window_rows": """
        SELECT group_id, tenant_id, sub_id, BOOL_OR(delete_only) AS delete_only, MAX(target_ts) AS target_ts,
               MAX(previous_ts) AS previous_ts, BOOL_AND(is_archived) AS is_archived, MAX(current_id) AS current_id,
               MAX(target_id) AS target_id
        FROM $c_windows GROUP BY group_id, tenant_id, sub_id""",
    "c_ledger": """
        SELECT l_orderkey * 2 + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS group_id,
               CAST((l_orderkey * 1000 + l_linenumber) * 100000 + l_partkey AS BIGINT) AS id
        FROM $lineitem WHERE l_suppkey % 3 <> 0
        GROUP BY 1, 2""",
    "c_groups": """
        SELECT l.l_orderkey * 2 + CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS group_id, l.l_orderkey AS trigger_id,
               MAX(l.l_shipdate) + INTERVAL '1' DAY * CAST(l.l_orderkey % 3 AS INT) AS delete_after,
               l.l_orderkey % 3 <> 0 AS is_archived, l.l_orderkey % 6 = 1 AS is_deleted,
               (l.l_orderkey % 12 = 1) OR (l.l_orderkey % 7 = 1 AND MIN(l.l_partkey) % 2 = 0) AS is_synced,
               MIN((l.l_orderkey * 1000 + l.l_linenumber) * 100000 + l.l_partkey) AS first_id,
               MAX((l.l_orderkey * 1000 + l.l_linenumber) * 100000 + l.l_partkey) AS last_id,
               COUNT(*) AS id_count
        FROM $lineitem l
        GROUP BY l.l_orderkey, CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END""",
    "c_status": """
        SELECT group_id, group_id % 4 = 1 AS is_deleted,
               CASE WHEN group_id % 4 = 1 THEN delete_after + INTERVAL '1' DAY END AS deleted_on, first_id,
               CASE WHEN group_id % 3 = 0 THEN first_id + 100000 END AS last_id
        FROM $c_groups WHERE group_id % 5 <> 0""",
    # --- log windows of two generations (FIXTURES 4.2): one per tenant and level with rows
    "log_keys": "SELECT tenant_id, level_id AS sub_id FROM $logs GROUP BY tenant_id, level_id",
    "log_cursor": "SELECT MAX(id) AS last_id FROM $logs WHERE arrived_at <= @'2024-01-11 00:00:00'",
    "log_windows": """
        SELECT CASE WHEN tenant_id % 3 = 0 THEN 10 ELSE 11 END AS group_id, tenant_id, sub_id, sub_id = 0 AS delete_only,
               @'1900-01-01 00:00:00' AS previous_ts, @'2024-01-11 00:00:00' AS target_ts, true AS is_archived,
               (SELECT last_id FROM $log_cursor) AS current_id, (SELECT last_id FROM $log_cursor) AS target_id
        FROM $log_keys
        UNION ALL
        SELECT CASE WHEN tenant_id % 3 = 0 THEN 20 ELSE 21 END, tenant_id, sub_id, sub_id = 0, @'2024-01-11 00:00:00',
               @'2024-01-21 00:00:00', false, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
        FROM $log_keys""",
    "log_groups": """
        SELECT group_id, CASE WHEN group_id < 20 THEN 1 ELSE 2 END AS trigger_id,
               CASE WHEN group_id % 10 = 0 THEN MAX(target_ts) ELSE MAX(target_ts) + INTERVAL '48' HOUR END AS delete_after,
               BOOL_AND(is_archived) AS is_archived, false AS is_deleted, false AS is_synced,
               CAST(NULL AS BIGINT) AS first_id, CAST(NULL AS BIGINT) AS last_id, CAST(NULL AS BIGINT) AS id_count
        FROM $log_windows GROUP BY group_id""",
    "log_triggers": """
        SELECT trigger_id, MAX(CASE WHEN trigger_id = 1 THEN @'2024-01-11 00:00:00' ELSE @'2024-01-21 00:00:00' END) AS trigger_time,
               BOOL_AND(is_archived) AS is_archived, false AS is_finished, false AS is_dry_run, false AS is_error
        FROM $log_groups GROUP BY trigger_id""",
    # --- windows of the other entities: one per key with rows -------------------------
    "job_windows": """
        SELECT 1 AS trigger_id, 30 AS group_id, tenant_id, state_id AS sub_id, state_id = 6 AS delete_only,
               tenant_id % 2 = 0 AS no_delay, @'1996-01-01 00:00:00' AS previous_ts, @'1998-01-01 00:00:00' AS target_ts
        FROM $jobs GROUP BY tenant_id, state_id""",
    "queue_windows": """
        SELECT 1 AS trigger_id, 40 AS group_id, tenant_id, status_id AS sub_id, status_id = 4 AS delete_only,
               tenant_id % 2 = 0 AS no_delay, @'1996-01-01 00:00:00' AS previous_ts, @'1998-01-01 00:00:00' AS target_ts
        FROM $queue_items GROUP BY tenant_id, status_id""",
    "audit_windows": """
        SELECT 1 AS trigger_id, 50 AS group_id, tenant_id, 0 AS sub_id, tenant_id % 5 = 0 AS delete_only,
               tenant_id % 2 = 0 AS no_delay, @'1996-01-01 00:00:00' AS previous_ts, @'1997-01-01 00:00:00' AS target_ts
        FROM $audit_logs GROUP BY tenant_id""",
    "licence_windows": """
        SELECT 1 AS trigger_id, 60 AS group_id, tenant_id, 0 AS sub_id, false AS delete_only,
               tenant_id % 2 = 0 AS no_delay, @'2024-01-05 00:00:00' AS previous_ts, @'2024-01-15 00:00:00' AS target_ts
        FROM $robot_license_logs GROUP BY tenant_id""",
    # --- many windows on one tenant that holds a third of the logs ---------------------
    "hot_logs": """
        SELECT id, CASE WHEN id % 3 = 0 THEN 7 ELSE tenant_id END AS tenant_id, level_id, ts, message FROM $logs""",
    "many_windows": """
        SELECT 1 AS trigger_id, event_id AS group_id, 7 AS tenant_id, CAST(event_id % 5 AS INT) AS sub_id, false AS delete_only,
               false AS no_delay, @'2024-01-02 00:00:00' + INTERVAL '1' MINUTE * CAST(FLOOR(event_id / 5) * 25 AS INT) AS previous_ts,
               @'2024-01-02 00:00:00' + INTERVAL '1' MINUTE * CAST(FLOOR(event_id / 5) * 25 + 25 AS INT) AS target_ts,
               CASE WHEN event_id < 5 THEN CAST(2000 AS BIGINT) END AS last_id
        FROM $events""",
    # --- two generations of windows of the entities with a late branch: the closed one had reached the middle
    # of the ids of its key, of licence logs (whose ids follow time) the first sixteenth
    **{f"{name}_generations": f"""
        SELECT 1 AS trigger_id, {group} AS group_id, tenant_id, {sub} AS sub_id, tenant_id % 5 = 0 AS delete_only, tenant_id % 2 = 0 AS no_delay,
               @'1900-01-01 00:00:00' AS previous_ts, @'{previous}' AS target_ts, true AS is_archived,
               CAST(FLOOR(AVG(id) / {part}) AS BIGINT) AS current_id, CAST(FLOOR(AVG(id) / {part}) AS BIGINT) AS target_id
        FROM ${name} GROUP BY {by}
        UNION ALL
        SELECT 2, {group + 1}, tenant_id, {sub}, tenant_id % 5 = 0, tenant_id % 2 = 0, @'{previous}', @'{target}', false,
               CASE WHEN tenant_id % 4 = 0 THEN CAST(FLOOR(AVG(id) / 2) AS BIGINT) END, CASE WHEN tenant_id % 4 = 0 THEN MAX(id) - 10 END
        FROM ${name} GROUP BY {by}"""
       for name, sub, by, group, part, previous, target in (
           ("jobs", "state_id", "tenant_id, state_id", 70, 1, "1996-01-01 00:00:00", "1998-01-01 00:00:00"), ("audit_logs", "0", "tenant_id", 80, 1, "1996-01-01 00:00:00", "1997-01-01 00:00:00"),
           ("robot_license_logs", "0", "tenant_id", 90, 8, "2024-01-05 00:00:00", "2024-01-15 00:00:00"))},
    # --- request tables ---------------------------------------------------------------
    "cutoff_request_rows": """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_orderkey % 5 < 3 THEN CAST(o_orderkey % 50 - 2 AS INT) END AS hours_to_keep,
               CASE WHEN o_orderkey % 5 > 1 AND o_orderkey % 10 <> 9 THEN
                    CASE WHEN o_orderkey % 77 = 3 THEN @'1999-01-01 00:00:00' ELSE o_orderdate END END AS before_date
        FROM $orders""",
    "retention_request_rows": """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_orderkey % 4 IN (0, 3) THEN o_orderdate + INTERVAL '7' HOUR END AS retention_date,
               CASE WHEN o_orderkey % 4 IN (1, 3) THEN CAST(o_orderkey % 60 AS INT) END AS retention_days,
               CASE WHEN o_orderkey % 8 = 1 THEN CAST(o_orderkey % 30 AS INT) END AS retention_hours,
               o_orderkey % 3 = 0 AS round_to_day
        FROM $orders""",
    "guard_request_rows": """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderkey % 45 AS INT) END AS keep_days,
               CASE WHEN o_orderkey % 4 > 1 AND o_orderkey % 8 <> 7 THEN o_orderdate END AS keep_after,
               CASE o_orderkey % 6 WHEN 0 THEN 'force-day' WHEN 1 THEN 'force-week' WHEN 2 THEN 'force-month'
                    WHEN 3 THEN 'force-remove-all-days' END AS keyword
        FROM $orders""",
    "tenant_lists": """
        SELECT c_custkey AS list_id,
               CASE c_custkey % 8
                 WHEN 0 THEN 'nation_' || CAST(c_nationkey AS STRING) || ',  , -NATION_1%, unknown , #INACTIVE_TENANTS# '
                 WHEN 1 THEN '#ALL_TENANTS#, -#DELETED_TENANTS#, -nation_' || CAST(c_nationkey AS STRING)
                 WHEN 2 THEN 'NATION_2%,,#active_tenants#'
                 WHEN 3 THEN '#WRONG#, NATION_1'
                 WHEN 4 THEN ' NATION_' || CAST(c_nationkey AS STRING) || ' , other_' || CAST(c_custkey AS STRING)
                 WHEN 5 THEN '-NATION_3, NATION_3, NATION_4'
                 WHEN 6 THEN '%' || CAST(c_nationkey AS STRING) || ', #DELETED_TENANTS#'
                 ELSE ' , ,' END AS items
        FROM $customer""",
    "level_words": """
        SELECT event_id, CASE event_id % 9 WHEN 0 THEN ' Trace ' WHEN 1 THEN '1' WHEN 2 THEN 'INFO' WHEN 3 THEN 'warn'
               WHEN 4 THEN ' 4' WHEN 5 THEN 'fatal' WHEN 6 THEN '9' WHEN 7 THEN 'verbose' ELSE event_type END AS word
        FROM $events""",
}

_REF = re.compile(r"\$([a-z_]+)")
_TS = re.compile(r"@'([^']*)'")


def view(spark: SparkSession, sf_dir: str, name: str, stored: dict[str, DataFrame] | None = None) -> DataFrame:
    """A base table or a fixture view as a DataFrame; ``stored`` views are read instead of derived."""
    if stored and name in stored:
        return stored[name]
    if name in BASE:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    prefix = "w" + hashlib.md5(sf_dir.encode()).hexdigest()[:8]

    def ref(match: re.Match) -> str:
        inner = match.group(1)
        view(spark, sf_dir, inner, stored).createOrReplaceTempView(f"{prefix}_{inner}")
        return f"{prefix}_{inner}"

    return spark.sql(_TS.sub(r"timestamp_ntz'\1'", _REF.sub(ref, VIEWS[name])))


def oracle(sql: str) -> str:
    """DuckDB text: the used views become CTEs in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _REF.findall(text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    body = sql.strip()
    if ctes:
        own = re.sub(r"(?is)^WITH\s+(RECURSIVE\s+)?", ", ", body)
        body = f"WITH RECURSIVE {ctes}\n{own}"
    return _TS.sub(r"TIMESTAMP '\1'", _REF.sub(r"\1", body))


def as_logs(events: DataFrame) -> DataFrame:
    """The ``logs`` view over a given frame of events, static or streaming."""
    name = "w_stream_events"
    events.createOrReplaceTempView(name)
    return events.sparkSession.sql(_TS.sub(r"timestamp_ntz'\1'", VIEWS["logs"].replace("$events", name)))
