"""Run log and sizing reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import ARCHIVED, AUDIT_LOGS, JOBS, LICENCE_LOGS, LOGS, QUEUE_ITEMS
from ebbline.functions.expressions import name_part, yes_no
from ebbline.operators import reports as r
from ebbline.operators import selection as s
from workload.archive import LOG_SELECTED, QUEUE_SELECTED, audit_selection, log_selection, queue_selection, GENERATIONS, generation_sql, next_generation
from workload.registry import query

NOW, CURRENT_RUN = "2024-02-02 06:00:00", 3


@query("""SELECT run_id, seq, severity FROM $messages m WHERE severity >= 10 OR severity > 10
    OR EXISTS (SELECT 1 FROM $messages e WHERE e.run_id = m.run_id AND e.severity >= 16)""")
def messages_visible(t):
    return r.messages_visible(t.messages, 10).select("run_id", "seq", "severity")


@query("""SELECT run_id, messages, errors, CASE WHEN errors > 0 AND first_error = 0 THEN 3 WHEN errors > 0 THEN 4 WHEN NOT is_finished THEN 255
           WHEN is_dry_run THEN 1 ELSE 0 END AS status
    FROM (SELECT r.id AS run_id, ANY_VALUE(r.is_finished) AS is_finished, ANY_VALUE(r.is_dry_run) AS is_dry_run, COUNT(m.seq) AS messages,
                 COUNT(*) FILTER (WHERE m.severity >= 16) AS errors, MIN(CASE WHEN m.severity >= 16 THEN m.seq END) AS first_error
          FROM $runs r LEFT JOIN $messages m ON m.run_id = r.id GROUP BY r.id)""")
def run_status(t):
    return r.run_status(t.runs, t.messages)


@query("SELECT id, start_time FROM $runs WHERE start_time >= @'2024-02-02 06:00:00' - INTERVAL '30' DAY OR id = 3")
def run_retention(t):
    return r.run_retention(t.runs, NOW, CURRENT_RUN).select("id", "start_time")


@query("""SELECT run_id, seq FROM $messages WHERE run_id IN (
    SELECT id FROM $runs WHERE start_time >= @'2024-02-02 06:00:00' - INTERVAL '30' DAY OR id = 3)""")
def message_retention(t):
    kept = r.run_retention(t.runs, NOW, CURRENT_RUN)
    return r.message_retention(t.messages, kept).select("run_id", "seq")


@query("SELECT m.run_id, r.start_time, m.seq, m.severity, m.message FROM $messages m JOIN $runs r ON r.id = m.run_id")
def run_log(t):
    return r.run_log(t.runs, t.messages).select("run_id", "start_time", "seq", "severity", "message")


@query(" UNION ALL ".join(
    f"""SELECT '{e.name}' AS entity, {e.tenant} AS tenant_id, {e.sub or 0} AS sub_id, CAST(CAST({e.time} AS DATE) AS VARCHAR) AS day,
        COUNT(*) AS row_count, MIN({e.id}) AS first_id, MAX({e.id}) AS last_id FROM ${e.name} GROUP BY ALL""" for e in ARCHIVED))
def volume_profile(t):
    """Every archived entity."""
    parts = [r.volume_profile(getattr(t, e.name), e).withColumn("entity", F.lit(e.name)) for e in ARCHIVED]
    return reduce(DataFrame.unionByName, parts).withColumn("day", F.col("day").cast("string"))


@query("""SELECT tenant_id, COUNT(*) AS sessions, CAST(SUM(m) AS BIGINT) AS total_minutes, ROUND(SUM(m) / COUNT(*), 4) AS mean_minutes,
           MIN(start_date) AS first_start, MAX(end_date) AS last_end
    FROM (SELECT *, CAST(floor((epoch(end_date) - epoch(start_date)) / 60) AS BIGINT) AS m FROM $robot_license_logs) GROUP BY tenant_id""")
def duration_stats(t):
    return r.duration_stats(t.robot_license_logs, "tenant_id", "start_date", "end_date")


@query("""SELECT DISTINCT n.name AS tenant, s.start_date, s.end_date FROM $robot_license_logs s JOIN $tenants n ON n.tenant_id = s.tenant_id""")
def session_detail(t):
    return r.session_detail(t.robot_license_logs, t.tenants)


@query("""
    SELECT 'levels' AS section, 1 AS section_rank, CAST(level_id AS STRING) AS item, COUNT(*) AS value FROM $logs GROUP BY level_id
    UNION ALL SELECT 'states', 2, CAST(state_id AS STRING), COUNT(*) FROM $jobs GROUP BY state_id
    UNION ALL SELECT 'notes', 99, lang, COUNT(*) FROM $documents GROUP BY lang""")
def report_sections(t):
    count = F.count(F.lit(1)).alias("value")
    return r.report_sections(
        {"notes": t.documents.groupBy(F.col("lang").alias("item")).agg(count),
         "states": t.jobs.groupBy(F.col("state_id").alias("item")).agg(count),
         "levels": t.logs.groupBy(F.col("level_id").alias("item")).agg(count)},
        {"levels": 1, "states": 2})


@query(f"""WITH {LOG_SELECTED.replace('sel AS', 'sel_logs AS')}, {QUEUE_SELECTED.replace('sel AS', 'sel_queues AS')}
    SELECT 'logs' AS table_name, trigger_id, COUNT(*) FILTER (WHERE NOT delete_only) AS inserted,
           COUNT(*) FILTER (WHERE no_delay) AS deleted FROM sel_logs GROUP BY trigger_id
    UNION ALL SELECT 'queue_items', 1, COUNT(*) FILTER (WHERE NOT delete_only), COUNT(*) FILTER (WHERE no_delay) FROM sel_queues HAVING COUNT(*) > 0
    UNION ALL SELECT 'jobs', x.trigger_id, COUNT(*) FILTER (WHERE NOT x.delete_only), COUNT(*) FILTER (WHERE x.no_delay)
        FROM $jobs j JOIN $job_windows x ON x.tenant_id = j.tenant_id AND x.sub_id = j.state_id
        WHERE j.creation_time > x.previous_ts AND j.creation_time <= x.target_ts GROUP BY x.trigger_id
    UNION ALL SELECT 'audit_logs', x.trigger_id, COUNT(*) FILTER (WHERE NOT x.delete_only), COUNT(*) FILTER (WHERE x.no_delay)
        FROM $audit_logs a JOIN $audit_windows x ON x.tenant_id = a.tenant_id
        WHERE a.execution_time >= x.previous_ts AND a.execution_time < x.target_ts GROUP BY x.trigger_id
    UNION ALL SELECT 'robot_license_logs', x.trigger_id, COUNT(*) FILTER (WHERE NOT x.delete_only), COUNT(*) FILTER (WHERE x.no_delay)
        FROM $robot_license_logs a JOIN $licence_windows x ON x.tenant_id = a.tenant_id
        WHERE a.end_date >= x.previous_ts AND a.end_date < x.target_ts GROUP BY x.trigger_id""")
def change_volume(t):
    """Every archived entity."""
    return r.change_volume({"logs": log_selection(t), "queue_items": queue_selection(t), "audit_logs": audit_selection(t),
                            "jobs": s.select_rows(t.jobs, t.job_windows, JOBS),
                            "robot_license_logs": s.select_rows(t.robot_license_logs, t.licence_windows, LICENCE_LOGS)})


@query(f"""WITH {LOG_SELECTED} SELECT 'logs' AS entity, tenant_id, level_id AS sub_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS row_count
    FROM sel WHERE is_late GROUP BY ALL UNION ALL """ + " UNION ALL ".join(
    f"SELECT entity, tenant_id, sub_id, CAST(CAST(ts AS DATE) AS VARCHAR), COUNT(*) FROM ({generation_sql(e, target)}) WHERE is_late GROUP BY ALL"
    for e, target in GENERATIONS))
def late_rows(t):
    """Every entity with a late branch; what is late follows from the windows closed before."""
    parts = [r.late_rows(log_selection(t), LOGS).withColumn("entity", F.lit(LOGS.name))]
    parts += [r.late_rows(next_generation(t, e, target), e).withColumn("entity", F.lit(e.name)) for e, target in GENERATIONS]
    return reduce(DataFrame.unionByName, parts).withColumn("day", F.col("day").cast("string"))


@query("""
    SELECT event_id, list_extract(parts, -1) AS object, list_extract(parts, -2) AS schema, list_extract(parts, -3) AS database, list_extract(parts, -4) AS server
    FROM (SELECT event_id, string_split(CASE event_id % 3 WHEN 0 THEN 'srv.db.' WHEN 1 THEN 'db.' ELSE '' END || event_type || '.t' || event_id, '.') AS parts FROM $events)""")
def name_parts(t):
    head = F.when(F.col("event_id") % 3 == 0, "srv.db.").when(F.col("event_id") % 3 == 1, "db.").otherwise("")
    name = F.concat(head, "event_type", F.lit(".t"), F.col("event_id").cast("string"))
    return t.events.select("event_id", *[name_part(name, i).alias(n) for i, n in enumerate(("object", "schema", "database", "server"), 1)])


@query("""
    SELECT event_id, CASE WHEN upper(trim(word)) IN ('YES', 'Y', '1') THEN true WHEN upper(trim(word)) IN ('NO', 'N', '0') THEN false END AS flag
    FROM (SELECT event_id, list_extract([' yes', 'Y', '1 ', 'No', 'n', '0', 'maybe', event_type], CAST(event_id % 8 AS INT) + 1) AS word FROM $events)""")
def yes_no_flags(t):
    words = F.array(*[F.lit(w) for w in (" yes", "Y", "1 ", "No", "n", "0", "maybe")], F.col("event_type"))
    return t.events.select("event_id", yes_no(F.element_at(words, (F.col("event_id") % 8 + 1).cast("int"))).alias("flag"))
