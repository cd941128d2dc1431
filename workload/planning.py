"""Window planning and request queries; triggers and requests come one per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.entities import LOGS
from ebbline.operators.selection import select_rows
from ebbline.plans import requests as rq
from ebbline.plans import windows as w
from ebbline.plans.policy import compile_policies, expand_keywords
from workload.fixtures import NOW_LOGS, NOW_ORDERS
from workload.policy import compiler, policy_oracle
from workload.registry import query

PLANNED = """
    planned AS (SELECT s.*, trigger_time - INTERVAL '1' HOUR * after_hours AS target_ts,
                trigger_time - INTERVAL '1' HOUR * after_hours + INTERVAL '1' HOUR * delay_hours AS delete_after
                FROM $trigger_settings s)"""
# one trigger after the other: earlier triggers and stored windows count as existing
CHAINED = PLANNED + """,
    chained AS (SELECT p.*, greatest(
            MAX(p.target_ts) OVER (PARTITION BY tenant_id, sub_id ORDER BY trigger_id RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            s.target_ts) AS last_target
        FROM planned p LEFT JOIN $stored_windows s USING (tenant_id, sub_id)),
    checked AS (SELECT *, last_target IS NULL OR last_target < target_ts AS is_valid FROM chained)"""
CHAINED = CHAINED.replace("s.target_ts) AS last_target", "s.stored_ts) AS last_target").replace(
    "LEFT JOIN $stored_windows s USING", "LEFT JOIN (SELECT tenant_id, sub_id, target_ts AS stored_ts FROM $stored_windows) s USING")


def planned(t):
    return w.plan_dates(t.trigger_settings)


@query("""SELECT request_id, hours_to_keep, before_date,
        CASE WHEN e IS NULL THEN CASE WHEN hours_to_keep IS NULL THEN before_date
             ELSE @'2001-08-02 00:00:00' - INTERVAL '1' HOUR * abs(hours_to_keep) END END AS cutoff, e AS error
    FROM (SELECT *, CASE WHEN hours_to_keep IS NOT NULL AND before_date IS NOT NULL THEN 'both given'
             WHEN hours_to_keep IS NULL AND before_date IS NULL THEN 'none given' WHEN hours_to_keep < 1 THEN 'hours below 1'
             WHEN before_date > @'2001-08-02 00:00:00' THEN 'date in the future'
             WHEN NOT COALESCE(hours_to_keep > 1, false) AND NOT COALESCE(before_date < @'2001-08-02 00:00:00', false)
             THEN 'boundary cannot be set' END AS e FROM $cutoff_request_rows)""")
def cutoff_requests(t):
    return rq.cutoff_requests(t.cutoff_request_rows, NOW_ORDERS)


@query("""SELECT request_id, retention_date, retention_days, retention_hours, round_to_day, e AS error,
        CASE WHEN e IS NULL THEN
            CASE WHEN round_to_day THEN CAST(CAST(COALESCE(retention_date, @'2001-08-02 00:00:00') AS DATE) AS TIMESTAMP)
                 ELSE COALESCE(retention_date, @'2001-08-02 00:00:00') END
            - INTERVAL '1' DAY * COALESCE(retention_days, 0) - INTERVAL '1' HOUR * COALESCE(retention_hours, 0) END AS trigger_time
    FROM (SELECT *, CASE WHEN retention_date IS NULL AND retention_days IS NULL AND retention_hours IS NULL THEN 'none given'
             WHEN retention_date IS NOT NULL AND (retention_days IS NOT NULL OR retention_hours IS NOT NULL) THEN 'both given'
             WHEN retention_date > @'2001-08-02 00:00:00' THEN 'date in the future' END AS e FROM $retention_request_rows)""")
def simple_retention_date(t):
    return rq.simple_retention_date(t.retention_request_rows, NOW_ORDERS)


@query("""
    WITH bands AS (SELECT past, word, COALESCE(LAG(past) OVER (ORDER BY past) + 1, past) AS lo FROM (VALUES
            (30, 'force-month'), (7, 'force-week'), (1, 'force-day'), (0, 'force-remove-all-days')) b(past, word)),
    limits AS (SELECT r.*, CASE WHEN keep_days IS NULL THEN keep_after
                WHEN keep_after > @'2001-08-02 00:00:00' - INTERVAL '1' DAY * keep_days THEN keep_after
                ELSE @'2001-08-02 00:00:00' - INTERVAL '1' DAY * keep_days END AS purge_before FROM $guard_request_rows r)
    SELECT l.request_id, l.keep_days, l.keep_after, l.keyword, l.purge_before, b.word AS needed_keyword,
           CASE WHEN purge_before IS NULL THEN 'none given' WHEN purge_before > @'2001-08-02 00:00:00' THEN 'date in the future'
                WHEN b.word IS NOT NULL AND (keyword IS NULL OR keyword <> b.word) THEN 'keyword needed' END AS error
    FROM limits l LEFT JOIN bands b ON date_diff('day', l.purge_before, @'2001-08-02 00:00:00') BETWEEN b.lo AND b.past""")
def purge_date_guard(t):
    return rq.purge_date_guard(t.guard_request_rows, NOW_ORDERS)


@query(f"WITH {PLANNED} SELECT trigger_id, tenant_id, sub_id, target_ts, delete_after FROM planned")
def plan_dates(t):
    return planned(t).select("trigger_id", "tenant_id", "sub_id", "target_ts", "delete_after")


@query(f"WITH {CHAINED} SELECT trigger_id, tenant_id, sub_id, target_ts, is_valid FROM checked")
def plan_valid(t):
    return w.plan_status(planned(t), t.stored_windows).select("trigger_id", "tenant_id", "sub_id", "target_ts", "is_valid")


@query(f"""WITH {CHAINED} SELECT trigger_id, tenant_id, sub_id, delete_only, delete_after, target_ts,
           COALESCE(last_target, @'1900-01-01 00:00:00') AS previous_ts FROM checked WHERE is_valid""")
def plan_windows(t):
    return w.plan_windows(planned(t), t.stored_windows)


@query(f"""WITH {PLANNED} SELECT trigger_id, delete_after, DENSE_RANK() OVER (PARTITION BY trigger_id ORDER BY delete_after DESC) AS group_no
    FROM (SELECT DISTINCT trigger_id, delete_after FROM planned)""")
def plan_groups(t):
    return w.plan_groups(planned(t))


@query(f"""WITH {CHAINED} SELECT trigger_id, COUNT(*) FILTER (WHERE is_valid) AS valid_windows,
           COUNT(*) FILTER (WHERE NOT is_valid) AS duplicate_windows, MAX(target_ts) AS target_ts FROM checked GROUP BY trigger_id""")
def plan_counts(t):
    return w.plan_counts(planned(t), t.stored_windows)


@query("""
    SELECT trigger_id AS parent_id, next_time AS trigger_time, repeat_hours, repeat_until FROM (
        SELECT *, trigger_time + INTERVAL '1' HOUR * repeat_hours AS next_time FROM $c_triggers
        WHERE NOT (is_archived OR is_finished OR is_dry_run OR is_error) AND repeats) a
    WHERE (repeat_until IS NULL OR repeat_until >= next_time)
      AND NOT EXISTS (SELECT 1 FROM $c_triggers x WHERE x.parent_id = a.trigger_id AND x.trigger_id > a.trigger_id)
      AND ((valid_windows = 0 AND target_ts <= @'1998-01-01 00:00:00')
           OR EXISTS (SELECT 1 FROM $c_groups g WHERE g.trigger_id = a.trigger_id AND NOT g.is_archived))""")
def repeat_next(t):
    batch = t.c_groups.where(~F.col("is_archived"))
    return w.repeat_next(t.c_triggers, batch, "1998-01-01 00:00:00")


@query("""
    WITH RECURSIVE r AS (
        SELECT trigger_id AS root_id, 0 AS repeat_no, trigger_time, repeat_hours, repeat_until FROM $c_triggers a
        WHERE NOT (is_archived OR is_finished OR is_dry_run OR is_error) AND repeats
          AND NOT EXISTS (SELECT 1 FROM $c_triggers x WHERE x.parent_id = a.trigger_id AND x.trigger_id > a.trigger_id)
        UNION ALL
        SELECT root_id, repeat_no + 1, trigger_time + INTERVAL '1' HOUR * repeat_hours, repeat_hours, repeat_until FROM r
        WHERE trigger_time + INTERVAL '1' HOUR * repeat_hours < @'1997-06-01 00:00:00'
          AND (repeat_until IS NULL OR repeat_until >= trigger_time + INTERVAL '1' HOUR * repeat_hours))
    SELECT root_id, repeat_no, trigger_time FROM r WHERE repeat_no > 0""")
def repeat_chain(t):
    return w.repeat_chain(t.c_triggers, "1997-06-01 00:00:00").select("root_id", "repeat_no", "trigger_time")


@query("""
    WITH RECURSIVE r AS (
        SELECT trigger_id, trigger_id AS root_id FROM $chain_triggers a
        WHERE parent_id IS NULL OR NOT EXISTS (SELECT 1 FROM $chain_triggers p WHERE p.trigger_id = a.parent_id)
        UNION ALL SELECT c.trigger_id, r.root_id FROM r JOIN $chain_triggers c ON c.parent_id = r.trigger_id AND c.trigger_id > c.parent_id)
    SELECT r.root_id, COUNT(*) AS triggers, MAX(c.trigger_time) AS last_time, BOOL_AND(c.is_finished) AS is_finished,
           COUNT(*) FILTER (WHERE NOT c.is_finished) AS unfinished FROM r JOIN $chain_triggers c ON c.trigger_id = r.trigger_id GROUP BY r.root_id""")
def chain_status(t):
    """Chains of up to 39 triggers by parent links; a chain is finished with its last trigger."""
    triggers, rounds = t.chain_triggers, iter(range(64))
    return w.chain_status(triggers, w.chain_roots(triggers, lambda df: t.store(f"chain_{next(rounds)}", df)))


@query("""
    SELECT trigger_id, CAST(n - 1 AS INT) AS repeat_no, trigger_time + INTERVAL '1' HOUR * repeat_hours * (n - 1) AS trigger_time
    FROM (SELECT trigger_id, trigger_time, repeat_hours, unnest(generate_series(1,
              CAST(floor(date_diff('hour', trigger_time, repeat_until) / repeat_hours) AS BIGINT) + 1)) AS n
          FROM $c_triggers WHERE repeats AND repeat_until IS NOT NULL AND repeat_until >= trigger_time)""")
def repeat_schedule(t):
    return w.repeat_schedule(t.c_triggers)


@query("""
    SELECT trigger_id, 2 AS entries, 'run-7' AS head_run, 'windows: ' || window_count AS head_message,
           '2001-08-02T00:00:00' AS head_time, CAST(trigger_id AS VARCHAR) AS tail_run
    FROM $c_triggers""")
def run_history(t):
    out = w.run_history(t.c_triggers, "run-7", NOW_ORDERS)
    h = F.from_json("history", "array<struct<runid:string,message:string,timestamp:string>>")
    return out.select("trigger_id", F.size(h).alias("entries"), h[0]["runid"].alias("head_run"),
                      h[0]["message"].alias("head_message"), h[0]["timestamp"].alias("head_time"), h[1]["runid"].alias("tail_run"))


@query(policy_oracle("""
    SELECT policy_id, policy_id * 10 AS trigger_id, bad AS is_error, policy_id % 7 = 0 AS is_finished,
           CASE WHEN bad THEN 'policy has violations' WHEN policy_id % 7 = 0 THEN 'dry run' ELSE 'added' END AS message
    FROM (SELECT policy_id, EXISTS (SELECT 1 FROM violations v WHERE v.policy_id = r.policy_id) AS bad FROM $policies_raw r)""", "violations"))
def trigger_insert(t):
    """Trigger rows with error and dry-run flags; a policy with any violation is an error."""
    requests = t.policies_raw.select("policy_id", (F.col("policy_id") * 10).alias("trigger_id"),
                                     F.lit(NOW_LOGS).cast("timestamp_ntz").alias("trigger_time"),
                                     (F.col("policy_id") % 7 == 0).alias("is_dry_run"))
    errors = compiler(t, staged=True).violations
    return w.new_triggers(requests, errors).select("policy_id", "trigger_id", "is_error", "is_finished", "message")


@query("""
    SELECT id, tenant_id, level_id FROM $logs WHERE ts < @'2024-01-21 00:00:00'
    AND tenant_id IN (SELECT tenant_id FROM $tenants)""")
def simple_archive(t):
    """Ten days kept from the start of the day: every tenant and level, no delay, deleted at once."""
    spark = t.spark
    request = spark.createDataFrame([(1, None, 10, None, True)],
                                    "policy_id int, retention_date timestamp_ntz, retention_days int, retention_hours int, round_to_day boolean")
    trigger = rq.simple_retention_date(request, NOW_LOGS).select(
        "policy_id", F.col("policy_id").alias("trigger_id"), "trigger_time")
    policy = spark.createDataFrame([(1, 0, 0, "ALL")], "policy_id int, after_hours int, delay_hours int, doc string")
    settings = compile_policies(expand_keywords(policy), t.tenants)
    plan = w.plan_windows(w.plan_dates(settings.join(trigger, "policy_id")), t.stored_windows.limit(0))
    windows = plan.withColumn("group_id", F.lit(1)).withColumn("no_delay", F.col("delete_after") == F.col("target_ts"))
    chosen = select_rows(t.logs, windows, LOGS)
    return chosen.where("no_delay AND NOT delete_only").select("id", "tenant_id", "level_id")
