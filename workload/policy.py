"""Policy compile queries: one policy document per customer, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.entities import AUDIT_LOGS, JOBS, LICENCE_LOGS, LOGS, QUEUE_ITEMS, Entity
from ebbline.functions.lookups import level_id
from ebbline.plans.policy import PolicyCompiler, expand_keywords, split_tenant_list
from ebbline.session import work_dir
from workload.registry import query

# The oracle parses with DuckDB's own JSON functions; every CTE follows the rule text, not the Spark plan.
ORACLE_CTES = {
    "j_docs": "SELECT policy_id, after_hours, delay_hours, doc, CASE WHEN json_valid(doc) THEN doc::JSON END AS j FROM $policies",
    "j_arrays": "SELECT policy_id, j FROM j_docs WHERE j IS NOT NULL AND json_type(j) = 'ARRAY'",
    "j_items": "SELECT a.policy_id, CAST(e.key AS INT) + 1 AS rule_no, e.type AS t, e.value AS v FROM j_arrays a, json_each(a.j) e",
    "j_kinds": """SELECT * FROM (VALUES ('NULL', 'null'), ('VARCHAR', 'string'), ('UBIGINT', 'number'), ('BIGINT', 'number'),
        ('DOUBLE', 'number'), ('BOOLEAN', 'true/false'), ('ARRAY', 'array'), ('OBJECT', 'object')) k(t, kind)""",
    "elements": """SELECT i.policy_id, i.rule_no,
            CASE WHEN lower(trim(e.key)) IN ('disable', 'disabled') THEN 'disabled' ELSE lower(trim(e.key)) END AS key,
            trim(e.value ->> '$') AS value, k.kind, e.value AS jv
        FROM j_items i, json_each(i.v) e JOIN j_kinds k ON k.t = e.type
        WHERE i.t = 'OBJECT' AND lower(trim(e.key)) NOT IN ('comment', 'comments')""",
    "rule_settings": """SELECT i.policy_id, i.rule_no,
            (SELECT MAX(TRY_CAST(value AS INT)) FROM elements e WHERE e.policy_id = i.policy_id AND e.rule_no = i.rule_no
             AND key = 'after_hours' AND kind = 'number') AS after_hours,
            (SELECT MAX(TRY_CAST(value AS INT)) FROM elements e WHERE e.policy_id = i.policy_id AND e.rule_no = i.rule_no
             AND key = 'delete_delay_hours' AND kind = 'number') AS delete_delay_hours,
            CASE WHEN (SELECT COUNT(*) FROM elements e WHERE e.policy_id = i.policy_id AND e.rule_no = i.rule_no AND key = 'disabled') > 1
                 THEN false
                 ELSE COALESCE((SELECT MIN((kind = 'true/false' AND value = 'true') OR (kind = 'number' AND TRY_CAST(value AS DOUBLE) >= 1))
                      FROM elements e WHERE e.policy_id = i.policy_id AND e.rule_no = i.rule_no AND key = 'disabled'
                      AND kind IN ('number', 'true/false', 'array')), false) END AS disabled
        FROM j_items i WHERE i.t = 'OBJECT'""",
    "live": """SELECT e.* FROM elements e JOIN rule_settings s ON s.policy_id = e.policy_id AND s.rule_no = e.rule_no
        WHERE NOT s.disabled""",
    "list_items": """SELECT l.policy_id, l.rule_no, l.key, CAST(x.key AS INT) + 1 AS pos, k.kind, x.value AS v
        FROM (SELECT * FROM live WHERE kind = 'array') l, json_each(l.jv) x JOIN j_kinds k ON k.t = x.type""",
    "sub_entries": """SELECT s.policy_id, s.rule_no, s.pos AS sub_no,
            CASE WHEN lower(trim(e.key)) IN ('disable', 'disabled') THEN 'disabled' ELSE lower(trim(e.key)) END AS key,
            trim(e.value ->> '$') AS value, k.kind, e.value AS jv
        FROM (SELECT * FROM list_items WHERE key = 'levels' AND kind = 'object') s, json_each(s.v) e JOIN j_kinds k ON k.t = e.type""",
    "sub_settings": """SELECT policy_id, rule_no, sub_no,
            MAX(CASE WHEN key = 'after_hours' AND kind = 'number' THEN TRY_CAST(value AS INT) END) AS after_hours,
            MAX(CASE WHEN key = 'delete_delay_hours' AND kind = 'number' THEN TRY_CAST(value AS INT) END) AS delete_delay_hours,
            COALESCE(BOOL_AND(CASE WHEN key = 'disabled' AND kind IN ('number', 'true/false', 'array')
                 THEN (kind = 'true/false' AND value = 'true') OR (kind = 'number' AND TRY_CAST(value AS DOUBLE) >= 1) END), false) AS disabled
        FROM sub_entries GROUP BY policy_id, rule_no, sub_no""",
    "live_sub": """SELECT e.* FROM sub_entries e JOIN sub_settings s USING (policy_id, rule_no, sub_no) WHERE NOT s.disabled""",
    "sub_items": """SELECT l.policy_id, l.rule_no, l.sub_no, l.key, k.kind, x.value AS v
        FROM (SELECT * FROM live_sub WHERE key IN ('archive', 'delete') AND kind = 'array') l, json_each(l.jv) x JOIN j_kinds k ON k.t = x.type""",
    "level_names": "SELECT * FROM (VALUES (0, 'trace'), (1, 'debug'), (2, 'info'), (3, 'warn'), (4, 'error'), (5, 'fatal')) d(sub_id, sub_name)",
    "sub_values": """SELECT policy_id, rule_no, sub_no, key AS action, CASE WHEN kind = 'string' THEN lower(value) END AS name,
            CASE WHEN kind = 'number' THEN TRY_CAST(value AS INT) END AS id
        FROM live_sub WHERE key IN ('archive', 'delete') AND kind IN ('string', 'number')
        UNION ALL
        SELECT policy_id, rule_no, sub_no, key, CASE WHEN kind = 'string' THEN lower(trim(v ->> '$')) END,
            CASE WHEN kind = 'number' THEN TRY_CAST(v ->> '$' AS INT) END
        FROM sub_items WHERE kind IN ('string', 'number')""",
    "sub_keys": """SELECT DISTINCT v.policy_id, v.rule_no, v.sub_no, v.action, d.sub_id
        FROM sub_values v JOIN level_names d ON d.sub_id = v.id OR d.sub_name = v.name OR v.name = 'all'""",
    "sel_all": """SELECT DISTINCT policy_id, rule_no, key, lower(trim(replace(s, '*', '%'))) AS pattern, n AS sel_id FROM (
            SELECT policy_id, rule_no, key, CASE WHEN kind = 'string' THEN value END AS s,
                   CASE WHEN kind = 'number' THEN TRY_CAST(value AS INT) END AS n
            FROM live WHERE key IN ('tenants', 'exclude') AND kind IN ('string', 'number')
            UNION ALL
            SELECT policy_id, rule_no, key, CASE WHEN kind = 'string' THEN v ->> '$' END,
                   CASE WHEN kind = 'number' THEN TRY_CAST(v ->> '$' AS INT) END
            FROM list_items WHERE key IN ('tenants', 'exclude') AND kind IN ('string', 'number'))""",
    "selectors": """SELECT policy_id, rule_no, pattern, sel_id, CASE WHEN sel_id IS NOT NULL THEN 'exact'
            WHEN pattern IN ('#active_tenants#', '#deleted_tenants#', '#other_tenants#') THEN 'keyword'
            WHEN contains(pattern, '%') THEN 'partial' ELSE 'exact' END AS kind
        FROM sel_all WHERE key = 'tenants'""",
    "excluded": """SELECT DISTINCT s.policy_id, s.rule_no, t.tenant_id FROM sel_all s JOIN $tenants t
            ON t.tenant_id = s.sel_id OR lower(t.name) LIKE s.pattern WHERE s.key = 'exclude'""",
    "single_keywords": """SELECT * FROM selectors s WHERE kind = 'keyword' AND NOT EXISTS (SELECT 1 FROM selectors o
            WHERE o.policy_id = s.policy_id AND o.pattern = s.pattern AND o.rule_no <> s.rule_no)""",
    "resolved": """SELECT m.*, CASE m.kind WHEN 'exact' THEN true WHEN 'partial' THEN x.tenant_id IS NULL AND NOT m.is_deleted
            ELSE x.tenant_id IS NULL END AS keep
        FROM (
            SELECT s.policy_id, s.rule_no, s.pattern, s.sel_id, s.kind, t.tenant_id, t.name, t.is_deleted
            FROM selectors s JOIN $tenants t ON t.tenant_id = s.sel_id OR lower(t.name) LIKE s.pattern WHERE s.kind <> 'keyword'
            UNION ALL
            SELECT s.policy_id, s.rule_no, s.pattern, s.sel_id, s.kind, t.tenant_id, t.name, t.is_deleted
            FROM single_keywords s JOIN $tenants t ON t.is_deleted = (s.pattern = '#deleted_tenants#') WHERE s.pattern <> '#other_tenants#'
        ) m LEFT JOIN excluded x ON x.policy_id = m.policy_id AND x.rule_no = m.rule_no AND x.tenant_id = m.tenant_id""",
    "others": """SELECT s.policy_id, s.rule_no, s.pattern, s.sel_id, s.kind, t.tenant_id, t.name, t.is_deleted,
            NOT EXISTS (SELECT 1 FROM excluded x WHERE x.policy_id = s.policy_id AND x.rule_no = s.rule_no AND x.tenant_id = t.tenant_id) AS keep
        FROM single_keywords s JOIN $tenants t ON NOT t.is_deleted
        WHERE s.pattern = '#other_tenants#' AND NOT EXISTS (
            SELECT 1 FROM resolved r WHERE r.policy_id = s.policy_id AND r.tenant_id = t.tenant_id AND r.keep)""",
    "rule_tenants": """SELECT DISTINCT policy_id, rule_no, tenant_id FROM (
            SELECT policy_id, rule_no, tenant_id, keep FROM resolved UNION ALL SELECT policy_id, rule_no, tenant_id, keep FROM others) WHERE keep""",
    "named": "SELECT v.*, d.sub_id, d.sub_name FROM sub_values v JOIN level_names d ON d.sub_id = v.id OR d.sub_name = v.name",
    "sub_hours": """SELECT s.policy_id, s.rule_no, s.sub_no, COALESCE(s.after_hours, r.after_hours, p.after_hours) AS h,
            COALESCE(s.delete_delay_hours, r.delete_delay_hours, p.delay_hours) AS d
        FROM sub_settings s JOIN rule_settings r USING (policy_id, rule_no) JOIN $policies p USING (policy_id) WHERE NOT s.disabled""",
    "violations": """
        SELECT policy_id, 0 AS rule_no, NULL::INT AS sub_no, 'JSON' AS code, 'no array of rules' AS detail FROM j_docs d
        WHERE d.j IS NULL OR json_type(d.j) <> 'ARRAY' OR json_array_length(d.j) = 0
        UNION ALL SELECT policy_id, rule_no, NULL, 'J0', kind FROM j_items JOIN j_kinds USING (t) WHERE t <> 'OBJECT'
        UNION ALL SELECT DISTINCT policy_id, rule_no, NULL, 'J1', key FROM live
            WHERE key NOT IN ('tenants', 'exclude', 'levels', 'after_hours', 'delete_delay_hours', 'disabled')
        UNION ALL SELECT s.policy_id, s.rule_no, NULL, 'J2', m.k FROM rule_settings s, (VALUES ('tenants'), ('levels')) m(k)
            WHERE NOT s.disabled AND NOT EXISTS (SELECT 1 FROM live l WHERE l.policy_id = s.policy_id AND l.rule_no = s.rule_no AND l.key = m.k)
        UNION ALL SELECT DISTINCT policy_id, rule_no, NULL, 'J3', key || ':' || kind FROM live
            WHERE (key = 'tenants' AND kind NOT IN ('string', 'number', 'array')) OR (key = 'levels' AND kind <> 'array')
               OR (key IN ('after_hours', 'delete_delay_hours') AND kind <> 'number') OR (key = 'disabled' AND kind NOT IN ('number', 'true/false'))
        UNION ALL SELECT policy_id, rule_no, NULL, 'J4', key || ':' || COUNT(*) FROM live GROUP BY policy_id, rule_no, key HAVING COUNT(*) > 1
        UNION ALL SELECT DISTINCT policy_id, rule_no, NULL, 'J5', key FROM live
            WHERE key IN ('tenants', 'exclude', 'levels') AND kind = 'array' AND json_array_length(jv) = 0
        UNION ALL SELECT DISTINCT policy_id, rule_no, NULL, 'T0', key || ':' || kind FROM list_items
            WHERE (key IN ('tenants', 'exclude') AND kind NOT IN ('string', 'number')) OR (key = 'levels' AND kind <> 'object')
        UNION ALL SELECT policy_id, rule_no, NULL, 'T1', COALESCE(pattern, sel_id::VARCHAR) FROM selectors s
            WHERE kind <> 'keyword' AND NOT EXISTS (SELECT 1 FROM $tenants t WHERE t.tenant_id = s.sel_id OR lower(t.name) LIKE s.pattern)
        UNION ALL SELECT a.policy_id, a.rule_no, NULL, 'T2', a.pattern || ' in #' || b.rule_no FROM selectors a
            JOIN selectors b ON a.policy_id = b.policy_id AND a.pattern = b.pattern AND a.rule_no < b.rule_no
            WHERE a.kind = 'keyword' AND NOT EXISTS (SELECT 1 FROM selectors o WHERE o.policy_id = a.policy_id AND o.pattern = a.pattern AND o.rule_no < a.rule_no)
        UNION ALL SELECT a.policy_id, a.rule_no, NULL, 'T3', a.tenant_id || ' in #' || b.rule_no FROM rule_tenants a
            JOIN rule_tenants b ON a.policy_id = b.policy_id AND a.tenant_id = b.tenant_id AND a.rule_no < b.rule_no
            WHERE NOT EXISTS (SELECT 1 FROM rule_tenants o WHERE o.policy_id = a.policy_id AND o.tenant_id = a.tenant_id AND o.rule_no < a.rule_no)
        UNION ALL SELECT DISTINCT policy_id, rule_no, sub_no, 'L0', key FROM sub_entries
            WHERE key NOT IN ('archive', 'delete', 'after_hours', 'delete_delay_hours', 'disabled', 'comment', 'comments')
        UNION ALL SELECT policy_id, rule_no, sub_no, 'L1', 'archive or delete' FROM sub_settings s WHERE NOT EXISTS (
            SELECT 1 FROM sub_entries e WHERE e.policy_id = s.policy_id AND e.rule_no = s.rule_no AND e.sub_no = s.sub_no AND e.key IN ('archive', 'delete'))
        UNION ALL SELECT DISTINCT policy_id, rule_no, sub_no, 'L3', key || ':' || kind FROM live_sub
            WHERE (key IN ('archive', 'delete') AND kind NOT IN ('string', 'number', 'array'))
               OR (key IN ('after_hours', 'delete_delay_hours') AND kind <> 'number') OR (key = 'disabled' AND kind NOT IN ('number', 'true/false'))
        UNION ALL SELECT policy_id, rule_no, sub_no, 'L4', key || ':' || COUNT(*) FROM live_sub GROUP BY policy_id, rule_no, sub_no, key HAVING COUNT(*) > 1
        UNION ALL SELECT DISTINCT policy_id, rule_no, sub_no, 'L5', key FROM live_sub
            WHERE key IN ('archive', 'delete') AND kind = 'array' AND json_array_length(jv) = 0
        UNION ALL SELECT DISTINCT policy_id, rule_no, sub_no, 'L6', key || ':' || kind FROM sub_items WHERE kind NOT IN ('string', 'number')
        UNION ALL SELECT DISTINCT policy_id, rule_no, sub_no, 'L7', action || ':' || COALESCE(name, id::VARCHAR) FROM sub_values v
            WHERE NOT EXISTS (SELECT 1 FROM level_names d WHERE d.sub_id = v.id OR d.sub_name = v.name)
              AND ((v.name <> 'all' AND v.name IS NOT NULL) OR v.id IS NOT NULL)
        UNION ALL SELECT policy_id, rule_no, NULL, 'L8', sub_name || ':' || COUNT(DISTINCT sub_no) FROM named
            GROUP BY policy_id, rule_no, sub_name HAVING COUNT(DISTINCT sub_no) > 1
        UNION ALL SELECT DISTINCT policy_id, rule_no, NULL::INT, 'L9', sub_name FROM named n WHERE EXISTS (
            SELECT 1 FROM sub_values v WHERE v.policy_id = n.policy_id AND v.rule_no = n.rule_no AND v.name = 'all')
        UNION ALL SELECT policy_id, rule_no, sub_no, 'H0', 'after_hours' FROM sub_hours WHERE h IS NULL
        UNION ALL SELECT policy_id, rule_no, sub_no, 'H1', 'delete_delay_hours' FROM sub_hours WHERE d IS NULL""",
    "compiled": """SELECT DISTINCT k.policy_id, t.tenant_id, k.sub_id, k.action = 'delete' AS delete_only, h.h AS after_hours,
            COALESCE(h.d, 0) AS delay_hours
        FROM sub_keys k JOIN sub_hours h USING (policy_id, rule_no, sub_no) JOIN rule_tenants t USING (policy_id, rule_no)
        WHERE NOT EXISTS (SELECT 1 FROM violations v WHERE v.policy_id = k.policy_id)""",
}
_DEPENDS = list(ORACLE_CTES)


def _ctes_of(entity: Entity, policies: str) -> dict[str, str]:
    """The CTEs in the words of an entity, over its view of the documents."""
    rows = ", ".join(f"({i}, '{n}')" for i, n in entity.sub_names) or "(0, 'none')"
    out = {}
    for name, sql in ORACLE_CTES.items():
        sql = sql.replace("$policies", f"${policies}")
        if not entity.sub_rule:
            sql = sql.replace("('tenants'), ('levels')) m(k)", "('tenants')) m(k)")
        out[name] = sql.replace("'levels'", f"'{entity.sub_rule or '-'}'")
    out["level_names"] = f"SELECT * FROM (VALUES {rows}) d(sub_id, sub_name)"
    if not entity.sub_rule:
        out["compiled"] = f"""SELECT DISTINCT r.policy_id, t.tenant_id, 0 AS sub_id, false AS delete_only, COALESCE(r.after_hours, p.after_hours) AS after_hours,
            COALESCE(r.delete_delay_hours, p.delay_hours, 0) AS delay_hours
        FROM rule_settings r JOIN ${policies} p USING (policy_id) JOIN rule_tenants t USING (policy_id, rule_no)
        WHERE NOT r.disabled AND NOT EXISTS (SELECT 1 FROM violations v WHERE v.policy_id = r.policy_id)"""
    return out


def policy_oracle(select: str, last: str, entity: Entity = LOGS, policies: str = "policies") -> str:
    """The CTEs up to ``last`` (they are in dependency order) and the select."""
    used, ctes = _DEPENDS[:_DEPENDS.index(last) + 1], _ctes_of(entity, policies)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({ctes[n]})" for n in used) + "\n" + select


def compiler(t, staged: bool = False) -> PolicyCompiler:
    policies = expand_keywords(t.policies_raw).select("policy_id", "after_hours", "delay_hours", "doc")
    return PolicyCompiler(policies, t.tenants, LOGS, work_dir(t.spark, "policy") if staged else None)


@query("""
    SELECT r.policy_id, p.doc, CASE WHEN UPPER(r.doc) IN ('ALL', 'ACTIVE_TENANTS', '#DELETED_TENANTS#') AND r.after_hours IS NULL
           THEN 'after_hours must be provided with a keyword' END AS error
    FROM $policies_raw r JOIN $policies p ON p.policy_id = r.policy_id""")
def policy_keywords(t):
    return expand_keywords(t.policies_raw).select("policy_id", "doc", "error")


@query(policy_oracle("""SELECT policy_id, rule_no, key, kind,
    CASE WHEN kind IN ('array', 'object') THEN NULL ELSE value END AS value FROM elements""", "elements"))
def policy_elements(t):
    """Nested values stay JSON text; only scalars are compared, the text form differs between parsers."""
    scalar = ~F.col("kind").isin("array", "object")
    return compiler(t).elements.select("policy_id", "rule_no", "key", "kind", F.when(scalar, F.col("value")).alias("value"))


@query(policy_oracle("""SELECT policy_id, rule_no, NULL::INT AS sub_no, after_hours, delete_delay_hours, disabled FROM rule_settings
    UNION ALL SELECT policy_id, rule_no, sub_no, after_hours, delete_delay_hours, disabled FROM sub_settings""", "sub_settings"))
def policy_settings(t):
    c = compiler(t)
    rule = c.rule_settings.withColumn("sub_no", F.lit(None).cast("int"))
    return rule.unionByName(c.sub_settings)


@query(policy_oracle("SELECT policy_id, rule_no, sub_no, action, name, id FROM sub_values", "sub_values"))
def policy_subrules(t):
    return compiler(t).sub_values.select("policy_id", "rule_no", "sub_no", "action", "name", "id")


@query(policy_oracle("SELECT policy_id, rule_no, sub_no, action, sub_id FROM sub_keys", "sub_keys"))
def policy_subkeys(t):
    return compiler(t).sub_keys.select("policy_id", "rule_no", "sub_no", "action", "sub_id")


@query(policy_oracle("SELECT policy_id, rule_no, kind, COALESCE(pattern, sel_id::VARCHAR) AS selector, tenant_id, keep FROM resolved", "resolved"))
def tenant_resolution(t):
    return compiler(t, staged=True).resolved.select(
        "policy_id", "rule_no", "kind", F.coalesce("pattern", F.col("sel_id").cast("string")).alias("selector"),
        "tenant_id", "keep")


@query(policy_oracle("SELECT policy_id, rule_no, tenant_id, keep FROM others", "others"))
def tenant_others(t):
    return compiler(t, staged=True).others.select("policy_id", "rule_no", "tenant_id", "keep")


@query(policy_oracle("SELECT policy_id, rule_no, sub_no, code, detail FROM violations", "violations"))
def policy_errors(t):
    return compiler(t, staged=True).violations


@query(policy_oracle("SELECT * FROM compiled", "compiled"))
def policy_compiled(t):
    return compiler(t, staged=True).settings


def compiler_of(t, entity: Entity, policies: str) -> PolicyCompiler:
    return PolicyCompiler(getattr(t, policies), t.tenants, entity, work_dir(t.spark, "policy"))


def _register(entity: Entity, short: str, policies: str) -> None:
    """``policy_compiled_<entity>`` and ``policy_errors_<entity>``: every document compiled, or rejected with its violations."""
    def compiled(t):
        return compiler_of(t, entity, policies).settings

    def errors(t):
        return compiler_of(t, entity, policies).violations

    compiled.__name__, errors.__name__ = f"policy_compiled_{short}", f"policy_errors_{short}"
    query(policy_oracle("SELECT * FROM compiled", "compiled", entity, policies))(compiled)
    query(policy_oracle("SELECT policy_id, rule_no, sub_no, code, detail FROM violations", "violations", entity, policies))(errors)


_register(JOBS, "jobs", "policies_jobs")
_register(QUEUE_ITEMS, "queues", "policies_queues")
_register(AUDIT_LOGS, "audit", "policies_plain")
_register(LICENCE_LOGS, "licence", "policies_plain")


@query(" UNION ALL ".join(
    f"SELECT '{e.name}' AS entity, k.policy_id, k.rule_no, k.sub_no, k.action, k.sub_id FROM ({policy_oracle('SELECT * FROM sub_keys', 'sub_keys', e, p)}) k"
    for e, p in ((JOBS, "policies_jobs"), (QUEUE_ITEMS, "policies_queues"))))
def policy_subkeys_of_states(t):
    """Names and numbers of job states and queue statuses through their dictionaries."""
    parts = [PolicyCompiler(getattr(t, p), t.tenants, e).sub_keys.select(F.lit(e.name).alias("entity"), "policy_id", "rule_no", "sub_no", "action", "sub_id")
             for e, p in ((JOBS, "policies_jobs"), (QUEUE_ITEMS, "policies_queues"))]
    return parts[0].unionByName(parts[1])


@query("""
    WITH items AS (
        SELECT DISTINCT list_id, CASE WHEN token LIKE '-%' THEN trim(substr(token, 2)) ELSE token END AS item, token LIKE '-%' AS discard
        FROM (SELECT list_id, trim(unnest(string_split(items, ','))) AS token FROM $tenant_lists) WHERE token <> ''),
    hits AS (
        SELECT i.*, t.tenant_id, t.name FROM items i LEFT JOIN $tenants_active t ON lower(t.name) LIKE lower(i.item)
            OR lower(i.item) = '#all_tenants#' OR (lower(i.item) = '#active_tenants#' AND t.is_active)
            OR (lower(i.item) = '#inactive_tenants#' AND NOT t.is_active) OR (lower(i.item) = '#deleted_tenants#' AND t.is_deleted)),
    bad AS (SELECT DISTINCT list_id FROM hits WHERE item LIKE '#%#' AND tenant_id IS NULL)
    SELECT list_id, tenant_id, name, NULL AS error FROM (
        SELECT list_id, tenant_id, COALESCE(name, item) AS name FROM hits WHERE NOT discard
        EXCEPT SELECT list_id, tenant_id, name FROM hits WHERE discard)
    WHERE list_id NOT IN (SELECT list_id FROM bad)
    UNION ALL SELECT list_id, NULL, NULL, 'invalid keyword' FROM bad""")
def tenant_list(t):
    return split_tenant_list(t.tenant_lists, t.tenants_active)


@query("""
    SELECT event_id, word, CASE lower(trim(word)) WHEN 'trace' THEN 0 WHEN '1' THEN 1 WHEN 'info' THEN 2 WHEN 'warn' THEN 3
           WHEN '4' THEN 4 WHEN 'error' THEN 4 WHEN 'fatal' THEN 5 END AS level_id
    FROM $level_words""")
def level_lookup(t):
    return t.level_words.withColumn("level_id", level_id(F.col("word")))
