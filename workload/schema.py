"""Schema, contract and catalogue queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.entities import contracts
from ebbline.sources import archive_table as at
from ebbline.sources import contract as ct
from ebbline.sources import inventory as inv
from workload.fixtures import BASE
from workload.registry import query

SOURCES = ("tenants", "logs", "jobs", "queue_items", "queue_item_comments", "queue_item_events", "audit_logs",
           "audit_log_entities", "robot_license_logs", "ledger", "ledger_deliveries", "tenant_notifications",
           "user_notifications")


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


def checked_sources(t, keys):
    parts = []
    for name, key in keys:
        df = getattr(t, name)
        errors = ct.contract_violations(ct.schema_rows(t.spark, name, df), ct.contract_rows(t.spark, name, contracts()[name]))
        zero = F.lit(0).cast("bigint")
        parts.append(ct.key_checks(df, name, key).withColumn("contract_errors", zero))
        parts.append(errors.agg(F.count(F.lit(1)).alias("contract_errors")).select(
            F.lit(name).alias("table_name"), *[zero.alias(c) for c in ("row_count", "null_keys", "duplicate_keys")], "contract_errors"))
    counts = ("row_count", "null_keys", "duplicate_keys", "contract_errors")
    return _union(parts).groupBy("table_name").agg(*[F.sum(c).alias(c) for c in counts])


LINE_KEY = {"queue_item_comments": ["queue_item_id", "l_linenumber"], "queue_item_events": ["queue_item_id", "l_linenumber"],
            "audit_log_entities": ["audit_log_id", "l_linenumber"], "tenants": ["tenant_id"], "ledger": ["ledger_id"]}
SOURCE_KEYS = tuple((name, LINE_KEY.get(name, ["id"])) for name in SOURCES)


@query(" UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in key)}) AS null_keys,
        (SELECT COUNT(*) FROM (SELECT 1 FROM ${name} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in key)}
            GROUP BY {', '.join(key)} HAVING COUNT(*) > 1)) AS duplicate_keys, 0 AS contract_errors FROM ${name}""" for name, key in SOURCE_KEYS))
def source_contract(t):
    """Columns and types against the contract, and NULL and duplicate keys of every source table; line tables on ``(parent, line)``."""
    return checked_sources(t, SOURCE_KEYS)


@query("SELECT id, tenant_id, level_id, ts, machine_id FROM $logs")
def archive_projection(t):
    return at.archive_projection(t.logs, '["Message", "arrived_at"]', "id")


@query("""SELECT id, tenant_id, NULL AS level_id, NULL AS machine_id, ts FROM $logs WHERE id % 7 = 0
    UNION ALL SELECT id, tenant_id, level_id, machine_id, ts FROM $logs WHERE id % 7 <> 0""")
def archive_evolve(t):
    """An archive written before two columns existed, and new rows with them."""
    old = t.logs.where(F.col("id") % 7 == 0).select("id", "tenant_id", "ts")
    new = t.logs.where(F.col("id") % 7 != 0).select(
        "id", "tenant_id", "level_id", "machine_id", "ts")
    return at.evolve(old, new, "id")




@query("""
    WITH l AS (SELECT 'c' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) AS name, event_type AS type FROM $events WHERE value < 60),
         r AS (SELECT 'c' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) AS name, event_type AS type FROM $events WHERE value > 40)
    SELECT name, type, 'left' AS side FROM (SELECT DISTINCT name, type FROM l EXCEPT ALL SELECT DISTINCT name, type FROM r)
    UNION ALL SELECT name, type, 'right' FROM (SELECT DISTINCT name, type FROM r EXCEPT ALL SELECT DISTINCT name, type FROM l)""")
def schema_drift(t):
    """Catalogue rows of two stores, as many as the events name, compared both ways."""
    rows = t.events.select(F.concat(F.lit("c"), F.floor(F.col("event_id") / 3).cast("string")).alias("name"),
                           F.col("event_type").alias("type"), "value")
    left = rows.where("value < 60").select("name", "type").distinct()
    right = rows.where("value > 40").select("name", "type").distinct()
    return ct.schema_drift(left, right)


@query("""SELECT id AS event_id, tenant_id AS tenant, level_id, ts AS event_time FROM $logs""")
def column_mapping(t):
    return at.map_columns(t.logs, "id=event_id, [tenant_id] = [tenant], ts = event_time, message=, machine_id =, arrived_at=",
                          "id", copy_key=True)


@query()
def catalog_inventory(t):
    """Every listed table with its columns, joined with the rows it holds."""
    spark = t.spark
    frames = {name: getattr(t, name) for name in SOURCES}
    actual = _union([ct.schema_rows(spark, n, d) for n, d in frames.items()])
    expected = _union([ct.contract_rows(spark, n, c) for n, c in contracts().items()])
    return inv.catalog_inventory(expected, actual).join(inv.row_counts(frames), "table_name", "left")


@query()
def table_usage(t):
    return inv.table_usage({name: getattr(t, name) for name in BASE})


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ${n}" for n in BASE))
def table_rows(t):
    return inv.row_counts({name: getattr(t, name) for name in BASE})


@query()
def space_totals(t):
    return inv.space_totals(inv.table_usage({name: getattr(t, name) for name in BASE}))
