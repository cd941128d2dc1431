"""Entity registry: what differs between the archived and the cleaned-up tables.

One parameterised operator serves all entities; an ``Entity`` says which columns
it reads, which side of the window is closed and whether late rows are picked up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: sub-key dictionaries and limits -------------------------------
LOG_LEVELS = {0: "trace", 1: "debug", 2: "info", 3: "warn", 4: "error", 5: "fatal"}
QUEUE_STATUS = {2: "failed", 3: "successful", 4: "abandoned", 5: "retried", 6: "deleted"}
JOB_STATES = {4: "faulted", 5: "successful", 6: "stopped", 7: "suspended", 8: "resumed"}

MAX_BROADCAST_WINDOWS = 10_000
RUN_LOG_DAYS = 30
# ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Child:
    """A table whose rows follow their parent row."""

    name: str
    parent_id: str
    key: tuple[str, ...] = ("id",)
    contract: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Entity:
    """Columns and window rules of one table.

    ``right_closed``: the window is ``(previous, target]`` instead of ``[previous, target)``.
    ``late``: rows older than the window that arrived after the last one closed are taken too.
    ``own_cursor``: a window resumes at its own id cursor.
    """

    name: str
    id: str
    time: str
    tenant: str | None = None
    sub: str | None = None
    sub_rule: str | None = None
    sub_names: tuple[tuple[int, str], ...] = ()
    right_closed: bool = False
    late: bool = True
    own_cursor: bool = True
    children: tuple[Child, ...] = ()
    contract: tuple[tuple[str, str], ...] = ()

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """``(sub_id, sub_name)``; one row ``(0, all)`` for an entity without sub-key."""
        rows = list(self.sub_names) or [(0, "all")]
        return spark.createDataFrame(rows, "sub_id int, sub_name string")


LOGS = Entity(
    "logs", "id", "ts", "tenant_id", "level_id", "levels", tuple(LOG_LEVELS.items()),
    contract=(("id", "bigint"), ("tenant_id", "int"), ("level_id", "int"), ("ts", "timestamp_ntz"),
              ("message", "string"), ("machine_id", "bigint")),
)
JOBS = Entity(
    "jobs", "id", "creation_time", "tenant_id", "state_id", "states", tuple(JOB_STATES.items()),
    right_closed=True,
    contract=(("id", "bigint"), ("tenant_id", "int"), ("state_id", "int"), ("creation_time", "timestamp_ntz")),
)
QUEUE_ITEMS = Entity(
    "queue_items", "id", "creation_time", "tenant_id", "status_id", "status", tuple(QUEUE_STATUS.items()),
    late=False, own_cursor=False,
    children=(
        Child("queue_item_comments", "queue_item_id", contract=(("queue_item_id", "bigint"), ("creation_time", "timestamp_ntz"))),
        Child("queue_item_events", "queue_item_id", contract=(("queue_item_id", "bigint"), ("ts", "timestamp_ntz"))),
    ),
    contract=(("id", "bigint"), ("tenant_id", "int"), ("status_id", "int"), ("creation_time", "timestamp_ntz")),
)
AUDIT_LOGS = Entity(
    "audit_logs", "id", "execution_time", "tenant_id",
    children=(Child("audit_log_entities", "audit_log_id", contract=(("audit_log_id", "bigint"), ("entity_id", "bigint"))),),
    contract=(("id", "bigint"), ("tenant_id", "int"), ("execution_time", "timestamp_ntz")),
)
LICENCE_LOGS = Entity(
    "robot_license_logs", "id", "end_date", "tenant_id",
    contract=(("id", "bigint"), ("tenant_id", "int"), ("start_date", "timestamp_ntz"), ("end_date", "timestamp_ntz")),
)
LEDGER = Entity("ledger", "ledger_id", "creation_time",
                contract=(("ledger_id", "bigint"), ("creation_time", "timestamp_ntz")))
LEDGER_DELIVERIES = Entity("ledger_deliveries", "id", "last_updated_time",
                           contract=(("id", "bigint"), ("last_updated_time", "timestamp_ntz")))
NOTIFICATIONS = Entity(
    "tenant_notifications", "id", "creation_time",
    children=(Child("user_notifications", "tenant_notification_id", contract=(("id", "bigint"), ("tenant_notification_id", "string"))),),
    contract=(("id", "string"), ("creation_time", "timestamp_ntz")),
)

ARCHIVED = (LOGS, JOBS, QUEUE_ITEMS, AUDIT_LOGS, LICENCE_LOGS)
CLEANED = (LOGS, QUEUE_ITEMS, LEDGER, LEDGER_DELIVERIES, NOTIFICATIONS)

TENANTS_CONTRACT = (("tenant_id", "int"), ("name", "string"), ("is_deleted", "boolean"))
STATUS_CONTRACT = (("group_id", "bigint"), ("is_deleted", "boolean"), ("deleted_on", "timestamp_ntz"),
                   ("first_id", "bigint"), ("last_id", "bigint"))


def contracts() -> dict[str, tuple[tuple[str, str], ...]]:
    """Expected columns of every source and status table, by table name."""
    out = {"tenants": TENANTS_CONTRACT}
    for entity in {e.name: e for e in ARCHIVED + CLEANED}.values():
        out[entity.name] = entity.contract
        for child in entity.children:
            out[child.name] = child.contract
    for entity in ARCHIVED:
        out[f"async_status_{entity.name}"] = STATUS_CONTRACT
    return out
