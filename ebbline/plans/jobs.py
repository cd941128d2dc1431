"""Jobs: read, call the operators, write. The order of writes makes a run repeatable.

A run writes (a) the selected rows, (b) the archive, (c) the ledger, (d) the rewritten
source partitions, (e) the control rows. Each goes to a path of that run. A run that dies
is started again under the same id and replaces what it wrote; only (e) makes it count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.entities import STATUS_CONTRACT, Entity
from ebbline.functions.expressions import ts_ntz
from ebbline.operators import archive as arc
from ebbline.operators import cleanup
from ebbline.operators.purge import ack_groups, acknowledged_status, due_groups, purge_finish, purge_ids, purge_status, resume_point
from ebbline.operators.rollup import close_empty, group_rollup, trigger_rollup
from ebbline.operators.selection import high_watermark, open_windows, select_rows, with_late_marker
from ebbline.operators.sizing import budget_slices, profile_windows
from ebbline.plans.policy import compile_policies, expand_keywords
from ebbline.plans.requests import simple_retention_date
from ebbline.plans.windows import chain_roots, plan_counts, plan_dates, plan_groups, plan_windows, repeat_chain
from ebbline.sources.archive_table import validate_objects
from ebbline.sources.contract import contract_rows, contract_violations, schema_rows
from ebbline.sources.store import read_run, read_table, run_label, run_path, write_run

TAGS = ["trigger_id", "group_id", "delete_only", "no_delay", "is_late", "event_date"]
DATE, SOURCE = "event_date", "source"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
LEDGER = "group_id bigint, id bigint, event_date date, run_id string"
STATUS = "group_id bigint, is_deleted boolean, deleted_on timestamp_ntz, first_id bigint, last_id bigint"
FLAGS = ", ".join(f"{c} boolean" for c in ("is_archived", "is_finished", "is_dry_run", "is_error"))
CONTROL = {
    "windows": "group_id bigint, tenant_id int, sub_id int, delete_only boolean, previous_ts timestamp_ntz, "
               "target_ts timestamp_ntz, is_archived boolean, current_id bigint, target_id bigint",
    "groups": "group_id bigint, trigger_id bigint, delete_after timestamp_ntz, is_archived boolean, is_deleted boolean, "
              "is_synced boolean, first_id bigint, last_id bigint, id_count bigint",
    "triggers": f"trigger_id bigint, trigger_time timestamp_ntz, {FLAGS}",
}


@dataclass(frozen=True)
class Store:
    """Tables of one entity and its children under one root.

    The source tables are copy-on-write by date: the manifest of a run says which run wrote the
    files of each date, so a delete rewrites only the dates it touches. A child row lies under its
    parent's date. Every run leaves its full state under its id: manifests, control rows, status.
    ``period`` makes the date the first day of a month or year, for tables with few rows a day.
    """

    spark: SparkSession
    root: str
    entity: Entity
    period: str = "day"

    @property
    def tables(self) -> tuple[str, ...]:
        return (SOURCE, *(c.name for c in self.entity.children))

    def create(self, source: DataFrame, run_id: str, children: dict[str, DataFrame] | None = None, **control: DataFrame) -> None:
        """First load: source and children by date, control tables ``windows``, ``groups``, ``triggers`` (empty where none is given)."""
        dated = source.withColumn(DATE, F.to_date(F.date_trunc(self.period, self.entity.time)))
        days = dated.select(F.col(self.entity.id).alias("_parent"), DATE)
        for name in self.tables:
            rows = dated
            if name != SOURCE:
                parent = next(c.parent_id for c in self.entity.children if c.name == name)
                rows = (children or {})[name]
                rows = rows.join(days, rows[parent] == F.col("_parent"), "left").drop("_parent")
            write_run(rows, self.root, name, run_id, [DATE])
            self._write_manifest(name, None, run_id, None, rows)
        write_run(self.spark.createDataFrame([], STATUS), self.root, "status", run_id)
        for name, schema in CONTROL.items():
            df = control.get(name)
            write_run(self.spark.createDataFrame([], schema) if df is None else df, self.root, name, run_id)

    def source(self, run_id: str) -> DataFrame:
        return self.rows(SOURCE, run_id)

    def rows(self, table: str, run_id: str) -> DataFrame:
        """A source table as the given run left it; one directory per date, nothing to filter out."""
        entries = self._manifest(table, run_id).collect()  # one small row per date
        base = f"{self.root}/{table}"
        if not entries:  # every row is gone: the columns are those of the older runs
            return self.spark.read.parquet(base).drop("run_id").limit(0)
        paths = [f"{run_path(self.root, table, row.owner)}/{DATE}={row.event_date or NO_DATE}" for row in entries]
        schema = self.spark.read.parquet(run_path(self.root, table, entries[0].owner)).schema
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("run_id")

    def control(self, name: str, run_id: str) -> DataFrame:
        return read_run(self.spark, self.root, name, run_id)

    def archived(self, like: DataFrame | None, table: str = SOURCE) -> DataFrame:
        return read_table(self.spark, self.root, archive_name(table), like)

    def ledger(self, run_id: str | None = None) -> DataFrame:
        """Ledger rows of all runs; of the groups that ``run_id`` has not seen acknowledged, if given."""
        listed = read_table(self.spark, self.root, "ledger", self.spark.createDataFrame([], LEDGER)).select("group_id", "id", DATE)
        if run_id is None:
            return listed
        return listed.join(self.control("groups", run_id).where("is_synced").select("group_id"), "group_id", "left_anti")

    def _manifest(self, table: str, run_id: str) -> DataFrame:
        return read_run(self.spark, self.root, f"manifest_{table}", run_id)

    def _write_manifest(self, table: str, before: DataFrame | None, run_id: str, touched: DataFrame | None, like: DataFrame) -> None:
        """Dates this run wrote, and the owners of the dates it left alone."""
        files = self.spark.read.schema(like.schema).parquet(run_path(self.root, table, run_id))
        owners = files.select(DATE).distinct().withColumn("owner", F.lit(run_id))
        if before is not None:
            kept = before.alias("b").join(touched.alias("t"), F.col(f"b.{DATE}").eqNullSafe(F.col(f"t.{DATE}")), "left_anti")
            owners = kept.unionByName(owners)
        write_run(owners.coalesce(1), self.root, f"manifest_{table}", run_id)

    def rewrite(self, gone: DataFrame, previous_run: str, run_id: str) -> None:
        """Remove ``gone(id, event_date)`` and, before it, their child rows, from the dates that hold them."""
        dates = [row[0] for row in gone.select(DATE).distinct().collect()]  # dates, not rows
        touched = self.spark.createDataFrame([(d,) for d in dates], f"{DATE} date")
        for table in reversed(self.tables):
            key = self.entity.id if table == SOURCE else next(c.parent_id for c in self.entity.children if c.name == table)
            rows = self.rows(table, previous_run)
            affected = rows.where(F.col(DATE).isin(dates)) if dates else rows.limit(0)
            kept = arc.survivors(affected, gone, key, "id")
            write_run(kept, self.root, table, run_id, [DATE])
            self._write_manifest(table, self._manifest(table, previous_run), run_id, touched, kept)

    def carry(self, previous_run: str, run_id: str, *but: str) -> None:
        """State that a run leaves as it was: manifests, control rows and status, under the run's own id."""
        names = (*(f"manifest_{t}" for t in self.tables), *CONTROL, "status")
        for name in names:
            if name not in but:
                write_run(read_run(self.spark, self.root, name, previous_run), self.root, name, run_id)


def archive_name(table: str) -> str:
    return "archive" if table == SOURCE else f"archive_{table}"


def log_run(store: Store, run_id: str, kind: str, started: str, messages: list[tuple[int, str]], status: int = 0) -> None:
    """Run row and its messages ``(severity, text)``, in order."""
    spark = store.spark
    run = spark.createDataFrame([(run_id, kind, started, status)], "run_id string, type string, started string, error_status int")
    write_run(run.withColumnRenamed("run_id", "id").withColumn("start_time", F.col("started").cast("timestamp_ntz")).drop("started"),
              store.root, "runs", run_id)
    rows = [(i, severity, text) for i, (severity, text) in enumerate(messages)]
    write_run(spark.createDataFrame(rows, "seq int, severity int, message string"), store.root, "messages", run_id)


def add_trigger(store: Store, previous_run: str, run_id: str, trigger_id: int, trigger_time: str, settings: DataFrame,
                violations: DataFrame | None = None) -> bool:
    """Plan the windows of a new trigger from compiled settings and add them to the control tables.

    A policy with violations stops the trigger: its row is stored as an error, without windows, and the run's log says
    which codes. Returns whether the trigger was planned.
    """
    spark = store.spark
    codes = sorted(r.code for r in violations.select("code").distinct().collect()) if violations is not None else []  # a few fixed codes
    if codes:
        settings = settings.limit(0)
        log_run(store, run_id, f"Add trigger {store.entity.name}", trigger_time, [(16, f"policy has violations: {', '.join(codes)}")], status=1)
    new = spark.createDataFrame([(trigger_id,)], "trigger_id bigint").select(
        "trigger_id", ts_ntz(trigger_time).alias("trigger_time"), F.lit(bool(codes)).alias("is_error"))
    _plan(store, previous_run, run_id, new, settings.withColumn("trigger_id", F.lit(trigger_id).cast("bigint")))
    return not codes


def _plan(store: Store, previous_run: str, run_id: str, new: DataFrame, settings: DataFrame) -> None:
    """Control tables with the triggers ``new(trigger_id, trigger_time, is_error, ..)`` and the windows of their ``settings``.

    All triggers are planned at once, in id order, as if they were added one after the other.
    """
    windows, groups, triggers = (store.control(n, previous_run) for n in CONTROL)
    planned = plan_dates(settings.join(new.select("trigger_id", "trigger_time"), "trigger_id"))
    added = plan_windows(planned, windows)
    first_free = groups.agg(F.coalesce(F.max("group_id"), F.lit(0))).first()[0]
    before = Window.orderBy("trigger_id").rowsBetween(Window.unboundedPreceding, -1)  # one row for each new trigger
    dates = plan_groups(added)
    offsets = dates.groupBy("trigger_id").agg(F.count("*").alias("n")).select(
        "trigger_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    numbered = dates.join(offsets, "trigger_id").withColumn("group_id", (F.col("group_no") + F.col("_offset") + first_free).cast("bigint"))
    null_id = F.lit(None).cast("bigint")
    new_windows = added.join(numbered, ["trigger_id", "delete_after"]).select(
        "group_id", "tenant_id", "sub_id", "delete_only", "previous_ts", "target_ts", F.lit(False).alias("is_archived"),
        null_id.alias("current_id"), null_id.alias("target_id"))
    new_groups = numbered.select("group_id", "trigger_id", "delete_after", *[F.lit(False).alias(c) for c in ("is_archived", "is_deleted", "is_synced")],
                                 *[null_id.alias(c) for c in ("first_id", "last_id", "id_count")])
    counts = plan_counts(planned, windows).select("trigger_id", "valid_windows", "target_ts")
    new_triggers = new.join(counts, "trigger_id", "left").withColumns({
        "valid_windows": F.coalesce("valid_windows", F.lit(0)), "target_ts": F.coalesce("target_ts", "trigger_time"),
        **{c: F.lit(False) for c in ("is_archived", "is_finished", "is_dry_run")}})
    write_run(windows.unionByName(new_windows), store.root, "windows", run_id)
    write_run(groups.unionByName(new_groups), store.root, "groups", run_id)
    write_run(triggers.unionByName(new_triggers, allowMissingColumns=True), store.root, "triggers", run_id)
    store.carry(previous_run, run_id, *CONTROL)


def add_repeats(store: Store, previous_run: str, run_id: str, now: str, settings: DataFrame) -> int:
    """Plan the repeats of all repeating triggers that are due before ``now``, and the next one each chain waits for.

    ``settings`` are compiled settings with the ``trigger_id`` of the first trigger of the chain they belong to. A
    repeat is the child of the one before it. Returns the number of repeats; with none the state is carried over.
    """
    spark, triggers = store.spark, store.control("triggers", previous_run)
    if not {"repeats", "repeat_hours", "repeat_until", "parent_id"} <= set(triggers.columns):
        store.carry(previous_run, run_id)
        return 0
    write_run(repeat_chain(triggers, now, pending=True), store.root, "repeats", run_id)
    due = read_run(spark, store.root, "repeats", run_id)
    count = due.count()
    if not count:
        store.carry(previous_run, run_id)
        return 0
    rounds = iter(range(1_000_000))

    def written(links: DataFrame) -> DataFrame:
        label = f"{run_id}-{next(rounds)}"
        write_run(links, store.root, "links", label)
        return read_run(spark, store.root, "links", label)

    roots = chain_roots(triggers, written).select(F.col("trigger_id").alias("root_id"), F.col("root_id").alias("_first"))
    last_id = triggers.agg(F.max("trigger_id")).first()[0]
    order = Window.orderBy("trigger_time", "root_id")  # one row for each repeat due: control rows, as few as triggers
    new = due.withColumn("trigger_id", (F.row_number().over(order) + last_id).cast("bigint")).withColumn(
        "parent_id", F.coalesce(F.lag("trigger_id").over(Window.partitionBy("root_id").orderBy("repeat_no")), "root_id").cast("bigint"))
    new = new.join(roots, "root_id").select("trigger_id", "trigger_time", "parent_id", "repeat_hours", "repeat_until", "_first",
                                            F.lit(True).alias("repeats"), F.lit(False).alias("is_error"))
    write_run(new, store.root, "repeats_planned", run_id)  # the ids must not change if the plan is read twice
    new = read_run(spark, store.root, "repeats_planned", run_id)
    own = settings.withColumnRenamed("trigger_id", "_first").join(new.select("trigger_id", "_first"), "_first").drop("_first")
    _plan(store, previous_run, run_id, new.drop("_first"), own)
    return count


def validate_store(store: Store, run_id: str, exclude: str | None = None) -> DataFrame:
    """``object, code, detail``: source, child and status tables against their contracts, the archive against the source."""
    spark, entity = store.spark, store.entity
    source = store.source(run_id)
    report = validate_objects(source, store.archived(source), store.control("status", run_id), contract_rows(spark, entity.name, entity.contract),
                              contract_rows(spark, f"async_status_{entity.name}", STATUS_CONTRACT), exclude, entity.id)
    for child in entity.children:
        found = contract_violations(schema_rows(spark, child.name, store.rows(child.name, run_id)), contract_rows(spark, child.name, child.contract))
        report = report.unionByName(found.select(F.lit(child.name).alias("object"), "code", F.coalesce("name", "table_name").alias("detail")))
    return report


def simple_archive_run(store: Store, tenants: DataFrame, previous_run: str, run_id: str, now: str, trigger_id: int, *,
                       retention_date=None, retention_days: int | None = None, retention_hours: int | None = None,
                       round_to_day: bool = False) -> dict:
    """Archive and delete at once everything of all tenants before a retention date."""
    spark = store.spark
    request = spark.createDataFrame(
        [(retention_date, retention_days, retention_hours, round_to_day)],
        "retention_date timestamp_ntz, retention_days int, retention_hours int, round_to_day boolean")
    trigger_time, error = simple_retention_date(request, now).select("trigger_time", "error").first()
    if error:
        raise ValueError(f"retention date: {error}")
    policy = spark.createDataFrame([(1, 0, 0, "ALL")], "policy_id int, after_hours int, delay_hours int, doc string")
    settings = compile_policies(expand_keywords(policy, store.entity), tenants, store.entity)
    add_trigger(store, previous_run, f"{run_id}-trigger", trigger_id, trigger_time, settings)
    return archive_run(store, f"{run_id}-trigger", run_id, now)


def archive_run(store: Store, previous_run: str, run_id: str, now: str, *,
                delete_if_no_delay: bool = True, ignore_delay: bool = False, rows_per_slice: int | None = None,
                settings: DataFrame | None = None, validate: bool = True) -> dict:
    """Archive every due window: from the state of ``previous_run`` to the state of ``run_id``.

    Rows and their child rows are copied once; rows without delay leave the source, children first; the others
    enter the ledger. With nothing to do the state is carried over. Objects that differ from their contracts stop the
    run before it reads a row: the state is carried over and the log says what was found. ``settings``, see
    ``add_repeats``, plans the repeats due by now before the windows are opened.
    """
    spark, entity, key = store.spark, store.entity, store.entity.id
    if validate:
        found = sorted((r.object, r.code, r.detail or "") for r in validate_store(store, previous_run).collect())  # columns, not rows
        if found:
            store.carry(previous_run, run_id)
            log_run(store, run_id, f"Archive {entity.name}", now, [(16, f"{o}: {code} {detail}".rstrip()) for o, code, detail in found], status=1)
            return {"windows": 0, "rows": 0, "violations": found}
    if settings is not None:
        add_repeats(store, previous_run, f"{run_id}-repeats", now, settings)
        previous_run = f"{run_id}-repeats"
    windows = store.control("windows", previous_run)
    groups, triggers = store.control("groups", previous_run), store.control("triggers", previous_run)
    source = store.source(previous_run)

    # the windows decide everything below and must not change if the run is repeated
    write_run(
        with_late_marker(open_windows(windows, groups, triggers, now, ignore_delay=ignore_delay,
                                      delete_if_no_delay=delete_if_no_delay), windows),
        store.root, "batch", run_id)
    batch = read_run(spark, store.root, "batch", run_id)
    profile = profile_windows(batch)
    if profile.count == 0:
        store.carry(previous_run, run_id)
        log_run(store, run_id, f"Archive {entity.name}", now, [(10, "nothing due")])
        return {"windows": 0, "rows": 0}
    watermark = high_watermark(source, entity, profile.last_target, profile.max_target_id or 0).first()[0]

    chosen = select_rows(source, batch, entity, watermark=watermark, profile=profile)
    if rows_per_slice:
        slices = budget_slices(chosen.select(key), key, rows_per_slice)
        for number, (first, last) in enumerate(slices):
            write_run(chosen.where(F.col(key).between(first, last)), store.root, f"selected/{run_id}", str(number), [DATE])
        selected = read_table(spark, store.root, f"selected/{run_id}", chosen).drop("run_id")
    else:
        write_run(chosen, store.root, "selected", run_id, [DATE])
        selected = read_run(spark, store.root, "selected", run_id)

    # (b) bound the archive side by the ids and dates it can share with this run
    lo, hi, first_day, last_day = selected.agg(F.min(key), F.max(key), F.min(DATE), F.max(DATE)).first()

    def other_runs(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("run_id") != run_label(run_id))
        return rows if lo is None else rows.where(F.col(DATE).between(F.lit(first_day), F.lit(last_day)))

    known = other_runs(store.archived(source.withColumn("run_id", F.lit(""))))
    if lo is not None:
        known = known.where(F.col(key).between(lo, hi))
    tags = [t for t in TAGS if t != DATE]
    for child in entity.children:
        rows = store.rows(child.name, previous_run)
        rows = rows.limit(0) if lo is None else rows.where(F.col(DATE).between(F.lit(first_day), F.lit(last_day)))
        copied = other_runs(store.archived(rows.withColumn("run_id", F.lit("")), child.name))
        write_run(arc.archive_children(selected, rows, copied, key, child), store.root, archive_name(child.name), run_id, [DATE])
    write_run(arc.archive_rows(selected.where(~F.col("delete_only")), known, key, tags), store.root, archive_name(SOURCE), run_id, [DATE])

    # (c)
    listed = read_table(spark, store.root, "ledger", spark.createDataFrame([], LEDGER)).where(F.col("run_id") != run_label(run_id))
    if lo is not None:
        listed = listed.where(F.col("id").between(lo, hi) & F.col(DATE).between(F.lit(first_day), F.lit(last_day)))
    days = selected.select(F.col(key).alias("id"), DATE)
    write_run(arc.delete_ledger(selected, listed, key).join(days, "id"), store.root, "ledger", run_id, [DATE])

    # (d)
    store.rewrite(selected.where(F.col("no_delay") | F.lit(ignore_delay)).select(F.col(key).alias("id"), DATE), previous_run, run_id)

    # (e)
    closed = arc.advance_windows(windows, batch, watermark)
    in_batch = batch.select("group_id").distinct()
    own = store.ledger().join(in_batch, "group_id", "left_semi")
    rolled = group_rollup(groups, closed, own, delete_if_no_delay=delete_if_no_delay)
    new = rolled.join(in_batch, "group_id", "left_semi").select(
        "group_id", *[F.col(c).alias(f"_{c}") for c in ("is_archived", "is_deleted", "is_synced", "first_id", "last_id", "id_count")])
    groups_out = groups.join(new, "group_id", "left").select(
        "group_id", "trigger_id", "delete_after",
        *[F.coalesce(f"_{c}", c).alias(c) for c in ("is_archived", "is_deleted", "is_synced", "first_id", "last_id", "id_count")])
    done = trigger_rollup(groups_out).select("trigger_id", F.col("is_archived").alias("_a"), F.col("is_finished").alias("_f"))
    triggers_out = triggers.join(done, "trigger_id", "left").withColumn(
        "is_archived", F.coalesce("_a", "is_archived")).withColumn("is_finished", F.coalesce("_f", "is_finished")).drop("_a", "_f")
    if {"valid_windows", "target_ts"} <= set(triggers.columns):  # triggers planned without a window end here
        empty = close_empty(triggers, profile.last_target).select("trigger_id", F.lit(True).alias("_e"))
        triggers_out = triggers_out.join(empty, "trigger_id", "left").withColumn(
            "is_finished", F.coalesce("_e", "is_finished")).drop("_e")
    for name, df in (("windows", closed), ("groups", groups_out), ("triggers", triggers_out)):
        write_run(df, store.root, name, run_id)
    store.carry(previous_run, run_id, *CONTROL, *(f"manifest_{t}" for t in store.tables))
    counts = arc.archive_metrics(selected, []).first()
    log_run(store, run_id, f"Archive {entity.name}", now, [
        (10, f"windows: {profile.count}"), (10, f"up to id: {watermark}"),
        (10, f"rows: {counts.row_count} (copied {counts.archived}, not copied {counts.delete_only_rows}; "
             f"deleted {counts.deleted_now}, to delete later {counts.deleted_later})")])
    return {"windows": profile.count, "rows": counts.row_count, "watermark": watermark}


def purge_run(store: Store, previous_run: str, run_id: str, now: str, stop_at: int | None = None) -> DataFrame:
    """Delete due ledger ids and their child rows from the source; returns the new local status rows.

    ``stop_at`` ends the run at that id, as a run out of time would; the next run resumes. The ledger holds the
    date of each id, so only the dates concerned are read and rewritten.
    """
    groups, status = store.control("groups", previous_run), store.control("status", previous_run)
    resume = resume_point(due_groups(groups, status, now), status)
    due = purge_ids(store.ledger(previous_run), resume)
    write_run(due, store.root, "due", run_id)
    due = read_run(store.spark, store.root, "due", run_id)
    ids = due if stop_at is None else due.where(F.col("id") <= stop_at)
    store.rewrite(ids.select("id", DATE).distinct(), previous_run, run_id)
    local = purge_status(resume, ids, due).select(
        "group_id", "is_deleted", F.when(F.col("is_deleted"), F.expr(f"timestamp_ntz'{now}'")).alias("deleted_on"),
        "first_id", "last_id")
    others = status.join(local.select("group_id"), "group_id", "left_anti").select(*local.columns)
    write_run(others.unionByName(local), store.root, "status", run_id)
    store.carry(previous_run, run_id, "status", *(f"manifest_{t}" for t in store.tables))
    log_run(store, run_id, f"Purge {store.entity.name}", now, [(10, f"groups: {resume.count()}"), (10, f"ids: {ids.count()}")])
    return read_run(store.spark, store.root, "status", run_id)


def acknowledge_run(store: Store, previous_run: str, run_id: str, now: str) -> dict:
    """Close on the archive side what the source side has purged, then drop the status rows that are closed.

    A closed group is synced, so its ledger rows no longer count; a trigger is finished with its last group.
    """
    groups, triggers, status = (store.control(n, previous_run) for n in ("groups", "triggers", "status"))
    acked = ack_groups(status, groups)
    finish = purge_finish(groups, acked).where("is_finished").select("trigger_id", F.lit(True).alias("_done"))
    closed = groups.join(acked.select("group_id", F.lit(True).alias("_acked")), "group_id", "left")
    for flag in ("is_deleted", "is_synced"):
        closed = closed.withColumn(flag, F.coalesce("_acked", flag))
    write_run(closed.drop("_acked"), store.root, "groups", run_id)
    write_run(triggers.join(finish, "trigger_id", "left").withColumn("is_finished", F.coalesce("_done", "is_finished")).drop("_done"),
              store.root, "triggers", run_id)
    removed = acknowledged_status(status, store.control("groups", run_id)).where("action = 'remove'")
    write_run(status.join(removed.select("group_id"), "group_id", "left_anti").select(*status.columns), store.root, "status", run_id)
    store.carry(previous_run, run_id, "groups", "triggers", "status")
    count = acked.count()
    log_run(store, run_id, f"Acknowledge {store.entity.name}", now, [(10, f"groups: {count}")])
    return {"groups": count}


def cleanup_run(store: Store, previous_run: str, run_id: str, now: str, cutoff, *, below_id=None, dry_run: bool = False) -> dict:
    """Delete the rows older than ``cutoff`` (up to ``below_id``, if given) and, before them, their child rows.

    Only dates that hold such rows are rewritten. The rows per day go to the table ``preview`` of the run in any case;
    a dry run writes nothing else and carries the state over. Returns rows removed and the last id among them.
    """
    entity, source = store.entity, store.source(previous_run)
    write_run(cleanup.preview(source, entity, cutoff, below_id), store.root, "preview", run_id)
    total = cleanup.totals(source, entity, cutoff, below_id).first()
    verb = "would be deleted" if dry_run else "deleted"
    messages = [(10, f"older than: {cutoff}"), (10, f"rows {verb}: {total.row_count} (last id {total.last_id})")]
    if dry_run or not total.row_count:
        store.carry(previous_run, run_id)
    else:
        store.rewrite(cleanup.removed(source, entity, cutoff, below_id).select(F.col(entity.id).alias("id"), DATE), previous_run, run_id)
        store.carry(previous_run, run_id, *(f"manifest_{t}" for t in store.tables))
    log_run(store, run_id, f"Clean up {entity.name}", now, messages)
    return {"rows": total.row_count, "last_id": total.last_id}
