"""Whole runs on storage: nothing is lost, nothing twice, any slicing and any restart ends the same."""

import pytest
from pyspark.sql import functions as F

from ebbline.entities import LOGS, QUEUE_ITEMS
from ebbline.operators import purge as p
from ebbline.plans.jobs import Store, acknowledge_run, add_repeats, add_trigger, archive_run, cleanup_run, purge_run, simple_archive_run
from ebbline.sources.store import read_run, read_table, write_run

NOW = "2024-01-31 00:00:00"


def new_store(spark, views, folder) -> Store:
    store = Store(spark, folder, LOGS)
    store.create(views.logs, "0", windows=views.log_windows, groups=views.log_groups, triggers=views.log_triggers)
    return store


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


@pytest.fixture
def store(spark, views, folder):
    return new_store(spark, views, folder)


def state(store, run):
    groups = {r.group_id: (r.is_archived, r.is_synced, r.first_id, r.last_id, r.id_count)
              for r in store.control("groups", run).collect()}
    return (ids(store.archived(None)), sorted(map(tuple, store.ledger().select("group_id", "id").collect())), ids(store.source(run)), groups)


def test_archive_run(spark, views, store):
    out = archive_run(store, "0", "1", NOW)
    selected = read_run(spark, store.root, "selected", "1")
    assert out["rows"] == selected.count() > 0
    all_ids = ids(views.logs)
    gone_now = ids(selected.where("no_delay"))
    assert ids(store.source("1")) == sorted(set(all_ids) - set(gone_now))
    assert ids(store.archived(None)) == ids(selected.where("NOT delete_only"))
    assert ids(store.ledger()) == ids(selected.where("NOT no_delay"))
    # every window is closed, the immediate group is synced, the delayed one waits
    assert store.control("windows", "1").where("NOT is_archived").count() == 0
    groups = {r.group_id: r for r in store.control("groups", "1").collect()}
    assert groups[20].is_synced and groups[20].id_count == 0
    assert not groups[21].is_synced and groups[21].id_count == store.ledger().count()
    triggers = {r.trigger_id: r for r in store.control("triggers", "1").collect()}
    assert triggers[2].is_archived and not triggers[2].is_finished
    # source data did not change except for the removed rows
    kept = store.source("1").drop("event_date").join(views.logs, views.logs.columns, "left_anti")
    assert kept.count() == 0


def test_repeating_a_run_changes_nothing(store):
    archive_run(store, "0", "1", NOW)
    first = state(store, "1")
    archive_run(store, "0", "1", NOW)  # the same run again, as after a crash before its control rows
    assert state(store, "1") == first
    assert archive_run(store, "1", "2", NOW) == {"windows": 0, "rows": 0}


def test_slices_end_in_the_same_state(spark, views, store, folder):
    archive_run(store, "0", "1", NOW)
    sliced = new_store(spark, views, folder + "-sliced")
    archive_run(sliced, "0", "1", NOW, rows_per_slice=40)
    assert state(sliced, "1") == state(store, "1")


def test_ignore_delay_deletes_everything_at_once(store, views):
    archive_run(store, "0", "1", NOW, ignore_delay=True)
    assert store.ledger().count() == 0
    left = store.source("1").where("ts >= timestamp_ntz'2024-01-11 00:00:00' AND ts < timestamp_ntz'2024-01-21 00:00:00'")
    assert left.count() == 0


def test_purge_acknowledge_and_archive_again(spark, store):
    archive_run(store, "0", "1", NOW)
    before, due_ids = ids(store.source("1")), ids(store.ledger())
    status = purge_run(store, "1", "2", NOW)
    assert ids(store.source("2")) == sorted(set(before) - set(due_ids))
    assert [r.group_id for r in status.where("is_deleted").collect()] == [21]
    assert acknowledge_run(store, "2", "3", NOW) == {"groups": 1}
    assert store.control("status", "3").count() == 0 and store.ledger("3").count() == 0
    assert {r.group_id: r.is_synced for r in store.control("groups", "3").collect()}[21]
    assert {r.trigger_id: r.is_finished for r in store.control("triggers", "3").collect()}[2]
    assert archive_run(store, "3", "4", NOW) == {"windows": 0, "rows": 0}
    assert purge_run(store, "4", "5", NOW).count() == 0 and ids(store.source("5")) == ids(store.source("2"))


def test_purge_resumes_after_a_cut(spark, store):
    archive_run(store, "0", "1", NOW)
    once = purge_run(store, "1", "whole", NOW)
    middle = ids(store.ledger())[store.ledger().count() // 2]
    part = purge_run(store, "1", "half", NOW, stop_at=middle)
    assert not part.first().is_deleted and part.first().last_id == middle
    rest = purge_run(store, "half", "rest", NOW)
    assert rest.first().is_deleted
    assert ids(store.source("rest")) == ids(store.source("whole"))
    assert rest.first().last_id == once.first().last_id
    complete = purge_run(store, "1", "past", NOW, stop_at=max(ids(store.ledger())))
    assert complete.first().is_deleted  # the cut came after the last id of the group


def test_a_resumed_purge_that_finds_nothing_keeps_the_last_id(spark):
    resume = spark.createDataFrame([(1, 12, 11)], "group_id long, resume_id long, reached_id long")
    row = p.purge_status(resume, spark.createDataFrame([], "group_id long, id long")).first()
    assert (row.first_id, row.last_id, row.is_deleted) == (12, 11, True)


def test_nothing_due_leaves_the_source(spark, store):
    archive_run(store, "0", "1", NOW)
    status = purge_run(store, "1", "early", "2024-01-01 00:00:00")
    assert status.count() == 0 and ids(store.source("early")) == ids(store.source("1"))


@pytest.mark.parametrize("entity", [QUEUE_ITEMS], ids=lambda e: e.name)
def test_whole_run_of_an_entity(spark, views, folder, entity):
    """Nothing is lost and nothing is there twice; children follow their parents, now and after the delay."""
    day = F.make_dt_interval((F.col(entity.id) % 12).cast("int"))  # few dates, each a folder
    source = getattr(views, entity.name).withColumn(entity.time, F.expr("timestamp_ntz'2024-01-01 00:00:00'") + day)
    child_id = F.monotonically_increasing_id()
    children = {c.name: getattr(views, c.name).withColumn("id", child_id) for c in entity.children}
    store = Store(spark, folder, entity)
    lo, mid, hi = ("2024-01-02 00:00:00", "2024-01-06 00:00:00", "2024-01-10 00:00:00")
    keys = source.select(entity.tenant, *([entity.sub] if entity.sub else [])).distinct()
    sub = F.col(entity.sub) if entity.sub else F.lit(0)
    one = keys.select(F.col(entity.tenant).alias("tenant_id"), sub.cast("int").alias("sub_id"))
    null_id = F.lit(None).cast("bigint")
    parts = [one.select(F.lit(g).cast("bigint").alias("group_id"), "tenant_id", "sub_id", F.lit(g == 3).alias("delete_only"),
                        F.lit(str(a)).cast("timestamp_ntz").alias("previous_ts"), F.lit(str(b)).cast("timestamp_ntz").alias("target_ts"),
                        F.lit(False).alias("is_archived"), null_id.alias("current_id"), null_id.alias("target_id"))
             for g, a, b in ((1, lo, mid), (2, mid, hi))]
    after = {1: mid, 2: "2030-01-01 00:00:00"}
    groups = spark.createDataFrame([(g, 1, str(t), False, False, False, None, None, None) for g, t in after.items()],
                                   "group_id long, trigger_id long, t string, is_archived boolean, is_deleted boolean, is_synced boolean, first_id long, last_id long, id_count long")
    groups = groups.withColumn("delete_after", F.col("t").cast("timestamp_ntz")).drop("t")
    triggers = spark.createDataFrame([(1, "2020-01-01 00:00:00", False, False, False, False)],
                                     "trigger_id long, t string, is_archived boolean, is_finished boolean, is_dry_run boolean, is_error boolean")
    triggers = triggers.withColumn("trigger_time", F.col("t").cast("timestamp_ntz")).drop("t")
    store.create(source, "0", children, windows=parts[0].unionByName(parts[1]), groups=groups, triggers=triggers)
    whole = {t: store.rows(t, "0").count() for t in store.tables}
    assert archive_run(store, "0", "1", "2031-01-01 00:00:00")["rows"] > 0
    archived = ids(store.archived(None))
    assert len(archived) == len(set(archived)) and set(ids(store.source("1"))) | set(archived) >= set(ids(source))
    later = set(ids(store.ledger()))
    assert set(archived) - set(ids(store.source("1"))) == set(archived) - later and later
    for child in entity.children:
        parents = {r[0] for r in store.rows(child.name, "1").select(child.parent_id).distinct().collect()}
        gone = set(archived) - later
        assert not parents & gone
        copied = store.archived(None, child.name)
        assert {r[0] for r in copied.select(child.parent_id).distinct().collect()} <= set(archived)
        assert store.rows(child.name, "1").count() + copied.where(F.col(child.parent_id).isin(*gone)).count() == whole[child.name]
    purge_run(store, "1", "2", "2031-01-01 00:00:00")
    assert set(ids(store.source("2"))) == set(ids(source)) - set(archived)
    for child in entity.children:
        assert store.rows(child.name, "2").count() + store.archived(None, child.name).count() == whole[child.name]
    assert acknowledge_run(store, "2", "3", "2031-01-01 00:00:00") == {"groups": 1}
    assert archive_run(store, "3", "4", "2031-01-01 00:00:00") == {"windows": 0, "rows": 0}


def test_untouched_dates_are_not_rewritten(spark, store):
    archive_run(store, "0", "1", NOW)
    owners = {r.event_date: r.owner for r in read_run(spark, store.root, "manifest_source", "1").collect()}
    touched = {r[0] for r in read_run(spark, store.root, "selected", "1").where("no_delay").select("event_date").distinct().collect()}
    assert set(owners.values()) == {"0", "1"}
    assert all((day in touched) == (owner == "1") for day, owner in owners.items())


def test_archive_gains_columns(spark, folder):
    write_run(spark.createDataFrame([(1, "a")], "id long, x string"), folder, "t", "1")
    write_run(spark.createDataFrame([(2, "b", 5)], "id long, x string, y int"), folder, "t", "2")
    got = {r.id: r.y for r in read_table(spark, folder, "t").collect()}
    assert got == {1: None, 2: 5}


def test_simple_archive(spark, views, store):
    out = simple_archive_run(store, views.tenants, "0", "1", NOW, 3, retention_days=5, round_to_day=True)
    # the open generation 2 ends on the 21st, the new windows go on to the 26th without delay
    left = store.source("1")
    assert out["rows"] > 0
    assert left.where("ts >= timestamp_ntz'2024-01-21 00:00:00' AND ts < timestamp_ntz'2024-01-26 00:00:00'").count() == 0
    assert left.where("ts >= timestamp_ntz'2024-01-26 00:00:00'").count() == views.logs.where(
        "ts >= timestamp_ntz'2024-01-26 00:00:00'").count()
    log = read_table(spark, store.root, "messages").orderBy("seq").collect()
    assert [r.severity for r in log] == [10, 10, 10] and f"rows: {out['rows']} " in log[2].message


def test_simple_archive_needs_one_kind_of_date(views, store):
    with pytest.raises(ValueError):
        simple_archive_run(store, views.tenants, "0", "1", NOW, 3)


def test_violations_stop_a_trigger(spark, views, store):
    settings = spark.createDataFrame([(1, 4, False, 24, 0)], "tenant_id int, sub_id int, delete_only boolean, after_hours int, delay_hours int")
    found = spark.createDataFrame([(1, "J2"), (1, "T1"), (2, "J2")], "policy_id int, code string")
    before = store.control("windows", "0").count()
    assert not add_trigger(store, "0", "bad", 77, NOW, settings, found)
    assert store.control("windows", "bad").count() == before
    assert [r.is_error for r in store.control("triggers", "bad").where("trigger_id = 77").collect()] == [True]
    assert [(r.severity, r.message) for r in read_run(spark, store.root, "messages", "bad").collect()] == [(16, "policy has violations: J2, T1")]
    assert add_trigger(store, "0", "good", 78, NOW, settings, found.limit(0))
    assert [r.is_error for r in store.control("triggers", "good").where("trigger_id = 78").collect()] == [False]
    assert store.control("windows", "good").count() == before + 1


def repeating(spark, rows):
    return spark.createDataFrame(rows, "trigger_id long, parent_id long, t string, repeats boolean, repeat_hours int, u string").select(
        "trigger_id", "parent_id", F.col("t").cast("timestamp_ntz").alias("trigger_time"), "repeats", "repeat_hours",
        F.col("u").cast("timestamp_ntz").alias("repeat_until"), *[F.lit(False).alias(c) for c in ("is_archived", "is_finished", "is_dry_run", "is_error")])


def test_a_run_plans_its_repeats(spark, views, folder):
    """One run over ten days ends as runs every few days; the chain goes on where the last run stopped."""
    settings = spark.createDataFrame([(1, t, s, False, 24 * 4, 0) for t in range(25) for s in range(6)],
                                     "trigger_id long, tenant_id int, sub_id int, delete_only boolean, after_hours int, delay_hours int")
    ends = []
    for name, days in (("once", [30]), ("often", (23, 26, 30))):
        store = Store(spark, f"{folder}-{name}", LOGS)
        store.create(views.logs, "r0", triggers=repeating(spark, [(1, None, "2024-01-20 00:00:00", True, 24, None)]))
        before = "r0"
        for day in days:
            archive_run(store, before, f"r{day}", f"2024-01-{day} 12:00:00", settings=settings)
            before = f"r{day}"
        times = [str(r.trigger_time)[:10] for r in store.control("triggers", before).orderBy("trigger_id").collect()]
        assert times == [f"2024-01-{d}" for d in range(20, 32)]  # ten due repeats and the one the chain waits for
        open_ones = store.control("triggers", before).where("parent_id IS NOT NULL AND NOT is_archived").collect()
        assert [str(r.trigger_time)[:10] for r in open_ones] == ["2024-01-31"]
        parents = {r.trigger_id: r.parent_id for r in store.control("triggers", before).collect()}
        assert all(parents[t] == t - 1 for t in parents if t > 1)
        ends.append((ids(store.archived(None)), ids(store.source(before))))
    assert ends[0] == ends[1]
    assert ends[0][0] == ids(views.logs.where("ts < timestamp_ntz'2024-01-26 00:00:00'"))


def test_repeats_end_with_repeat_until_and_keep_to_their_chain(spark, views, folder):
    store = Store(spark, folder, LOGS)
    store.create(views.logs, "0", triggers=repeating(spark, [
        (1, None, "2024-01-10 00:00:00", True, 24, "2024-01-12 00:00:00"), (2, None, "2024-01-11 00:00:00", True, 100, None),
        (3, None, "2024-01-11 00:00:00", False, None, None), (4, None, "2024-02-11 00:00:00", True, 24, None)]))
    settings = spark.createDataFrame([(1, 1, 0, False, 24, 0), (2, 2, 0, False, 24, 0), (4, 4, 0, False, 24, 0)],
                                     "trigger_id long, tenant_id int, sub_id int, delete_only boolean, after_hours int, delay_hours int")
    assert add_repeats(store, "0", "1", "2024-01-15 00:00:00", settings) == 3
    triggers = store.control("triggers", "1")
    got = [(r.parent_id, str(r.trigger_time), r.valid_windows) for r in triggers.where("parent_id IS NOT NULL").orderBy("trigger_id").collect()]
    assert got == [(1, "2024-01-11 00:00:00", 1), (5, "2024-01-12 00:00:00", 1), (2, "2024-01-15 04:00:00", 1)]
    joined = store.control("windows", "1").join(store.control("groups", "1"), "group_id")
    assert sorted((r.trigger_id, r.tenant_id) for r in joined.collect()) == [(5, 1), (6, 1), (7, 2)]
    assert add_repeats(store, "1", "2", "2024-01-15 00:00:00", settings) == 0  # trigger 7 is not due yet
    assert add_repeats(store, "1", "3", "2024-01-16 00:00:00", settings) == 1
    assert add_repeats(store, "0", "1", "2024-01-15 00:00:00", settings) == 3  # again under its id, as after a crash
    assert store.control("triggers", "1").count() == 7


def test_objects_are_validated_before_a_run(spark, views, store, folder):
    broken = Store(spark, folder + "-broken", LOGS)
    broken.create(views.logs.withColumn("tenant_id", F.col("tenant_id").cast("string")).drop("machine_id"), "0",
                  windows=views.log_windows, groups=views.log_groups, triggers=views.log_triggers)
    out = archive_run(broken, "0", "1", NOW)
    assert out == {"windows": 0, "rows": 0, "violations": [("source", "TS2", "machine_id"), ("source", "TS3", "tenant_id")]}
    assert broken.control("windows", "1").count() == broken.control("windows", "0").count()
    assert ids(broken.source("1")) == ids(views.logs)
    assert [r.severity for r in read_run(spark, broken.root, "messages", "1").collect()] == [16, 16]
    assert archive_run(store, "0", "1", NOW)["rows"] > 0


def test_clean_up_run(spark, views, folder):
    store = Store(spark, folder, QUEUE_ITEMS, period="year")
    store.create(views.queue_items, "0", {c.name: getattr(views, c.name) for c in QUEUE_ITEMS.children})
    cutoff = "1995-06-01 00:00:00"
    old = views.queue_items.where(f"creation_time < timestamp_ntz'{cutoff}'")
    out = cleanup_run(store, "0", "dry", NOW, cutoff, dry_run=True)
    assert out["rows"] == old.count() and ids(store.source("dry")) == ids(views.queue_items)
    assert read_run(spark, store.root, "preview", "dry").agg(F.sum("row_count")).first()[0] == out["rows"]
    assert cleanup_run(store, "dry", "1", NOW, cutoff) == out
    left = set(ids(store.source("1")))
    assert left == set(ids(views.queue_items)) - set(ids(old))
    for child in QUEUE_ITEMS.children:
        expected = getattr(views, child.name).where(F.col(child.parent_id).isin(*left)).count()
        assert store.rows(child.name, "1").count() == expected > 0
    owners = {str(r.event_date)[:4]: r.owner for r in read_run(spark, store.root, "manifest_source", "1").collect()}
    assert all((year <= "1995") == (owner == "1") for year, owner in owners.items())
    assert cleanup_run(store, "1", "2", NOW, cutoff)["rows"] == 0 and set(ids(store.source("2"))) == left
