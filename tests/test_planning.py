"""Previous targets and requests against brute force."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ebbline.operators.sizing import prior_max
from ebbline.plans import windows as w

START = datetime(2024, 1, 1)


def test_prior_max_equals_brute_force(spark):
    rng = random.Random(7)
    # key 0 holds most rows; several rows share a trigger and do not see each other
    data = [(rng.choice([0, 0, 0, 1, 2]), rng.randrange(400), rng.randrange(1000)) for _ in range(1500)]
    df = spark.createDataFrame(data, "k int, n long, v int")
    got = sorted((r.k, r.n, r.v, -1 if r.p is None else r.p) for r in prior_max(df, ["k"], "n", "v", "p", bucket=16).collect())
    want = sorted((k, n, v, max([x for (j, m, x) in data if j == k and m < n], default=-1)) for k, n, v in data)
    assert got == want


def test_chain_of_triggers(spark):
    schema = "trigger_id long, trigger_time timestamp_ntz, tenant_id int, sub_id int, delete_only boolean, after_hours int, delay_hours int"
    rows = [(1, START, 1, 0, False, 0, 24), (2, START + timedelta(days=1), 1, 0, False, 0, 0),
            (3, START, 1, 0, False, 0, 0), (4, START + timedelta(days=2), 1, 0, False, 12, 0)]
    planned = w.plan_dates(spark.createDataFrame(rows, schema))
    none = spark.createDataFrame([], "tenant_id int, sub_id int, target_ts timestamp_ntz")
    got = {r.trigger_id: r for r in w.plan_windows(planned, none).collect()}
    assert set(got) == {1, 2, 4}  # 3 is behind 2
    assert got[1].previous_ts == datetime(1900, 1, 1)
    assert got[2].previous_ts == START and got[4].previous_ts == START + timedelta(days=1)
    counts = {r.trigger_id: (r.valid_windows, r.duplicate_windows) for r in w.plan_counts(planned, none).collect()}
    assert counts == {1: (1, 0), 2: (1, 0), 3: (0, 1), 4: (1, 0)}


def test_stored_windows_supersede(spark):
    schema = "trigger_id long, trigger_time timestamp_ntz, tenant_id int, sub_id int, delete_only boolean, after_hours int, delay_hours int"
    planned = w.plan_dates(spark.createDataFrame([(9, START, 1, 0, False, 0, 0), (9, START, 2, 0, False, 0, 0)], schema))
    stored = spark.createDataFrame([(1, 0, START), (2, 0, START - timedelta(hours=1))], "tenant_id int, sub_id int, target_ts timestamp_ntz")
    got = w.plan_windows(planned, stored).collect()
    assert [(r.tenant_id, r.previous_ts) for r in got] == [(2, START - timedelta(hours=1))]


def test_groups_are_numbered_newest_first(spark):
    df = spark.createDataFrame([(1, START), (1, START + timedelta(days=3)), (1, START), (2, START)],
                               "trigger_id long, delete_after timestamp_ntz")
    got = {(r.trigger_id, r.group_no): r.delete_after for r in w.plan_groups(df).collect()}
    assert got == {(1, 1): START + timedelta(days=3), (1, 2): START, (2, 1): START}


def test_history_without_a_past(spark):
    df = spark.createDataFrame([(1, None, 2)], "trigger_id long, history string, window_count long")
    assert w.run_history(df, "r", "2024-01-01 00:00:00").first().history == (
        '[{"runid":"r","message":"windows: 2","timestamp":"2024-01-01T00:00:00"}]')


def test_schedule_ends_at_until(spark):
    df = spark.createDataFrame([(1, START, True, 10, START + timedelta(hours=25)), (2, START, True, 10, START - timedelta(hours=1))],
                               "trigger_id long, trigger_time timestamp_ntz, repeats boolean, repeat_hours int, repeat_until timestamp_ntz")
    got = w.repeat_schedule(df).orderBy("repeat_no").collect()
    assert [r.trigger_time for r in got] == [START, START + timedelta(hours=10), START + timedelta(hours=20)]
