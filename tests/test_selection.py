"""Window edges, late rows and the two join paths."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbline.entities import AUDIT_LOGS, JOBS, LOGS, QUEUE_ITEMS
from ebbline.operators import selection as s
from ebbline.operators import sizing

PREV, TARGET = datetime(2024, 1, 11), datetime(2024, 1, 21)
WINDOW = ("trigger_id long, group_id long, tenant_id int, sub_id int, delete_only boolean, no_delay boolean, "
          "previous_ts timestamp_ntz, target_ts timestamp_ntz, current_id long, target_id long, last_id long")


def window(spark, last_id=None, current_id=None, tenant=1, sub=4, prev=PREV, target=TARGET, group=1):
    return spark.createDataFrame([(1, group, tenant, sub, False, False, prev, target, current_id, None, last_id)], WINDOW)


def rows(spark, entity, data):
    return spark.createDataFrame(data, f"id long, tenant_id int, {entity.sub} int, {entity.time} timestamp_ntz")


EDGE = [(1, 1, 4, PREV), (2, 1, 4, TARGET), (3, 1, 4, datetime(2024, 1, 15)), (4, 1, 4, datetime(2024, 1, 1)),
        (5, 1, 4, None), (6, None, 4, datetime(2024, 1, 15)), (7, 2, 4, datetime(2024, 1, 15))]


@pytest.mark.parametrize("entity, expected", [(LOGS, {1, 3}), (JOBS, {2, 3}), (QUEUE_ITEMS, {1, 3})])
def test_closed_side(spark, entity, expected):
    got = s.select_rows(rows(spark, entity, EDGE), window(spark), entity)
    assert {r.id for r in got.collect()} == expected


@pytest.mark.parametrize("entity, expected", [(LOGS, {1, 3, 4}), (JOBS, {2, 3, 4}), (QUEUE_ITEMS, {1, 3})])
def test_late_rows_need_an_id_past_the_marker(spark, entity, expected):
    got = s.select_rows(rows(spark, entity, EDGE), window(spark, last_id=3), entity).collect()
    assert {r.id for r in got} == expected
    assert {r.id for r in got if r.is_late} == expected - {1, 2, 3}


def test_all_rows_late(spark):
    data = [(i, 1, 4, datetime(2024, 1, 2)) for i in range(10, 20)]
    got = s.select_rows(rows(spark, LOGS, data), window(spark, last_id=14), LOGS)
    assert sorted(r.id for r in got.collect()) == [15, 16, 17, 18, 19]


def test_own_cursor_and_watermark(spark):
    data = [(i, 1, 4, datetime(2024, 1, 12)) for i in range(10)]
    got = s.select_rows(rows(spark, LOGS, data), window(spark, current_id=4), LOGS, watermark=7)
    assert sorted(r.id for r in got.collect()) == [4, 5, 6, 7]


def test_no_windows_select_nothing(spark):
    got = s.select_rows(rows(spark, LOGS, EDGE), window(spark).limit(0), LOGS)
    assert got.count() == 0


def test_salted_join_equals_broadcast(spark, views, monkeypatch):
    """Past the broadcast bound the windows are salted; one key holds a third of the rows."""
    logs = views.logs.withColumn("tenant_id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("tenant_id")))
    windows = views.log_windows.where(~F.col("is_archived")).select(
        F.lit(2).alias("trigger_id"), "*", F.lit(False).alias("no_delay"), F.lit(100).cast("long").alias("last_id"))
    broadcast = s.select_rows(logs, windows, LOGS)
    want = sorted((r.id, r.group_id, r.is_late) for r in broadcast.collect())
    monkeypatch.setattr(sizing, "MAX_BROADCAST_WINDOWS", 3)
    salted = s.select_rows(logs, windows, LOGS)
    assert sorted((r.id, r.group_id, r.is_late) for r in salted.collect()) == want
    assert len(want) > 100


def test_a_row_has_one_window(views):
    from workload.archive import log_selection

    chosen = log_selection(views)
    assert chosen.count() == chosen.select("id").distinct().count() > 0


def test_budget_slices_cover_every_id_once(spark, views):
    logs = views.logs
    slices = sizing.budget_slices(logs, "id", 100, cells=64)
    assert len(slices) > 5
    assert all(a[1] < b[0] for a, b in zip(slices, slices[1:]))
    covered = sum(logs.where(F.col("id").between(a, b)).count() for a, b in slices)
    assert covered == logs.count()
    assert sizing.budget_slices(logs.limit(0), "id", 10) == []


def test_every_open_window_is_taken_in_order(views):
    rows = s.open_windows(views.c_window_rows, views.c_groups, views.c_triggers, "1999-01-01 00:00:00").collect()
    assert len(rows) > 500
    keys = {}
    for r in rows:
        keys.setdefault((r.tenant_id, r.sub_id), []).append((r.target_ts, r.group_id, r.order_no))
    assert all([n for _, _, n in sorted(v)] == list(range(1, len(v) + 1)) for v in keys.values())


def overlapping(spark, n, draw):
    """Windows of a few keys that lie on top of each other, some twice, some empty, some without bounds or key."""
    at = lambda: datetime(2024, 1, 1) + timedelta(hours=draw.randint(0, 24 * 40))
    data = [(i % 7, 1, draw.choice((1, 1, 2, None)), draw.choice((3, 4)), draw.random() < 0.5, False, draw.choice((datetime(1900, 1, 1), at())),
             draw.choice((at(), at(), at(), None))) for i in range(n)]
    return spark.createDataFrame(data + data[:5], WINDOW.partition(", current_id")[0])


@pytest.mark.parametrize("entity", [LOGS, JOBS, AUDIT_LOGS])
def test_counts_by_pieces_equal_those_of_pairs(spark, entity):
    draw = random.Random(3)
    windows = overlapping(spark, 120, draw)
    if not entity.sub:
        windows = windows.withColumn("sub_id", F.lit(0))
    data = [(i, draw.choice((1, 1, 2, 3, None)), draw.choice((3, 4)), datetime(2024, 1, 1) + timedelta(hours=draw.randint(-50, 1000))) for i in range(400)]
    source = spark.createDataFrame([*data, (400, 1, 4, None)], f"id long, tenant_id int, {entity.sub or 'other'} int, {entity.time} timestamp_ntz")
    by = ["trigger_id", "tenant_id", "delete_only"]
    pairs = s.select_rows(source, windows, entity).groupBy(*by).agg(F.count("*").alias("row_count"))
    pieces = s.window_pieces(windows, entity)
    chosen = s.select_rows(source, pieces, entity)
    assert sorted(chosen.select("id").collect()) == sorted(s.select_rows(source, windows, entity).select("id").distinct().collect())
    want = sorted(map(tuple, pairs.collect()))
    assert sorted(map(tuple, s.count_by_window(chosen, pieces, windows, entity, by).collect())) == want and len(want) > 10


def test_windows_with_a_marker_or_cursor_have_no_pieces(spark):
    with pytest.raises(ValueError, match="current_id, last_id"):
        s.window_pieces(window(spark), LOGS)


def test_flagship_selects_a_row_once_for_all_policies(spark, tmp_path, monkeypatch):
    """Selected rows grow with the logs, not with logs times policies."""
    from workload import archive
    from workload.registry import QUERIES

    nation = [(0, "NATION_0", 0), (1, "NATION_1", 1), (2, "NATION_2", 4)]
    spark.createDataFrame(nation, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    # keys 1 + 36 n take the template of one tenant and all levels, with other hours each
    spark.createDataFrame([(1 + 36 * n, 1) for n in range(30)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, datetime(2024, 1, 1), 1, "view", 1.0, "x") for i in range(1, 21)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    monkeypatch.setattr(archive.s, "select_rows", lambda *a, f=s.select_rows, **b: seen.append(f(*a, **b)) or seen[-1])
    got = {(r.policy_id, r.tenant_id, r.level_id, r.delete_only, r.row_count) for r in QUERIES["flagship"](spark, str(tmp_path)).collect()}
    assert got == {(1 + 36 * n, 1, 0, False, 20) for n in range(30)}
    assert [df.count() for df in seen] == [20]
