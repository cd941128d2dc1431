"""Interval index, id sets as bit words, gram index, exact slices, chains and incremental roll-ups."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbline.entities import LOGS
from ebbline.functions.lookups import gram_candidates, like_matches
from ebbline.operators import idsets, intervals, rollup, sizing
from ebbline.operators import selection as s
from ebbline.plans import windows as w
from ebbline.plans.policy import PolicyCompiler
from tests.conftest import plan


# ---- interval index ----------------------------------------------------------------------------
def test_cover_holds_each_day_once_in_few_cells(spark):
    draw = random.Random(1)
    cases = [(a, a + draw.choice((0, 1, 6, 7, 8, 63, 64, 500, 40_000))) for a in [draw.randint(0, 90_000) for _ in range(150)]]
    df = spark.createDataFrame(cases, "lo int, hi int").select("lo", "hi", intervals.cover(F.col("lo"), F.col("hi")).alias("c"))
    for r in df.collect():
        days = sorted(d for c in r.c for d in range(c.cell * 8 ** c.level, (c.cell + 1) * 8 ** c.level))
        assert days == list(range(r.lo, r.hi + 1))
        assert len(r.c) <= 14 * intervals.LEVELS


def many(spark, n, late=None):
    start = datetime(1900, 1, 1)
    data = [(1, g, 1, 4, False, False, start + timedelta(days=30 * g), start + timedelta(days=30 * (g + 1)), None, None, late if g == 0 else None) for g in range(n)]
    return spark.createDataFrame(data, "trigger_id long, group_id long, tenant_id int, sub_id int, delete_only boolean, no_delay boolean, "
                                 "previous_ts timestamp_ntz, target_ts timestamp_ntz, current_id long, target_id long, last_id long")


def logs(spark, n):
    draw = random.Random(2)
    data = [(i, 1, 4, datetime(1899, 1, 1) + timedelta(hours=draw.randint(0, 24 * 365 * 26))) for i in range(n)] + [(n, 1, 4, None)]
    return spark.createDataFrame(data, "id long, tenant_id int, level_id int, ts timestamp_ntz")


@pytest.mark.parametrize("cells", [80_000, 0])
def test_indexed_selection_equals_the_direct_one(spark, monkeypatch, cells):
    windows, rows = many(spark, 300, late=150), logs(spark, 400)
    monkeypatch.setattr(sizing, "MAX_DIRECT_WINDOWS", 1000)
    want = sorted((r.id, r.group_id, r.is_late) for r in s.select_rows(rows, windows, LOGS).collect())
    monkeypatch.setattr(sizing, "MAX_DIRECT_WINDOWS", 0)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_WINDOWS", cells // 8)
    got = s.select_rows(rows, windows, LOGS)
    assert sorted((r.id, r.group_id, r.is_late) for r in got.collect()) == want
    assert len(want) > 200 and any(x[2] for x in want)
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("windows", [50, 700])
def test_rows_meet_a_constant_number_of_windows(spark, windows):
    """Rows tested per row: at most two windows share a day, whatever the number of windows of the key."""
    rows, true = logs(spark, 300), F.lit(True)
    met = intervals.indexed_join(rows, many(spark, windows).withColumnsRenamed({"tenant_id": "_t"}), [("tenant_id", "_t")], "ts", "previous_ts", "target_ts",
                                 true, None, None, "id", 10 ** 6)
    assert max(r["count"] for r in met.groupBy("id").count().collect()) <= 2


# ---- id sets -----------------------------------------------------------------------------------
def test_not_in_is_exact(spark):
    draw = random.Random(3)
    held = {draw.randint(-500, 500) for _ in range(300)} | {2 ** 62, -2 ** 62, 63, 64, -1, 0}
    ids = list(range(-600, 600)) + [2 ** 62, 2 ** 62 + 1, -2 ** 62, -2 ** 62 + 1, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    other = spark.createDataFrame([(i,) for i in held] * 3 + [(None,)], "id long")
    assert {r.id for r in idsets.not_in(rows, "id", other).collect()} == set(ids) - held
    words = idsets.id_words(other, "id")
    assert {r.i for r in idsets.expanded(words, "i").collect()} == held
    assert words.count() < len(held) / 4
    text = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert {r.id for r in idsets.not_in(text, "id", text.where("id = 'a'")).collect()} == {"b", None}


# ---- grams -------------------------------------------------------------------------------------
PATTERNS = ["%needle%", "%a_b%", "%_1", "%", "%%", "%_%", "%zzz", "%ha%ys%", "%\\%", "%é%", "ha%", "%NEEDLE%", "%ab%", "_a%"]


def test_headless_patterns_match_like_and_meet_few_names(spark):
    words = [f"haystack{i}" for i in range(200)] + ["xneedley", "a1b", "A_B", "x1", "11", "", "é", "back\\slash%", "zzz"]
    names = spark.createDataFrame(list(enumerate(words)), "id int, name string")
    patterns = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    import re
    got = {(r.pattern, r.name) for r in like_matches(patterns, names, "name").collect()}
    want = set()
    for p in PATTERNS:
        rule = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in p), re.S)
        want |= {(p, n) for n in words if rule.fullmatch(n.lower())}
    assert got == want
    met = {r.pattern: r["count"] for r in gram_candidates(patterns.where("pattern in ('%needle%', '%zzz', '%a_b%')"), names, "name").groupBy("pattern").count().collect()}
    assert met["%needle%"] == 1 and met["%zzz"] == 1 and met["%a_b%"] < 10


# ---- exact slices ------------------------------------------------------------------------------
@pytest.mark.parametrize("cells,width", [(1, 7), (5, 3), (4096, 65536)])
def test_exact_slices(spark, cells, width):
    ids = sorted({int(x ** 3) for x in range(40)} | set(range(5000, 5200)) | {-50, 10 ** 9})
    got = sorted(sizing.exact_slices(spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long"), "id", 17, cells, width).collect())
    want = [(n, ids[i], ids[min(i + 16, len(ids) - 1)], len(ids[i:i + 17])) for n, i in enumerate(range(0, len(ids), 17))]
    assert [tuple(r) for r in got] == want


# ---- chains ------------------------------------------------------------------------------------
def test_a_long_chain_takes_few_rounds(spark):
    from ebbline.session import work_dir
    rounds = []

    def written(df):
        path = work_dir(spark, "chain")
        df.write.parquet(path)
        rounds.append(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = [(i, i - 1 if i > 1 else None, i < 200) for i in range(1, 201)] + [(500, 499, True), (501, 500, True), (600, 700, False)]
    triggers = spark.createDataFrame(rows, "trigger_id long, parent_id long, is_finished boolean").withColumn("trigger_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    roots = w.chain_roots(triggers, written)
    got = {r.root_id: (r.triggers, r.is_finished, r.unfinished) for r in w.chain_status(triggers, roots).collect()}
    assert got == {1: (200, False, 1), 500: (2, True, 0), 600: (1, False, 1)}
    assert len(rounds) <= 11


def test_repeats_of_one_run_equal_repeats_of_many(spark):
    base = [(1, None, datetime(2024, 1, 1), 24, datetime(2024, 1, 9), True), (2, None, datetime(2024, 1, 1), 100, None, True),
            (3, None, datetime(2024, 1, 1), 24, None, False), (4, 3, datetime(2024, 1, 2), 24, datetime(2024, 1, 2), True)]
    triggers = spark.createDataFrame(base, "trigger_id long, parent_id long, trigger_time timestamp_ntz, repeat_hours int, repeat_until timestamp_ntz, repeats boolean")
    for flag in ("is_archived", "is_finished", "is_dry_run", "is_error"):
        triggers = triggers.withColumn(flag, F.lit(False))
    got = sorted((r.root_id, r.repeat_no, r.trigger_time, r.is_last) for r in w.repeat_chain(triggers, "2024-01-10 00:00:00").collect())
    ones = [(1, n, datetime(2024, 1, 1 + n), n == 8) for n in range(1, 9)]
    assert got == ones + [(2, 1, datetime(2024, 1, 5, 4), False), (2, 2, datetime(2024, 1, 9, 8), True)]


# ---- roll-ups ----------------------------------------------------------------------------------
def test_partials_after_a_delete_read_only_groups_that_lost_an_edge(spark):
    ledger = spark.createDataFrame([(1, i) for i in range(10)] + [(2, i) for i in range(100, 110)] + [(3, 7)], "group_id long, id long")
    removed = ledger.where("id in (0, 1, 105, 7) and not (group_id = 1 and id = 7)")
    left = ledger.join(removed, ["group_id", "id"], "left_anti")
    untouched = left.where("group_id <> 2")  # group 2 lost no edge: its rows must not be needed
    got = sorted(map(tuple, rollup.partials_after_delete(rollup.ledger_partials(ledger), removed, untouched).collect()))
    assert got == [(1, 2, 9, 8), (2, 100, 109, 9)]
    halves = rollup.merge_partials(rollup.ledger_partials(ledger.where("id % 2 = 0")), rollup.ledger_partials(ledger.where("id % 2 = 1")))
    assert sorted(map(tuple, halves.collect())) == sorted(map(tuple, rollup.ledger_partials(ledger).collect()))


# ---- tenant sets -------------------------------------------------------------------------------
def test_policy_holds_tenants_as_words_until_the_settings(spark):
    tenants = spark.createDataFrame([(i, f"t{i}", i % 10 == 0) for i in range(1000)], "tenant_id int, name string, is_deleted boolean")
    doc = '[{"tenants": "#OTHER_TENANTS#", "levels": [{"archive": "all"}]}, {"tenants": ["t1*"], "exclude": 17, "levels": [{"archive": "error"}]}]'
    policies = spark.createDataFrame([(1, 5, 0, doc)], "policy_id int, after_hours int, delay_hours int, doc string")
    compiled = PolicyCompiler(policies, tenants)
    assert compiled.rule_words.count() <= 2 * (1000 // 64 + 1)
    starts = {i for i in range(1000) if f"t{i}".startswith("t1") and i % 10 and i != 17}
    others = {i for i in range(1000) if i % 10} - starts
    got = {(r.tenant_id, r.sub_id) for r in compiled.settings.collect()}
    assert got == {(i, 4) for i in starts} | {(i, n) for i in others for n in range(6)}
