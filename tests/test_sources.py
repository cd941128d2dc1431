"""Contracts, archive shape and column mapping."""

import pytest
from pyspark.sql import functions as F

from ebbline.entities import STATUS_CONTRACT, contracts
from ebbline.sources import archive_table as at
from ebbline.sources import contract as ct
from ebbline.sources import inventory as inv

COLUMNS = ["id", "tenant_id", "message"]


def test_contract_codes(spark):
    want = ct.contract_rows(spark, "t", (("id", "bigint"), ("name", "string"), ("n", "int"))).unionByName(
        ct.contract_rows(spark, "empty", (("id", "bigint"),)))
    have = ct.schema_rows(spark, "t", spark.createDataFrame([], "ID bigint, n string, extra int"))
    got = {(r.table_name, r.name, r.code) for r in ct.contract_violations(have, want).collect()}
    assert got == {("t", "name", "TS2"), ("t", "n", "TS3"), ("empty", None, "TS1"), ("empty", "id", "TS2")}


def test_every_fixture_meets_its_contract(spark, views):
    for name, contract in contracts().items():
        if name.startswith("async_status"):
            continue
        have = ct.schema_rows(spark, name, getattr(views, name))
        assert ct.contract_violations(have, ct.contract_rows(spark, name, contract)).collect() == [], name


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id long")
    row = ct.key_checks(df, "t", ["id"]).first()
    assert (row.row_count, row.null_keys, row.duplicate_keys) == (5, 2, 1)


@pytest.mark.parametrize("exclude, codes", [
    (None, []), ("", []), ("nope", ["EX1"]), ("[1]", ["EX2"]), ('["ID"]', ["EX3"]), ('["x", "message"]', ["EX4"]), ('[" message "]', [])])
def test_exclude(exclude, codes):
    assert [c for c, _ in at.exclude_errors(COLUMNS, exclude, "id")] == codes


def test_projection_keeps_order(spark):
    df = spark.createDataFrame([], "b int, id long, a int")
    assert at.archive_projection(df, '["B"]', "id").columns == ["id", "a"]
    with pytest.raises(ValueError):
        at.archive_projection(df, '["id"]', "id")


def test_evolution(spark):
    old = spark.createDataFrame([(1,)], "id long")
    new = spark.createDataFrame([(2, 3)], "id long, a int")
    assert {(r.id, r.a) for r in at.evolve(old, new, "id").collect()} == {(1, None), (2, 3)}
    assert at.evolve(old, new, "id", update=False, ignore_missing=True).columns == ["id"]
    codes = lambda *a, **k: [c for c, _ in at.evolution_errors(*a, **k)]
    assert codes(new, old, "id", update=False) == ["TA4"]
    assert codes(new, None, "id", create=False) == ["TA2"]
    assert codes(old, new, "a") == ["TA7"]
    assert codes(spark.createDataFrame([], "id string"), old, "id") == ["TA3"]


@pytest.mark.parametrize("mapping, codes", [
    ("id=key, message=", []), ("=x", ["missing source"]), ("message=a, tenant_id=a", ["duplicate target"]),
    ("message=a, message=", ["mapped and removed", "mapped and removed"]), ("zzz=a", ["unknown source"])])
def test_mapping(mapping, codes):
    assert [c for c, _ in at.mapping_errors(COLUMNS, mapping, "id", copy_key=True)] == codes


def test_key_needs_permission(spark):
    df = spark.createDataFrame([(1, 2, "m")], "id long, tenant_id int, message string")
    assert [c for c, _ in at.mapping_errors(df.columns, "id=key", "id")] == ["key mapped"]
    assert at.map_columns(df, "[message] = [text]", "id").columns == ["tenant_id", "text"]


def test_validate_objects(spark, views):
    status = spark.createDataFrame([], "group_id bigint, is_deleted boolean")
    report = at.validate_objects(
        views.logs, views.logs.withColumn("id", F.col("id").cast("string")), status,
        ct.contract_rows(spark, "logs", contracts()["logs"]), ct.contract_rows(spark, "status", STATUS_CONTRACT), '["nope"]', "id")
    got = {(r.object, r.code) for r in report.collect()}
    assert got == {("status", "TS2"), ("archive", "EX4"), ("archive", "TA3")}


def test_bind_tables_and_usage(spark):
    frames = inv.bind_tables(spark, ["nation", "region"], "/root/testdata/sf0.001/#NAME#.parquet")
    usage = {r.table_name: r for r in inv.table_usage(frames).collect()}
    assert usage["nation"].row_count == 25 and usage["nation"].files == 1 and usage["region"].bytes > 0


def test_work_folder_follows_the_session(spark):
    from ebbline.session import work_dir

    root = spark.conf.get("spark.checkpoint.dir", None)
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and (not root or a.startswith(root))
