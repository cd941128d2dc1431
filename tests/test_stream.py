"""The incremental archive equals the batch, in any file order and after a restart."""

import pytest
from pyspark.sql import functions as F

from ebbline.entities import LOGS
from ebbline.operators.selection import select_rows
from ebbline.sources.store import read_table
from ebbline.streaming.incremental import archive_stream, read_increments
from workload.archive import log_batch
from workload.fixtures import as_logs


@pytest.fixture
def windows(spark, views, folder):
    log_batch(views).write.parquet(f"{folder}/w")
    return spark.read.parquet(f"{folder}/w")


def expected(views, windows):
    rows = select_rows(views.logs, windows, LOGS)
    return (sorted(r.id for r in rows.where("NOT delete_only").collect()),
            sorted(r.id for r in rows.where("NOT no_delay").collect()))


def result(spark, root):
    return (sorted(r.id for r in read_table(spark, root, "archive").collect()),
            sorted(r.id for r in read_table(spark, root, "ledger").collect()))


@pytest.mark.parametrize("order", ["event_id", "-event_id", "hash"])
def test_stream_equals_batch(spark, views, windows, folder, order):
    key = {"event_id": F.col("event_id"), "-event_id": -F.col("event_id"), "hash": F.xxhash64("event_id")}[order]
    views.events.repartitionByRange(5, key).write.parquet(f"{folder}/in/events.parquet")
    archive_stream(as_logs(read_increments(spark, f"{folder}/in", "events")), windows, LOGS, f"{folder}/out").awaitTermination()
    assert result(spark, f"{folder}/out") == expected(views, windows)


def test_restart_adds_only_new_files(spark, views, windows, folder):
    events, source, out = views.events, f"{folder}/in/events.parquet", f"{folder}/out"
    events.where("event_id % 2 = 0").coalesce(2).write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        archive_stream(as_logs(read_increments(spark, f"{folder}/in", "events")), windows, LOGS, out).awaitTermination()
    half = result(spark, out)
    assert len(half[0]) == len(set(half[0]))
    # the other half and a repeat of rows that are archived already
    events.where("event_id % 2 = 1 OR event_id % 10 = 0").coalesce(3).write.mode("append").parquet(source)
    archive_stream(as_logs(read_increments(spark, f"{folder}/in", "events")), windows, LOGS, out).awaitTermination()
    assert result(spark, out) == expected(views, windows)
