"""The incremental archive: a stream over the event files must equal the batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbline.entities import LOGS
from ebbline.session import work_dir
from ebbline.sources.store import read_table
from ebbline.streaming.incremental import archive_stream, read_increments
from workload.archive import LOG_SELECTED, log_batch
from workload.fixtures import as_logs
from workload.registry import query

# a stream has no closing watermark: every row of a file that arrived is a candidate
STREAM_SELECTED = LOG_SELECTED.replace("l.id <= (SELECT MAX(id) FROM $logs WHERE ts <= @'2024-01-21 00:00:00')", "true")


@query(f"""WITH {STREAM_SELECTED}
    SELECT 'archive' AS kind, id FROM sel WHERE NOT delete_only UNION ALL SELECT 'ledger', id FROM sel WHERE NOT no_delay""")
def stream_archive(t):
    root = work_dir(t.spark, "stream")
    windows = log_batch(t)
    rows = as_logs(read_increments(t.spark, t.sf_dir, "events", files_per_trigger=8))
    archive_stream(rows, windows, LOGS, root).awaitTermination()
    archived = read_table(t.spark, root, "archive").select(F.lit("archive").alias("kind"), "id")
    return archived.unionByName(read_table(t.spark, root, "ledger").select(F.lit("ledger").alias("kind"), "id"))
