"""Incremental archive: the batch operators inside ``foreachBatch``.

Files are the increments. Each micro-batch writes its own run path in overwrite mode, so a
batch replayed after a restart replaces itself: exactly-once without a transaction. Late
rows are selected, not dropped: there is no event-time watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbline.entities import Entity
from ebbline.operators.archive import archive_rows, delete_ledger
from ebbline.operators.selection import WINDOW_TAGS, select_rows
from ebbline.operators.sizing import profile_windows
from ebbline.sources.store import read_table, run_label, write_run


def read_increments(spark: SparkSession, sf_dir: str, table: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet table as a stream of files; the table is a directory or a single file."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    static = spark.read.parquet(path)
    first = static.select("_metadata.file_path").first()
    reader = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", files_per_trigger)
    if first and first[0].endswith(f"/{table}.parquet"):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def archive_stream(rows: DataFrame, windows: DataFrame, entity: Entity, root: str) -> StreamingQuery:
    """Archive and ledger rows of the open windows until the source has no more files."""
    profile = profile_windows(windows)
    spark = windows.sparkSession

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        run = f"{batch_id:09d}"
        selected = select_rows(batch, windows, entity, profile=profile).persist()
        lo, hi = selected.agg(F.min(entity.id), F.max(entity.id)).first()
        if lo is not None:
            shape = selected.drop(*WINDOW_TAGS).withColumn("run_id", F.lit(""))
            in_range = F.col(entity.id).between(lo, hi) & (F.col("run_id") != run_label(run))
            known = read_table(spark, root, "archive", shape).where(in_range)
            write_run(archive_rows(selected, known, entity.id, WINDOW_TAGS), root, "archive", run)
            listed = read_table(spark, root, "ledger", spark.createDataFrame([], "group_id bigint, id bigint, run_id string"))
            listed = listed.where(F.col("id").between(lo, hi) & (F.col("run_id") != run_label(run)))
            write_run(delete_ledger(selected, listed, entity.id), root, "ledger", run)
        selected.unpersist()

    return (
        rows.writeStream.foreachBatch(one_batch).option("checkpointLocation", f"{root}/_progress")
        .trigger(availableNow=True).start())
