"""Run-scoped Parquet writes.

Every output of a run goes to a path holding that run only, in overwrite mode: a run that
is repeated after a crash replaces its own files and nothing else. No table is written
while it is being read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

MAX_RECORDS_PER_FILE = 5_000_000


def run_label(run_id: str | int) -> str:
    """Value of the ``run_id`` partition; never numeric, so it is always read back as text."""
    return f"r-{run_id}"


def run_path(root: str, table: str, run_id: str | int) -> str:
    return f"{root.rstrip('/')}/{table}/run_id={run_label(run_id)}"


def write_run(df: DataFrame, root: str, table: str, run_id: str | int, partition_by: list[str] | None = None) -> str:
    """Write one run of a table; the partition columns get whole files, not one per task.

    ``REBALANCE`` lets AQE split a date that holds most rows and merge the small ones.
    """
    path = run_path(root, table, run_id)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, root: str, table: str, like: DataFrame | None = None) -> DataFrame:
    """All runs of a table, schemas merged; empty like ``like`` when nothing was written yet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{table}")
    except AnalysisException as error:
        if like is not None and error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return like.limit(0)
        raise


def read_run(spark: SparkSession, root: str, table: str, run_id: str | int) -> DataFrame:
    return spark.read.parquet(run_path(root, table, run_id))
