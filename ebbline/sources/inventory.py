"""What is stored: catalogue inventory, table usage, space totals. File facts come from ``_metadata``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_inventory(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Listed tables: exists, valid (every expected column is there), columns as JSON.

    Lists hold one table's columns, so they are short.
    """
    want = expected.groupBy("table_name").agg(F.collect_set(F.lower("name")).alias("wanted"))
    have = actual.groupBy("table_name").agg(
        F.collect_set(F.lower("name")).alias("found"),
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("position", "name", "type"))),
                              lambda c: F.struct(c["name"].alias("column"), c["type"].alias("type")))).alias("columns"))
    joined = want.join(have, "table_name", "left")
    return joined.select(
        "table_name", F.col("found").isNotNull().alias("table_exists"),
        F.coalesce(F.size(F.array_except("wanted", "found")) == 0, F.lit(False)).alias("is_valid"), "columns")


def file_usage(table: str, df: DataFrame) -> DataFrame:
    """Rows and bytes per file; no data column is read, so the counts come from file footers."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.max("_metadata.file_size").alias("file_bytes"), F.count(F.lit(1)).alias("row_count"),
    ).select(F.lit(table).alias("table_name"), "file_path", "file_bytes", "row_count")


def table_usage(tables: dict[str, DataFrame]) -> DataFrame:
    """Files, rows, bytes and bytes per row of each table, largest first."""
    files = reduce(DataFrame.unionByName, [file_usage(n, d) for n, d in tables.items()])
    return files.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"), F.sum("file_bytes").alias("bytes"),
    ).withColumn("bytes_per_row", F.round(F.col("bytes") / F.col("row_count"), 2)).orderBy(F.desc("bytes"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [d.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
               for n, d in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def space_totals(usage: DataFrame) -> DataFrame:
    """Totals over all tables and the share of the largest, from the per-table rows."""
    return usage.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("files").alias("files"), F.sum("row_count").alias("row_count"),
        F.sum("bytes").alias("bytes"), F.max_by("table_name", "bytes").alias("largest_table"),
        F.max("bytes").alias("largest_bytes"),
    ).withColumn("megabytes", (F.col("bytes") / F.lit(1024 * 1024)).cast("decimal(18,4)"))


def bind_tables(spark: SparkSession, names: list[str], pattern: str) -> dict[str, DataFrame]:
    """Readers for every listed table; ``#NAME#`` in the path pattern is the table name."""
    return {n: spark.read.parquet(pattern.replace("#NAME#", n)) for n in names}
