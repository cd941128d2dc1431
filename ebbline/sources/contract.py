"""Source contracts: expected columns and types, key checks, schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_ROW = "table_name string, position int, name string, type string"


def schema_rows(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Columns of a DataFrame as rows; metadata only, no job."""
    rows = [(table, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, COLUMN_ROW)


def contract_rows(spark: SparkSession, table: str, contract) -> DataFrame:
    return spark.createDataFrame([(table, i, n, t) for i, (n, t) in enumerate(contract)], COLUMN_ROW)


def contract_violations(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """TS1 no columns at all, TS2 expected column missing, TS3 wrong type. Names in any case."""
    have = actual.select("table_name", F.lower("name").alias("name"), F.col("type").alias("actual"))
    want = expected.select("table_name", F.lower("name").alias("name"), F.col("type").alias("expected"))
    none = want.select("table_name").distinct().join(have.select("table_name").distinct(), "table_name", "left_anti").select(
        "table_name", F.lit(None).cast("string").alias("name"), F.lit("TS1").alias("code"))
    both = want.join(have, ["table_name", "name"], "left")
    code = F.when(F.col("actual").isNull(), "TS2").when(F.col("actual") != F.col("expected"), "TS3")
    return none.unionByName(both.select("table_name", "name", code.alias("code")).where(F.col("code").isNotNull()))


def key_checks(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Rows, NULL keys and duplicate keys of a table in one shuffle on the key.

    Grouped by the key itself, which is spread, then summed; NULL keys are one group but
    arrive pre-aggregated.
    """
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in key]) if len(key) > 1 else F.col(key[0]).isNull().cast("int")
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).withColumn("null_key", null_key)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("null_key") == 1, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("null_key") == 0) & (F.col("n") > 1)).alias("duplicate_keys"),
    ).select(F.lit(table).alias("table_name"), "row_count", "null_keys", "duplicate_keys")


def schema_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns on one side only, with the side."""
    cols = ["name", "type"]
    return (left.select(*cols).exceptAll(right.select(*cols)).withColumn("side", F.lit("left"))
            .unionByName(right.select(*cols).exceptAll(left.select(*cols)).withColumn("side", F.lit("right"))))
