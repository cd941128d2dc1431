"""Helpers shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.session import work_dir

WHITE = r"\x20\x09-\x0D"
BROADCAST_ROWS = 1_000_000


def stage(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what is written inside: rows with arrays or whole texts are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more, their successors being written."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(spark: SparkSession, df: DataFrame, purpose: str, name: str = "row_id") -> DataFrame:
    """``stage`` with a row number that is written, and so never changes when a task is run again."""
    return stage(spark, df.withColumn(name, F.monotonically_increasing_id()), purpose)


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side of few narrow rows whose number was counted; else leave the join to the shuffle."""
    return F.broadcast(df) if rows <= bound else df


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that are kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_share(column: Column | str, seed: int) -> Column:
    """A repeatable number in [0, 1) for each value."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), column), 11)) / F.lit(float(1 << 53))


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.col(text))


def components(spark: SparkSession, edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the smallest node as component.

    Alternates the large-star and small-star steps, which keep every group linear in the number of
    edges, until the edges no longer change. Each round is written, so lineage stays short. Empty
    edges give an empty result; repeated edges and loops are ignored.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(pairs: DataFrame) -> DataFrame:
        """Every neighbour of a node, and the node, to the smallest of them."""
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return pairs.join(least, "a")

    current = stage(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose)
    before = None
    while True:
        large = star(both(current)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        linked = star(large)
        small_star = linked.select("b", "m").union(linked.select(F.col("a").alias("b"), "m")).where("b <> m").distinct()
        last, current = current, stage(spark, small_star.select(F.col("b").alias("a"), F.col("m").alias("b")), purpose)
        discard(spark, last)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def per_key(decided: DataFrame, copies: Column | str) -> DataFrame:
    """``doc_id, text_key, n_keep, n_rows`` from a decision ``copies`` on each row."""
    return decided.groupBy("doc_id", "text_key").agg(F.sum(copies).alias("n_keep"), F.count("*").alias("n_rows"))


def keep_copies(spark: SparkSession, docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` with each row as often as decided; all columns stay.

    ``decided(doc_id, text_key, n_keep, n_rows)`` has a row for each pair of id and text hash. Rows that
    share both cannot be told apart, so one of them stands for all where their number changes. Only
    decisions that change something take part in the join; it is broadcast behind a count.
    """
    changes = stage(spark, decided.where("n_keep <> n_rows").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("n_keep").alias("__keep"), F.col("n_rows").alias("__rows")), "changes")
    total = changes.agg(F.count("*").alias("n"), F.coalesce(F.max("__rows"), F.lit(0)).alias("most")).first()
    if not total.n:
        return docs
    held = docs.withColumn("__text_key", text_key())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    joined = held.join(small(changes, total.n), same, "left")
    single = joined.where("__rows is null or __rows = 1")
    if total.most > 1:
        single = single.union(joined.where("__rows > 1").dropDuplicates(["doc_id", "__text_key"]))
    often = F.coalesce(F.col("__keep"), F.lit(1)).cast("int")
    again = single.where(often > 0).withColumn("__copy", F.explode(F.array_repeat(F.lit(0), often)))
    return again.select(*[docs_column(c) for c in docs.columns])


def docs_column(name: str) -> Column:
    return F.col(f"`{name}`")
