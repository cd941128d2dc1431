"""Corpus pipeline: documents -> quality -> near duplicates -> decontamination -> mix -> token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import decontaminate, mixing, ngram_join, rule_ensemble, token_files
from ebbline.llm.common import docs_column, keep_copies, per_key, stage
from ebbline.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rule ensemble scores 0.5 or more; the ensemble is fitted on the labels of the stage's own input."""
    model = rule_ensemble.fit(spark, docs, table(spark, sf_dir, "labels"))
    held, name = rule_ensemble.with_statistics(docs)
    return held.where(model.score(name) >= 0.5).select(*map(docs_column, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8; the smallest id stays.

    Documents without words are in no group and stay.
    """
    joined = stage(spark, ngram_join.ngram_join(spark, docs, n=5, t=80), "groups")
    keys = joined.groupBy("doc_id", "text_key", "grp").agg(F.count("*").alias("n_rows"))
    first = keys.where("grp is not null").groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    kept = F.when(F.col("grp").isNull(), F.col("n_rows")).when(is_first, 1).otherwise(0)
    return keep_copies(spark, docs, keys.join(first, "grp", "left").select("doc_id", "text_key", kept.alias("n_keep"), "n_rows"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie inside benchmark passages."""
    judged = decontaminate.Matcher(spark, docs, table(spark, sf_dir, "benchmark")).judged()
    return keep_copies(spark, docs, per_key(judged, F.when(F.col("contaminated"), 0).otherwise(1)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: up to three times, or not at all."""
    return keep_copies(spark, docs, per_key(mixing.mix(spark, docs), "copies"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row for each document in them."""
    manifest = token_files.write_tokens(spark, docs, tokenizer_path(), end_id=1)
    return token_files.read_tokens(spark, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix), ("tokens", tokens)]
# The trained classifier, the seeded draw and the tokenizer are not SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
