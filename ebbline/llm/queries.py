"""Registered queries of this package, each with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import (
    decontaminate, divergence, language_id, line_dedup, mixing, ngram_join, pii, rule_ensemble, sharding, token_files, topk, url_filters, whitening,
)
from ebbline.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_pii(spark, sf_dir):
    found = pii.find_pii(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


@query
def op2_url_filters(spark, sf_dir):
    return url_filters.judge(spark, table(spark, sf_dir, "pages")).drop("pattern")


@query
def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.LineIndex.build(spark, docs).dedup(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op4_mixing(spark, sf_dir):
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


@query
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(spark, docs, language_id.fit(spark, docs)).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_decontamination(spark, sf_dir):
    matcher = decontaminate.Matcher(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return matcher.judged().select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = rule_ensemble.fit(spark, docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(spark, table(spark, sf_dir, "documents"), n=3, t=90).select("doc_id", "n_shingles", F.col("component").alias("component_id"))


@query
def op9_token_files(spark, sf_dir):
    manifest = token_files.write_tokens(spark, table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)
    return token_files.read_tokens(spark, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_top_k(spark, sf_dir):
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), k=5, every=50)


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"), k=16)


@query
def op13_sharding(spark, sf_dir):
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=40)


ORACLES["op11_source_divergence"] = divergence.oracle()
ORACLES["op2_url_filters"] = url_filters.oracle()
