"""Sets of whole-number ids as words of 64 bits: exact, and up to 64 ids in a row of two numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, ShortType


def word_of(key: str) -> Column:
    return F.shiftright(F.col(f"`{key}`").cast("bigint"), 6)


def bit_of(key: str) -> Column:
    return F.expr(f"shiftleft(1L, cast(cast(`{key}` as bigint) & 63 as int))")


def packs(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (LongType, IntegerType, ShortType))


def id_words(ids: DataFrame, key: str, *by: str) -> DataFrame:
    """``by, word, bits`` of the ids; combined before the shuffle, so neighbouring ids travel as one row."""
    return ids.where(F.col(f"`{key}`").isNotNull()).groupBy(*by, word_of(key).alias("word")).agg(F.bit_or(bit_of(key)).alias("bits"))


def expanded(words: DataFrame, key: str, bits: str = "bits") -> DataFrame:
    """``words`` once for each id in ``bits``, in column ``key``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col(bits).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)) != 0)
    return words.withColumn("_place", F.explode(places)).withColumn(key, F.call_function("shiftleft", F.col("word"), F.lit(6)) + F.col("_place")).drop("_place")


def not_in_words(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """``rows`` whose id is not in the set ``words(word, bits)``; rows without id stay."""
    held = words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    joined = rows.withColumn("_own", word_of(key)).join(held, F.col("_own") == F.col("_word"), "left")
    free = F.col("_bits").isNull() | (F.col("_bits").bitwiseAND(bit_of(key)) == 0)
    return joined.where(free).drop("_own", "_word", "_bits")


def not_in(rows: DataFrame, key: str, others: DataFrame, other_key: str | None = None) -> DataFrame:
    """``rows`` whose id is not among those of ``others``: by words where ids are whole numbers, else by an anti join."""
    other_key = other_key or key
    if packs(rows, key) and packs(others, other_key):
        return not_in_words(rows, key, id_words(others, other_key))
    return rows.join(others.select(F.col(other_key).alias(key)), key, "left_anti")
