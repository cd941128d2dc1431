"""Name lookups against small dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.entities import LOG_LEVELS
from ebbline.functions.expressions import like


def dictionary_id(text: Column, names: dict[int, str] | tuple[tuple[int, str], ...]) -> Column:
    """Id for an id written as text or for a name in any case; NULL when unknown.

    The dictionary is a handful of fixed values, so it travels as a map literal and
    the lookup stays inside the projection: no join.
    """
    pairs = dict(names)
    word = F.lower(F.trim(text))
    by_name = F.create_map(*[x for i, n in pairs.items() for x in (F.lit(n), F.lit(i))])
    as_id = word.try_cast("int")
    return F.when(as_id.isin(*pairs), as_id).otherwise(F.try_element_at(by_name, word))


def level_id(text: Column) -> Column:
    return dictionary_id(text, LOG_LEVELS)


def _masked(text: Column, mask: Column) -> Column:
    """``text`` with ``_`` wherever the mask has one."""
    places = F.sequence(F.lit(1), F.length(mask))
    chars = F.transform(places, lambda i: F.when(F.substr(mask, i, F.lit(1)) == "_", F.lit("_")).otherwise(
        F.substr(text, i, F.lit(1))))
    return F.when(F.length(mask) == 0, F.lit("")).otherwise(F.array_join(chars, ""))


def _runs(pattern: Column) -> Column:
    """Literal parts of a LIKE pattern between its wildcards."""
    return F.filter(F.split(pattern, "[%_]+"), lambda x: x != "")


def _grams_of_runs(pattern: Column, size: int) -> Column:
    return F.array_distinct(F.flatten(F.transform(_runs(pattern), lambda run: _grams(run, size))))


def _grams(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` characters."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(size))))


def gram_candidates(patterns: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """``(pattern, <names columns>)`` that share the rarest gram of the pattern; to be checked with LIKE.

    Names are filed under their pieces of up to three characters. A pattern takes pieces as long as its longest literal part
    allows and is filed under the one that the fewest names hold, so ``%x%`` meets the names with that piece only. A pattern of
    wildcards alone is filed under the empty piece, which every name holds: all names are its matches, but for their length.
    """
    longest = F.array_max(F.transform(_runs(F.col("pattern")), F.length))
    size = F.least(F.coalesce(longest, F.lit(0)), F.lit(3))
    pieces = F.when(size == 0, F.array(F.lit("")))
    for n in (1, 2, 3):
        pieces = pieces.when(size == n, _grams_of_runs(F.col("pattern"), n))
    low = F.lower(F.col(name))
    filed = names.withColumn("_gram", F.explode(F.concat(F.array(F.lit("")), *[_grams(low, n) for n in (1, 2, 3)])))
    held = filed.groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
    asked = patterns.select("pattern").distinct().withColumn("_gram", F.explode(pieces)).join(held, "_gram", "left")
    rarest = asked.groupBy("pattern").agg(F.min(F.struct(F.coalesce("_held", F.lit(0)).alias("held"), F.col("_gram").alias("gram"))).alias("_least"))
    return rarest.select("pattern", F.col("_least.gram").alias("_gram")).join(filed, "_gram").select("pattern", *names.columns)


def like_matches(patterns: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """``(pattern, <names columns>)`` for the names each distinct pattern is LIKE, by equality joins.

    ``name LIKE pattern`` alone would compare all pairs.
    """
    return head_matches(patterns, names, name).unionByName(piece_matches(patterns, names, name))


def _headless() -> Column:
    return F.startswith(F.col("pattern"), F.lit("%"))


def piece_matches(patterns: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """The matches of patterns that start with ``%``: they have no head and meet the names that hold their rarest piece."""
    distinct = patterns.select("pattern").distinct()
    return gram_candidates(distinct.where(_headless()), names, name).where(like(F.lower(name), F.col("pattern")))


def head_matches(patterns: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """The matches of the other patterns.

    The head of a pattern (up to its first ``%``) fixes every character except at its ``_`` places, so names
    are keyed by their prefixes of the lengths that heads have, masked at those places: head = masked prefix
    is an equality. Patterns without ``%`` need the whole name and nothing else; the rest is checked with LIKE.
    """
    shaped = patterns.select("pattern").distinct().where(~_headless()).select(
        "pattern", F.regexp_extract("pattern", "(?s)^([^%]*)", 1).alias("_head"), F.contains("pattern", F.lit("%")).alias("_open"))
    shaped = shaped.withColumn("_mask", F.regexp_replace("_head", "(?s)[^_]", "x"))
    masks = shaped.select("_mask", "_open").distinct().withColumn("_length", F.length("_mask"))
    sized = names.withColumn("_size", F.length(name))
    whole = sized.join(masks.where(~F.col("_open")), F.col("_size") == F.col("_length")).drop("_size")
    # One row for each length of a head, at most the longest pattern's.
    lengths = sorted(r[0] for r in masks.where("_open").select("_length").distinct().collect())
    heads = sized.withColumn("_cut", F.explode(F.filter(F.array(*map(F.lit, lengths or [-1])), lambda n: (n >= 0) & (n <= F.col("_size")))))
    headed = heads.join(masks.where("_open"), F.col("_cut") == F.col("_length")).drop("_size", "_cut")
    prefix = F.left(F.lower(F.col(name)), F.col("_length"))
    keyed = whole.unionByName(headed).select(*names.columns, F.col("_open").alias("_nopen"), F.col("_mask").alias("_nmask"),
                                             _masked(prefix, F.col("_mask")).alias("_key"))
    hits = shaped.join(keyed, (F.col("_head") == F.col("_key")) & (F.col("_open") == F.col("_nopen")) & (F.col("_mask") == F.col("_nmask")))
    return hits.where(~F.col("_open") | like(F.lower(name), F.col("pattern"))).select("pattern", *names.columns)
