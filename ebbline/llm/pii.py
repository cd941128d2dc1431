"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction for what they miss.

The spans of the fixed patterns are the seeds. The words that stand before a seed make a lexical
pattern; identifier-like tokens that no seed covers are candidates. Patterns and instances form a
graph: a pattern is as sure as the share of its instances that are known to be of a kind, an instance
as sure as its patterns make it, and both are scored in turn. Patterns that end up sure, and that
several different seeds support, mark their candidates. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import WHITE, numbered, small, stage

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = len(KINDS)
ROUNDS = 3
SURE = 0.8
SUPPORT = 3
CONTEXT = 64

# Each finds what the plain pattern of its kind finds, leftmost and non-overlapping, in linear time: a
# run is entered at its start only (or where the match before ended) and never given back.
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TOKEN = rf"(?<![^{WHITE}])(?=[^{WHITE}0-9@]*+[0-9@])[^{WHITE}]++(?: [0-9().-]++(?![^{WHITE}]))*+"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
# What a candidate must look like to be taken for a kind.
SHAPES = {"email": "@", "ip": r"^[0-9a-fA-F]{1,4}(?:[.:][0-9a-fA-F]{1,4}){3,7}$", "card": r"^(?:[^0-9]*[0-9]){12,19}[^0-9]*$", "phone": r"^(?:[^0-9A-Za-z]*[0-9]){7,15}[^0-9A-Za-z]*$"}


def digits(column: Column) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def luhn(column: Column) -> Column:
    """Whether the digits of the column pass the Luhn check."""
    held = digits(column)

    def value(i: Column) -> Column:
        twice = F.substring(held, F.length(held) - i + 1, F.lit(1)).cast("int") * (1 + (i + 1) % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(held)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def context(before: Column) -> Column:
    """The last two words before a span, lower-cased, from the text right before it."""
    words = F.filter(F.split(F.lower(F.right(before, F.lit(CONTEXT))), f"[{WHITE}]+"), lambda w: F.length(w) > 0)
    return F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2))


def hits(text: Column, name: str, regex: str, when: Column) -> tuple[Column, Column]:
    found = F.when(when, F.regexp_extract_all(text, F.lit(regex), F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size(name) > 0, F.split(text, regex, -1)).otherwise(F.array().cast("array<string>"))
    return found, gaps


def occurrences(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows, and the spans in them: ``row_id, kind, start, end, hit, words``; kind 4 are candidate tokens.

    Matches are listed in one pass and the text between them gives their places, so no text is scanned again
    unless something was found in it. Places are running sums over the spans of a document, in code points.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select("doc_id", text.alias("body"))
    number, at = F.col("body").rlike("[0-9]"), F.contains(F.col("body"), F.lit("@"))
    held = held.select("*", number.alias("number"), at.alias("at"))
    number, at = F.col("number"), F.col("at")
    parts = (("f0", EMAIL, at), ("f1", IP, number), ("f2", CARD, number), ("f3", PHONE, number & F.contains(F.col("body"), F.lit("+"))), ("f4", TOKEN, number | at))
    for name, regex, when in parts:
        held = held.withColumn(name, hits(F.col("body"), name, regex, when)[0])
    def spans(k: int, name: str, regex: str) -> Column:
        gaps = hits(F.col("body"), name, regex, F.lit(True))[1]
        return F.transform(F.arrays_zip(F.col(name).alias("hit"), gaps.alias("gap")), lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), context(x["gap"]).alias("words"), x["hit"].alias("hit")))
    every = F.filter(F.concat(*[spans(k, name, regex) for k, (name, regex, _) in enumerate(parts)]), lambda s: s["hit"].isNotNull())
    rows = numbered(spark, held.select("doc_id", every.alias("spans")), "pii_rows")

    flat = rows.select("row_id", F.explode("spans").alias("s")).select("row_id", "s.*").repartition("row_id")
    upto = Window.partitionBy("row_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(upto)).withColumn("start", F.col("end") - F.length("hit"))
    size = F.length(digits(F.col("hit")))
    good = F.when(F.col("kind") == 1, F.col("hit").rlike(OCTETS)).when(F.col("kind") == 2, luhn(F.col("hit"))).when(
        F.col("kind") == 3, size.between(8, 15)).otherwise(True)
    placed = placed.where(good)
    # Candidates lose the marks around them, and go if a seed touches them.
    bare = F.regexp_extract("hit", r"""^[("'<\[{]*+(.*?)[.,;:!?)"'>\]}]*$""", 1)
    lead = F.length(F.regexp_extract("hit", r"""^[("'<\[{]*+""", 0))
    candidate = F.col("kind") == CANDIDATE
    placed = placed.select("row_id", "kind", "words", F.when(candidate, F.col("start") + lead).otherwise(F.col("start")).alias("start"),
                           F.when(candidate, F.col("start") + lead + F.length(bare)).otherwise(F.col("end")).alias("end"), F.when(candidate, bare).otherwise(F.col("hit")).alias("hit"))
    before = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row_id").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    seed_end, seed_start = F.when(~candidate, F.col("end")), F.when(~candidate, F.col("start"))
    clear = (F.coalesce(F.max(seed_end).over(before), F.lit(-1)) <= F.col("start")) & (F.coalesce(F.min(seed_start).over(after), F.col("end")) >= F.col("end"))
    judged = placed.withColumn("clear", ~candidate | (clear & (F.length("hit") >= 5)))
    return rows.select("row_id", "doc_id"), stage(spark, judged.where("clear").drop("clear"), "pii_spans")


@dataclass(frozen=True)
class Patterns:
    """``pattern, kind, sure, support`` of every pattern that seeds induced."""

    scores: DataFrame

    def accepted(self, sure: float = SURE, support: int = SUPPORT) -> DataFrame:
        return self.scores.where((F.col("sure") >= sure) & (F.col("support") >= support))


def with_patterns(spans: DataFrame) -> DataFrame:
    """Each span with each of its patterns: the word before it, and the two words before it."""
    both = F.array_distinct(F.array(F.element_at("words", -1), F.concat_ws(" ", "words")))
    return spans.where(F.size("words") > 0).withColumn("pattern", F.explode(both))


def bootstrap(spark: SparkSession, spans: DataFrame, rounds: int = ROUNDS) -> Patterns:
    """Score the pattern-instance graph: ``rounds`` times patterns from instances and instances from patterns.

    Edges are distinct pairs, counted once however often they occur, so one much repeated page cannot carry a pattern.
    A pattern's score is smoothed by two unknown instances.
    """
    edges = stage(spark, with_patterns(spans).select("pattern", "kind", F.lower("hit").alias("instance")).distinct(), "pii_edges")
    seeds = edges.where(F.col("kind") < CANDIDATE)
    support = stage(spark, seeds.groupBy("pattern", "kind").agg(F.count("*").alias("support")), "pii_support")
    induced = support.select("pattern").distinct()
    totals = edges.join(induced, "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("n"))
    known = stage(spark, support.join(totals, "pattern"), "pii_known")
    open_edges = stage(spark, edges.where(F.col("kind") == CANDIDATE).join(induced, "pattern", "left_semi").select("pattern", "instance"), "pii_open")
    scores = known.select("pattern", "kind", "support", "n", (F.col("support") / (F.col("n") + 2)).alias("sure"))
    for _ in range(rounds):
        doubt = F.sum(F.log1p(-F.least(F.col("sure"), F.lit(0.999))))
        instances = open_edges.join(scores, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("belief"))
        gained = open_edges.join(instances, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("gain"))
        scores = stage(spark, known.join(gained, ["pattern", "kind"], "left").select(
            "pattern", "kind", "support", "n", ((F.col("support") + F.coalesce("gain", F.lit(0.0))) / (F.col("n") + 2)).alias("sure")), "pii_scores")
    return Patterns(scores)


def discovered(spans: DataFrame, accepted: DataFrame, rows: int) -> DataFrame:
    """Candidate spans that an accepted pattern marks and whose shape fits the kind; the surest kind wins."""
    marked = with_patterns(spans.where(F.col("kind") == CANDIDATE).drop("kind")).join(small(accepted.select("pattern", "kind", "sure"), rows), "pattern")
    fits = F.lit(False)
    for k, name in enumerate(KINDS):
        fits = fits | ((F.col("kind") == k) & F.col("hit").rlike(SHAPES[name]))
    best = marked.where(fits).groupBy("row_id", "start", "end").agg(F.max(F.struct("sure", -F.col("kind"))).alias("best"))
    return best.select("row_id", (-F.col("best")["col2"]).alias("kind"), "start", "end")


def find_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` for each row of ``docs(doc_id, text)``.

    ``base`` and ``spans`` are arrays of ``(kind, start, end)`` in the order of kinds, then start; ``base`` holds the fixed
    patterns' spans and their counts, ``spans`` also what the accepted patterns found. Null and empty texts hold nothing,
    repeated rows are judged each, other columns are ignored, an empty table gives no rows.
    """
    rows, spans = occurrences(spark, docs)
    accepted = stage(spark, bootstrap(spark, spans).accepted(), "pii_accepted")
    seeds = spans.where(F.col("kind") < CANDIDATE).select("row_id", "kind", "start", "end", F.lit(True).alias("base"))
    every = seeds.unionByName(discovered(spans, accepted, accepted.count()).withColumn("base", F.lit(False)))
    listed = every.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base"))).alias("all"))
    full = rows.join(listed, "row_id", "left").withColumn("all", F.coalesce("all", F.array().cast("array<struct<kind:int,start:bigint,end:bigint,base:boolean>>")))
    named = lambda s: F.struct(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    count = lambda k: F.size(F.filter("all", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{KINDS[k]}")
    return full.select("doc_id", *[count(k) for k in range(len(KINDS))], F.transform(F.filter("all", lambda s: s["base"]), named).alias("base"), F.transform("all", named).alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
