"""Quality classifier: a sparse ensemble of rules over text statistics.

A forest of shallow trees is fitted on a bounded sample of labelled rows; every path in a tree is a
conjunctive rule. Lasso logistic regression weighs the rules, most of them with zero, and what is
left is compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import hash_share, held_out, small, stage

STATISTICS = (
    "n_words", "word_length", "distinct_words", "repeated_next", "distinct_triples", "short_words", "upper", "digits", "marks",
    "stops", "pipes", "shouts", "letters", "blanks", "lines", "repeated_lines", "longest_word", "marked_words",
)
SCHEMA = T.StructType([T.StructField(name, T.DoubleType()) for name in STATISTICS])
MAX_ROWS = 20_000
LINE = re.compile(r"^( *)(?:(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+))$")
IS_UPPER, IS_DIGIT, IS_LETTER, IS_STOP = (np.zeros(256, bool) for _ in range(4))
IS_UPPER[65:91] = IS_DIGIT[48:58] = IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
IS_STOP[[*b".,;:'\"?()-"]] = True
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[*b" \t\n\r\x0b\x0c"]] = True
IS_MARK = ~(IS_LETTER | IS_DIGIT | IS_STOP | IS_BLANK)


def statistics_of(raw: bytes | None) -> tuple[float, ...]:
    """Statistics of one whole text; all zero for a null or empty one."""
    if not raw:
        return (0.0,) * len(STATISTICS)
    size, words, lines = len(raw), raw.split(), raw.split(b"\n")
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(words))
    lengths = [len(w) for w in words]
    nexts = sum(map(bytes.__eq__, words, words[1:]))
    triples = max(1, len(words) - 2)
    long_lines = [x for x in lines if len(x) >= 20]
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    return (
        float(len(words)), sum(lengths) / n, len(set(words)) / n, nexts / n, len(set(zip(words, words[1:], words[2:]))) / triples if len(words) > 2 else 1.0,
        sum(x <= 3 for x in lengths) / n, byte[IS_UPPER].sum() / max(1, byte[IS_LETTER].sum()), byte[IS_DIGIT].sum() / size, byte[IS_MARK].sum() / size,
        byte[IS_STOP].sum() / size, byte[124] / size, byte[33] / size, byte[IS_LETTER].sum() / size, byte[IS_BLANK].sum() / size, len(lines) / n,
        1 - len(set(long_lines)) / len(long_lines) if long_lines else 0.0, float(max(lengths, default=0)), marked / n,
    )


@F.pandas_udf(SCHEMA)
def _statistics(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([tuple(map(float, statistics_of(r))) for r in raw], columns=list(STATISTICS), dtype=float)


def statistics(text: str = "text") -> Column:
    """Struct of the statistics of a text column."""
    return _statistics(F.col(text).cast("binary"))


@dataclass(frozen=True)
class Rule:
    """``low < statistic <= high`` for each statistic named."""

    bounds: tuple[tuple[int, float, float], ...]

    def column(self, stats: str) -> Column:
        test = F.lit(True)
        for feature, low, high in self.bounds:
            value = F.col(f"{stats}.{STATISTICS[feature]}")
            if low != -np.inf:
                test = test & (value > low)
            if high != np.inf:
                test = test & (value <= high)
        return test.cast("double")


def rules_of(tree: str) -> set[Rule]:
    """Every path from the root to a node of a printed tree, as a rule."""
    found, path = set(), []
    for line in tree.split("\n"):
        match = LINE.match(line)
        if not match or match[6] is not None:
            continue
        depth = len(match[1])
        path = [step for step in path if step[0] < depth] + [(depth, int(match[3]), match[4], float(match[5]))]
        bounds: dict[int, list[float]] = {}
        for _, feature, sign, value in path:
            held = bounds.setdefault(feature, [-np.inf, np.inf])
            if sign == "<=":
                held[1] = min(held[1], value)
            else:
                held[0] = max(held[0], value)
        found.add(Rule(tuple((k, *v) for k, v in sorted(bounds.items()))))
    return found


def hits_of(rules: list[Rule], stats: str) -> Column:
    """1 or 0 for each rule. Hundreds of candidate rules as column expressions would take much of the driver's memory to plan."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def hits(s: pd.DataFrame) -> pd.Series:
        values, held = s.to_numpy(float), np.ones((len(s), len(rules)))
        for k, rule in enumerate(rules):
            for feature, low, high in rule.bounds:
                held[:, k] *= (values[:, feature] > low) & (values[:, feature] <= high)
        return pd.Series(list(held))

    return hits(F.col(stats))


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: str) -> Column:
        """Probability of label 1 as one expression over the struct ``stats``."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + rule.column(stats) * weight
        return 1.0 / (1.0 + F.exp(-total))


def training_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 7) -> DataFrame:
    """Statistics and label of at most about ``max_rows`` labelled documents outside the held-out third, drawn by a hash of the id.

    Repeated labels count once; an id with both labels keeps both. Rows of ``docs`` that share a drawn id are all taken.
    """
    usable = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("label")).where("__id is not null and label in (0, 1)").where(~held_out("__id")).distinct()
    share = max_rows / max(1, usable.count())
    usable = stage(spark, usable.where(hash_share("__id", seed) < share), "quality_labels")
    rows = docs.select("doc_id", "text").join(small(usable, usable.count()), F.col("doc_id") == F.col("__id"))
    return stage(spark, rows.select("label", statistics().alias("s")), "quality_sample")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, trees: int = 24, depth: int = 4,
        penalty: float = 0.001, seed: int = 7) -> RuleEnsemble:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, quality)``; null ids and labels other than 0 and 1 are passed over.

    With labels of one kind only, or none, the score is the smoothed share of label 1.
    """
    sample = training_rows(spark, docs, labels, max_rows, seed)
    seen = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones")).first()
    if seen.ones in (0, seen.n):
        share = (seen.ones + 1) / (seen.n + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    inputs = sample.select("label", "s", array_to_vector(F.array(*[f"s.{name}" for name in STATISTICS])).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, subsamplingRate=0.7, cacheNodeIds=False).fit(inputs)
    rules = sorted(set().union(*[rules_of(t.toDebugString) for t in forest.trees]), key=lambda r: r.bounds)
    held = stage(spark, sample.select("label", hits_of(rules, "s").alias("hits")), "quality_rules")
    fitted = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=80, standardization=False).fit(held.select("label", array_to_vector("hits").alias("features")))
    weights = fitted.coefficients.toArray()
    return RuleEnsemble(float(fitted.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def with_statistics(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the statistics of its texts, and the name of that column, which no given column has."""
    name, taken = "__statistics", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return docs.withColumn(name, statistics()), name


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """``docs`` with ``score``; a given ``score``, in any case of letters, is replaced, all other columns stay.

    Whole texts of any length are scored, null and empty ones by their (zero) statistics, repeated rows each; an empty table gives no rows.
    """
    held, name = with_statistics(docs)
    return held.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"], model.score(name).alias("score"))
