"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern in the notation of common filter lists: ``||`` anchors at a host or one of its
parent domains, ``|`` at an end of the URL, ``^`` is a separator, ``*`` is anything. Its literal tokens
are the runs of letters and digits that are bounded on both sides. Each rule is filed under the token
that the fewest URLs hold; the tokens of a URL fetch its candidate rules, and only those are matched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import numbered, small, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` and what it says; ``name`` is set for rules that win over all others, the longest name first."""

    verdict: str
    pattern: str
    name: str | None = None

    @property
    def at_host(self) -> bool:
        return self.pattern.startswith("||")

    def regex(self) -> str:
        """Matched from the host on if ``at_host``, else against the whole URL."""
        body, out = self.pattern, ""
        if self.at_host:
            body, out = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, out = body[1:], "^"
        last = body.endswith("|")
        for c in body[:-1] if last else body:
            out += {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}.get(c, re.escape(c))
        return "(?s)" + out + ("$" if last else "")

    def tokens(self) -> list[str]:
        found = re.finditer("[A-Za-z0-9]+", self.pattern)
        inside = [m for m in found if m.start() > 0 and m.end() < len(self.pattern) and "*" not in (self.pattern[m.start() - 1], self.pattern[m.end()])]
        return sorted({m[0].lower() for m in inside})


def host_rule(verdict: str, name: str) -> UrlRule:
    """A host with all its subdomains, and a prefix of the path: ``example.net/en/``."""
    return UrlRule(verdict, "||" + name, name)


# The rules of the contract, then patterns for all other URLs.
RULES = (
    host_rule(BLOCK, "net/"), host_rule(ALLOW, "example.net/en/"), host_rule(BLOCK, "example.com/de/"), host_rule(ALLOW, "org/fr/"),
    UrlRule(BLOCK, "?utm_source="), UrlRule(BLOCK, "&utm_source="), UrlRule(BLOCK, "/ads/"), UrlRule(BLOCK, "/banner/*.gif"), UrlRule(BLOCK, "||tracker."),
    UrlRule(BLOCK, "://ads.*/click?"), UrlRule(BLOCK, "/login?*session="), UrlRule(ALLOW, "/robots.txt|"), UrlRule(BLOCK, ".exe^"),
)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def indexed(spark: SparkSession, tokens: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """``token, verdict, regex, at_host, name`` with the rarest token of each rule, counted over all ``tokens(token)``.

    Rules without a bounded token are filed under the empty token, which every URL has.
    """
    rows = [(i, r.verdict, r.regex(), r.at_host, r.name, t) for i, r in enumerate(rules) for t in (r.tokens() or [""])]
    columns = (("rule_no", "int"), ("verdict", "string"), ("regex", "string"), ("at_host", "boolean"), ("name", "string"), ("token", "string"))
    listed = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(columns, row)]) for row in rows])))
    wanted = F.broadcast(listed.select("token").distinct())  # one row for each token of the given rules
    counts = tokens.join(wanted, "token").groupBy("token").agg(F.count("*").alias("n"))
    filed = listed.join(counts, "token", "left").groupBy("rule_no", "verdict", "regex", "at_host", "name").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("by"))
    return filed.select(F.col("by.token").alias("token"), "verdict", "regex", "at_host", "name")


def judge(spark: SparkSession, pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, otherwise: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` for each row of ``pages(page_id, url)``.

    Named rules win, the longest name first; then an allowing pattern, then a blocking one, then ``otherwise``.
    ``rule`` is the name of the winning named rule, ``pattern`` the regular expression that decided, else null. Null,
    empty and odd URLs have empty parts and fit no named rule. Repeated rows are judged each; other columns are ignored.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = url_parts(url)
    # The host is lower-cased in the text that rules see; the rest is kept.
    rest = F.concat(host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1))
    seen = F.when(F.length(host) > 0, F.concat(F.regexp_extract(url, "(?s)^(.*?://)", 1), rest)).otherwise(url)
    rows = numbered(spark, pages.select("page_id", host.alias("host"), path.alias("path"), seen.alias("seen"), rest.alias("rest")), "urls")
    split = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lower_ascii(F.col("seen")), F.lit("[a-z0-9]+"), F.lit(0))))
    tokens = rows.select("row_id", "seen", "rest", F.explode(split).alias("token"))
    index = stage(spark, indexed(spark, tokens.select("token"), rules), "url_rules")
    candidates = tokens.join(small(index, len(rules)), "token")
    fitting = candidates.where(F.regexp_like(F.when(F.col("at_host"), F.col("rest")).otherwise(F.col("seen")), F.col("regex")))
    rank = F.struct(F.col("name").isNotNull().alias("named"), F.coalesce(F.length("name"), F.lit(0)).alias("length"), (F.col("verdict") == ALLOW).alias("allows"),
                    "name", "verdict", "regex")
    best = fitting.groupBy("row_id").agg(F.max(rank).alias("best"))
    return rows.join(best, "row_id", "left").select("page_id", "host", "path", F.col("best.name").alias("rule"),
                                                    F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"), F.col("best.regex").alias("pattern"))


def oracle() -> str:
    """DuckDB SQL of ``judge`` without the pattern column."""
    named = ", ".join(f"('{r.name}', '{r.name.split('/')[0]}', '/{r.name.split('/', 1)[1]}', '{r.verdict}')" for r in RULES if r.name)
    quote = lambda x: x.replace("'", "''")
    fits = lambda v: " OR ".join(f"regexp_matches({'rest' if r.at_host else 'seen'}, '{quote(r.regex())}')" for r in RULES if not r.name and r.verdict == v)
    return f"""
    WITH parts AS (SELECT page_id, row_number() OVER () AS k, coalesce(url, '') AS url,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    cut AS (SELECT *, host || regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)$', 1) AS rest FROM parts),
    seen AS (SELECT *, CASE WHEN host = '' THEN url ELSE regexp_extract(url, '(?s)^(.*?://)', 1) || rest END AS seen FROM cut),
    named(name, rhost, rpath, verdict) AS (VALUES {named}),
    best AS (SELECT k, arg_max(name, length(name)) AS name, arg_max(n.verdict, length(name)) AS verdict FROM seen, named n
             WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k)
    SELECT s.page_id, s.host, s.path, b.name AS rule,
      CASE WHEN b.name IS NOT NULL THEN b.verdict WHEN {fits(ALLOW)} THEN 'allow' WHEN {fits(BLOCK)} THEN 'block' ELSE 'allow' END AS verdict
    FROM seen s LEFT JOIN best b USING (k)"""
