"""Policy compile: JSON retention rules x tenants x sub-keys -> flat settings.

Input is a table ``policies(policy_id, after_hours, delay_hours, doc)``; any number of
documents is compiled in one pass. The steps are plain DataFrames, so a job may use one
of them alone (tenant resolution, the violation report, the settings).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.entities import LOGS, Entity
from ebbline.functions.expressions import (
    entries_sql, items_sql, json_items, json_kind, json_text, kind_sql, like_pattern, mark_json_strings, text_sql,
)
from ebbline.functions.lookups import head_matches, like_matches, piece_matches
from ebbline.operators.idsets import bit_of, expanded, word_of
from ebbline.session import work_dir

# fixed values: keywords of the policy grammar
ACTIVE, DELETED, OTHER = "#active_tenants#", "#deleted_tenants#", "#other_tenants#"
SHORT_KEYWORDS = ("ALL", "ACTIVE_TENANTS", "DELETED_TENANTS")
COMMENT_KEYS = ("comment", "comments")
HOURS_KEYS = ("after_hours", "delete_delay_hours")


def expand_keywords(policies: DataFrame, entity: Entity = LOGS) -> DataFrame:
    """Replace a bare keyword by the rule document it stands for; needs ``after_hours``.

    Adds ``error``: set when a keyword comes without hours.
    """
    word = F.upper(F.trim(F.col("doc")))
    bare = F.replace(word, F.lit("#"), F.lit(""))
    known = bare.isin(*SHORT_KEYWORDS) & ((word == bare) | (word == F.concat(F.lit("#"), bare, F.lit("#"))))
    tail = f', "{entity.sub_rule}": [{{"archive": "all"}}]' if entity.sub_rule else ""

    def rule(tenants: str) -> str:
        return f'{{"tenants": "#{tenants}#"{tail}}}'

    doc = (
        F.when(~known, F.col("doc"))
        .when(bare == "ALL", F.lit(f"[{rule('ACTIVE_TENANTS')}, {rule('DELETED_TENANTS')}]"))
        .when(bare == "ACTIVE_TENANTS", F.lit(f"[{rule('ACTIVE_TENANTS')}]"))
        .otherwise(F.lit(f"[{rule('DELETED_TENANTS')}]"))
    )
    return policies.withColumn(
        "error", F.when(known & F.col("after_hours").isNull(), F.lit("after_hours must be provided with a keyword"))
    ).withColumn("doc", doc)


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _typed_entries(text: str, drop_comments: bool) -> str:
    """``array<struct<key,value,kind,text>>`` of a marked JSON object; ``disable`` is ``disabled``."""
    name = f"lower({text_sql('e.key')})"
    name = f"CASE WHEN {name} IN ('disable', 'disabled') THEN 'disabled' ELSE {name} END"
    entries = (f"transform({entries_sql(text)}, e -> struct({name} AS key, {text_sql('e.value')} AS value, "
               f"{kind_sql('e.value')} AS kind, e.value AS text))")
    return f"filter({entries}, e -> e.key NOT IN ({_quoted(COMMENT_KEYS)}))" if drop_comments else entries


def _once(value: str):
    """Evaluate a costly expression once: filters and projections above see its result only."""
    return F.explode(F.array(F.expr(value)))


def _of_key(*keys: str, kind: str | None = None, entries: str = "entries") -> str:
    of_kind = f" AND e.kind = '{kind}'" if kind else ""
    return f"filter({entries}, e -> e.key IN ({_quoted(keys)}){of_kind})"


def _hours(name: str):
    return F.expr(f"array_max(transform({_of_key(name, kind='number')}, e -> try_cast(e.value AS INT)))")


def _is_disabled() -> str:
    """True when every usable ``disabled`` entry says true or at least 1."""
    usable = "filter(entries, e -> e.key = 'disabled' AND e.kind IN ('number', 'true/false', 'array'))"
    on = ("coalesce((e.kind = 'true/false' AND e.value = 'true') "
          "OR (e.kind = 'number' AND try_cast(e.value AS DOUBLE) >= 1), false)")
    return f"(size({usable}) > 0 AND forall({usable}, e -> {on}))"


NO_VIOLATION = "CAST(array() AS array<struct<code:string,detail:string>>)"


def _violation(code: str, detail: str) -> str:
    return f"struct('{code}' AS code, CAST({detail} AS STRING) AS detail)"


def _violations(code: str, test: str, detail: str, entries: str = "entries") -> str:
    """Distinct violations of the entries that fail a test."""
    return f"array_distinct(transform(filter({entries}, e -> {test}), e -> {_violation(code, detail)}))"


def _repeated(code: str) -> str:
    keys = "transform(entries, e -> e.key)"
    counted = f"transform(array_distinct({keys}), k -> struct(k AS key, size(filter({keys}, x -> x = k)) AS n))"
    return f"transform(filter({counted}, c -> c.n > 1), c -> {_violation(code, NAMED_COUNT)})"


def _wrong_items(code: str, arrays: str, allowed: str) -> str:
    """Kinds of array items that are not allowed, per entry."""
    kinds = f"array_distinct(transform({items_sql('e.text')}, i -> {kind_sql('i')}))"
    bad = f"transform(array_except({kinds}, {allowed}), k -> {_violation(code, CONCAT_KIND)})"
    return f"array_distinct(flatten(transform({arrays}, e -> {bad})))"


ARRAY_EXPECTED = "'no array of rules'"
NAMED_COUNT = "concat_ws(':', c.key, CAST(c.n AS STRING))"
CONCAT_KIND = "concat_ws(':', e.key, k)"
KEY_KIND = "concat_ws(':', e.key, e.kind)"
HOURS_OR_FLAG = (f"(e.key IN ({_quoted(HOURS_KEYS)}) AND e.kind <> 'number') "
                 "OR (e.key = 'disabled' AND e.kind NOT IN ('number', 'true/false'))")


@dataclass(frozen=True)
class PolicyCompiler:
    """The compile steps of one policy table for one entity.

    A rule and a sub-rule stay one row with their entries in an array, so settings and
    most checks are row-local expressions: no shuffle until tenants are matched.
    """

    policies: DataFrame
    tenants: DataFrame
    entity: Entity = LOGS
    stage_root: str | None = None

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Written once and read back: parsed rules and matches feed many branches.

        It also keeps the driver small: it plans a step from files instead of a step with all steps below it.
        Without ``stage_root`` the step stays lazy, which suits a caller that needs one branch.
        """
        if self.stage_root is None:
            return df
        df.write.mode("overwrite").parquet(f"{self.stage_root}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.stage_root}/{name}")

    # ---- parse -------------------------------------------------------------------
    @cached_property
    def documents(self) -> DataFrame:
        return self.policies.select(
            "policy_id", F.col("after_hours").alias("p_after"), F.col("delay_hours").alias("p_delay"),
            mark_json_strings(F.trim("doc")).alias("marked")).withColumn("items", json_items("marked")).drop("marked")

    @cached_property
    def items(self) -> DataFrame:
        """Array items of the document: ``(policy_id, .., rule_no, kind, text)``.

        A document that is no array of rules gives one row with ``rule_no`` 0.
        """
        return self.documents.select(
            "policy_id", "p_after", "p_delay", F.posexplode_outer("items").alias("pos", "text"),
        ).select("policy_id", "p_after", "p_delay", F.coalesce(F.col("pos") + 1, F.lit(0)).alias("rule_no"),
                 F.when(F.col("pos").isNotNull(), json_kind("text")).alias("kind"), "text")

    @cached_property
    def rules(self) -> DataFrame:
        """One row per rule with entries and settings; ``disabled`` given twice counts as not disabled."""
        return self._staged(self.items.where(F.col("kind") == "object").select(
            "policy_id", "p_after", "p_delay", "rule_no", _once(_typed_entries("text", True)).alias("entries"),
        ).select(
            "*", _hours("after_hours").alias("after_hours"), _hours("delete_delay_hours").alias("delete_delay_hours"),
            F.expr(f"size({_of_key('disabled')}) <= 1 AND {_is_disabled()}").alias("disabled")), "rules")

    @cached_property
    def rule_settings(self) -> DataFrame:
        return self.rules.select("policy_id", "rule_no", "after_hours", "delete_delay_hours", "disabled")

    @cached_property
    def elements(self) -> DataFrame:
        """Typed entries of each rule: ``(policy_id, rule_no, key, value, kind)``."""
        return self.rules.select("policy_id", "rule_no", F.explode("entries").alias("e")).select(
            "policy_id", "rule_no", "e.key", "e.value", "e.kind")

    @cached_property
    def live_rules(self) -> DataFrame:
        return self.rules.where(~F.col("disabled"))

    @cached_property
    def sub_rules(self) -> DataFrame:
        """One row per non-empty sub-rule object of a live rule, with its entries and settings."""
        subs = self.live_rules.select(
            "policy_id", "p_after", "p_delay", "rule_no", F.col("after_hours").alias("r_after"),
            F.col("delete_delay_hours").alias("r_delay"),
            F.explode(F.expr(_of_key(self.entity.sub_rule, kind="array"))).alias("e"),
        ).select("policy_id", "p_after", "p_delay", "rule_no", "r_after", "r_delay",
                 F.posexplode(json_items("e.text")).alias("pos", "text"))
        return self._staged(
            subs.where(json_kind("text") == "object")
            .select("policy_id", "rule_no", (F.col("pos") + 1).alias("sub_no"), "p_after", "p_delay", "r_after", "r_delay",
                    _once(_typed_entries("text", False)).alias("entries"))
            .where(F.size("entries") > 0)
            .select("*", _hours("after_hours").alias("after_hours"), _hours("delete_delay_hours").alias("delete_delay_hours"),
                    F.expr(_is_disabled()).alias("disabled"),
                    F.expr(f"size({_of_key('archive', 'delete')}) > 0").alias("has_action"))
            .select("*", F.coalesce("after_hours", "r_after", "p_after").alias("use_after"),
                    F.coalesce("delete_delay_hours", "r_delay", "p_delay").alias("use_delay")), "sub_rules")

    @cached_property
    def sub_settings(self) -> DataFrame:
        return self.sub_rules.select("policy_id", "rule_no", "sub_no", "after_hours", "delete_delay_hours", "disabled")

    @cached_property
    def live_sub_rules(self) -> DataFrame:
        return self.sub_rules.where(~F.col("disabled"))

    @cached_property
    def sub_values(self) -> DataFrame:
        """Sub-key values, scalars and array items, with the sub-key they name.

        The dictionary is a few fixed values, so the lookup is a literal map in the projection.
        """
        entry = self.live_sub_rules.select(
            "policy_id", "rule_no", "sub_no", "use_after", "use_delay",
            F.explode(F.expr(_of_key("archive", "delete"))).alias("e"))
        values = F.when(F.col("e.kind") == "array", json_items("e.text")).otherwise(F.array("e.text"))
        text = json_text("text")
        return self._staged(
            entry.select("policy_id", "rule_no", "sub_no", "use_after", "use_delay", F.col("e.key").alias("action"),
                         F.explode(values).alias("text"))
            .withColumn("kind", json_kind("text")).where(F.col("kind").isin("string", "number"))
            .select("policy_id", "rule_no", "sub_no", "use_after", "use_delay", "action",
                    F.when(F.col("kind") == "string", F.lower(text)).alias("name"),
                    F.when(F.col("kind") == "number", text.try_cast("int")).alias("id"))
            .withColumn("is_all", F.coalesce(F.col("name") == "all", F.lit(False)))
            .withColumn("sub_id", self._sub_id()), "sub_values")

    def _sub_id(self):
        names = dict(self.entity.sub_names)
        by_name = F.create_map(*[x for i, n in names.items() for x in (F.lit(n), F.lit(i))])
        return F.when(F.col("id").isin(*names), F.col("id")).otherwise(F.try_element_at(by_name, F.col("name")))

    @cached_property
    def sub_keys(self) -> DataFrame:
        """Expanded sub-keys per sub-rule: ``(policy_id, rule_no, sub_no, action, sub_id, ..)``."""
        every = F.array(*[F.lit(i) for i, _ in self.entity.sub_names])
        return self.sub_values.select(
            "policy_id", "rule_no", "sub_no", "use_after", "use_delay", "action",
            F.explode(F.when(F.col("is_all"), every).when(F.col("sub_id").isNotNull(), F.array("sub_id"))).alias("sub_id"),
        ).distinct()

    # ---- tenants -----------------------------------------------------------------
    @cached_property
    def _all_selectors(self) -> DataFrame:
        """Entries of ``tenants`` and ``exclude``: a lower-case LIKE pattern or an id, and ``(is_id, text)`` as join key."""
        entry = self.live_rules.select("policy_id", "rule_no", F.explode(F.expr(_of_key("tenants", "exclude"))).alias("e"))
        values = F.when(F.col("e.kind") == "array", json_items("e.text")).otherwise(F.array("e.text"))
        text, kind = json_text("text"), json_kind("text")
        return self._staged(entry.select("policy_id", "rule_no", F.col("e.key").alias("role"), F.explode(values).alias("text")).where(
            kind.isin("string", "number")).select(
            "policy_id", "rule_no", "role", F.when(kind == "string", like_pattern(text)).alias("pattern"),
            F.when(kind == "number", text.try_cast("int")).alias("sel_id")).distinct().select(
            "*", F.col("sel_id").isNotNull().alias("is_id"),
            F.coalesce("pattern", F.col("sel_id").cast("string")).alias("text")), "selectors")

    @cached_property
    def selectors(self) -> DataFrame:
        """Tenant selectors with their type."""
        kind = (
            F.when(F.col("is_id"), "exact").when(F.col("pattern").isin(ACTIVE, DELETED, OTHER), "keyword")
            .when(F.contains("pattern", F.lit("%")), "partial").otherwise("exact"))
        return self._all_selectors.where(F.col("role") == "tenants").withColumn("kind", kind)

    @cached_property
    def selector_matches(self) -> DataFrame:
        """``(is_id, text, tenant)``: distinct patterns are matched once, ids are the tenants' own."""
        names = self.tenants.select("tenant_id", "name", "is_deleted")
        patterns = self._staged(
            self._all_selectors.where(~F.col("is_id") & ~F.col("pattern").isin(ACTIVE, DELETED, OTHER)).select("pattern").distinct(), "patterns")
        matches = self._staged(head_matches(patterns, names, "name"), "head_matches").unionByName(
            self._staged(piece_matches(patterns, names, "name"), "piece_matches"))
        by_name = matches.select(F.lit(False).alias("is_id"), F.col("pattern").alias("text"), *names.columns)
        by_id = names.select(F.lit(True).alias("is_id"), F.col("tenant_id").cast("string").alias("text"), "*")
        return self._staged(by_name.unionByName(by_id), "selector_matches")

    @cached_property
    def selector_words(self) -> DataFrame:
        """``(is_id, text, word, bits, active)``: the tenants of each distinct selector as words of 64 ids."""
        active = F.when(~F.col("is_deleted"), bit_of("tenant_id")).otherwise(F.lit(0).cast("bigint"))
        return self._staged(self.selector_matches.groupBy("is_id", "text", word_of("tenant_id").alias("word")).agg(
            F.bit_or(bit_of("tenant_id")).alias("bits"), F.bit_or(active).alias("active")), "selector_words")

    @cached_property
    def status_words(self) -> DataFrame:
        """``(word, active, deleted)``: all tenants as words."""
        none, bit = F.lit(0).cast("bigint"), bit_of("tenant_id")
        return self.tenants.groupBy(word_of("tenant_id").alias("word")).agg(
            F.bit_or(F.when(~F.col("is_deleted"), bit).otherwise(none)).alias("active"),
            F.bit_or(F.when(F.col("is_deleted"), bit).otherwise(none)).alias("deleted"))

    @cached_property
    def excluded_words(self) -> DataFrame:
        """``(policy_id, rule_no, word, excluded)``: tenants a rule excludes, by name pattern or id."""
        asked = self._all_selectors.where(F.col("role") == "exclude")
        return self._staged(asked.join(self.selector_words, ["is_id", "text"]).groupBy("policy_id", "rule_no", "word").agg(
            F.bit_or("bits").alias("excluded")), "excluded_words")

    @cached_property
    def keyword_uses(self) -> DataFrame:
        """``(policy_id, pattern, rules)``: the sorted rules that use a keyword.

        The list is no longer than the document has rules.
        """
        return self._staged(self.selectors.where(F.col("kind") == "keyword").groupBy("policy_id", "pattern").agg(
            F.sort_array(F.collect_set("rule_no")).alias("rules")), "keyword_uses")

    @cached_property
    def _keyword_selectors(self) -> DataFrame:
        """Keywords used by one rule only; a repeated keyword selects nothing."""
        return self.keyword_uses.where(F.size("rules") == 1).select(
            "policy_id", F.col("rules")[0].alias("rule_no"), "pattern", F.lit(None).cast("int").alias("sel_id"),
            F.lit("keyword").alias("kind"))

    @cached_property
    def resolved_words(self) -> DataFrame:
        """Matches of exact, wildcard and status selectors: ``bits``, and of them ``keep``.

        Exact selectors ignore ``exclude``; wildcards also leave deleted tenants out.
        """
        cols = ["policy_id", "rule_no", "pattern", "sel_id", "kind", "word", "bits", "active"]
        named = self.selectors.join(self.selector_words, ["is_id", "text"])
        alias = self._all_words(self._keyword_selectors.where(F.col("pattern") != OTHER)).withColumn(
            "bits", F.when(F.col("pattern") == DELETED, F.col("deleted")).otherwise(F.col("active"))).where("bits <> 0")
        return self._staged(self._with_keep(named.select(*cols).unionByName(alias.select(*cols))), "resolved_words")

    def _all_words(self, selectors: DataFrame, salts: int = 16) -> DataFrame:
        """Keyword selectors next to the words of all tenants.

        Every selector needs every word, 64 tenants each, so selectors are spread over salts by policy and the
        words are copied to each salt; no join key collects all policies.
        """
        salted = self.status_words.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        asked = selectors.withColumn("_asalt", F.pmod(F.xxhash64("policy_id"), F.lit(salts)).cast("int"))
        return asked.join(salted, F.col("_asalt") == F.col("_salt")).drop("_salt", "_asalt")

    def _with_keep(self, matches: DataFrame) -> DataFrame:
        met = matches.join(self.excluded_words, ["policy_id", "rule_no", "word"], "left")
        free = F.bitwise_not(F.coalesce("excluded", F.lit(0).cast("bigint")))
        keep = F.when(F.col("kind") == "exact", F.col("bits")).when(
            F.col("kind") == "partial", F.col("active").bitwiseAND(free)).otherwise(F.col("bits").bitwiseAND(free))
        return met.withColumn("keep", keep).drop("excluded", "active")

    @cached_property
    def other_words(self) -> DataFrame:
        """``#OTHER_TENANTS#``: active tenants no other selector of the policy keeps."""
        taken = self.resolved_words.groupBy("policy_id", "word").agg(F.bit_or("keep").alias("taken"))
        free = self._all_words(self._keyword_selectors.where(F.col("pattern") == OTHER)).join(taken, ["policy_id", "word"], "left")
        rest = F.col("active").bitwiseAND(F.bitwise_not(F.coalesce("taken", F.lit(0).cast("bigint"))))
        return self._staged(self._with_keep(free.withColumn("bits", rest).where("bits <> 0").select(
            "policy_id", "rule_no", "pattern", "sel_id", "kind", "word", "bits", "active")), "other_words")

    @cached_property
    def rule_words(self) -> DataFrame:
        """``(policy_id, rule_no, word, bits)``: the tenants each rule keeps."""
        kept = self.resolved_words.unionByName(self.other_words).where("keep <> 0")
        return self._staged(kept.groupBy("policy_id", "rule_no", "word").agg(F.bit_or("keep").alias("bits")), "rule_words")

    @staticmethod
    def _one_by_one(words: DataFrame) -> DataFrame:
        kept = F.col("keep").bitwiseAND(bit_of("tenant_id")) != 0
        return expanded(words, "tenant_id").select(
            "policy_id", "rule_no", "pattern", "sel_id", "kind", F.col("tenant_id").cast("int").alias("tenant_id"), kept.alias("keep"))

    @cached_property
    def resolved(self) -> DataFrame:
        """``resolved_words`` with a row for each tenant, for reports."""
        return self._one_by_one(self.resolved_words)

    @cached_property
    def others(self) -> DataFrame:
        """``other_words`` with a row for each tenant, for reports."""
        return self._one_by_one(self.other_words)

    # ---- checks ------------------------------------------------------------------
    @cached_property
    def violations(self) -> DataFrame:
        """One row per violation: ``(policy_id, rule_no, sub_no, code, detail)``."""
        return reduce(DataFrame.unionByName, self._checks.values())

    @cached_property
    def _checks(self) -> dict[str, DataFrame]:
        """The violations of each group of checks, by its name."""
        parts = {"document": self._document_checks(), "rule": self._rule_checks(), "unknown_tenants": self._unknown_tenants(),
                 "repeated_keywords": self._repeated_keywords(), "shared_tenants": self._shared_tenants()}
        if self.entity.sub_rule:
            parts |= {"sub_rule": self._sub_rule_checks(), "sub_values": self._sub_value_checks(), "shared_sub_keys": self._shared_sub_keys()}
        return parts

    @cached_property
    def rejected(self) -> DataFrame:
        """``policy_id`` of the policies with a violation, once for each group of checks they fail.

        Each group is written by itself: the driver plans it alone, and plans it again after each of its own stages only.
        """
        ids = [self._staged(part.select("policy_id").distinct(), f"rejected_{name}") for name, part in self._checks.items()]
        return reduce(DataFrame.unionByName, ids)

    @staticmethod
    def _rows(df: DataFrame, found, rule="rule_no", sub="sub_no") -> DataFrame:
        """Explode an array of violations next to its rule."""
        sub_no = F.col(sub).cast("int") if sub in df.columns else F.lit(None).cast("int")
        rule_no = F.col(rule) if isinstance(rule, str) else rule
        return df.select("policy_id", rule_no.cast("int").alias("rule_no"), sub_no.alias("sub_no"),
                         F.explode(found).alias("v")).select("policy_id", "rule_no", "sub_no", "v.code", "v.detail")

    def _document_checks(self) -> DataFrame:
        bad = self.items.where((F.col("rule_no") == 0) | (F.col("kind") != "object"))
        return self._rows(bad, F.expr(f"array(IF(rule_no = 0, {_violation('JSON', ARRAY_EXPECTED)}, {_violation('J0', 'kind')}))"))

    def _rule_checks(self) -> DataFrame:
        """J1-J5 and T0 of a rule in one projection."""
        sub = self.entity.sub_rule
        required = ["tenants"] + ([sub] if sub else [])
        lists = ["tenants", "exclude"] + ([sub] if sub else [])
        arrays = _of_key(*lists, kind="array")
        wrong_kind = f"(e.key = 'tenants' AND e.kind NOT IN ('string', 'number', 'array')) OR {HOURS_OR_FLAG}"
        if sub:
            wrong_kind += f" OR (e.key = '{sub}' AND e.kind <> 'array')"
        allowed = "CASE WHEN e.key IN ('tenants', 'exclude') THEN array('string', 'number') ELSE array('object') END"
        missing = f"array_except(array({_quoted(required)}), transform(entries, e -> e.key))"
        known = _quoted([*lists, *HOURS_KEYS, "disabled"])
        found = ", ".join([
            _violations("J1", f"e.key NOT IN ({known})", "e.key"),
            f"transform({missing}, k -> {_violation('J2', 'k')})",
            _violations("J3", wrong_kind, KEY_KIND),
            _repeated("J4"),
            _violations("J5", f"size({items_sql('e.text')}) = 0", "e.key", arrays),
            _wrong_items("T0", arrays, allowed),
        ])
        return self._rows(self.live_rules, F.expr(f"concat({found})"))

    def _sub_rule_checks(self) -> DataFrame:
        """L0-L6, H0 and H1 of a sub-rule in one projection."""
        arrays = _of_key("archive", "delete", kind="array")
        wrong_kind = f"(e.key IN ('archive', 'delete') AND e.kind NOT IN ('string', 'number', 'array')) OR {HOURS_OR_FLAG}"
        known = _quoted(["archive", "delete", *HOURS_KEYS, "disabled", *COMMENT_KEYS])

        def when(test: str, code: str, detail: str) -> str:
            return f"CASE WHEN {test} THEN array({_violation(code, repr(detail))}) ELSE {NO_VIOLATION} END"

        enabled = ", ".join([
            _violations("L3", wrong_kind, KEY_KIND), _repeated("L4"),
            _violations("L5", f"size({items_sql('e.text')}) = 0", "e.key", arrays),
            _wrong_items("L6", arrays, "array('string', 'number')"),
            when("use_after IS NULL", "H0", "after_hours"), when("use_delay IS NULL", "H1", "delete_delay_hours"),
        ])
        found = ", ".join([
            _violations("L0", f"e.key NOT IN ({known})", "e.key"), when("NOT has_action", "L1", "archive or delete"),
            f"CASE WHEN disabled THEN {NO_VIOLATION} ELSE concat({enabled}) END",
        ])
        return self._rows(self.sub_rules, F.expr(f"concat({found})"))

    def _sub_value_checks(self) -> DataFrame:
        """L7: a value that names no sub-key."""
        unknown = self.sub_values.where(~F.col("is_all") & F.col("sub_id").isNull()
                                        & (F.col("name").isNotNull() | F.col("id").isNotNull()))
        shown = "concat_ws(':', action, coalesce(name, CAST(id AS STRING)))"
        return self._rows(unknown, F.expr(f"array({_violation('L7', shown)})")).distinct()

    def _shared_sub_keys(self) -> DataFrame:
        """L8: a sub-key in two sub-rules; L9: a sub-key beside ``all``. A rule's values are a bounded group."""
        name = F.try_element_at(
            F.create_map(*[x for i, n in self.entity.sub_names for x in (F.lit(i), F.lit(n))]), F.col("sub_id"))
        per_key = self.sub_values.groupBy("policy_id", "rule_no", name.alias("sub_name")).agg(
            F.countDistinct("sub_no").alias("n"), F.bool_or("is_all").alias("is_all"))
        marked = per_key.withColumn("has_all", F.bool_or("is_all").over(Window.partitionBy("policy_id", "rule_no")))
        counted = "concat_ws(':', sub_name, CAST(n AS STRING))"
        found = F.expr(
            f"concat(CASE WHEN n > 1 THEN array({_violation('L8', counted)}) ELSE {NO_VIOLATION} END, "
            f"CASE WHEN has_all THEN array({_violation('L9', 'sub_name')}) ELSE {NO_VIOLATION} END)")
        return self._rows(marked.where(F.col("sub_name").isNotNull()), found)

    def _unknown_tenants(self) -> DataFrame:
        """T1: a selector that matches no tenant, name or id."""
        asked = self.selectors.where(F.col("kind") != "keyword")
        unknown = asked.join(self.selector_matches, ["is_id", "text"], "left_anti")
        return self._rows(unknown, F.expr(f"array({_violation('T1', 'text')})"))

    @staticmethod
    def _on_first_rule(df: DataFrame, code: str, shown: str) -> DataFrame:
        """A violation on the first of the sorted ``rules`` for each of the others."""
        detail = f"concat_ws(' in #', CAST({shown} AS STRING), CAST(r AS STRING))"
        others = F.expr(f"transform(slice(rules, 2, size(rules)), r -> {_violation(code, detail)})")
        return PolicyCompiler._rows(df.where(F.size("rules") > 1), others, F.col("rules")[0])

    def _repeated_keywords(self) -> DataFrame:
        """T2: a keyword used by more than one rule, reported on the first."""
        return self._on_first_rule(self.keyword_uses, "T2", "pattern")

    def _shared_tenants(self) -> DataFrame:
        """T3: a tenant kept by two rules, reported on the first.

        Rules of a policy are bounded by its document; only the tenants in two of them become rows.
        """
        held = self.rule_words.groupBy("policy_id", "word").agg(F.collect_list(F.struct("rule_no", "bits")).alias("held")).where(F.size("held") > 1)
        twice = ("aggregate(held, named_struct('once', 0L, 'twice', 0L), "
                 "(a, h) -> named_struct('once', a.once | h.bits, 'twice', a.twice | (a.once & h.bits)), a -> a.twice)")
        shared = expanded(held.withColumn("twice", F.expr(twice)).where("twice <> 0"), "tenant_id", "twice")
        rules = F.sort_array(F.transform(F.filter("held", lambda h: h["bits"].bitwiseAND(bit_of("tenant_id")) != 0), lambda h: h["rule_no"]))
        return self._on_first_rule(shared.select("policy_id", "tenant_id", rules.alias("rules")), "T3", "tenant_id")

    def report(self) -> DataFrame:
        """All violations, numbered within each policy by rule and code.

        A policy's violations are bounded by its document, so the window stays small.
        """
        order = Window.partitionBy("policy_id").orderBy("rule_no", "code", "sub_no", "detail")
        return self.violations.withColumn("position", F.row_number().over(order))

    # ---- result ------------------------------------------------------------------
    @cached_property
    def _rule_actions(self) -> DataFrame:
        """What each rule does with its tenants: sub-rule over rule over default hours."""
        if self.entity.sub_rule:
            return self.sub_keys.select("policy_id", "rule_no", "sub_id", (F.col("action") == "delete").alias("delete_only"),
                                        F.col("use_after").alias("after_hours"), F.col("use_delay").alias("delay_hours"))
        return self.live_rules.select(
            "policy_id", "rule_no", F.lit(0).alias("sub_id"), F.lit(False).alias("delete_only"),
            F.coalesce("after_hours", "p_after").alias("after_hours"),
            F.coalesce("delete_delay_hours", "p_delay").alias("delay_hours"))

    def _with_tenants(self, subs: DataFrame) -> DataFrame:
        """Flat settings: the tenants of a rule as rows."""
        by = ["policy_id", "sub_id", "delete_only", "after_hours", F.coalesce("delay_hours", F.lit(0)).alias("delay_hours"), "word"]
        words = subs.join(self.rule_words, ["policy_id", "rule_no"]).groupBy(*by).agg(F.bit_or("bits").alias("bits"))
        return expanded(words, "tenant_id").select(
            "policy_id", F.col("tenant_id").cast("int").alias("tenant_id"), "sub_id", "delete_only", "after_hours", "delay_hours")

    @cached_property
    def settings_of_all(self) -> DataFrame:
        """Settings without the validity check."""
        return self._with_tenants(self._rule_actions)

    @cached_property
    def settings(self) -> DataFrame:
        """Compiled settings of the policies without a violation; the others leave before their tenants become rows."""
        valid = self._staged(self._rule_actions.join(self.rejected, "policy_id", "left_anti"), "valid")
        return self._staged(self._with_tenants(valid), "settings")


def compile_policies(policies: DataFrame, tenants: DataFrame, entity: Entity = LOGS,
                     stage_root: str | None = None) -> DataFrame:
    """``(policy_id, tenant_id, sub_id, delete_only, after_hours, delay_hours)`` of all valid policies."""
    root = stage_root or work_dir(policies.sparkSession, "policy")
    return PolicyCompiler(policies, tenants, entity, root).settings


def split_tenant_list(lists: DataFrame, tenants: DataFrame) -> DataFrame:
    """``'a, -p%, #INACTIVE_TENANTS#'`` -> tenants kept, unmatched names kept by name.

    ``lists(list_id, items)`` and ``tenants(tenant_id, name, is_active, is_deleted)``. Returns
    ``(list_id, tenant_id, name, error)``: a list with an unknown or unmatched keyword gives
    one row with the error and no tenants.
    """
    tokens = F.transform(F.split(F.regexp_replace("items", r"[\r\n]", ""), ","), lambda x: F.trim(x))
    items = lists.select("list_id", F.explode(tokens).alias("token")).where(F.col("token") != "")
    items = items.select(
        "list_id",
        F.trim(F.when(F.col("token").startswith("-"), F.substr("token", F.lit(2))).otherwise(F.col("token"))).alias("item"),
        F.col("token").startswith("-").alias("discard")).where(F.col("item") != "").distinct()
    items = items.withColumn("pattern", F.lower("item"))
    keyword = F.col("pattern").rlike("^#.*#$")
    flags = (("#all_tenants#", F.lit(True)), ("#active_tenants#", F.col("is_active")),
             ("#inactive_tenants#", ~F.col("is_active")), ("#deleted_tenants#", F.col("is_deleted")))
    # every tenant once per keyword it answers to: the keyword join is an equality
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(word)) for word, cond in flags]))
    tagged = tenants.select("tenant_id", "name", F.explode(tags).alias("_word"))
    by_word = items.join(tagged, F.col("pattern") == F.col("_word")).drop("_word")
    by_name = items.join(like_matches(items, tenants.select("tenant_id", "name"), "name"), "pattern")
    matched = by_word.unionByName(by_name).distinct()
    missing = items.join(matched.select("list_id", "item", "discard").distinct(),
                         ["list_id", "item", "discard"], "left_anti")
    bad = missing.where(keyword).select("list_id").distinct()
    kept = matched.where(~F.col("discard")).select("list_id", "tenant_id", "name")
    loose = missing.where(~keyword & ~F.col("discard")).select(
        "list_id", F.lit(None).cast("int").alias("tenant_id"), F.col("item").alias("name"))
    dropped = matched.where("discard").select("list_id", "tenant_id", "name")
    tenants_out = kept.unionByName(loose).distinct().exceptAll(dropped.distinct())
    good = tenants_out.join(bad, "list_id", "left_anti").withColumn("error", F.lit(None).cast("string"))
    errors = bad.select("list_id", F.lit(None).cast("int").alias("tenant_id"), F.lit(None).cast("string").alias("name"),
                        F.lit("invalid keyword").alias("error"))
    return good.unionByName(errors)
