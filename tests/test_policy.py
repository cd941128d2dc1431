"""Policy grammar: fixture document, every error code, wildcards and keywords."""

import pytest

from ebbline.entities import AUDIT_LOGS, JOBS, LOGS
from ebbline.plans.policy import PolicyCompiler, compile_policies, expand_keywords
from ebbline.session import work_dir
from tests.conftest import plan

DOC = """[
  {"tenants": ["NATION_1*", 3], "exclude": "NATION_12", "after_hours": 240, "delete_delay_hours": 48,
   "levels": [{"archive": ["error", 3]}, {"delete": ["trace", "debug"], "after_hours": 120, "delete_delay_hours": 0}]},
  {"tenants": "#DELETED_TENANTS#", "after_hours": 24, "delete_delay_hours": 0, "levels": [{"delete": "all"}]},
  {"tenants": "#OTHER_TENANTS#", "after_hours": 480, "delete_delay_hours": 24, "levels": [{"archive": "all"}]},
  {"tenants": "NATION_0", "disabled": true, "levels": [{"archive": "all"}]}
]"""
CODES = {"JSON", "J0", "J1", "J2", "J3", "J4", "J5", "T0", "T1", "T2", "T3", "L0", "L1", "L3", "L4", "L5", "L6", "L7", "L8",
         "L9", "H0", "H1"}


def policies(spark, *docs, after=None, delay=None):
    return spark.createDataFrame([(i, after, delay, d) for i, d in enumerate(docs)],
                                 "policy_id long, after_hours int, delay_hours int, doc string")


def staged(policy_rows, views, entity=LOGS):
    return PolicyCompiler(policy_rows, views.tenants, entity, work_dir(policy_rows.sparkSession, "policy"))


def codes(spark, views, doc, **kw):
    c = staged(policies(spark, doc, **kw), views)
    return sorted((r.rule_no, r.code) for r in c.violations.collect())


def test_fixture_document(spark, views):
    c = staged(policies(spark, DOC), views)
    assert c.violations.count() == 0
    rows = c.settings.collect()
    by_tenant = {}
    for r in rows:
        by_tenant.setdefault(r.tenant_id, set()).add((r.sub_id, r.delete_only, r.after_hours, r.delay_hours))
    deleted = {4, 9, 14, 19, 24}
    first = {(4, False, 240, 48), (3, False, 240, 48), (0, True, 120, 0), (1, True, 120, 0)}
    assert all(by_tenant[t] == {(s, True, 24, 0) for s in range(6)} for t in deleted)
    assert by_tenant[3] == first and by_tenant[10] == first and by_tenant[1] == first
    # 12 is excluded from the first rule, so it is one of the others
    assert by_tenant[12] == {(s, False, 480, 24) for s in range(6)} == by_tenant[0]
    assert set(by_tenant) == set(range(25))


def test_twin_shares_a_tenant(spark, views):
    assert codes(spark, views, DOC.replace('["NATION_1*", 3]', '["NATION_1*", 3, 4]')) == [(1, "T3")]


def test_every_code_appears(views):
    from workload.policy import compiler

    # the smallest tables have 150 customers, several per template
    seen = {r.code for r in compiler(views, staged=True).violations.select("code").distinct().collect()}
    assert seen == CODES


def test_disabled_twice_means_enabled(spark, views):
    doc = '[{"tenants": 1, "disabled": true, "disabled": true, "after_hours": 1, "delete_delay_hours": 1, "levels": [{"archive": "all"}]}]'
    assert codes(spark, views, doc) == [(1, "J4")]
    assert codes(spark, views, doc.replace(' "disabled": true,', "", 1)) == []


def test_underscore_is_a_wildcard_and_case_is_ignored(spark, views):
    doc = '[{"tenants": "nation___", "exclude": ["*2", "Nation_1_"], "after_hours": 1, "delete_delay_hours": 0, "levels": [{"archive": "WARN"}]}]'
    c = staged(policies(spark, doc), views)
    # no "%" in the pattern: an exact selector, so excludes and the deleted status do not apply
    assert sorted(r.tenant_id for r in c.settings.collect()) == list(range(10, 25))


def test_wildcard_skips_deleted_and_excluded(spark, views):
    doc = '[{"tenants": "*_1*", "exclude": ["*2", 13], "after_hours": 1, "delete_delay_hours": 0, "levels": [{"archive": 3}]}]'
    c = staged(policies(spark, doc), views)
    assert sorted(r.tenant_id for r in c.settings.collect()) == [1, 10, 11, 15, 16, 17, 18, 21]


def test_defaults_fill_missing_hours(spark, views):
    doc = '[{"tenants": 1, "levels": [{"archive": "error"}]}]'
    assert codes(spark, views, doc) == [(1, "H0"), (1, "H1")]
    got = compile_policies(policies(spark, doc, after=5, delay=7), views.tenants).collect()
    assert [(r.after_hours, r.delay_hours) for r in got] == [(5, 7)]


def test_quoted_numbers_stay_strings(spark, views):
    doc = '[{"tenants": ["1"], "after_hours": 1, "delete_delay_hours": 1, "levels": [{"archive": "4"}]}]'
    assert codes(spark, views, doc) == [(1, "L7"), (1, "T1")]


def test_escaped_text_survives(spark, views):
    doc = r'[{"tenants": "a\"b, {x}: [1]", "after_hours": 1, "delete_delay_hours": 1, "levels": [{"archive": "all"}]}]'
    rows = staged(policies(spark, doc), views).violations.collect()
    assert [(r.code, r.detail) for r in rows] == [("T1", 'a"b, {x}: [1]')]


@pytest.mark.parametrize("word, rules", [("ALL", 2), ("#all#", 2), (" active_tenants ", 1), ("#DELETED_TENANTS#", 1)])
def test_keywords(spark, word, rules):
    row = expand_keywords(policies(spark, word, after=1)).first()
    assert row.doc.count('"tenants"') == rules and row.error is None
    assert expand_keywords(policies(spark, word)).first().error is not None


def test_entity_without_sub_keys(spark, views):
    doc = '[{"tenants": 1, "after_hours": 1, "delete_delay_hours": 2}, {"tenants": 2, "levels": []}]'
    c = staged(policies(spark, doc), views, AUDIT_LOGS)
    assert [(r.rule_no, r.code) for r in c.violations.collect()] == [(2, "J1")]
    got = compile_policies(policies(spark, doc.split(", {")[0] + "]"), views.tenants, AUDIT_LOGS).collect()
    assert [(r.tenant_id, r.sub_id, r.delete_only, r.after_hours, r.delay_hours) for r in got] == [(1, 0, False, 1, 2)]


def test_job_states(spark, views):
    doc = '[{"tenants": 1, "after_hours": 1, "delete_delay_hours": 2, "states": [{"archive": ["Stopped", 8]}]}]'
    got = compile_policies(policies(spark, doc), views.tenants, JOBS).collect()
    assert sorted(r.sub_id for r in got) == [6, 8]


def test_report_is_cut_per_policy(spark, views):
    doc = "[" + ", ".join("1" for _ in range(150)) + "]"
    c = staged(policies(spark, doc, DOC), views)
    assert c.violations.count() == 150 and c.report().count() == 150


@pytest.mark.parametrize("name", ["policy_compiled", "policy_compiled_queues"])
def test_every_step_is_planned_alone(spark, monkeypatch, name):
    """The driver plans a step again after each of its stages, so no step may hold all the steps below it."""
    from tests.conftest import SMALL
    from workload import load

    sizes, real = {}, PolicyCompiler._staged
    monkeypatch.setattr(PolicyCompiler, "_staged", lambda self, df, step: sizes.update({step: len(plan(df, "simple"))}) or real(self, df, step))
    assert load().QUERIES[name](spark, SMALL).count() > 50
    assert max(sizes.values()) < 25_000, sizes


def test_a_policy_that_fails_any_check_has_no_settings(spark, views):
    good = '{"tenants": 1, "after_hours": 1, "delete_delay_hours": 2, "levels": [{"archive": "all"}]}'
    every, unknown = good.replace("1", '"#ACTIVE_TENANTS#"', 1), good.replace("1", "99", 1)
    extra = good.replace('"levels"', '"x": 1, "levels"')
    subs = ['{"keep": 1}', '{"archive": 9}', '{"archive": 1}, {"delete": 1}']
    bad = ["none", *(f"[{x}]" for x in (f"{good}, 5", extra, unknown, f"{good}, {good}", f"{every}, {every}")),
           *(f"[{good.replace('{"archive": "all"}', x)}]" for x in subs)]
    c = staged(policies(spark, f"[{good}]", *bad), views)
    assert {r.policy_id for r in c.rejected.collect()} == set(range(1, 1 + len(bad)))
    assert {(r.policy_id, r.tenant_id) for r in c.settings.collect()} == {(0, 1)}
