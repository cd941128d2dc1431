"""Every document is compiled for an entity without sub-keys."""

from types import SimpleNamespace

from ebbline.entities import AUDIT_LOGS
from ebbline.plans.policy import PolicyCompiler, expand_keywords


def test_a_document_without_levels_is_compiled_for_audit(spark):
    docs = [(1, 24, 0, '[{"tenants": "NATION_1"}]'), (2, 24, 0, '[{"tenants": "NATION_1", "levels": [{"archive": "all"}]}]'), (3, 48, 0, "ACTIVE_TENANTS")]
    held = SimpleNamespace(policies_raw=spark.createDataFrame(docs, "policy_id long, after_hours int, delay_hours int, doc string"),
                           tenants=spark.createDataFrame([(1, "NATION_1", False)], "tenant_id int, name string, is_deleted boolean"))
    found = PolicyCompiler(expand_keywords(held.policies_raw, AUDIT_LOGS), held.tenants, AUDIT_LOGS).settings.collect()
    assert {(r.policy_id, r.tenant_id, r.after_hours) for r in found} == {(1, 1, 24), (3, 1, 48)}
