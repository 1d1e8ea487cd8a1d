"""The gates of a load read the facts of all keys from one shuffle, and report what each would find alone."""

from __future__ import annotations

import pytest

from tallyhouse.contracts import MARKETPLACE
from tallyhouse.operators import domains as D
from tallyhouse.operators import integrity as I
from tallyhouse.plans import catalog, publish
from tallyhouse.sources.testbed import Testbed

USES = [use for use, _ in I.KEY_RULES.values()]


@pytest.fixture
def model(spark):
    return catalog.published_with_defects(Testbed(spark, "/root/testdata/sf0.001"))


def test_shared_facts_give_the_same_reports(spark, model):
    facts = D.shared_key_facts(model, MARKETPLACE, USES)
    for alone, shared in (
        (I.integrity_checks(model), I.integrity_checks(model, facts)),
        (D.declared_constraints(model), D.declared_constraints(model, facts=facts)),
    ):
        found = sorted(map(str, shared.collect()))
        assert found == sorted(map(str, alone.collect())) and any("failed" in row for row in found)


def test_keys_of_other_types_are_not_shared(spark, model):
    model["order_items"] = model["order_items"].selectExpr("* EXCEPT (order_id)", "CAST(order_id AS bigint) AS order_id")
    assert D.shared_key_facts(model, MARKETPLACE, USES) is None


def test_a_load_shuffles_the_keys_once(spark, tmp_path, monkeypatch):
    asked, facts = [], D.key_facts
    for module in (D, I):
        monkeypatch.setattr(module, "key_facts", lambda tables, uses: asked.append(len(list(uses))) or facts(tables, uses))
    folder, _ = catalog.cleaning_run(Testbed(spark, "/root/testdata/sf0.001"))
    counts, checks = publish.load_processed_data(spark, catalog.read_processed(spark, f"{folder}/processed"), str(tmp_path))
    assert len(asked) == 1
    assert {r.status for r in counts.collect()} == {"passed"} and checks.count() == 14
