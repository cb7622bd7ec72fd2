"""Identities and requests on a hand-made evidence set."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from attestry.operators import answers as A
from attestry.operators import identity as I
from tests.test_units import ASSERTION, CONTRACT, FACT, RULE

PAY = "PAYMENT_SERVICES"


@pytest.fixture(scope="module")
def evidence(spark):
    table = spark.createDataFrame
    entities = table([(1, "Pago  Uno"), (2, "Dos"), (3, "DOS "), (4, "Agent")], "entity_id long, legal_name string")
    records = table(
        [(1, "EBA_PSD2_REGISTER", {"entity_code": "ES!1", "lei": "5493001KJTIIGC8Y1R12"}), (2, "EBA_PSD2_REGISTER", {"entity_code": "ES!2"}), (3, "EBA_PSD2_REGISTER", {"entity_code": "es!2 "}), (4, "CNMV_ESI_FPS", {"official_number": "77", "lei": "5493"}), (4, "OTHER", {"entity_code": "no", "lei": ""})],
        "entity_id long, source string, texts map<string,string>",
    )
    old, root = date(2023, 1, 1), "R|PSD_PI|1"

    def assertion(i, e, effect="ENTITLED_TO_PROVIDE", kind="PAYMENT_INSTITUTION"):
        return (i, e, PAY, "ES", effect, "FREEDOM_TO_PROVIDE_SERVICES", old, None, False, False, root, "FR", "A", kind, None, None)

    assertions = table([assertion(10, 1), assertion(11, 1, "NOT_ENTITLED"), assertion(20, 2), assertion(40, 4, kind="PSP_AGENT"), assertion(41, 4)], ASSERTION)
    sources = table([(10, "A", date(2023, 12, 1), None), (11, "A", date(2024, 3, 1), None), (20, "A", date(2023, 12, 1), None), (40, "A", date(2023, 12, 1), None), (41, "A", date(2023, 12, 1), None)], "assertion_id long, register_id string, retrieved_at date, source_as_of date")
    facts = table([(90, 1, "r", "ACTIVE", "A", root, "FR", None, None, None, date(2023, 12, 1), date(2023, 12, 1)), (10, 2, "r", "ACTIVE", "A", root, "FR", None, None, None, None, None)], FACT)
    contracts = table([("A", 400, 300, "COMPLETE_ENUMERATION", [], [PAY], ["EEA"])], CONTRACT)
    rules = table([("A", 1, "IN1", "IN", None, None, None, None, None, None)], RULE)
    candidates = table([("p1", "k1", "c1"), ("p1", "k2", "c2"), ("p2", "k1", "c3")], "pair string, record_key string, candidate string")
    return A.Evidence("set@1", entities, I.identifiers(records), assertions, sources, facts, contracts, rules, candidates)


def ask(spark, evidence, *requests):
    rows = [tuple(str(r[c]) if c in r else None for c in A.REQUEST) for r in ({"request_id": k} | r for k, r in enumerate(requests))]
    found = A.answered(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in A.REQUEST)), evidence).collect()
    assert sorted(int(r.request_id) for r in found) == list(range(len(requests)))
    return [r for r in sorted(found, key=lambda r: int(r.request_id))]


def test_identifiers_and_their_rejects(evidence):
    got = sorted((r.entity_id, r.kind, r.value, r.diagnostic) for r in evidence.identifiers.collect())
    assert got == [(1, "BDE_REGISTRY_ID", "ES!1", None), (1, "LEI", "5493001KJTIIGC8Y1R12", None), (2, "BDE_REGISTRY_ID", "ES!2", None), (3, "BDE_REGISTRY_ID", "es!2 ", None), (4, "CNMV_REGISTRY_ID", "77", None), (4, "LEI", "5493", "INVALID_LENGTH")]
    classes = {r.entity_id: r.entity_classes for r in I.index(evidence.entities, evidence.assertions).collect()}
    assert classes == {1: ["PAYMENT_INSTITUTION"], 2: ["PAYMENT_INSTITUTION"], 3: [], 4: ["PAYMENT_INSTITUTION", "PSP_AGENT"]}


def test_three_ways_to_name_an_entity(spark, evidence):
    base = {"operation": "assess", "activity": PAY, "jurisdiction": "ES", "valid_at": "2024-01-01"}
    forms = [{"entity_id": 1}, {"entity_id": 9}, {"id_kind": "BDE_REGISTRY_ID", "id_value": " es!1"}, {"id_kind": "BDE_REGISTRY_ID", "id_value": "ES!2"}, {"id_kind": "LEI", "id_value": "5493"}, {"name": "pago uno"}, {"name": "dos"}, {"name": "tres"}, {"entity_id": 4, "name": "dos"}]
    got = [(r.entity_id, r.identity_state, r.reason, r.diagnostics) for r in ask(spark, evidence, *(base | f for f in forms))]
    assert [g[1] for g in got] == ["EXACT", "NOT_FOUND", "EXACT", "CONFLICTING_IDENTIFIERS", "NOT_FOUND", "AMBIGUOUS", "AMBIGUOUS", "NOT_FOUND", "EXACT"]
    assert got[0][:3] == got[2][:3] == (1, "EXACT", "ROUTE_CONFLICT") and got[8][2] == "NO_ASSERTIONS_IN_SCOPE" and got[8][3] == "agent_missing_principal:40,agent_missing_principal:41"
    assert [g[3] for g in got[1:2] + got[3:8]] == ["identity:UNKNOWN_ENTITY_ID", "identity:IDENTIFIER_MAPS_TO_MULTIPLE_ENTITIES", "identity:NO_IDENTIFIER_MATCH", "identity:SINGLE_CANDIDATE_NAME_MATCH", "identity:MULTIPLE_NAME_CANDIDATES", "identity:NO_NAME_MATCH"]
    assert got[1][2] == "IDENTITY_NOT_FOUND" and got[3][0] is None


def test_knowledge_explanations_and_audits(spark, evidence):
    base = {"activity": PAY, "jurisdiction": "ES", "valid_at": "2024-01-01", "entity_id": 1}
    now, then, said, both, same = ask(
        spark, evidence, base | {"operation": "assess"}, base | {"operation": "assess_bitemporal", "known_at": "2023-12-31"}, base | {"operation": "explain"}, base | {"operation": "explain", "known_at": "2023-12-31", "territorial_basis": "FREEDOM_TO_PROVIDE_SERVICES"},
        base | {"operation": "assess", "known_at": "2023-12-31"},
    )
    assert (now.verdict, now.reason, now.used_ids) == ("INDETERMINATE", "ROUTE_CONFLICT", "10,11") and now.evaluations is None and now.audit is None
    assert (then.verdict, then.used_ids, then.audit.usable_assertion_ids, then.audit.after_k_assertion_ids, then.audit.usable_fact_ids) == ("CONFIRMED_ENTITLED", "10", "10", "11", "90")
    assert [(e.assertion_id, e.effect_at) for e in said.evaluations] == [("10", "ENTITLED_TO_PROVIDE"), ("11", "NOT_ENTITLED")] and said.audit is None
    assert (both.verdict, [e.assertion_id for e in both.evaluations], both.audit.after_k_assertion_ids) == ("CONFIRMED_ENTITLED", ["10"], "11")
    assert same.reason == "ROUTE_CONFLICT" and same.evidence_set_id == "set@1"  # assess knows all


def test_evidence_and_changes(spark, evidence):
    item, fact, of, none, empty, key, pair, both, nothing, no_pair, every = ask(
        spark, evidence, *({"operation": "evidence"} | r for r in ({"item_id": 10}, {"item_id": 90}, {"entity_id": 1}, {"item_id": 77}, {"entity_id": 3})),
        *({"operation": "changes"} | r for r in ({"record_key": "k1"}, {"pair": "p1"}, {"pair": "p1", "record_key": "k2"}, {"record_key": "k9"}, {"pair": "p9"}, {})),
    )
    assert [(i.kind, i.id, i.sources) for i in item.items] == [("assertion", "10", ["A"])] and [i.kind for i in fact.items] == ["reported_fact"]
    assert [(i.kind, i.id) for i in of.items] == [("assertion", "10"), ("assertion", "11"), ("reported_fact", "90")] and (none.error, none.items) == ("not_found", None) and empty.items == []
    assert [c.candidate for c in key.candidates] == ["c1", "c3"] and [c.candidate for c in pair.candidates] == ["c1", "c2"] and [c.candidate for c in both.candidates] == ["c2"]
    assert nothing.candidates == [] and nothing.error is None and no_pair.error == "not_found" and (every.candidates, every.n_candidates) == (None, 3)


def test_bad_requests_fail_alone(spark, evidence):
    good = {"operation": "assess", "entity_id": 2, "activity": PAY, "jurisdiction": "ES", "valid_at": "2024-01-01"}
    bad = [
        {"operation": "drop"}, {}, good | {"entity_id": ""}, good | {"activity": ""}, good | {"valid_at": "2024-1-01"}, good | {"valid_at": "20240101"}, good | {"operation": "assess_bitemporal"}, good | {"operation": "explain", "known_at": "x"},
        {"operation": "evidence"}, {"operation": "evidence", "item_id": 1, "entity_id": 1}, good | {"evidence_set_id": "set@2"},
    ]
    got = ask(spark, evidence, good | {"evidence_set_id": "set@1"}, *bad)
    assert got[0].verdict == "CONFIRMED_ENTITLED" and got[0].error is None
    assert [r.error for r in got[1:]] == ["invalid_input"] * 10 + ["unknown_evidence_set"] and all(r.message and r.verdict is None for r in got[1:])
    assert A.answered(spark.createDataFrame([], ", ".join(f"{c} string" for c in A.REQUEST)), evidence).select(F.count("*")).first()[0] == 0
