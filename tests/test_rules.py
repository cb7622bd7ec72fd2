"""Rule files and register records on hand-made cases."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from attestry.functions import scalars as S
from attestry.operators import registers as G
from attestry.operators import rulefile as R
from attestry.operators import tables as T
from attestry.operators.tables import ordinal
from attestry.plans import payment_rules
from attestry.plans import register_queries as Q
from attestry.sources.artifacts import strict_object

GROUP = "group_ord long, entity_id string, source string, register_id string, texts map<string,string>, lists map<string,array<string>>, claim_ids array<string>, source_assertions array<struct<url:string>>"


def rule(rule_id, conditions=(), required=(), source="A", **outcome):
    return {"rule_id": rule_id, "match": {"source": source, "conditions": list(conditions)}, "required_fields": list(required)} | outcome


EMIT = {
    "entity_class_from": {"field": "type", "map": {"T1": "BANK", "T2": "SHOP"}}, "activity": "$ITEM", "jurisdiction": "ES", "entry_mechanism": "AUTHORISATION", "territorial_basis": "DOMESTIC", "legal_effect": "ENTITLED_TO_PROVIDE",
    "legal_basis": "by {law} in Services{ES}", "scope": "all", "effective_from": {"derivation": "FIELD_DDMMYYYY", "field": "start"}, "effective_to": {"derivation": "FIELD_COPY_OR_NULL", "field": "end"}, "interval_end": "EXCLUSIVE",
}
FACT = {"reported_status_from": {"field": "state"}, "detail": "state", "negative_scope_from": {"field": "why", "map": {"x": "ROOT_FAMILY"}}, "effective_from_field": "end", "emit_source_provenance": True}
RULES = [
    rule("per", [{"field": "codes", "op": "NOT_NULL"}], ["law_id"], emit_per={"iterate": {"field": "codes", "mode": "SPLIT", "separator": "|", "exclude_values": ["zz"], "exclude_field_value": "own"}, "emit": EMIT}),
    rule("absent", [{"field": "list", "op": "ABSENT_IN", "value": "old"}], emit_per={"iterate": {"field": "list", "mode": "ABSENT_FROM_SET", "universe": ["a", "b", "c"]}, "emit": EMIT | {"effective_from": {"derivation": "EVIDENCE_AS_OF"}}}),
    rule("fact", [{"field": "state", "op": "NOT_IN", "value": ["QUIET"]}], emit_status_fact=FACT),
    rule("find", [{"field": "type", "op": "EQ", "value": None}], finding={"classification": "NO_TYPE", "detail": "no type"}),
]
BASE = {"entity_class": "BANK", "activity": "a"}
FOLLOWS = {"activity": "b2", "legal_effect": "ENTITLED_TO_PROVIDE", "entry_mechanism": "LAW", "legal_basis": "l", "scope": "s"}
IDLE = {"classification": "IDLE", "detail": "nothing"}
DERIVED = [
    {"rule_id": "d1", "ruleset_version": "v", "base": BASE, "emit": FOLLOWS, "untriggered_finding": IDLE},
    {"rule_id": "d2", "ruleset_version": "v", "base": {"entity_class": "BANK", "activity": "b2"}, "emit": FOLLOWS | {"activity": "c3"}, "untriggered_finding": IDLE},
    {"rule_id": "d3", "ruleset_version": "v", "base": {"entity_class": "BANK", "activity": "no"}, "emit": FOLLOWS, "untriggered_finding": IDLE},
]


@pytest.fixture(scope="module")
def tables(spark):
    full = {"codes": " a |a||b|zz|me", "own": "me", "law_id": "1", "law": "L", "type": "T1", "start": "01/02/2000", "end": "2001-01-01", "state": "ACTIVE", "why": "x"}
    rows = [
        (1, "e1", "A", "r", full, {}, ["c1", "c2"], [("u",)]),
        (2, "e1", "A", "r", full | {"codes": "a"}, {}, ["c3"], []),
        (3, "e2", "A", "r", full | {"law": "", "codes": "q", "state": "QUIET"}, {}, [], []),
        (4, "e2", "A", "r", full | {"start": "soon", "codes": "a", "state": "QUIET"}, {}, [], []),
        (5, "e3", "A", "r", {"codes": "a", "state": "ACTIVE"}, {}, [], []),
        (6, "e4", "A", "r", {"type": "T9", "law": "L"}, {"list": ["b"]}, [], []),
        (7, "e4", "A", "r", {"type": "T2", "law": "L"}, {"list": ["a", "b", "c"]}, [], []),
        (8, "e5", "A", "r", {"type": "T2", "law": "L"}, {"list": ["old"]}, [], []),
        (9, "e6", "B", "r", full, {}, [], []),
    ]
    groups = spark.createDataFrame(rows, GROUP).repartition(3)
    rules = R.load(R.dumps("v1", RULES, DERIVED))
    return groups, rules, {k: df.orderBy(F.length(df.columns[-1]), df.columns[-1]).collect() for k, df in R.run(groups, rules, "2002-02-02", "dv", "p").items()}


def test_assertions_of_both_passes(tables):
    got = [(r.assertion_id, r.entity_id, r.rule_id, r.activity, r.entity_class, r.effective_from, r.effective_to, r.derived_by) for r in tables[2]["assertions"]]
    assert got == [
        ("p-asm-001", "e1", "per", "a", "BANK", "2000-02-01", "2001-01-01", None), ("p-asm-002", "e1", "per", "b", "BANK", "2000-02-01", "2001-01-01", None),
        ("p-asm-003", "e1", "per", "a", "BANK", "2000-02-01", "2001-01-01", None), ("p-asm-004", "e1", "d1", "b2", "BANK", "2000-02-01", "2001-01-01", "d1"),
        ("p-asm-005", "e1", "d2", "c3", "BANK", "2000-02-01", "2001-01-01", "d2"),
    ]
    first, derived = tables[2]["assertions"][0], tables[2]["assertions"][3]
    assert first.legal_basis == "by L in Services{ES}" and first.source_claim_ids == ["c1", "c2"] and first.interval_end == "EXCLUSIVE" and first.ruleset_version == "dv"
    assert derived.source_claim_ids == ["c1", "c2"] and derived.legal_basis == "l" and derived.interval_end is None and derived.ruleset_version == "v"


def test_facts_and_findings(tables):
    facts = [(r.fact_id, r.entity_id, r.reported_status, r.negative_scope, r.effective_from, r.source_claim_ids) for r in tables[2]["facts"]]
    assert facts == [("p-fact-001", "e1", "ACTIVE", "ROOT_FAMILY", "2001-01-01", ["c1", "c2"]), ("p-fact-002", "e1", "ACTIVE", "ROOT_FAMILY", "2001-01-01", ["c3"]), ("p-fact-003", "e3", "ACTIVE", None, None, [])]
    assert [(r.finding_id, r.entity_id, r.source, r.rule_id, r.classification) for r in tables[2]["findings"]] == [
        ("p-fnd-001", "e2", "A", "per", "REQUIRED_FIELD_MISSING"), ("p-fnd-002", "e2", "A", "per", "REQUIRED_FIELD_UNDERIVABLE"), ("p-fnd-003", "e3", "A", "per", "REQUIRED_FIELD_MISSING"),
        ("p-fnd-004", "e3", "A", "find", "NO_TYPE"), ("p-fnd-005", "e4", "A", "absent", "UNSUPPORTED_ENTITY_CLASS"), ("p-fnd-006", "e4", "A", "absent", "UNSUPPORTED_ENTITY_CLASS"), ("p-fnd-007", "e1", None, "d3", "IDLE"),
    ]


def test_header_pins_rules_and_groups(spark, tables):
    groups, rules, _ = tables
    head = lambda g, r: R.header(g, R.outcomes(g, r, "2002-02-02"), r, "a1", "dv").first()
    one = head(groups, rules)
    assert (one.claims_consumed, one.assertions_emitted, one.findings_emitted, one.reported_facts_emitted, one.assessment) == (3, 5, 7, 3, "NOT_RUN")
    assert head(groups.repartition(5), rules) == one
    changed = head(groups.withColumn("source", F.when(F.col("group_ord") == 9, "C").otherwise(F.col("source"))), rules)
    assert changed.claims_sha256 != one.claims_sha256 and changed.assertions_emitted == 5
    assert R.load(R.dumps("v1", RULES, DERIVED[:2])).sha256 != rules.sha256


def test_faults_of_rule_files():
    bad = [
        rule("x", [{"field": "a", "op": "LIKE", "value": 1}], emit_per={"iterate": {"field": "f", "mode": "SPLIT"}, "emit": {k: v for k, v in EMIT.items() if k != "scope"}}),
        rule("x", emit=EMIT, finding={"classification": "c"}), rule("y", emit=EMIT | {"interval_end": "OPEN", "effective_to": {"derivation": "FIELD_COPY"}}), rule("z", emit_status_fact={"detail": "d"}),
    ]
    with pytest.raises(R.RuleFileError) as e:
        R.load(R.dumps("v", bad, [{"rule_id": "d"}]))
    text = str(e.value)
    for part in ("rules[0].match.conditions[0]", "rules[0].emit_per.iterate", "rules[0].emit_per.emit.scope", "rules[1]: one outcome", "rules[2].emit.interval_end", "rules[2].emit.effective_to", "rules[3].emit_status_fact", "x: twice", "derived_rules[0].base: missing"):
        assert part in text, part
    with pytest.raises(R.RuleFileError):
        R.load(json.dumps({"rules": []}))
    for text in ('{"a": 1, "a": 2}', '{"a": 1.5}', '{"a": NaN}', "[1]"):
        with pytest.raises(ValueError):
            strict_object(text)


def test_the_payment_rule_set():
    rules = R.load(payment_rules.text())
    assert len(rules.rules) == 26 and rules.sha256 == R.load(payment_rules.text()).sha256
    assert payment_rules.EU_MAP["PS_060"] == payment_rules.NATIONAL_MAP["6"] == "MONEY_REMITTANCE" and payment_rules.NATIONAL_MAP["B"] == "E_MONEY_ISSUANCE"


FIELDS = (
    "entity_type entity_code ent_aut_text der_chi_ent_aut parent_type parent_code codigo_be tipo_entidad pais_origen fecha_alta fecha_baja motivo_baja cnmv_category services_from service_countries home_member_state "
    "service_codes authorisation_notification_date authorisation_end_date mica_home_route home_mechanism_remark home_entity_class_de home_licences"
).split()


def records(spark, rows):
    schema = "group_ord long, entity_id string, source string, " + ", ".join(f"{c} string" for c in FIELDS)
    df = spark.createDataFrame([(k, e, s, *(f.get(c) for c in FIELDS)) for k, (e, s, f) in enumerate(rows)], schema)
    return df.withColumn("ent_aut", F.filter(F.split("ent_aut_text", r"\|"), lambda x: x != "")).repartition(3)


def test_root_keys(spark):
    eba = lambda t, c, **f: ("e", G.EBA, {"entity_type": t, "entity_code": c} | f)
    nat = lambda code, kind, land="ES", entity="e", source=G.PAYMENTS: (entity, source, {"codigo_be": code, "tipo_entidad": kind, "pais_origen": land})
    rows = [
        eba("PSD_PI", "PSD_PI!ES_BE!1"), eba("PSD_EMI", "ES_BE!2"), eba("PSD_EMI", "PSD_EMI!ES_BE!2"), eba("PSD_BR", "x", parent_type="PSD_PI", parent_code="PSD_PI!NL_DNB!7"), eba("PSD_AG", "y", parent_type="PSD_PI"),
        nat("1", "Entidad de pago"), nat("2", "Entidad de dinero electrónico"), nat("3", "Entidad de pago"), nat("9", "Sucursal de EP", "NL"), nat("9", "Entidad de pago", "FR"), nat("8", "Otra", None), nat(None, "Otra", None),
        nat("1", "Entidad de pago", entity="f"), ("f", G.EBA, {"entity_type": "PSD_BR", "entity_code": "q", "parent_type": "PSD_PI", "parent_code": "DE_BF!1"}),
        ("f", G.EBA, {"entity_type": "PSD_BR", "entity_code": "r", "parent_type": "PSD_PI", "parent_code": "DE_BF!2"}), nat("5", "Sucursal", "DE", "f", G.ESTABLISHED), ("g", G.CRYPTO, {}),
    ]
    got = {r.group_ord: (r.root_key, r.root_home_jurisdiction) for r in G.with_roots(records(spark, rows)).collect()}
    assert got == dict(enumerate([
        ("EBA|PSD_PI|ES_BE!1", "ES"), ("EBA|PSD_EMI|ES_BE!2", "ES"), ("EBA|PSD_EMI|ES_BE!2", "ES"), ("EBA|PSD_PI|NL_DNB!7", "NL"), (None, None),
        ("EBA|PSD_PI|ES_BE!1", "ES"), ("BDE|PSD_EMI|2", "ES"), ("BDE|PSD_PI|3", "ES"), ("EBA|PSD_PI|NL_DNB!7", "NL"), ("EBA|PSD_PI|NL_DNB!7", "NL"), ("BDE|UNKNOWN|8", None), (None, None),
        ("BDE|PSD_PI|1", "ES"), ("EBA|PSD_PI|DE_BF!1", "DE"), ("EBA|PSD_PI|DE_BF!2", "DE"), ("BDE|BRANCH|5", "DE"), (None, None),
    ]))


def test_parents_branches_categories_and_mechanisms(spark):
    rows = [
        ("e", G.EBA, {"entity_type": "PSD_PI", "entity_code": "P!1", "ent_aut_text": "2000-01-01"}), ("e", G.EBA, {"entity_type": "PSD_PI", "entity_code": "P!1", "ent_aut_text": "2000-01-01|2001-01-01"}),
        ("e", G.EBA, {"entity_type": "PSD_BR", "entity_code": "B", "parent_type": "PSD_PI", "parent_code": "P!1", "der_chi_ent_aut": "Removed"}),
        ("f", G.EBA, {"entity_type": "PSD_BR", "entity_code": "C", "parent_type": "PSD_PI", "parent_code": "none"}),
        ("e", G.ESTABLISHED, {"fecha_alta": "01/01/2000", "codigo_be": "7"}), ("e", G.PAYMENTS, {"fecha_alta": "01/01/2000", "fecha_baja": "02/03/2004", "motivo_baja": "Fusión"}),
        ("f", G.PAYMENTS, {"fecha_alta": "01/01/2000"}), ("f", G.PAYMENTS, {"fecha_alta": "02/01/2000"}),
        ("m", G.CRYPTO, {"service_countries": "DE|ES", "home_member_state": "DE", "authorisation_notification_date": "01/02/2003", "service_codes": "a. x c. y"}),
        ("m", G.CATEGORY, {"cnmv_category": "Sucursal", "services_from": "09/09/2009"}), ("m", G.CATEGORY, {"cnmv_category": "PSC Limited LP", "services_from": "1/2/2003"}),
        ("m", G.HOME_SOURCES[0], {"mica_home_route": "ART_59_1B", "home_entity_class_de": "Kreditinstitut"}), ("n", G.CRYPTO, {"authorisation_end_date": "x"}),
        ("n", G.HOME_SOURCES[0], {"mica_home_route": "ART_59_1A"}), ("n", G.HOME_SOURCES[1], {"home_mechanism_remark": "ART_60_3"}),
    ]
    r = {x.group_ord: x for x in G.derived(records(spark, rows)).collect()}
    assert (r[2].eba_parent_status, r[2].eba_parent_class_label, r[2].eba_child_status, r[2].corroborating) == ("WITHDRAWN", "PI", "WITHDRAWN", [1, 4, 5])
    assert (r[3].eba_parent_status, r[3].eba_parent_entity_type) == ("UNKNOWN", None)
    assert (r[2].bde_branch_registered, r[2].bde_branch_fecha_alta, r[2].bde_branch_codigo, r[2].bde_entity_baja_kind, r[2].bde_branch_date_conflict) == ("FALSE", "01/01/2000", "7", "TRANSFORMATION", None)
    assert (r[3].bde_branch_registered, r[3].bde_branch_fecha_alta, r[3].bde_branch_date_conflict) == ("TRUE", None, "TRUE")
    assert (r[8].cnmv_territorial_route, r[8].mica_es_declared, r[8].mica_foreign_countries, r[8].mica_dates_agree, r[8].mica_status, r[8].mica_service_letters) == ("LIMITED_LP", "TRUE", "ES", "TRUE", "ACTIVE", "a|c")
    assert (r[8].mica_home_mechanism, r[8].mica_home_legal_ref, r[8].mica_home_entity_class, r[8].corroborating) == ("NOTIFICATION", G.LEGAL_REFS["NOTIFICATION"], G.CREDIT, [10, 11])
    assert (r[12].mica_home_mechanism, r[12].mica_home_mechanism_conflict, r[12].mica_home_legal_ref, r[12].mica_status, r[12].corroborating) == (None, "TRUE", None, "ENDED", [13, 14])
    claims = spark.createDataFrame([(k, f"c{k}", "s1" if k < 12 else "s2") for k in range(15)], "group_ord long, claim_id string, snapshot_file string")
    e = {x.group_ord: x for x in G.with_evidence(G.derived(records(spark, rows)), claims, spark.createDataFrame([("s1", "http://s1")], "snapshot_file string, source_url string")).collect()}
    assert e[2].claim_ids == ["c2", "c1", "c4", "c5"] and not e[2].unsourced and e[12].unsourced and len(e[12].source_assertions) == 3


def test_ordinal(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("a"), (-F.col("id")).alias("b")).repartition(6)
    got = ordinal(rows, ["a", "b"]).orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(1, 3001)) and [(r.a, r.b) for r in got] == sorted((i % 7, -i) for i in range(3000))
    assert ordinal(rows.where("a > 9"), ["a", "b"]).collect() == []


def test_texts_of_registers(spark):
    row = spark.range(1).select(
        S.country_services_json(F.lit('[{"ES": ["PS_1", "PS_2"]}, {"FR": "PS_9"}, {"ES": "PS_2"}, {"ES": "PS_3"}]'), "ES").alias("services"), S.code_core(F.lit("PSD_PI"), F.lit("PSD_PI!PT_BP!8")).alias("core"),
        S.home_country(F.lit("BE_NBB!07!ES")).alias("home"), S.home_country(F.lit("8703")).alias("nowhere"), S.psd_family(F.lit("Sucursal de entidad de pago")).alias("family"), S.child_state(F.lit("")).alias("child"),
        S.territorial_route(F.lit("PSC (España)")).alias("route"), S.territorial_route(F.lit("PSC en régimen de LP")).alias("lp"), S.ended(F.lit(" ")).alias("ended"), S.template("{a}{B}{c d}", {"a": F.lit("x")}).alias("t"),
    ).first()
    assert tuple(row) == (["PS_1", "PS_2", "PS_3"], "PT_BP!8", "BE", None, "BRANCH", None, "DOMESTIC", "LP", "ACTIVE", "x{B}{c d}")


def test_assertions_numbered_by_ranges(spark, tables):
    groups, rules, whole = tables
    for at in ([], [2], [1, 2, 5, 40]):
        got = R.numbered_assertions(groups, lambda rows: rows, rules, "2002-02-02", "dv", at, "assertion_id", "p-asm").orderBy("assertion_id").collect()
        assert [r.asDict() for r in got] == [r.asDict() for r in whole["assertions"]]
        got = R.numbered_facts(groups, lambda rows: rows, rules, "2002-02-02", at, "fact_id", "p-fact").orderBy("fact_id").collect()
        assert [r.asDict() for r in got] == [r.asDict() for r in whole["facts"]]


def test_sequence_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(T, "FEW_ROWS", 500)
    rows = spark.range(3000).select((F.col("id") * 7 % 3001).alias("k")).repartition(5)
    at = T.cuts(rows, "k")
    assert len(at) == 3 and sorted({r.p for r in rows.select(T.part_of(F.col("k"), [10, 20, 2000]).alias("p")).collect()}) == [0, 1, 2, 3]
    held = T.ranged(rows, "k", [10, 20, 2000])
    one = (lambda in_order: held.sortWithinPartitions("k") if in_order else held, T.part_of(F.col("k"), [10, 20, 2000]))
    got = [r.seq for r in T.in_sequence([one, one]).orderBy("k", "seq").collect()]
    assert got == [x for k in range(1, 3001) for x in (k, k + 3000)]


def written_by(spark, monkeypatch, query) -> tuple[int, int]:
    """Exchanges of chosen partitions that the query wrote, and those that it read again; it must write nothing else between steps."""
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables here")

    def refused(df):
        raise AssertionError("rows between steps are written")

    for module in (T, R, Q):
        monkeypatch.setattr(module, "kept", refused)
    df = query(spark, d)
    assert df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    found = [line for line in plan.splitlines() if "Exchange " in line and "REPARTITION_BY_NUM" in line]
    again = sum("ReusedExchange" in line for line in found)
    return len(found) - again, again


def test_assertions_write_no_copies(spark, monkeypatch):
    wrote, again = written_by(spark, monkeypatch, Q.ruleset_assertions)
    assert wrote == 3 and again >= 3  # records by entity, their groups by range, derived rows by range


def test_facts_write_no_copies(spark, monkeypatch):
    assert written_by(spark, monkeypatch, Q.ruleset_facts)[0] == 2


def test_header_writes_no_copies(spark, monkeypatch):
    assert written_by(spark, monkeypatch, Q.ruleset_header) == (1, 1)


def test_header_counts_derived_rules_by_entity(spark, tables):
    groups, _, _ = tables
    rules = R.load(R.dumps("v1", RULES, [DERIVED[0], DERIVED[2]]))  # no chain: one grouping by entity
    found = R.outcomes(groups, rules, "2002-02-02")
    one = R.header(groups, found, rules, "a1", "dv").first()
    every = R.assertions(found, rules, "dv")
    assert (one.assertions_emitted, one.findings_emitted, one.reported_facts_emitted) == (every.count(), R.findings(found, every, rules).count(), R.facts(found).count()) == (4, 7, 3)
    assert one.claims_sha256 and R.header(groups, found, rules, "a1", "dv", pinned=False).first().claims_sha256 is None


def test_records_of_no_entity_say_nothing_of_each_other(spark):
    rows = [
        (None, G.EBA, {"entity_type": "PSD_BR", "entity_code": "B", "parent_type": "PSD_PI", "parent_code": "P"}), (None, G.PAYMENTS, {"fecha_alta": "01/01/2000", "codigo_be": "7", "tipo_entidad": "Sucursal"}),
        ("e", G.EBA, {"entity_type": "PSD_PI", "entity_code": "P", "ent_aut_text": "2000-01-01"}),
    ]
    r = {x.group_ord: x for x in G.derived(records(spark, rows)).collect()}
    assert len(r) == 3 and (r[0].bde_branch_registered, r[0].eba_parent_status, r[0].corroborating) == (None, "ACTIVE", [2]) and r[1].root_key == "BDE|BRANCH|7"


def test_fields_that_rules_read():
    assert R.fields(R.load(R.dumps("v1", RULES, DERIVED))) == {"codes", "law_id", "own", "type", "law", "start", "end", "list", "state", "why", R.INTERVALS_FIELD}
