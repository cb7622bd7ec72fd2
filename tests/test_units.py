"""Scalars, conditions, rules, identity and sources against values worked out by hand."""

from __future__ import annotations

import json
import os
import uuid
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from attestry.functions import conditions as C
from attestry.functions import scalars as S
from attestry.operators import longitudinal as LG
from attestry.operators import rules as R
from attestry.operators import verdict as V
from attestry.sources import archives, registers


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_conditions_give_no_null(spark):
    rows = [(None, None), ("", []), ("A", ["x"])]
    v, a = F.col("v"), F.col("a")
    got = values(spark, rows, "v string, a array<string>", C.equals(v, None), C.present(v), C.absent(v), C.one_of(v, ["A"]), C.none_of(v, ["A"]), C.lacks(a, "x"))
    assert got == [(True, False, True, False, True, False), (False, False, True, False, True, True), (False, True, False, True, False, False)]


def test_lei_and_tax_ids(spark):
    leis = [(None,), ("  ",), ("529900T8BM49AURSDO5",), ("529900T8BM49AURSDO*5",), ("529900T8BM49AURSDO56",), (" 529900t8bm49aursdo55 ",)]
    assert [x for (x,) in values(spark, leis, "v string", S.lei_diagnostic(F.col("v")))] == ["MISSING", "MISSING", "INVALID_LENGTH", "INVALID_CHARSET", "INVALID_CHECK_DIGITS", "VALID"]
    ids = [("12345678Z",), ("12345678A",), ("X1234567L",), ("A12345676",), ("A12345671",), (None,), ("",), ("B1234567F",), ("A1234567",)]
    assert [x for (x,) in values(spark, ids, "v string", S.valid_tax_id(F.col("v")))] == [True, False, True, True, False, False, False, True, False]


def test_dates_and_templates(spark):
    got = values(spark, [("2026-09-04", "1/2/2020"), ("2026-9-4", "31/02/2020"), (None, "")], "a string, b string", S.strict_date(F.col("a")), S.spanish_date(F.col("b")))
    assert got == [(date(2026, 9, 4), date(2020, 2, 1)), (None, None), (None, None)]
    got = values(spark, [("x", 1), ("", 2), (None, 3)], "a string, b int", S.template("{a}-{b}!", {"a": F.col("a"), "b": F.col("b")}))
    assert got == [("x-1!",), (None,), (None,)]
    assert values(spark, [("run/1",)], "a string", S.uuid5(S.NAMESPACE_URL, F.col("a"))) == [(str(uuid.uuid5(uuid.NAMESPACE_URL, "run/1")),)]


def test_windows_and_effects(spark):
    at, lo, hi, ex = (F.col(c) for c in ("t", "a", "b", "x"))
    day = date(2020, 1, 10)
    rows = [(day, date(2020, 1, 1), day, True), (day, date(2020, 1, 1), day, False), (day, date(2020, 1, 11), None, False), (day, day, None, True)]
    assert [x for (x,) in values(spark, rows, "t date, a date, b date, x boolean", V.covers(at, lo, hi, ex))] == [False, True, False, True]


def test_transition_log(spark):
    d = [date(2020, 1, i) for i in range(1, 5)]
    log = F.col("log")
    got = values(spark, [([],), (d[:1],), (d[:2],), (d[:3],)], "log array<date>", LG.intervals_of_log(log), LG.last_authorisation(log))
    assert [[tuple(i) for i in x] for x, _ in got] == [[], [(d[0], None)], [(d[0], d[1])], [(d[0], d[1]), (d[2], None)]]
    assert [y for _, y in got] == [None, d[0], d[0], d[2]]


def test_rules_items_and_missing(spark):
    rules = [
        R.Rule("A", "s", (), ("must",), "EMIT", emit={"activity": "{code}"}, mapping={"activity": {"1": "ONE"}}),
        R.Rule("B", "s", (), (), "EMIT_PER", R.Iterate("seen", "ABSENT_FROM_SET", universe=("p", "q"), excludes=("q",)), {"activity": "$ITEM"}),
    ]
    df = spark.createDataFrame([(1, "s", "x", "1", ["q"]), (2, "s", None, "1", ["p"]), (3, "s", "x", "9", None), (4, "other", "x", "1", None)], "id long, source string, must string, code string, seen array<string>")
    got = sorted((r.id, r.rule_id, r.kind, r.activity) for r in R.derive(df, rules, "id").collect())
    assert got == [(1, "A", "EMIT", "ONE"), (1, "B", "EMIT_PER", "p"), (2, "A", "FINDING", None), (3, "A", "FINDING", None)]


def test_diff_is_its_own_inverse(spark):
    left = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "a", "y")], "k long, path string, v string")
    right = spark.createDataFrame([(1, "a", "z"), (3, "a", "y")], "k long, path string, v string")
    there = {(r.k, r.kind, r.change, r.path, r.old, r.new) for r in LG.structural_diff(left, right, "k", "path", "v").collect()}
    back = {(r.k, r.kind, r.change, r.path, r.old, r.new) for r in LG.structural_diff(right, left, "k", "path", "v").collect()}
    swap = {"added": "removed", "removed": "added", "changed": "changed", None: None}
    assert there == {(1, "changed", "changed", "a", "x", "z"), (1, "changed", "removed", "b", None, None), (2, "removed", None, "", None, None), (3, "added", None, "", None, None)}
    assert back == {(k, swap[kind], swap[c], p, new, old) for k, kind, c, p, old, new in there}


def test_csv_and_snapshots(spark, tmp_path):
    f = tmp_path / "reg.csv"
    f.write_text('﻿name,lei,end,\nA,X1,,\n"B, b",,01/02/2020,\n', encoding="utf-8")
    got = registers.register_csv(spark, str(f), ["name", "lei"], ("end",)).collect()
    assert [tuple(r) for r in got] == [("A", "X1", None), ("B, b", "", "01/02/2020")]
    some = registers.register_csv(spark, str(f), ["name"], renamed={"lei": "id"}, targets=("name", ["B, b"])).collect()
    assert [r.asDict() for r in some] == [{"id": ""}]
    with pytest.raises(ValueError):
        registers.register_csv(spark, str(f), ["absent"])
    manifest = spark.createDataFrame([("reg.csv", 1, "0"), ("gone.csv", 1, "0")], "snapshot_file string, bytes long, sha256 string")
    got = {r.snapshot_file: r.fetch for r in registers.verified_snapshots(spark, str(tmp_path / "*.csv"), manifest).collect()}
    assert got == {"reg.csv": "SIZE_MISMATCH", "gone.csv": "SNAPSHOT_MISSING"}
    assert registers.evidence_set_id(spark, str(f)).first().evidence_set_id.startswith("reg@sha256:")


def test_strict_json(spark):
    rows = [('{"a": 1}',), ('{"a": 1.0}',), ('{"a": "1.5"}',), ('{"a": 1, "a": 2}',), ("[1e3]",)]
    assert [x for (x,) in values(spark, rows, "v string", registers.strict_json(F.col("v")).isNotNull())] == [True, False, True, False, False]


def test_zip_and_xlsx(spark, tmp_path):
    records = [{"EntityCode": f"E{i}", "Properties": [{"ENT_NAM": "Ñ" * 9}]} for i in range(300)]
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("r.json", json.dumps([[{"disclaimer": "no"}], records]))
    got = archives.zip_records(spark, str(tmp_path / "r.zip"), ("EntityCode", "Properties")).orderBy("ordinal").collect()
    assert [json.loads(r.record) for r in got] == records
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="One" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>code</t></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1"><v>7</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>hi</t></is></c></row></sheetData></worksheet>')
    got = archives.sheet_cells(spark, str(tmp_path / "b.xlsx")).collect()
    assert [(r.sheet, r.row_no, r.column_no, r.value) for r in got] == [("One", 1, 0, "code"), ("One", 1, 27, "7"), ("One", 3, 1, "hi")]
    assert archives.zip_records(spark, str(tmp_path / "r.zip")).count() == 301
    under = archives.with_header(archives.sheet_cells(spark, str(tmp_path / "b.xlsx")), "code").collect()
    assert [(r.header, r.row_no, r.value) for r in under] == []
    cells = spark.createDataFrame([("f", "S", 1, 0, "title"), ("f", "S", 2, 0, " Código "), ("f", "S", 2, 1, "Name"), ("f", "S", 3, 0, "7"), ("f", "S", 3, 1, "A"), ("f", "T", 1, 0, "x")], "file string, sheet string, row_no long, column_no int, value string")
    assert sorted((r.row_no, r.header, r.value) for r in archives.with_header(cells, "codigo").collect()) == [(3, "codigo", "7"), (3, "name", "A")]
    with pytest.raises(ValueError):
        list(archives.array_items(__import__("io").StringIO("[[1.5]]")))


def test_arrivals_as_a_stream(spark, tmp_path):
    from attestry.streaming import observations

    src = spark.createDataFrame([(1, "2024-01-02 03:00:00"), (1, "2024-01-20 03:00:00"), (2, "2024-01-02 04:00:00")], "u long, ts string").select("u", F.col("ts").cast("timestamp").alias("ts"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = observations.arrivals(stream, "u", "ts", "2024-01-15").writeStream.outputMode("complete").format("memory").queryName("arrived").trigger(availableNow=True).start()
    q.awaitTermination(60)
    want = {tuple(r) for r in observations.arrivals(src, "u", "ts", "2024-01-15").collect()}
    assert {tuple(r) for r in spark.table("arrived").collect()} == want


def test_succession_and_observations(spark):
    d = date(2024, 1, 2)
    got = values(spark, [(None, None), (d, None), (d, d), (d, date(2024, 1, 1)), (date(2024, 1, 1), d)], "a date, b date", LG.succession_state(F.col("a"), F.col("b")))
    assert [x for (x,) in got] == ["UNKNOWN_SOURCE_AS_OF", "UNKNOWN_SOURCE_AS_OF", "SAME_AS_OF_REVISION", "NORMAL_SUCCESSION", "SOURCE_AS_OF_REGRESSION"]
    got = values(spark, [("R|2024-01-02|ab",), ("R|x|2024-01-02|ab",), ("R|2024",), (None,)], "v string", LG.observed_at(F.col("v")))
    assert [x for (x,) in got] == ["2024-01-02", "2024-01-02", None, None]


def test_claims_derived_again_as_null(spark):
    from attestry.operators import claims

    own = spark.createDataFrame([("a", None, None, "h"), ("b", "x", None, "h"), ("c", "x", "y", "h"), ("d", "x", "y", "h")], "claim_id string, raw_value string, normal_value string, raw_sha256 string")
    again = spark.createDataFrame([("a", None, None, "h"), ("b", "x", "z", "h"), ("d", "x", "y", "other")], "claim_id string, raw_value string, normal_value string, raw_sha256 string")
    assert {r.claim_id: r.state for r in claims.verified(own, again).collect()} == {"a": "VERIFIED", "b": "NORMALIZED_MISMATCH", "c": "NO_ATTEMPT", "d": "RAW_HASH_MISMATCH"}


def test_mentions_inside_words(spark):
    from attestry.operators import projection

    notices = spark.createDataFrame([(1, "the etorogroup of x"), (2, "ETORO (CLONE)"), (3, "an E-TORO here"), (4, "nothing"), (5, None)], "notice_id long, text string")
    names = spark.createDataFrame([(1, "Etoro Ltd"), (2, "E-Toro, S.A."), (3, "Abc Def"), (4, None)], "entity_id long, legal_name string")
    assert sorted(tuple(r) for r in projection.name_mentions(notices, names).collect()) == [(1, 1), (3, 2)]


def test_digest_does_not_depend_on_order_but_on_rows(spark):
    from attestry.operators import projection

    one = lambda df, n: projection.table_digest(df, "id", ["v"], n).first()
    df = spark.range(50).select("id", (F.col("id") * 7).alias("v"))
    for n in (3, 10_000):
        assert one(df, n) == one(df.orderBy(F.desc("id")).repartition(3), n) and one(df, n).n_rows == 50
        assert one(df, n).digest != one(df.where("id <> 3"), n).digest
    assert one(df.where("false"), 3).n_rows == 0


QUESTION = "entity_id long, activity string, jurisdiction string, asked_basis string, valid_at date, known_at date, identity_state string, identity_reason string, entity_classes array<string>"
ASSERTION = (
    "assertion_id long, entity_id long, activity string, jurisdiction string, legal_effect string, territorial_basis string, effective_from date, effective_to date, exclusive_end boolean, "
    "blocked boolean, root_key string, root_home string, register_id string, entity_class string, principal_id long, composition string"
)
FACT = (
    "fact_id long, entity_id long, rule_id string, reported_status string, register_id string, root_key string, root_home string, negative_class string, effective_from date, "
    "spans array<struct<from:date,to:date>>, knowledge_time date, fresh_at date"
)
CONTRACT = "register_id string, positive_days long, negative_days long, capability string, excluded_classes array<string>, activities array<string>, jurisdictions array<string>"
RULE = "register_id string, ordinal long, rule_id string, scope string, rule_class string, rule_activities array<string>, rule_jurisdictions array<string>, rule_bases array<string>, valid_from date, valid_to date"


@pytest.fixture(scope="module")
def judged(spark):
    """Hand-made evidence, one entity a case, and what each version says of it."""
    yes, no, unknown, fps = "ENTITLED_TO_PROVIDE", "NOT_ENTITLED", "UNKNOWN", "FREEDOM_TO_PROVIDE_SERVICES"
    day, pay, aisp = date(2024, 1, 1), "PAYMENT_INITIATION_SERVICES", "ACCOUNT_INFORMATION_SERVICES"
    old, root, other, only = date(2020, 1, 1), "R|PSD_PI|1", "R|PSD_EMI|2", "R|PSD_AISP|3"
    a, f, q = [], [], []

    def assertion(e, effect=yes, basis=fps, key=root, home="FR", since=date(2023, 1, 1), until=None, register="A", blocked=False, kind="BANK", principal=None, composition=None, exclusive=False):
        a.append((len(a), e, pay, "ES", effect, basis, since, until, exclusive, blocked, key, home, register, kind, principal, composition))

    def fact(e, negative=None, since=date(2023, 6, 1), key=root, spans=None, status="ACTIVE", rule="x", fresh=date(2023, 12, 1), home="FR", register="A"):
        f.append((len(f), e, rule, status, register, key, home, negative, since, spans, fresh, fresh))

    def ask(e, basis=None, state="EXACT"):
        q.append((e, pay, "ES", basis, day, day, state, "WHY", ["BANK", "PSP_AGENT"] if e in (16, 17, 29) else ["BANK"]))

    assertion(1)  # an open route
    assertion(2), assertion(2, no)  # both on one route
    assertion(3, no), assertion(3, no, "BRANCH")  # a foreign root has two routes, both closed
    assertion(4, no, "DOMESTIC", home="ES")  # a domestic root has one
    assertion(5, no), fact(5, "EXPLICIT_WITHDRAWAL", key=root)  # withdrawn
    assertion(6, no), fact(6, "ENTITY_BAJA")  # a change of form closes nothing
    assertion(7, no, blocked=True)
    assertion(8, no), assertion(8, no, "BRANCH"), fact(8, key=only, negative=None)  # a root that can't hold the activity doesn't count
    assertion(9, no), assertion(9, no, "BRANCH"), fact(9, key=other)  # one that can does
    assertion(10, since=date(2025, 1, 1)), fact(10)  # in force later, on an open root
    assertion(11, until=date(2023, 12, 1)), fact(11)
    assertion(12, no)  # a route of two
    assertion(13, register="NONE")
    assertion(14, register="B")  # no rule, but sources
    assertion(15, composition="ALL_REQUIRED", register="A")  # its second register is stale
    assertion(16, kind="PSP_AGENT"), assertion(17, kind="PSP_AGENT", principal=5)
    assertion(18), fact(18, status="WITHDRAWN", key=None)
    fact(19, rule="ruleset/agent-parent-status", key=None), fact(20, status="WITHDRAWN", key=None)
    assertion(21, unknown), assertion(22, unknown, "BRANCH")
    assertion(23, no, key=None), assertion(23, key=None, register="B")  # routes without a root are one a register
    fact(24, spans=[(old, date(2023, 1, 1))]), fact(25, spans=[(date(2025, 1, 1), None)]), fact(26, "UNRESOLVED_MOTIVO")
    assertion(27, no, "BRANCH"), ask(27, "BRANCH")
    ask(28, None, "AMBIGUOUS"), assertion(28)
    assertion(29), assertion(29, no)  # an agent's assertions need a principal, whatever their class
    for e in (*range(1, 27), 29):
        ask(e)
    sources = [(i, "A" if r[12] == "NONE" else r[12], date(2023, 12, 1), None) for i, r in enumerate(a)]
    sources += [(next(i for i, r in enumerate(a) if r[1] == 15), "VIEW", old, None)]
    contracts = [(r, 365, 300, "COMPLETE_ENUMERATION", [], [pay, aisp], ["EEA"]) for r in ("A", "B", "C")]
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    parts = (
        table(q, QUESTION), table(a, ASSERTION), table(sources, "assertion_id long, register_id string, retrieved_at date, source_as_of date"), table(f, FACT), table(contracts, CONTRACT),
        table([("A", 1, "IN1", "IN", None, None, None, None, None, None), ("C", 1, "IN2", "IN", None, None, None, None, None, None)], RULE),
    )
    aliases = {"VIEW": "C"}
    return V.verdicts(*parts, aliases).collect(), V.assess(*parts, "V1", aliases).collect(), V.assess(*parts, "V2", aliases).collect()


def test_verdicts_by_routes_and_roots(judged):
    got = {r.entity_id: (r.verdict.split("_")[0] + ("_NOT" if "CONFIRMED_NOT" in r.verdict else ""), r.reason) for r in judged[0]}
    shut, withdrawn, unresolved = "ALL_AVAILABLE_ROUTES_CLOSED", "ROOT_FAMILY_WITHDRAWN", "TERRITORIAL_ENTITLEMENT_UNRESOLVED"
    yes, none = ("CONFIRMED", "ACTIVE_ENTITLEMENT_EVIDENCED"), ("NO", "NO_ASSERTIONS_IN_SCOPE")
    assert got == {
        1: yes, 2: ("INDETERMINATE", "ROUTE_CONFLICT"), 3: ("CONFIRMED_NOT", shut), 4: ("CONFIRMED_NOT", shut), 5: ("CONFIRMED_NOT", withdrawn), 6: ("INDETERMINATE", unresolved),
        7: ("INDETERMINATE", "NEGATIVE_EVIDENCE_BLOCKED"), 8: ("CONFIRMED_NOT", shut), 9: ("INDETERMINATE", unresolved), 10: ("INDETERMINATE", unresolved), 11: ("NO", "ENTITLEMENT_EXPIRED"),
        12: ("INDETERMINATE", unresolved), 13: none, 14: yes, 15: none, 16: none, 17: yes, 18: yes, 19: none, 20: none, 21: none, 22: none, 23: yes, 24: ("CONFIRMED_NOT", withdrawn), 25: none, 26: none,
        27: ("CONFIRMED_NOT", shut), 28: ("INDETERMINATE", "AMBIGUOUS_IDENTITY"), 29: none,
    }
    by = {r.entity_id: r for r in judged[0]}
    assert by[1].used_ids == "0" and by[1].response_freshness == date(2023, 12, 1) and by[28].used_ids == "" and by[28].diagnostics == "identity:WHY"
    assert by[15].diagnostics.startswith("stale_required_source:") and by[15].diagnostics.endswith(":VIEW") and by[13].diagnostics == "no_contract:NONE"
    assert "route_conflict:R|PSD_PI|1:FREEDOM_TO_PROVIDE_SERVICES" in by[2].diagnostics and by[7].diagnostics.startswith("blocked_evidence:")


def test_verdicts_without_routes(judged):
    one, two = ({r.entity_id: r.reason for r in rows} for rows in judged[1:])
    assert {one[e] for e in (1, 17, 18)} == {"SUPPORTED_BY_ACTIVE_ASSERTIONS"} and two[1] == "ACTIVE_ENTITLEMENT_EVIDENCED" and two[18] == "CONFLICTING_ASSERTIONS"
    assert one[2] == two[2] == "CONFLICTING_ASSERTIONS" and one[3] == "EXPLICIT_NEGATIVE_EVIDENCE" and one[7] == "EXPLICIT_NEGATIVE_EVIDENCE"
    assert one[10] == "NO_ASSERTIONS_IN_SCOPE" and one[11] == "ENTITLEMENT_EXPIRED" and two[11] == "MALFORMED_STATUS_SEQUENCE"
    assert one[13] == one[15] == "UNINTERPRETABLE_EVIDENCE" and one[16] == "AGENT_ASSERTION_MISSING_PRINCIPAL"
    assert one[29] == two[29] == "AGENT_ASSERTION_MISSING_PRINCIPAL"
    one_said, two_said = ({r.entity_id: r.diagnostics for r in rows} for rows in judged[1:])
    assert one_said[2] == "conflicting_legal_effects" and one_said[18] == "" and two_said[18] == "conflicting_reported_fact:withdrawn"
    assert two_said[20] == "reported_facts:" + str(next(r.used_ids or 8 for r in judged[2] if r.entity_id == 20)) and one_said[20] == ""
    assert one[19] == "NO_ASSERTIONS_IN_SCOPE" and two[19] == "AGENT_DELEGATED_ROUTE_NO_INDEPENDENT_ENTITLEMENT" and two[20] == "WITHDRAWAL_SEMANTICS_DEFERRED"
    assert one[21] == "UNINTERPRETABLE_EVIDENCE" and two[21] == "TERRITORIAL_ENTITLEMENT_UNRESOLVED" and two[22] == "UNINTERPRETABLE_EVIDENCE"


def test_upper_case_does_not_grow(spark):
    from attestry.functions.scalars import upper_alone
    from attestry.operators.projection import name_mentions

    rows = spark.createDataFrame([("a\u00dfb\u00df", "A\u1e9eB\u1e9e"), ("x\ufb01y\u1fb3", "X\ufb01Y\u1fbc"), ("\u00e9\n", "\u00c9\n"), ("", ""), (None, None)], "text string, said string")
    assert all(r.got == r.said for r in rows.select(upper_alone(F.col("text")).alias("got"), "said").collect())
    notices = spark.createDataFrame([(1, "die \u00dfcher hier"), (2, "die Scher hier")], "notice_id long, text string")
    assert [r.notice_id for r in name_mentions(notices, spark.createDataFrame([(9, "scher, S.A.")], "entity_id long, legal_name string")).collect()] == [2]


def test_questions_are_never_broadcast(spark):
    import re

    from attestry.operators import verdict as V
    from attestry.plans import lens as L

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables here")
    q = L.questions(spark, d)
    for pairs, key in ((V.matched(q, L.assertions(spark, d), L.sources(spark, d)), r"entity_id#\d+L, activity"), (V.facts_asked(q, L.facts(spark, d), L.contracts(spark, d)), r"entity_id#\d+L\]")):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[" + key, plan) and not re.search(r"BroadcastHashJoin \[" + key, plan)


def test_records_without_a_parent_are_spread(spark):
    from attestry.operators import registers as G

    rows = [(k, G.EBA if k % 9 == 0 else G.PAYMENTS, "PSD_PI", f"C{k}", "PSD_PI" if k % 9 == 0 else None, "C9" if k % 9 == 0 else None, "ACTIVE", "d") for k in range(900)]
    records = spark.createDataFrame(rows, "group_ord long, source string, entity_type string, entity_code string, parent_type string, parent_code string, eba_ent_aut_status string, eba_ent_aut_last_auth string")
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = G.with_parents(records).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    assert len(found) == 900 and {(r.eba_parent_status, r.parent_ord) for r in found} == {("ACTIVE", 9), (None, None)}
    sizes = [sum(r.part == p for r in found) for p in {r.part for r in found}]
    assert max(sizes) < 500  # 800 have no parent


def test_cases_are_never_broadcast(spark):
    from attestry.operators import runs as R
    from attestry.operators import verdict as V
    from attestry.plans import lens as L

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables here")
    q = L.questions(spark, d)
    verdicts = q.groupBy(*V.QUESTION).agg(F.lit("v").alias("verdict"), F.lit("r").alias("reason"), F.max("identity_state").alias("used_ids"))
    plan = R._found(q.withColumn("case_id", F.concat_ws("/", *V.QUESTION)), verdicts).where("used_ids <> ''")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_parts_of_a_numbering_do_not_grow(spark, monkeypatch):
    from attestry.operators import tables as T

    monkeypatch.setattr(T, "PART_ROWS", 50)
    made = []
    keep = T.kept
    monkeypatch.setattr(T, "kept", lambda df: made.append(keep(df)) or made[-1])
    rows = spark.range(5000).select((-F.col("id")).alias("k"))
    assert sorted((r.k, r.seq) for r in T.ordinal(rows, ["k"]).collect()) == [(k, k + 5000) for k in range(-4999, 1)]
    sizes = [r["count"] for r in made[-1].groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 250 and len(sizes) > 50
    assert T.ordinal(rows.where("k > 0"), ["k"]).count() == 0
