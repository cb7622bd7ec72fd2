"""The seven-table projection: losslessness, identities, digests and faults."""

from __future__ import annotations

import json

import pytest

from attestry.operators import public_tables as P

SET = {"assertions": [{"assertion_id": "a1", "entity_id": "e", "extra": {"é": [1, None, "x"]}, "source_assertions": [{"register_id": "R", "n": 1}, {"register_id": "S"}]}, {"assertion_id": "a2"}], "reported_facts": [{"fact_id": "f1", "corpus_id": "e"}]}
CMP = {"artifact": "cmp", "comparison": {"left_observation_id": "l", "succession_state": "NORMAL"}, "changes": {"removed": ["k3"], "added": ["k1", "k2"], "changed": [{"record_key": "k4", "new": None}]}}
EV1 = {"artifact": {"not": "a text"}, "source_comparison": {"file": "c/cmp.json", "kind": "x", "sha256": "y"}, "candidates": [{"candidate_type": "A", "record_key": "k1"}, {"candidate_type": "B"}]}
EV2 = {"artifact": "ev2", "source_comparison": {"kind": "slice", "sha256": "99"}, "summary": {"input": {"added": 3}}, "candidates": [{"record_key": "k9"}]}


def files(spark, **changed):
    docs = {"s/set.one.json": (P.EVIDENCE, SET), "c/cmp.json": (P.COMPARISON, CMP), "e/ev1.json": (P.EVENTS, EV1), "e/ev2.json": (P.EVENTS, EV2), "e/bad.json": (P.EVENTS, None)} | changed
    return spark.createDataFrame([(p, k, "{" if d is None else json.dumps(d, ensure_ascii=False, indent=2)) for p, (k, d) in docs.items()], "path string, kind string, content string").repartition(3)


@pytest.fixture(scope="module")
def tables(spark):
    return P.built(files(spark))


def test_no_part_of_an_artefact_is_lost(tables):
    rows = {name: t.collect() for name, t in tables.items()}
    by_path = {r.path: r for r in rows["artifacts"]}
    for path, doc in (("s/set.one.json", SET), ("c/cmp.json", CMP), ("e/ev1.json", EV1)):
        assert by_path[path].payload_json == json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert by_path["e/bad.json"].payload_json is None and by_path["c/cmp.json"].artifact_id == "cmp" and by_path["e/ev2.json"].artifact_id == "ev2"
    assert by_path["s/set.one.json"].artifact_id == "set.one@sha256:" + by_path["s/set.one.json"].sha256 and by_path["e/ev1.json"].artifact_id.startswith("ev1@sha256:")
    assert {r.assertion_id: json.loads(r.payload_json) for r in rows["assertions"]} == {a["assertion_id"]: a for a in SET["assertions"]}
    assert sorted((r.owner_type, r.owner_id, r.ordinal, r.register_id) for r in rows["source_assertions"]) == [("assertion", "a1", 0, "R"), ("assertion", "a1", 1, "S")]
    assert [(r.ordinal, r.kind, r.record_key) for r in sorted(rows["structural_changes"], key=lambda r: r.ordinal)] == [(0, "added", "k1"), (1, "added", "k2"), (2, "changed", "k4"), (3, "removed", "k3")]
    assert sorted((r.comparison_id, r.added_count, r.changed_count, r.succession_state) for r in rows["comparisons"]) == [("cmp", 2, 1, "NORMAL"), ("slice@sha256:99", 3, None, None)]
    assert sorted((r.comparison_id, r.ordinal, r.record_key) for r in rows["change_candidates"]) == [("cmp", 0, "k1"), ("cmp", 1, None), ("slice@sha256:99", 0, "k9")]
    assert [json.loads(r.payload_json) for r in rows["reported_facts"]] == SET["reported_facts"]


def test_a_projection_built_again_is_the_same(spark, tables):
    one = P.manifest(tables, "v").orderBy("place").collect()
    assert [(r.name, r.rows) for r in one] == [("artifacts", 5), ("assertions", 2), ("reported_facts", 1), ("source_assertions", 2), ("comparisons", 2), ("structural_changes", 4), ("change_candidates", 3), ("projection", 19)]
    assert P.manifest(P.built(files(spark).repartition(1)), "v").orderBy("place").collect() == one
    other = {r.name: r.digest for r in P.manifest(P.built(files(spark, **{"e/ev2.json": (P.EVENTS, EV2 | {"candidates": []})})), "v").collect()}
    same = {r.name for r in one if r.digest == other[r.name]}
    assert same == {"assertions", "reported_facts", "source_assertions", "comparisons", "structural_changes"}
    assert P.manifest(tables, "w").collect()[-1].digest != one[-1].digest


def test_faults_of_a_projection(spark, tables):
    assert P.broken(tables).collect() == []
    twice = P.built(files(spark, **{"s/again.json": (P.EVIDENCE, {"assertions": [{"assertion_id": "a2"}]})}))
    twice["comparisons"] = twice["comparisons"].where("comparison_id = 'cmp'")
    twice["assertions"] = twice["assertions"].where("assertion_id <> 'a1'")
    assert sorted((r.fault, r.key) for r in P.broken(twice).collect()) == [("assertions: key twice", "a2"), ("change_candidates: no comparisons", "slice@sha256:99"), ("source_assertions: no owner", "assertion/a1")]


def test_a_set_in_parts_is_the_same_set(spark, tables):
    parts = [{"assertions": SET["assertions"][:1], "reported_facts": SET["reported_facts"], "note": "n"}, {"assertions": SET["assertions"][1:], "note": "n"}]
    rows = [("s/set.one.json", P.EVIDENCE, k, json.dumps(d, ensure_ascii=False)) for k, d in enumerate(parts)] + [("s/bad.json", P.EVIDENCE, 0, "{"), ("s/bad.json", P.EVIDENCE, 1, '{"assertions":[{"assertion_id":"x"}]}')]
    cut = P.built(spark.createDataFrame(rows, "path string, kind string, part long, content string").repartition(3), once=True)
    by_path = {r.path: r for r in cut["artifacts"].collect()}
    assert len(by_path) == 2 == cut["artifacts"].count() and by_path["s/bad.json"].payload_json is None and json.loads(by_path["s/set.one.json"].payload_json) == {"note": "n"}
    for name in ("assertions", "reported_facts", "source_assertions"):
        plain = [c for c in tables[name].columns if c not in ("evidence_set_id", "source_artifact_id")]
        assert sorted(map(str, cut[name].select(*plain).collect())) == sorted(map(str, tables[name].select(*plain).collect()))
    assert {r.source_artifact_id for r in cut["assertions"].collect()} == {by_path["s/set.one.json"].artifact_id}


def test_no_part_of_a_set_grows_with_the_table(spark, tmp_path):
    from attestry.plans import projection_queries as Q

    n = 3 * Q.PART
    orders = spark.range(0, n, 500).selectExpr("id as o_orderkey", "id % 2 as o_custkey", "'F' as o_orderstatus", "timestamp'1998-01-02' as o_orderdate", "'5-LOW' as o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select id as c_custkey, 0 as c_nationkey from range(2)").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql("select id as s_suppkey, 0 as s_nationkey, 'S' as s_name from range(2)").write.parquet(str(tmp_path / "supplier.parquet"))
    sizes = [len(json.loads(r.content)["assertions"]) for r in Q.artifacts(spark, str(tmp_path)).where("kind = 'evidence-set'").collect()]
    assert len(sizes) == 3 and max(sizes) <= Q.PART / 500
    assert {r["name"]: r["rows"] for r in Q.projection_manifest(spark, str(tmp_path)).collect()}["artifacts"] == 3
