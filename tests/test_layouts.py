"""Page layouts, ground truth, lineage, typed differences and addresses on hand-made cases."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from attestry.functions import scalars as S
from attestry.operators import ground_truth as G
from attestry.operators import lineage as N
from attestry.operators import longitudinal as LG
from attestry.sources import layouts as Y

PAGE = """<p><table><tr><td>menu</td></tr></table> ContentPrincipal
<table><tr><th>Nombre</th><th>Direcci&oacute;n</th><th></th></tr><tr><td>Uno</td><td>Calle <b>A</b>&#44; 1</td><td>x</td></tr></table>
<table><tr><th>Nombre</th></tr><tr><td>Dos &#233;&#x20AC;</td></tr></table>
<table><tr><td> </td></tr><tr><th>Fecha</th><th>Acto</th></tr><tr><td>1/1/2000</td><td>Alta</td></tr><tr><td>2/2/2001</td></tr></table>
<table><tr><th>Servicios de inversi&oacute;n</th></tr><tr><th>a. Valores</th><th>b. Otros</th><th>Minoristas</th></tr>
<tr><td>Gesti&oacute;nCarteras propias</td><td><img alt="Si"></td><td></td><td><img alt="Si"/></td></tr><tr><td>Custodia</td><td><img alt="No"></td><td><img alt="Si"></td><td></td></tr><tr><td></td><td><img alt="Si"></td></tr></table>
<table><tr><th>Servicios auxiliares</th></tr><tr><th>Profesionales</th></tr><tr><td>Cambio</td><td><img alt="Si"></td></tr></table>"""


def test_pages_of_tables(spark):
    pages = spark.createDataFrame([("p", PAGE), ("q", "no table"), ("r", None)], "id string, html string")
    found = Y.cells(pages, "id", "html", "ContentPrincipal").cache()
    assert {(r.id, r.header): r.value for r in Y.pairs(found, "id").collect()} == {("p", "Nombre"): "Dos é€", ("p", "Dirección"): "Calle A , 1"}
    assert sorted((r.row, r.header, r.text) for r in Y.listed(found, "id", "fecha").collect()) == [(1, "Acto", "Alta"), (1, "Fecha", "1/1/2000"), (2, "Fecha", "2/2/2001")]
    got = sorted((r.kind, r.service, r.instruments, r.clients) for r in Y.service_matrix(found, "id").collect())
    assert got == [("auxiliary", "Cambio", [], ["Profesionales"]), ("investment", "Custodia", ["b"], []), ("investment", "Gestión", ["a"], ["Minoristas"])]
    assert Y.cells(pages.where("false"), "id", "html").collect() == []


def test_pages_read_by_patterns(spark):
    permission = "<tr><td>Verwahrung von Kryptowerte (Art. 59 Abs{} i.V.m. Art. 3 Abs. 1 Nr. 16 {} MiCA-R) x</td><td>{}</td></tr>"
    head = "<dt>Bafin-ID:</dt> <dd>123&nbsp;</dd><dt>Gattung:</dt><dd>Wertpapierinstitut&nbsp;</dd><h2>Unternehmen</h2> <p> <strong>X AG </strong>"
    pages = [("one", head + permission.format(". 1a", "a", "01.02.2025") + permission.format(" .1a", "c", "01.02.2025")), ("two", head + permission.format(".1b", "c", "01.02.2025") + permission.format(". 1a", "b", "03.02.2025")), ("none", "<dt>")]
    got = {r.id: tuple(r)[1:7] for r in Y.home_permissions(spark.createDataFrame(pages, "id string, html string"), "id", "html").collect()}
    assert got == {"one": ("X AG", "123", "Wertpapierinstitut", "ART_59_1A", "01.02.2025", "a|c"), "two": ("X AG", "123", "Wertpapierinstitut", "MIXED", None, "b|c"), "none": (None,) * 6}
    data = '{"name":"F","finanstilsynetId":"FT1","remarks":"see MiCA  Article 60(3)","licenceCode":"B"},{"licenceCode":"A"},{"licenceCode":"B"}'
    r = Y.remarked_licences(spark.createDataFrame([("f", data), ("g", "{}")], "id string, html string"), "id", "html").orderBy("id").collect()
    assert tuple(r[0])[1:] == ("F", "FT1", "see MiCA  Article 60(3)", "A|B", "ART_60_3") and tuple(r[1])[1:] == (None,) * 5


def test_character_references(spark):
    text = "&#8364; &#xE9; &#233; &eacute;&ntilde; &amp;lt; &lt; &#xZZ; &#99999999; &# &nope;"
    assert spark.range(1).select(S.unescaped(F.lit(text))).first()[0] == "€ é é éñ &lt; < &#xZZ; &#99999999; &# &nope;"


def test_ground_truth(spark):
    fields = ["lei", "service_codes_raw", "service_countries_raw", "commercial_name", "entity_code", "national_reference_code", "official_number", "country", "european_code", "home_member_state", "authorisation_notification_date", "category", "registration_date", "entity_type", "legal_name"]
    rows = [
        ("e", {"lei": "L", "home_member_state": "ES", "legal_name": "Uno  sa", "entity_type": "PSD_PI"}, ["PS_080"], ["2000-01-01", "2001-01-01"]), ("e", {"legal_name": "UNO SA", "official_number": "7", "registration_date": "01/01/2006"}, None, None),
        ("f", {"lei": "L", "legal_name": "A"}, [], ["2000-1-1"]), ("f", {"legal_name": "B", "official_number": ""}, None, []),
    ]
    schema = "entity_id string, " + ", ".join(f"{c} string" for c in fields) + ", service_codes array<string>, ent_aut_raw array<string>"
    records = spark.createDataFrame([(e, *(f.get(c) for c in fields), codes, dates) for e, f, codes, dates in rows], schema)
    asked = {
        "e": ["home_state_ES", "esma_lei_present", "lei_present", "entity_type_PSD_PI", "service_PS_080", "ent_aut_raw_is_date_array", "multiple_ent_aut_dates", "no_lei_in_summary", "old_registration_date", "official_number_present", "source_is_partial_classification"],
        "f": ["lei_present", "cross_source_name_variant", "esma_lei_present", "official_number_present", "no_lei_in_summary", "multiple_ent_aut_dates", "ent_aut_raw_is_date_array"], "g": ["source_is_partial_classification", "lei_present"], "h": ["no such fact"], "i": [],
    }
    got = {r.entity_id: (r.status, r.missing, r.unknown) for r in G.checked(spark.createDataFrame(list(asked.items()), "entity_id string, facts array<string>"), records, ("PSD_PI",)).collect()}
    # an empty log is a log of dates, as nothing in it is not one
    assert got == {
        "e": ("MATCH", [], []), "f": ("DIVERGENCE", ["esma_lei_present", "official_number_present", "multiple_ent_aut_dates"], []), "g": ("DIVERGENCE", ["lei_present"], []),
        "h": ("UNKNOWN_FACT", [], ["no such fact"]), "i": ("MATCH", [], []),
    }
    assert len(G.predicates(("PSD_PI", "PSD_EMI", "PSD_AISP"))) == 29


def test_lineage_events(spark):
    names = N.Names("http://me", "jobs", "snaps", "arts", "http://me/facets")
    snapshots = spark.createDataFrame([("s1", "a.csv", "h1", "http://x", 5, "2024-01-01", None, "S", "R", "A")], "ref string, snapshot_file string, sha256 string, source_url string, bytes long, retrieved_at string, source_as_of string, source string, register_id string, authority string")
    artifacts = spark.createDataFrame([("a1", "ledger", "l.json", "h2", None, None), ("a2", "rules", "b.json", None, "v1", "h3")], "ref string, artifact_kind string, path string, sha256 string, artifact_version string, result_sha256 string")
    runs = spark.createDataFrame(
        [("r1", "derive", "2024-02-02T00:00:00Z", "2025-01-01T00:00:00Z", ["s1", "a1"], ["a2"], "v", None, "i", "o", None), ("r2", "freeze", None, "2025-01-01T00:00:00Z", ["a2", "lost"], [], "v", "G", "i", None, None)],
        "run string, job string, executed_at string, observed_at string, inputs array<string>, outputs array<string>, run_version string, gate string, input_sha256 string, output_sha256 string, code_sha256 string",
    )
    found = N.events(runs, N.datasets(names, snapshots, artifacts), names)
    got = {r.file: (json.loads(r.event), r.missing) for r in found.collect()}
    assert sorted(got) == ["derive.r1.complete.json", "derive.r1.start.json", "freeze.r2.jobevent.json"]
    start, job = got["derive.r1.start.json"][0], got["freeze.r2.jobevent.json"][0]
    assert start["run"]["runId"] == got["derive.r1.complete.json"][0]["run"]["runId"] and start["eventType"] == "START" and start["schemaURL"].endswith("RunEvent")
    assert [(d["namespace"], d["name"]) for d in start["inputs"]] == [("arts", "l.json"), ("snaps", "h1")] and [d["name"] for d in start["outputs"]] == ["b.json"]
    facet = start["inputs"][1]["facets"]["snapshot"]
    assert facet["snapshot_file"] == "a.csv" and "source_as_of" not in facet and facet["_schemaURL"] == "http://me/facets/snapshot.json" and "artifact" not in start["inputs"][1]["facets"]
    assert start["run"]["facets"]["run_contract"] == {"_producer": "http://me", "_schemaURL": "http://me/facets/contract.json", "run_name": "r1", "run_version": "v", "input_sha256": "i", "output_sha256": "o"}
    assert "run" not in job and "eventType" not in job and job["eventTime"] == "2025-01-01T00:00:00Z" and job["job"]["facets"]["job_contract"]["gate"] == "G" and got["freeze.r2.jobevent.json"][1] == ["lost"]
    assert sorted(tuple(r) for r in N.edges(found).select("input", "job", "output").collect()) == [("h1", "derive", "b.json"), ("l.json", "derive", "b.json")]


def test_lineage_files(spark, tmp_path):
    N.written(spark.createDataFrame([('{"a":1}',), ('{"b":"é"}',)], "event string"), str(tmp_path / "events"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "events")).collect()) == ['{"a":1}', '{"b":"é"}']


def test_typed_differences(spark):
    pairs = {
        1: ({"a": 1, "b": {"c": "x", "d": None}}, {"a": "1", "b": {"c": "x"}}), 2: ({"a": [1, 2]}, {"a": [2, 1], "n": None}), 3: ({"a": {"b": {"c": {"d": 1}}}}, {"a": {"b": {"c": {"d": 2, "e": {}}}}}),
        4: ({"a": {"b": 1}}, {"a": 5}), 5: ({"a": None}, {"a": 0}), 6: ({"x": 1}, {"x": 1}), 7: (None, {"x": 1}), 8: ({"x": 1}, None), 9: ({"a.b": {}}, {"a.b": {"": 1}}),
    }
    side = lambda n: spark.createDataFrame([(k, json.dumps(p[n])) for k, p in pairs.items() if p[n] is not None], "k long, t string").select("k", F.parse_json("t").alias("doc"))
    got = sorted((r.k, r.kind, tuple(r.path), r.old, r.new) for r in LG.typed_diff(side(0), side(1), "k", "doc").collect())
    assert got == [
        (1, "changed", ("a",), "1", '"1"'), (1, "removed", ("b", "d"), "null", None), (2, "added", ("n",), None, "null"), (2, "changed", ("a",), "[1,2]", "[2,1]"),
        (3, "added", ("a", "b", "c", "e"), None, "{}"), (3, "changed", ("a", "b", "c", "d"), "1", "2"), (4, "changed", ("a",), '{"b":1}', "5"), (5, "changed", ("a",), "null", "0"),
        (7, "added", (), None, '{"x":1}'), (8, "removed", (), '{"x":1}', None), (9, "added", ("a.b", ""), None, "1"),
    ]


def test_addresses(spark):
    states = [("e", "2001", "A"), ("e", "2002", "A"), ("e", "2003", "UNKNOWN"), ("e", "2004", "A"), ("e", "2005", "B"), ("e", "2006", "A"), ("f", "2001", "X"), ("f", "2002", "X"), ("g", "2001", "Q"), ("h", "2001", "Z"), ("h", "2002", None)]
    present = [("e", "C", "2010"), ("f", "X", "2010"), ("g", "UNKNOWN", "2010")]
    got = LG.address_changes(spark.createDataFrame(states, "entity_id string, as_of string, address string"), spark.createDataFrame(present, "entity_id string, address string, observed_at string")).collect()
    assert sorted(tuple(r) for r in got) == [("e", "A", "2001", "2004", 3, "B", "2005"), ("e", "A", "2006", "2006", 1, "C", "2010"), ("e", "B", "2005", "2005", 1, "A", "2006")]


def test_records_without_a_code(spark):
    texts = ['{"EntityType":"T","Properties":[{"A":1}]}', '{"EntityType":"T","Properties":[{"A":2}]}', '{"EntityType":"T","EntityCode":"1","Properties":[{"A":3}]}']
    got = LG.normalized(spark.createDataFrame([(t,) for t in texts], "record string")).collect()
    assert {(r.record_key, r.path, r.value, r.problem) for r in got} == {(None, "ca_owner_id", None, "NO_RECORD_KEY"), (None, "properties.A", None, "NO_RECORD_KEY"), ("T:1", "ca_owner_id", None, None), ("T:1", "properties.A", "3", None)}
