"""The claims ledger: eleven rules, untraced fields and derivation again."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from attestry.operators import ledger as K

LEI = "5493001KJTIIGC8Y1R12"
EBA = {"EntityCode": "C1", "Properties": [{"NAM": "Uno"}, {"NAM": "Dos"}, {"AUT": ["2000-01-01"]}, {"N": 5}], "Services": [{"ES": ["b", {"x": ["a", "q\"é:"]}]}, {"FR": "b"}, 7]}
RECORDS = {
    ("e1", "EBA"): (EBA, {"code": "C1", "name": "Uno", "aut": ["2000-01-01"], "aut_type": "list", "n_type": "int", "none_type": "NoneType", "codes": ["b", "a", "q\"é:", "b"], "odd": 1}),
    ("e1", "CSV"): ({"lei": LEI, "end": "", "sup": None}, {"lei": LEI, "valid": True, "diag": "VALID", "end": None, "sup": ""}),
    ("e2", "CSV"): ({"lei": "x", "end": "2001"}, {"lei": "x", "valid": False, "diag": "INVALID_LENGTH", "end": "2001", "sup": ""}),
    ("e3", "TXT"): ("Firm Uno no. 7", {"title": "Uno", "lei": None}),
}
TRACES = [
    ("EBA", "code", "ATTR", "EntityCode"), ("EBA", "name", "PROPERTY", "NAM"), ("EBA", "aut", "PROPERTY", "AUT"), ("EBA", "aut_type", "TYPE_NAME", "AUT"), ("EBA", "n_type", "TYPE_NAME", "N"), ("EBA", "none_type", "TYPE_NAME", "no"), ("EBA", "codes", "FLATTEN_STRINGS", "Services"),
    ("CSV", "lei", "COPY", "lei"), ("CSV", "valid", "IS_VALID_LEI", "lei"), ("CSV", "diag", "LEI_DIAGNOSTIC_V2", "lei"), ("CSV", "end", "EMPTY_TO_NULL", "end"), ("CSV", "sup", "COPY_OR_EMPTY", "sup"), ("TXT", "title", "TEXT_EXTRACT", "h1"), ("TXT", "lei", "NOT_PUBLISHED", None),
]


def attempts(spark, records):
    rows = [(c, s, "PARSE_OK", f"{s}.json", f"k{c}", json.dumps(raw), json.dumps(seen), "p1", "run1") for (c, s), (raw, seen) in records.items()] + [("e9", "CSV", "FETCH_FAILED", "CSV.json", None, None, None, "p1", "run1")]
    df = spark.createDataFrame(rows, "corpus_id string, source string, parse_status string, snapshot_file string, record_key string, raw string, seen string, parser string, run_version string")
    return df.withColumns({"raw_record": F.parse_json("raw"), "observed": F.parse_json("seen")}).drop("raw", "seen")


@pytest.fixture(scope="module")
def ledger(spark):
    manifest = spark.createDataFrame([("EBA.json", "h1", "u1", "2024-01-01", "2023-12-31"), ("CSV.json", "h2", "u2", "2024-01-01", None)], "snapshot_file string, sha256 string, source_url string, retrieved_at string, source_as_of string")
    return K.claims(attempts(spark, RECORDS), spark.createDataFrame(TRACES, K.TRACE), manifest).cache()


def test_a_claim_for_every_traced_field(ledger):
    got = {r.claim_id: r for r in ledger.collect()}
    assert len(got) == 7 + 5 + 5 + 2
    assert got["e1|EBA|name"].raw_value == '"Uno"' and got["e1|EBA|none_type"].raw_value == "null" and json.loads(got["e1|EBA|codes"].raw_value) == EBA["Services"] and got["e3|TXT|title"].raw_value == '"Firm Uno no. 7"'
    assert (got["e1|EBA|code"].source_date_reliability, got["e1|CSV|lei"].source_date_reliability, got["e3|TXT|lei"].snapshot_sha256) == ("TRUSTED", "UNAVAILABLE", None)
    assert got["e1|CSV|diag"].rule_version == "LEI_DIAGNOSTIC_V2" and got["e1|CSV|lei"].rule_version == "run1" and got["e1|CSV|end"].normalized_value == "null"


def test_claims_are_derived_again(spark, ledger):
    assert {r.state for r in K.verified(ledger, attempts(spark, RECORDS)).collect()} == {"VERIFIED"}
    spoilt = ledger.withColumns({
        "raw_value": F.when(F.col("claim_id") == "e1|CSV|lei", '"y"').otherwise(F.col("raw_value")), "raw_record_sha256": F.when(F.col("claim_id") == "e2|CSV|end", "0").otherwise(F.col("raw_record_sha256")),
        "normalized_value": F.when(F.col("claim_id") == "e1|EBA|codes", '["a","b"]').when(F.col("claim_id") == "e3|TXT|title", '"Dos"').when(F.col("claim_id") == "e1|EBA|n_type", "5").otherwise(F.col("normalized_value")),
    })
    got = {r.claim_id: r.state for r in K.verified(spoilt, attempts(spark, {k: v for k, v in RECORDS.items() if k != ("e2", "CSV")} | {("e2", "CSV"): RECORDS["e2", "CSV"]})).collect()}
    assert {k: v for k, v in got.items() if v != "VERIFIED"} == {"e1|CSV|lei": "RAW_MISMATCH", "e2|CSV|end": "RAW_HASH_MISMATCH", "e1|EBA|codes": "NORMALIZED_MISMATCH", "e3|TXT|title": "NORMALIZED_MISMATCH", "e1|EBA|n_type": "NORMALIZED_MISMATCH"}
    left = K.verified(ledger, attempts(spark, {("e1", "CSV"): RECORDS["e1", "CSV"]})).collect()
    assert {r.state for r in left if not r.claim_id.startswith("e1|CSV")} == {"NO_ATTEMPT"}


def test_untraced_fields_and_faulty_traces(spark):
    traces = spark.createDataFrame(TRACES, K.TRACE)
    assert [tuple(r) for r in K.untraced(attempts(spark, RECORDS), traces).select("corpus_id", "source", "field").collect()] == [("e1", "EBA", "odd")]
    assert K.faulty(traces).collect() == []
    bad = spark.createDataFrame([("A", "x", "COPY", None), ("A", "y", "GUESS", "r"), ("A", "z", "COPY", "r"), ("A", "z", "ATTR", "r")], K.TRACE)
    assert sorted(tuple(r) for r in K.faulty(bad).collect()) == [("A", "x", "NO_REFERENCE"), ("A", "y", "UNKNOWN_RULE"), ("A", "z", "TWICE")]


def test_flattening(spark):
    cases = ['[["a",{"k":"b","l":[{"m":"a"}]}],"c:d","e\\"f"]', "null", "7", '"x"', "{}", '["\\\\","\\u00e9",""]']
    got = spark.createDataFrame([(c,) for c in cases], "t string").select(K.flattened(F.col("t")).alias("f")).collect()
    assert [json.loads(r.f) for r in got] == [["a", "b", "a", "c:d", 'e"f'], [], [], ["x"], [], ["\\", "é", ""]]
