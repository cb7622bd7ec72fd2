"""Runs: parse outcomes, case metrics, summaries and merges on hand-made cases."""

from __future__ import annotations

from datetime import date

from attestry.operators import runs as R


def test_outcomes_of_attempts(spark):
    keys = spark.createDataFrame([("A", ["code"]), ("B", ["code", "kind"])], "source string, fields array<string>")
    attempts = [
        (1, "A", "s", "FETCH_OK", {"code": "1", "name": "x", "field": "f"}), (2, "A", "s", "FETCH_OK", {"code": "1", "name": "y"}), (3, "A", "s", "FETCH_OK", {"code": "9"}), (4, "A", "t", "FETCH_OK", {"code": "1"}),
        (5, "A", "s", "SNAPSHOT_MISSING", {"code": "1"}), (6, "A", "s", None, {"code": "1"}), (7, "C", "s", "FETCH_OK", {"code": "1"}), (8, "B", "s", "FETCH_OK", {"code": "1", "kind": "k", "value": None}), (9, "B", "s", "FETCH_OK", None),
    ]
    records = [("A", "s", {"code": "1", "name": "x", "field": "other", "more": "m"}), ("B", "s", {"code": "1", "kind": "k"}), ("C", "s", {"code": "1"})]
    locator = "source string, snapshot_file string, {}locator map<string,string>"
    got = R.parse_outcomes(spark.createDataFrame(attempts, "attempt_id long, " + locator.format("fetch string, ")), spark.createDataFrame(records, locator.format("")), keys).collect()
    assert {r.attempt_id: (r.status, r.reason, r.record_found) for r in got} == {
        1: ("PARSE_OK", None, True), 2: ("PARSE_ERROR", "RECORD_KEY_MISMATCH", True), 3: ("PARSE_ERROR", "EXPECTED_RECORD_NOT_FOUND_IN_SNAPSHOT", False), 4: ("PARSE_ERROR", "EXPECTED_RECORD_NOT_FOUND_IN_SNAPSHOT", False),
        5: ("NOT_RUN", "SNAPSHOT_NOT_FETCHED", False), 6: ("NOT_RUN", "SNAPSHOT_NOT_FETCHED", False), 7: ("PARSE_ERROR", "NO_PARSER_FOR_SOURCE", False), 8: ("PARSE_OK", None, True), 9: ("PARSE_ERROR", "EXPECTED_RECORD_NOT_FOUND_IN_SNAPSHOT", False),
    }


def test_loose_and_strict_metrics_of_cases(spark):
    day = date(2024, 1, 1)
    question = "entity_id long, activity string, jurisdiction string, asked_basis string, valid_at date, known_at date"
    verdicts = [(e, "P", "ES", None, day, day, v, r, u) for e, v, r, u in ((1, "YES", "R", "10,11"), (2, "YES", "R", "10"), (3, "NO", "N", ""))]
    case = lambda n, e, v, r, b, m: (n, e, "P", "ES", None, day, day, v, r, b, m)
    cases = [
        case("exact", 1, "YES", "R", ["B", "D"], None), case("loose", 1, "YES", "R", ["B"], "M1"), case("strict", 2, "YES", "R", ["D"], "M1"), case("basis", 2, "YES", "R", ["B"], None), case("mechanism", 2, "YES", "R", None, "M9"),
        case("reason", 2, "YES", "Q", None, None), case("empty", 3, "NO", "N", [], None), case("lost", 9, "YES", "R", None, None),
    ]
    assertions = spark.createDataFrame([(10, "ENTITLED_TO_PROVIDE", "D", "M1"), (11, "ENTITLED_TO_PROVIDE", "B", "M2"), (12, "NOT_ENTITLED", "X", "M3")], "assertion_id long, legal_effect string, territorial_basis string, entry_mechanism string")
    found = R.case_results(
        spark.createDataFrame(cases, f"case_id string, {question}, expected_verdict string, expected_reason string, expected_bases array<string>, expected_mechanism string"), spark.createDataFrame(verdicts, f"{question}, verdict string, reason string, used_ids string"), assertions
    )
    got = {r.case_id: (r.match, r.strict_match, r.strict_divergences) for r in found.collect()}
    b, m = "territorial_basis_set", "entry_mechanism_set"
    assert got == {
        "exact": (True, False, [m]), "loose": (True, False, [b, m]), "strict": (True, True, []), "basis": (False, False, [b, m]), "mechanism": (False, False, [b, m]), "reason": (False, False, [b, m]), "empty": (True, True, []), "lost": (False, False, [b]),
    }
    total = {r.verdict: (r.n_cases, r.n_match, r.n_strict, r.n_reason_mismatch) for r in R.case_summary(found).collect()}
    assert total == {"*": (8, 4, 2, 2), "YES": (6, 3, 1, 1), "NO": (1, 1, 1, 0), "NONE": (1, 0, 0, 1)}


def test_merges(spark):
    one = spark.createDataFrame([("a", 1, None), ("b", 1, "x")], "file string, n int, day string")
    two = spark.createDataFrame([("b", 2, None), ("c", 2, "y")], "file string, n int, day string")
    assert sorted(tuple(r) for r in R.merged([one, two], "file").collect()) == [("a", 1, None), ("b", 2, None), ("c", 2, "y")]
    assert [tuple(r) for r in R.twice([one, two], "file").collect()] == [("b", 2)] and R.twice([one], "file").collect() == []


def test_summary_of_attempts(spark):
    rows = [("FETCH_OK", "PARSE_OK", None, None, [("NAME", True), ("NAME", None)]), ("FETCH_OK", None, "EXACT", None, None)]
    got = R.attempt_summary(spark.createDataFrame(rows, "fetch string, parse string, identity string, semantics string, divergences array<struct<classification:string,expected:boolean>>")).collect()
    assert sorted(tuple(r) for r in got) == [("divergence", "*", 2, 1), ("divergence", "NAME", 2, 1), ("fetch", "*", 2, 0), ("fetch", "FETCH_OK", 2, 0), ("identity", "*", 1, 0), ("identity", "EXACT", 1, 0), ("parse", "*", 1, 0), ("parse", "PARSE_OK", 1, 0)]
