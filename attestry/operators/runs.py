"""Runs over register snapshots and over cases: outcomes, metrics and summaries, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.operators.tables import kept
from attestry.operators.verdict import ENTITLED, QUESTION, many

LAYERS = ("fetch", "parse", "identity", "semantics")
PARSED, FAILED, NOT_RUN = "PARSE_OK", "PARSE_ERROR", "NOT_RUN"
#: The part of a locator that only says which field it was taken from.
LABEL = "field"


def located(expected: Column, observed: Column) -> Column:
    """Whether every part of an expected locator (a map), but for its label, is the observed one's."""
    parts = F.filter(F.map_entries(expected), lambda e: e["key"] != LABEL)
    return F.coalesce(F.forall(parts, lambda e: F.try_element_at(observed, e["key"]).eqNullSafe(e["value"])), F.lit(False))


def record_key(locator: Column, fields: Column) -> Column:
    """A record's key: the values of its source's key fields, in their order."""
    return F.array_join(F.transform(fields, lambda f: F.coalesce(F.try_element_at(locator, f), F.lit(""))), "|")


def parse_outcomes(attempts: DataFrame, records: DataFrame, keys: DataFrame) -> DataFrame:
    """What became of each attempt to read a record: attempt_id, status, reason, record_found.

    ``attempts`` has attempt_id, source, snapshot_file, fetch and locator, ``records`` source,
    snapshot_file and locator, ``keys`` the names of each source's key fields. An attempt meets the
    records of its own snapshot by key; of several under one key the last locator counts. A
    snapshot that was not fetched is not parsed, a source without key fields has no parser.
    """
    keyed = lambda df: df.join(F.broadcast(keys.select("source", "fields")), "source", "left").withColumn("key", record_key(F.col("locator"), F.col("fields")))
    found = keyed(records).where("key is not null").groupBy("source", "snapshot_file", "key").agg(F.max(F.array_sort(F.map_entries("locator"))).alias("_there"))
    rows = keyed(attempts).join(found, ["source", "snapshot_file", "key"], "left")
    there = F.col("_there").isNotNull()
    reason = (
        F.when(~F.coalesce(F.col("fetch") == "FETCH_OK", F.lit(False)), "SNAPSHOT_NOT_FETCHED").when(F.col("fields").isNull(), "NO_PARSER_FOR_SOURCE").when(~there, "EXPECTED_RECORD_NOT_FOUND_IN_SNAPSHOT")
        .when(~located(F.col("locator"), F.map_from_entries("_there")), "RECORD_KEY_MISMATCH")
    )
    status = F.when(reason == "SNAPSHOT_NOT_FETCHED", NOT_RUN).when(reason.isNotNull(), FAILED).otherwise(PARSED)
    return rows.select("attempt_id", "source", status.alias("status"), reason.alias("reason"), (there & (status != NOT_RUN)).alias("record_found"))


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """How many attempts of each layer had each status, and divergences by class and in total.

    ``attempts`` has a status column of each layer (NULL where a layer said nothing) and
    ``divergences``, an array of classification and expected. Columns: counter, value, n, unexpected.
    """
    layers = [F.struct(F.lit(layer).alias("counter"), F.col(layer).alias("value"), F.lit(None).cast("boolean").alias("expected")) for layer in LAYERS]
    diverged = F.transform(F.coalesce("divergences", F.array().cast("array<struct<classification:string,expected:boolean>>")), lambda d: F.struct(F.lit("divergence").alias("counter"), d["classification"].alias("value"), F.coalesce(d["expected"], F.lit(False)).alias("expected")))
    rows = attempts.select(F.explode(F.concat(F.array(*layers), diverged)).alias("c")).select("c.*").where("value is not null")
    sets = rows.rollup("counter", "value").agg(F.count("*").alias("n"), F.count_if(~F.col("expected")).alias("unexpected"))
    return sets.where("counter is not null").select("counter", F.coalesce("value", F.lit("*")).alias("value"), "n", "unexpected")


def _found(cases: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Cases with their verdict, reason and used evidence; cases, of which there are as many as questions, are not broadcast."""
    said = verdicts.select(*(F.col(c).alias(f"_{c}") for c in QUESTION), "verdict", "reason", "used_ids")
    return many(cases).join(said, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in QUESTION], "left").drop(*(f"_{c}" for c in QUESTION))


def case_results(cases: DataFrame, verdicts: DataFrame, assertions: DataFrame) -> DataFrame:
    """Each case with what was found and how it meets what was expected, loosely and strictly.

    ``cases`` has case_id, the question, expected_verdict, expected_reason, expected_bases and
    expected_mechanism; ``assertions`` assertion_id, legal_effect, territorial_basis and
    entry_mechanism. Loosely, expected bases are among those of the entitling assertions that were
    used and an expected mechanism among those of all used ones, and what is not expected is not
    asked. Strictly both sets are equal to what was expected; nothing expected is an empty set of
    mechanisms, and no expectation of bases is never met.
    """
    met = kept(_found(cases, verdicts))  # read twice, and a verdict is costly
    used = met.where("used_ids <> ''").select("case_id", F.explode(F.split("used_ids", ",")).alias("id"))
    told = assertions.select(F.col("assertion_id").cast("string").alias("id"), "legal_effect", "territorial_basis", "entry_mechanism")
    sets = used.join(told, "id").groupBy("case_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("legal_effect") == ENTITLED, F.col("territorial_basis")))).alias("bases"), F.array_sort(F.collect_set("entry_mechanism")).alias("mechanisms")
    )
    none = F.array().cast("array<string>")
    rows = met.join(sets, "case_id", "left").withColumns({"bases": F.coalesce("bases", none), "mechanisms": F.coalesce("mechanisms", none)})
    yes = lambda c: F.coalesce(c, F.lit(False))
    basis = F.col("expected_bases").isNull() | (F.size(F.array_except("expected_bases", "bases")) == 0)
    mechanism = F.col("expected_mechanism").isNull() | F.array_contains("mechanisms", F.col("expected_mechanism"))
    strict_basis = yes(F.array_sort(F.array_distinct("expected_bases")) == F.col("bases"))
    strict_mechanism = F.col("mechanisms") == F.when(F.col("expected_mechanism").isNull(), none).otherwise(F.array("expected_mechanism"))
    rows = rows.withColumns({"verdict_match": yes(F.col("verdict") == F.col("expected_verdict")), "reason_match": yes(F.col("reason") == F.col("expected_reason")), "basis_match": yes(basis), "mechanism_match": yes(mechanism)})
    rows = rows.withColumn("match", F.col("verdict_match") & F.col("reason_match") & F.col("basis_match") & F.col("mechanism_match"))
    rows = rows.withColumn("strict_divergences", F.array_compact(F.array(F.when(~strict_basis, "territorial_basis_set"), F.when(~strict_mechanism, "entry_mechanism_set"))))
    return rows.withColumn("strict_match", F.col("match") & (F.size("strict_divergences") == 0))


def case_summary(results: DataFrame) -> DataFrame:
    """Both metrics by found verdict and in total: verdict, n_cases, n_match, n_strict, n_reason_mismatch."""
    count = lambda c, name: F.count_if(c).alias(name)
    sets = results.withColumn("verdict", F.coalesce("verdict", F.lit("NONE"))).rollup("verdict").agg(F.count("*").alias("n_cases"), count(F.col("match"), "n_match"), count(F.col("strict_match"), "n_strict"), count(~F.col("reason_match"), "n_reason_mismatch"))
    return sets.withColumn("verdict", F.coalesce("verdict", F.lit("*")))


def candidate_summary(changes: DataFrame, candidates: DataFrame, on: str) -> DataFrame:
    """Of each comparison: what went in by kind, and how many candidates came out, supported or blocked."""
    kind = lambda k: F.count_if(F.col("kind") == k).alias(k)
    went = changes.groupBy(on).agg(*map(kind, ("added", "removed", "changed")))
    came = candidates.groupBy(on).agg(F.count("*").alias("candidates"), F.count_if(F.col("admissibility") == "SUPPORTED").alias("supported"), F.count_if(F.col("admissibility") == "BLOCKED").alias("blocked"))
    return went.join(came, on, "full").fillna(0)


def merged(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of several tables, of each key the one of the last table that has it."""
    rows = None
    for k, part in enumerate(parts):
        part = part.withColumn("_part", F.lit(k))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    columns = [c for c in rows.columns if c not in (key, "_part")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "_part").alias("_r")).select(key, "_r.*")


def twice(parts: list[DataFrame], key: str) -> DataFrame:
    """Keys that more than one row of the tables together have, and how many: a merge of claims must have none."""
    rows = parts[0].select(key)
    for part in parts[1:]:
        rows = rows.union(part.select(key))
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
