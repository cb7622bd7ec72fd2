"""The read-only operations as tables: requests are checked, answered, explained and evidenced.

A request that cannot be answered has a code in ``error`` instead of an answer; one bad request
does not fail the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import strict_date

OPERATIONS = ("assess", "assess_bitemporal", "explain", "evidence", "changes")


def _given(*columns: str) -> Column:
    """How many of the columns have a value."""
    total = F.lit(0)
    for c in columns:
        total = total + F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0)
    return total


def checked(requests: DataFrame, entities: DataFrame) -> DataFrame:
    """Requests (all texts) with their parsed dates and the first error, by the order of the checks.

    Columns: request_id, operation, entity_id, activity, jurisdiction, valid_at, known_at,
    assertion_id, record_key, pair.
    """
    known = entities.select(F.col("entity_id").cast("string").alias("entity_id"), F.lit(True).alias("known")).distinct()
    rows = requests.join(known, "entity_id", "left")
    op = F.col("operation")
    asks = op.isin("assess", "assess_bitemporal", "explain")
    dated = lambda c: F.when(F.col(c).isNotNull(), strict_date(F.col(c)))
    error = (
        F.when(~F.coalesce(op.isin(*OPERATIONS), F.lit(False)), "UNKNOWN_OPERATION")
        .when(asks & (_given("entity_id", "activity", "jurisdiction") < 3), "MISSING_ARGUMENT")
        .when(asks & dated("valid_at").isNull(), "INVALID_DATE")
        .when(op.isin("assess_bitemporal", "explain") & dated("known_at").isNull(), "INVALID_DATE")
        .when(asks & F.col("known").isNull(), "UNKNOWN_ENTITY")
        .when((op == "evidence") & (_given("assertion_id") == 0), "MISSING_ARGUMENT")
        .when((op == "changes") & (_given("record_key", "pair") != 1), "EXACTLY_ONE_SELECTOR")
    )
    return rows.select(*requests.columns, dated("valid_at").alias("valid_day"), dated("known_at").alias("known_day"), error.alias("error"))


def explained(verdicts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """One row a used assertion of each verdict, with what it says at the question's date.

    A question is known by all six of its keys, and two that ask nothing of a key ask the same.
    """
    keys = ["entity_id", "activity", "jurisdiction", "asked_basis", "valid_at", "known_at"]
    used = verdicts.where("used_ids <> ''").select(*keys, "verdict", "reason", F.explode(F.split("used_ids", ",")).alias("assertion_id"))
    said = evaluations.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("assertion_id").cast("string").alias("_id"), "register_id", "effect_at", F.col("reason").alias("effect_reason"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("assertion_id") == F.col("_id")]
    return used.join(said, same).select("assertion_id", *keys, "verdict", "reason", "register_id", "effect_at", "effect_reason")


def evidence_of(assertions: DataFrame, sources: DataFrame) -> DataFrame:
    """The distinct sources of the given assertions: assertion_id, register, first and last fetched, how many."""
    held = sources.join(assertions.select("assertion_id").distinct(), "assertion_id", "left_semi")
    return held.groupBy("assertion_id", "register_id").agg(F.min("retrieved_at").alias("first_seen"), F.max("retrieved_at").alias("last_seen"), F.count_distinct(F.struct("retrieved_at", "source_as_of")).alias("n_sources"))


def met(verdicts: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Each expected case with whether its verdict is the one found; a case without a verdict is not.

    Keys without a value are equal.
    """
    found = verdicts.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("verdict").alias("found"))
    pair = expected.join(found, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*(f"_{k}" for k in keys))
    return pair.withColumn("match", F.coalesce(F.col("expected") == F.col("found"), F.lit(False)))


def run_summary(cases: DataFrame) -> DataFrame:
    """Cases, matches and mismatches of a run, by what was expected and in total."""
    return cases.rollup("expected").agg(F.count("*").alias("n_cases"), F.count_if("match").alias("n_match"), F.count_if(~F.col("match")).alias("n_mismatch")).withColumn("expected", F.coalesce("expected", F.lit("*")))


def contract_faults(contracts: DataFrame, rules: DataFrame, classes: list[str], activities: list[str], bases: list[str]) -> DataFrame:
    """register_id and fault of every contract or rule that breaks a rule of the vocabulary."""
    outside = lambda c, allowed: F.size(F.array_except(F.coalesce(c, F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))) > 0
    empty = lambda c: F.coalesce(F.size(c) == 0, F.lit(False))
    of_contract = {
        "UNKNOWN_CAPABILITY": ~F.coalesce(F.col("capability").isin("COMPLETE_ENUMERATION", "EXPLICIT_NEGATIVE_ONLY", "NO_NEGATIVE_INFERENCE"), F.lit(False)),
        "UNKNOWN_CLASS": outside(F.col("excluded_classes"), classes),
        "UNKNOWN_ACTIVITY": outside(F.col("activities"), activities),
        "DAYS_NOT_POSITIVE": F.coalesce((F.col("positive_days") <= 0) | (F.col("negative_days") <= 0), F.lit(False)),
        "NEGATIVE_OUTLASTS_POSITIVE": F.coalesce(F.col("negative_days") > F.col("positive_days"), F.lit(False)),
    }
    of_rule = {
        "UNKNOWN_SCOPE": ~F.coalesce(F.col("scope").isin("IN", "OUT"), F.lit(False)),
        "UNKNOWN_RULE_CLASS": F.col("rule_class").isNotNull() & ~F.col("rule_class").isin(classes),
        "UNKNOWN_RULE_BASIS": outside(F.col("rule_bases"), bases),
        "EMPTY_LIST": empty("rule_activities") | empty("rule_jurisdictions") | empty("rule_bases"),
    }
    parts = []
    for df, tests in ((contracts, of_contract), (rules, of_rule)):
        faults = F.array_compact(F.array(*(F.when(t, n) for n, t in tests.items())))
        parts.append(df.select("register_id", F.explode(faults).alias("fault")))
    return parts[0].unionByName(parts[1])
