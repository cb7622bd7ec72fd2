"""Requests answered in bulk: a table of requests to a table of answers, one row each.

Each operation is one plan over all requests of its kind, never a loop over them. A request that
cannot be answered has an error code and message instead; it does not fail the others.

    assess              verdict on all evidence
    assess_bitemporal   verdict on what was known at a date, with the audit of all evidence
    explain             verdict with what each assertion said; with a date of knowledge, the audit
    evidence            one item by id, or all items of an entity, with their sources
    changes             candidates of the compared snapshots, by record, by pair, or how many in all
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import strict_date
from attestry.operators import identity as I
from attestry.operators import verdict as V
from attestry.operators.tables import kept

# codes of errors (fixed values)
INVALID, NOT_FOUND, OTHER_SET = "invalid_input", "not_found", "unknown_evidence_set"
ASKS = ("assess", "assess_bitemporal", "explain")
OPERATIONS = (*ASKS, "evidence", "changes")
#: Knowledge of a request that names no date: all of it.
ALL_TIME = "9999-12-31"
AUDIT = ("usable_assertion_ids", "after_k_assertion_ids", "untraceable_assertion_ids", "usable_fact_ids", "after_k_fact_ids", "untraceable_fact_ids")
REQUEST = ("request_id", "operation", "entity_id", "id_kind", "id_value", "name", "activity", "jurisdiction", "territorial_basis", "valid_at", "known_at", "item_id", "record_key", "pair", "evidence_set_id")


@dataclass(frozen=True)
class Evidence:
    """The tables that requests are answered from; ``candidates`` has pair, record_key and candidate."""

    set_id: str
    entities: DataFrame
    identifiers: DataFrame
    assertions: DataFrame
    sources: DataFrame
    facts: DataFrame
    contracts: DataFrame
    rules: DataFrame
    candidates: DataFrame
    aliases: dict[str, str] = field(default_factory=dict)


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def checked(requests: DataFrame, set_id: str) -> DataFrame:
    """Requests (all texts) with their dates and, of what is wrong with one, the first: error and message."""
    op, asks = F.col("operation"), F.col("operation").isin(*ASKS)
    valid, known = (F.when(_given(c), strict_date(F.col(c))) for c in ("valid_at", "known_at"))
    tests = (
        (~F.coalesce(op.isin(*OPERATIONS), F.lit(False)), INVALID, "operation is none of the five"),
        (asks & ~(_given("entity_id") | _given("id_value") | _given("name")), INVALID, "an entity, identifier or name is needed"),
        (asks & ~(_given("activity") & _given("jurisdiction")), INVALID, "activity and jurisdiction are needed"),
        (asks & valid.isNull(), INVALID, "valid_at is no date written yyyy-MM-dd"),
        ((op == "assess_bitemporal") & known.isNull() | (op == "explain") & _given("known_at") & known.isNull(), INVALID, "known_at is no date written yyyy-MM-dd"),
        ((op == "evidence") & (_given("item_id") == _given("entity_id")), INVALID, "exactly one of item_id and entity_id is needed"),
        ((op != "changes") & _given("evidence_set_id") & (F.col("evidence_set_id") != set_id), OTHER_SET, "the evidence set is another one"),
    )
    first = F.coalesce(*(F.when(t, F.struct(F.lit(code).alias("error"), F.lit(text).alias("message"))) for t, code, text in tests))
    used = F.when(op.isin("assess_bitemporal", "explain"), known)
    return requests.select(*REQUEST, valid.alias("valid_day"), F.coalesce(used, F.lit(ALL_TIME).cast("date")).alias("known_day"), used.isNotNull().alias("dated"), first.alias("_e")).select("*", "_e.*").drop("_e")


def _questions(asks: DataFrame, evidence: Evidence) -> DataFrame:
    """Requests as questions with the state of their entity's identity."""
    entries = I.index(evidence.entities, evidence.assertions)
    asked = asks.select(F.col("request_id").alias("question_id"), "entity_id", F.col("id_kind").alias("kind"), F.col("id_value").alias("value"), "name")
    found = I.resolved(asked, entries, evidence.identifiers).withColumnRenamed("question_id", "request_id")
    rows = asks.drop("entity_id").join(found, "request_id").join(entries.select("entity_id", "entity_classes"), "entity_id", "left")
    basis = F.when(_given("territorial_basis"), F.col("territorial_basis"))
    return rows.select(
        "request_id", "operation", "dated", "entity_id", "activity", "jurisdiction", basis.alias("asked_basis"), F.col("valid_day").alias("valid_at"), F.col("known_day").alias("known_at"), "identity_state", "identity_reason", "entity_classes"
    )


def _back(questions: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a table by question, for every request that asked it."""
    theirs = table.select(*(F.col(c).alias(f"_{c}") for c in V.QUESTION), *columns)
    return questions.join(theirs, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in V.QUESTION]).drop(*(f"_{c}" for c in V.QUESTION))


def assessed(asks: DataFrame, evidence: Evidence) -> DataFrame:
    """Answers to the three operations that ask for a verdict.

    The same question is decided once, whoever asks it; an identity that is not exact is answered
    without looking at evidence.
    """
    questions = kept(_questions(asks, evidence))
    exact = questions.where(F.col("identity_state") == I.EXACT)
    distinct = exact.select(*V.QUESTION, *V.IDENTITY, "entity_classes").distinct()
    distinct = distinct.withColumn("identity_reason", F.lit("EXACT")).distinct()  # told apart by no way of asking
    e = evidence
    found = V.verdicts(distinct, e.assertions, e.sources, e.facts, e.contracts, e.rules, e.aliases)
    answers = _back(exact, found, ["verdict", "reason", "used_ids", "response_freshness", "diagnostics"])
    said = V.evaluations(distinct, e.assertions, e.sources)
    explains = exact.where("operation = 'explain'")
    one = F.struct(F.col("assertion_id").cast("string").alias("assertion_id"), "register_id", "legal_effect", "effect_at", F.col("reason").alias("effect_reason"))
    evaluations = _back(explains, said, ["assertion_id", "register_id", "legal_effect", "effect_at", "reason"]).groupBy("request_id").agg(F.sort_array(F.collect_list(one)).alias("evaluations"))
    dated = exact.where("dated")
    audit = V.audit(dated.select(*V.QUESTION).distinct(), e.assertions, e.sources, e.facts, e.contracts)
    audits = _back(dated, audit, list(AUDIT)).select("request_id", F.struct(*AUDIT).alias("audit"))
    answers = answers.join(evaluations, "request_id", "left").join(audits, "request_id", "left")
    reasons = {"AMBIGUOUS": "AMBIGUOUS_IDENTITY", "NOT_FOUND": "IDENTITY_NOT_FOUND", "CONFLICTING_IDENTIFIERS": "CONFLICTING_IDENTIFIERS"}
    reason = F.coalesce(*(F.when(F.col("identity_state") == k, v) for k, v in reasons.items()))
    open_ = questions.where(F.col("identity_state") != I.EXACT).select(
        "request_id", "entity_id", "identity_state", F.lit("INDETERMINATE").alias("verdict"), reason.alias("reason"), F.lit("").alias("used_ids"), F.concat(F.lit("identity:"), "identity_reason").alias("diagnostics")
    )
    columns = ("request_id", "entity_id", "identity_state", "verdict", "reason", "used_ids", "response_freshness", "diagnostics", "evaluations", "audit")
    return answers.select(*columns).unionByName(open_, allowMissingColumns=True)


ITEM = "struct<kind:string,id:string,entity_id:string,says:string,sources:array<string>>"


def _items(evidence: Evidence) -> DataFrame:
    """Assertions and facts as items: kind, id, entity_id, what they say, and their registers."""
    cited = evidence.sources.groupBy("assertion_id").agg(F.sort_array(F.collect_set("register_id")).alias("sources"))
    assertions = evidence.assertions.join(cited, "assertion_id", "left").select(F.lit("assertion").alias("kind"), F.col("assertion_id").cast("string").alias("id"), "entity_id", F.concat_ws(" ", "legal_effect", "activity", "territorial_basis").alias("says"), "sources")
    facts = evidence.facts.select(F.lit("reported_fact").alias("kind"), F.col("fact_id").cast("string").alias("id"), "entity_id", F.concat_ws(" ", "reported_status", "rule_id").alias("says"), F.array("register_id").alias("sources"))
    return assertions.unionByName(facts).withColumn("entity_id", F.col("entity_id").cast("string"))


def evidenced(asks: DataFrame, evidence: Evidence) -> DataFrame:
    """Items of each request: one by id, an assertion before a fact, or all of an entity. None by id is not found."""
    items = _items(evidence)
    item = F.struct("kind", "id", "entity_id", "says", "sources").alias("item")
    by_id = asks.where(_given("item_id")).select("request_id", F.col("item_id").alias("id")).join(items.select("id", "kind", item), "id").groupBy("request_id").agg(F.array(F.min_by("item", "kind")).alias("items"))
    by_entity = asks.where(~_given("item_id")).select("request_id", "entity_id").join(items.select("entity_id", item), "entity_id").groupBy("request_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = asks.select("request_id", "entity_id", "item_id").join(by_id.unionByName(by_entity), "request_id", "left")
    missing = _given("item_id") & F.col("items").isNull()
    return found.select("request_id", F.when(missing, NOT_FOUND).alias("error"), F.when(missing, F.concat(F.lit("no item "), "item_id")).alias("message"), F.when(~missing, F.coalesce("items", F.array().cast(f"array<{ITEM}>"))).alias("items"))


def changed(asks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates of each request by pair, by record, or by both. With neither, only how many there are.

    A pair that is not known is an error; a record without candidates is an empty list.
    """
    one = F.struct("pair", "record_key", "candidate").alias("c")
    pairs = candidates.select("pair").distinct().withColumn("known", F.lit(True))
    rows = asks.select("request_id", F.when(_given("pair"), F.col("pair")).alias("pair"), F.when(_given("record_key"), F.col("record_key")).alias("record_key"))
    by_pair = rows.where("pair is not null").withColumnRenamed("record_key", "_key").join(candidates.select("pair", "record_key", one), "pair").where("_key is null or _key = record_key")
    by_record = rows.where("pair is null and record_key is not null").drop("pair").join(candidates.select("record_key", one), "record_key")
    found = by_pair.select("request_id", "c").unionByName(by_record.select("request_id", "c")).groupBy("request_id").agg(F.sort_array(F.collect_list("c")).alias("candidates"))
    total = candidates.agg(F.count("*").alias("total")).scalar()
    joined = rows.join(found, "request_id", "left").join(pairs, "pair", "left")
    missing = F.col("pair").isNotNull() & F.col("known").isNull()
    none = F.array().cast("array<struct<pair:string,record_key:string,candidate:string>>")
    some = F.when(F.col("pair").isNotNull() | F.col("record_key").isNotNull(), F.coalesce("candidates", none))
    return joined.select(
        "request_id", F.when(missing, NOT_FOUND).alias("error"), F.when(missing, F.concat(F.lit("no pair "), "pair")).alias("message"),
        F.when(~missing, some).alias("candidates"), F.when(~missing, F.coalesce(F.size(some).cast("long"), total)).alias("n_candidates"),
    )


def answered(requests: DataFrame, evidence: Evidence) -> DataFrame:
    """One answer a request: operation, error and message, or what the operation gives; fields of other operations are NULL."""
    rows = kept(checked(requests, evidence.set_id))
    good = rows.where("error is null")
    of = lambda *ops: good.where(F.col("operation").isin(*ops))
    parts = [
        rows.where("error is not null").select("request_id", "error", "message"), assessed(of(*ASKS), evidence), evidenced(of("evidence"), evidence), changed(of("changes"), evidence.candidates),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return rows.select("request_id", "operation").join(out, "request_id").withColumn("evidence_set_id", F.lit(evidence.set_id))
