"""Entitlement verdicts for a table of questions over a table of evidence.

Everything is set-wise. Questions meet assertions in one equi-join and facts in another; gates
are columns, coverage is decided from each register's rules, which travel as an array in its
contract's row. Assertions, facts and questions then go to one table dealt by question, and
three groupings (question, root and basis; question and root; question) that need no further
exchange end in one CASE ladder.

Absence is a value: a missing policy is stale, a missing source is untraceable, a missing match
is FALSE. A question whose identity is not EXACT gets no conclusion, never a negative.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import freshness, is_stale

QUESTION = ("entity_id", "activity", "jurisdiction", "asked_basis", "valid_at", "known_at")
IDENTITY = ("identity_state", "identity_reason")

# vocabulary of effects, bases and classes (fixed values)
ENTITLED, NOT_ENTITLED = "ENTITLED_TO_PROVIDE", "NOT_ENTITLED"
DOMESTIC, BRANCH, SERVICES = "DOMESTIC", "BRANCH", "FREEDOM_TO_PROVIDE_SERVICES"
AGENT, HOME = "PSP_AGENT", "ES"
# what a root of each type can hold (fixed values); roots of other types can hold anything
_PAYMENTS = (
    "PAYMENT_ACCOUNT_CASH_PLACEMENT", "PAYMENT_ACCOUNT_CASH_WITHDRAWAL", "PAYMENT_DIRECT_DEBIT_EXECUTION", "PAYMENT_CARD_TRANSACTION_EXECUTION",
    "PAYMENT_CREDIT_TRANSFER_EXECUTION", "PAYMENT_DIRECT_DEBIT_EXECUTION_CREDIT_LINE", "PAYMENT_CARD_TRANSACTION_EXECUTION_CREDIT_LINE",
    "PAYMENT_CREDIT_TRANSFER_EXECUTION_CREDIT_LINE", "PAYMENT_INSTRUMENT_ISSUING", "PAYMENT_TRANSACTION_ACQUIRING", "MONEY_REMITTANCE",
    "PAYMENT_INITIATION_SERVICES", "ACCOUNT_INFORMATION_SERVICES", "PAYMENT_SERVICES",
)
ROOT_TYPES = {"PSD_PI": _PAYMENTS, "PSD_EMI": (*_PAYMENTS, "E_MONEY_ISSUANCE"), "PSD_AISP": ("ACCOUNT_INFORMATION_SERVICES",)}

#: Contracts that are broadcast; more are joined by a shuffle.
FEW_CONTRACTS = 10_000


def _yes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def covers(at: Column, start: Column, end: Column, exclusive: Column) -> Column:
    """Whether the window holds the date; an open end never closes."""
    closed = F.when(exclusive, at >= end).otherwise(at > end)
    return (start <= at) & ~_yes(closed)


def effect_at(at: Column, effect: Column, start: Column, end: Column, exclusive: Column) -> Column:
    """What an assertion says at a date, and why: a struct of effect and reason."""
    reason = (
        F.when(start > at, "NOT_YET_EFFECTIVE")
        .when(~covers(at, start, end, exclusive), F.when(effect == ENTITLED, "ENTITLEMENT_EXPIRED").otherwise("WINDOW_CLOSED"))
        .otherwise("IN_EFFECT")
    )
    then = F.when(reason == "IN_EFFECT", effect).when(reason == "ENTITLEMENT_EXPIRED", NOT_ENTITLED).otherwise("UNKNOWN")
    return F.struct(then.alias("effect"), reason.alias("reason"))


def knowledge(sources: DataFrame) -> DataFrame:
    """Per assertion: when all of it was known, how fresh it is, its number of sources, and how
    fresh each register's share of it is."""
    fresh = freshness(F.col("source_as_of"), F.col("retrieved_at"))
    dealt = sources.select("assertion_id", "register_id", "retrieved_at", fresh.alias("fresh")).repartition("assertion_id")  # both groupings need no further exchange
    shares = dealt.groupBy("assertion_id", "register_id").agg(F.max("retrieved_at").alias("last"), F.max("fresh").alias("fresh"), F.count("*").alias("n"))
    return shares.groupBy("assertion_id").agg(
        F.max("last").alias("knowledge_time"), F.max("fresh").alias("fresh_at"), F.sum("n").alias("n_sources"), F.sort_array(F.collect_list(F.struct(F.col("register_id").alias("register"), "fresh"))).alias("registers")
    )


def bucket(knowledge_time: Column, known_at: Column) -> Column:
    return F.when(knowledge_time.isNull(), "untraceable").when(knowledge_time <= known_at, "usable").otherwise("after_k")


def many(questions: DataFrame) -> DataFrame:
    """Questions, never broadcast: what explodes into them is as small as its file to Spark, so any number of them would go through the driver."""
    return questions.hint("merge")


def matched(questions: DataFrame, assertions: DataFrame, sources: DataFrame) -> DataFrame:
    """Question and assertion pairs of the universe, with the evidence's bucket."""
    known = assertions.join(knowledge(sources), "assertion_id", "left")
    pairs = many(questions).join(known, ["entity_id", "activity", "jurisdiction"])
    pairs = pairs.where(F.col("asked_basis").isNull() | (F.col("asked_basis") == F.col("territorial_basis")))
    return pairs.withColumn("bucket", bucket(F.col("knowledge_time"), F.col("known_at")))


def with_rules(contracts: DataFrame, rules: DataFrame) -> DataFrame:
    """Each register's contract with its coverage rules, in order, in an array ``rules``."""
    fields = ("ordinal", "rule_id", "scope", "rule_class", "rule_activities", "rule_jurisdictions", "rule_bases", "valid_from", "valid_to")
    held = rules.groupBy("register_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rules"))
    return contracts.join(held, "register_id", "left").withColumn("policy_ok", ~_yes(F.col("negative_days") > F.col("positive_days")))


def coverage(contract: Column, entity_class: Column, activity: Column, jurisdiction: Column, basis: Column, at: Column) -> Column:
    """Status, rule and reason of a place under a contract (a row of ``with_rules`` as a struct).

    The first OUT rule that applies decides, then what the contract excludes or does not cover,
    then the first IN rule; else the scope is UNKNOWN.
    """

    def first(scope: str) -> Column:
        def applies(r: Column) -> Column:
            listed = [r[a].isNull() | F.array_contains(r[a], v) for a, v in (("rule_activities", activity), ("rule_jurisdictions", jurisdiction), ("rule_bases", basis))]
            dated = (r["valid_from"].isNull() | (r["valid_from"] <= at)) & (r["valid_to"].isNull() | (at <= r["valid_to"]))
            same = r["rule_class"].isNull() | (r["rule_class"] == entity_class)
            return _yes((r["scope"] == scope) & same & dated & listed[0] & listed[1] & listed[2])

        return F.get(F.filter(contract["rules"], applies), 0)["rule_id"]

    out, in_ = first("OUT"), first("IN")
    has = lambda field, value: _yes(F.array_contains(contract[field], value))
    cases = (
        (out.isNotNull(), "OUT_OF_SCOPE", out, "EXPLICIT_EXCLUSION"),
        (has("excluded_classes", entity_class), "OUT_OF_SCOPE", F.lit("contract-excluded-entity-classes"), "EXCLUDED_ENTITY_CLASS"),
        (~has("activities", activity), "OUT_OF_SCOPE", F.lit("contract-activities-coverage"), "ACTIVITY_NOT_COVERED_BY_REGISTER"),
        (~has("jurisdictions", F.lit("EEA")) & ~has("jurisdictions", jurisdiction), "OUT_OF_SCOPE", F.lit("contract-jurisdiction-coverage"), "JURISDICTION_NOT_COVERED_BY_REGISTER"),
        (in_.isNotNull(), "IN_SCOPE", in_, "COVERED_BY_RULE"),
    )
    decision = F.struct(F.lit("UNKNOWN").alias("status"), F.lit(None).cast("string").alias("rule_id"), F.lit("NO_RULE_MATCHES").alias("reason"))
    for test, status, rule, reason in reversed(cases):
        decision = F.when(test, F.struct(F.lit(status).alias("status"), rule.alias("rule_id"), F.lit(reason).alias("reason"))).otherwise(decision)
    return decision


def enumeration_negative(identity_state: Column, decision: Column, capability: Column, snapshot_rule: Column) -> Column:
    """Whether an absence from a register may count as a negative: the first of five refusals.

    ``snapshot_rule`` is the coverage rule that the enumeration's snapshot was taken under; NULL
    where there is no snapshot.
    """
    return (
        F.when(~_yes(identity_state == "EXACT"), "IDENTITY_NOT_EXACT")
        .when(decision["status"] != "IN_SCOPE", F.concat(F.lit("SCOPE_"), decision["status"]))
        .when(~_yes(capability == "COMPLETE_ENUMERATION"), "SOURCE_CAPABILITY_DOES_NOT_ALLOW_ENUMERATION_NEGATIVE")
        .when(snapshot_rule.isNull(), "MISSING_ENUMERATION_SNAPSHOT")
        .when(snapshot_rule != decision["rule_id"], "COVERAGE_RULE_MISMATCH")
        .otherwise("ENUMERATION_NEGATIVE_ALLOWED")
    )


def _small(df: DataFrame, most: int = FEW_CONTRACTS) -> DataFrame:
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def gated(pairs: DataFrame, contracts: DataFrame, rules: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Usable pairs with the first gate they fail in ``diagnostic``; NULL means admissible.

    An assertion that requires all of its registers passes only if each of them, under the
    contract that governs it (``aliases`` names those of views), covers it and is fresh. An agent is
    an entity with that class among its own (``entity_classes`` of the question), whatever class
    the assertion is of.
    """
    held = with_rules(contracts, rules)
    own = _small(held.select("register_id", F.struct(*held.columns).alias("contract")))
    usable = pairs.where("bucket = 'usable'").join(own, "register_id", "left")
    place = [F.col(c) for c in ("entity_class", "activity", "jurisdiction", "territorial_basis", "valid_at")]
    at = F.col("valid_at")

    def policy(contract: Column) -> Column:
        return F.when(F.col("legal_effect") == NOT_ENTITLED, contract["negative_days"]).otherwise(contract["positive_days"])

    contract = F.col("contract")
    decided = usable.withColumn("decision", F.when(contract.isNotNull(), coverage(contract, *place)))
    status = F.col("decision.status")
    first = (
        F.when(contract.isNull(), "no_contract")
        .when(status == "OUT_OF_SCOPE", "out_of_source_scope")
        .when((status == "UNKNOWN") & (F.coalesce("n_sources", F.lit(0)) == 0), "unknown_scope_no_evidence")
        .when(_yes(F.array_contains("entity_classes", AGENT)) & F.col("principal_id").isNull(), "agent_missing_principal")
        .when(~covers(at, F.col("effective_from"), F.col("effective_to"), F.col("exclusive_end")), "not_in_effect")
        .when(is_stale(at, F.col("fresh_at"), policy(contract)), "stale_evidence")
    )
    decided = decided.withColumn("diagnostic", first)
    # what must hold together looks its registers up among all contracts, which are a few rows
    together = _yes(F.col("composition") == "ALL_REQUIRED") & F.col("diagnostic").isNull()
    governing = F.create_map(*(F.lit(x) for kv in (aliases or {"": ""}).items() for x in kv))
    every = held.agg(F.map_from_entries(F.collect_list(F.struct("register_id", F.struct(*held.columns)))))
    decided = decided.withColumn("every", every.scalar())

    def failure(r: Column) -> Column:
        c = F.try_element_at(F.col("every"), F.coalesce(F.try_element_at(governing, r["register"]), r["register"]))
        kind = (
            F.when(c.isNull(), "no_contract")
            .when(coverage(c, *place)["status"] == "OUT_OF_SCOPE", "out_of_source_scope")
            .when(is_stale(at, r["fresh"], policy(c)), "stale_required_source")
        )
        return F.when(kind.isNotNull(), F.concat_ws(":", kind, r["register"]))

    failed = F.get(F.filter(F.transform("registers", failure), lambda x: x.isNotNull()), 0)
    kind = F.substring_index(failed, ":", 1)
    return decided.withColumns(
        {
            "failed_register": F.when(together, F.substring_index(failed, ":", -1)),
            "diagnostic": F.when(together, kind).otherwise(F.col("diagnostic")),
        }
    ).drop("every")


QUESTION_KEYS = [*QUESTION, *IDENTITY]


def root_can_hold(root_key: Column, activity: Column) -> Column:
    """Whether the root's type (the second of three parts) can hold the activity; unknown types can."""
    parts = F.split(root_key, r"\|")
    kind = F.when(F.size(parts) >= 3, F.get(parts, 1))
    test = F.lit(True)
    for name, activities in ROOT_TYPES.items():
        test = F.when(kind == name, activity.isin(list(activities))).otherwise(test)
    return test


def possible_routes(home: Column, asked_basis: Column) -> Column:
    """Bases that the law has for a root of that home, of those asked about."""
    routes = F.when(_yes(home == HOME), F.array(F.lit(DOMESTIC))).otherwise(F.array(F.lit(SERVICES), F.lit(BRANCH)))
    return F.when(asked_basis.isNull(), routes).otherwise(F.array_intersect(routes, F.array(asked_basis)))


def facts_asked(questions: DataFrame, facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Facts of each question's entity with their bucket, and whether they are fresh by the
    negative policy of their register's contract; without provenance or contract they are not."""
    days = _small(contracts.select("register_id", "negative_days"))
    known = facts.drop("activity", "jurisdiction").join(days, "register_id", "left")
    pairs = many(questions).join(known, "entity_id").withColumn("bucket", bucket(F.col("knowledge_time"), F.col("known_at")))
    return pairs.withColumn("fresh", ~is_stale(F.col("valid_at"), F.col("fresh_at"), F.col("negative_days")))


def _root_facts() -> list[Column]:
    """Aggregates of fact rows that a root's state is made of; other rows have NULL in them."""
    at, fresh = F.col("valid_at"), _yes(F.col("fresh"))
    spans = F.when(fresh, F.coalesce("spans", F.array().cast("array<struct<from:date,to:date>>")))
    inside = F.exists(spans, lambda s: (s["from"] <= at) & (s["to"].isNull() | (at < s["to"])))
    kind, dated = F.col("negative_class"), F.col("fact_from").isNotNull()
    other = _yes(kind.isin("ENTITY_BAJA", "UNRESOLVED_MOTIVO")) | (kind.isNull() & _yes(F.col("reported_status") == "WITHDRAWN"))
    return [
        F.bool_or(F.col("fact_id").isNotNull()).alias("has_fact"),
        F.bool_or(_yes(inside)).alias("inside"),
        F.min(F.array_min(F.transform(spans, lambda s: s["from"]))).alias("first_span"),
        F.bool_or(fresh & _yes(kind == "EXPLICIT_WITHDRAWAL") & _yes(F.col("fact_from") <= at)).alias("withdrawn"),
        F.bool_or(fresh & dated & other).alias("unresolved"),
    ]


def root_state(at: Column) -> Column:
    """OPEN, CLOSED, UNRESOLVED or ABSENT of a root with facts; NULL of one without."""
    spans = F.when(F.col("inside"), "OPEN").when(at >= F.col("first_span"), "CLOSED").otherwise("ABSENT")
    events = F.when(F.col("withdrawn"), "CLOSED").when(F.col("unresolved"), "UNRESOLVED").otherwise("OPEN")
    return F.when(F.col("has_fact"), F.when(F.col("first_span").isNotNull(), spans).otherwise(events))


def root_states(questions: DataFrame, facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """The state of each root that a question's usable facts know."""
    asked = facts_asked(questions, facts, contracts).where("bucket = 'usable' and root_key is not null").withColumnRenamed("effective_from", "fact_from")
    found = asked.groupBy(*QUESTION, "root_key").agg(*_root_facts())
    return found.select(*QUESTION, "root_key", root_state(F.col("valid_at")).alias("root_state"))


def _dealt(questions: DataFrame, judged: DataFrame, facts: DataFrame) -> DataFrame:
    """Judged pairs, facts and the questions themselves in one table, dealt by question."""
    pair = ("assertion_id", "register_id", "territorial_basis", "legal_effect", "effective_from", "effective_to", "blocked", "diagnostic", "failed_register", "fresh_at", "root_key", "root_home")
    fact = ("fact_id", "rule_id", "reported_status", "negative_class", "spans", "fresh", "root_key", "root_home")
    exact = "identity_state = 'EXACT'"
    rows = questions.unionByName(judged.where(exact).select(*QUESTION_KEYS, *pair), allowMissingColumns=True)
    facts = facts.where(exact).select(*QUESTION_KEYS, *fact, F.col("effective_from").alias("fact_from"))
    return rows.unionByName(facts, allowMissingColumns=True).repartition(*QUESTION)


def _ids(test: Column) -> Column:
    return F.collect_list(F.when(test, F.col("assertion_id").cast("string")))


def _flat(test: Column, ids: str) -> Column:
    return F.flatten(F.collect_list(F.when(test, F.col(ids))))


def _diagnosis() -> Column:
    return F.when(_yes(F.col("blocked")), F.concat_ws(":", F.lit("blocked_evidence"), "assertion_id")).when(
        F.col("diagnostic").isNotNull(),
        F.when(F.col("diagnostic") == "no_contract", F.concat_ws(":", "diagnostic", F.coalesce("failed_register", "register_id"))).otherwise(
            F.concat_ws(":", "diagnostic", "assertion_id", "failed_register")
        ),
    )


def routes(rows: DataFrame) -> DataFrame:
    """What is open and closed on each question's routes: a root (or a register without one) and a basis."""
    sound = F.col("assertion_id").isNotNull() & ~_yes(F.col("blocked")) & F.col("diagnostic").isNull()
    positive, negative = sound & (F.col("legal_effect") == ENTITLED), sound & (F.col("legal_effect") == NOT_ENTITLED)
    blocked = F.col("assertion_id").isNotNull() & _yes(F.col("blocked"))
    early = (F.col("legal_effect") == ENTITLED) & F.col("root_key").isNotNull()
    first_home = F.struct(F.col("fact_id").isNull(), F.coalesce(F.col("fact_id").cast("string"), F.col("assertion_id").cast("string")))
    scope = F.coalesce("root_key", F.concat(F.lit("UNSCOPED|"), "register_id"))
    return rows.withColumn("scope", scope).groupBy(*QUESTION_KEYS, "scope", "root_key", "territorial_basis").agg(
        _ids(positive).alias("open_ids"), _ids(negative).alias("closed_ids"), _ids(blocked).alias("blocked_ids"),
        F.min(F.when(positive, F.col("fresh_at"))).alias("open_fresh"), F.min(F.when(negative, F.col("fresh_at"))).alias("closed_fresh"),
        F.min(F.when(blocked, F.col("fresh_at"))).alias("blocked_fresh"),
        F.collect_list(_diagnosis()).alias("diagnostics"),
        F.bool_or(_yes(early & (F.col("effective_from") > F.col("valid_at")))).alias("future"),
        F.bool_or(_yes(early & (F.col("effective_to") <= F.col("valid_at")))).alias("expired"),
        F.min(F.when(F.col("root_key").isNotNull(), F.struct(first_home.alias("place"), F.col("root_home").alias("home")))).alias("first_home"),
        *_root_facts(),
    )


def verdicts(questions: DataFrame, assertions: DataFrame, sources: DataFrame, facts: DataFrame, contracts: DataFrame, rules: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """One verdict and reason a question, by routes and roots, with the evidence that was used.

    ``used_ids`` and ``diagnostics`` are sorted and joined by a comma; ``response_freshness`` is
    the least fresh date of what was used.
    """
    judged = gated(matched(questions, assertions, sources), contracts, rules, aliases)
    usable = facts_asked(questions, facts, contracts).where("bucket = 'usable'")
    route = routes(_dealt(questions, judged, usable))
    is_open, is_closed = F.size("open_ids") > 0, F.size("closed_ids") > 0
    clean, conflict = is_open & ~is_closed, is_open & is_closed
    mark = F.when(conflict, F.array(F.concat_ws(":", F.lit("route_conflict"), "scope", "territorial_basis"))).otherwise(F.array().cast("array<string>"))
    roots = route.groupBy(*QUESTION_KEYS, "scope", "root_key").agg(
        F.bool_or(clean).alias("clean"), F.bool_or(conflict).alias("conflict"), F.bool_or(is_closed).alias("closed"), F.bool_or(F.size("blocked_ids") > 0).alias("blocked"),
        _flat(clean, "open_ids").alias("clean_ids"), F.flatten(F.collect_list(F.when(conflict, F.concat("open_ids", "closed_ids")))).alias("conflict_ids"),
        _flat(is_closed, "closed_ids").alias("closed_ids"), F.flatten(F.collect_list("blocked_ids")).alias("blocked_ids"),
        F.min(F.when(clean, F.col("open_fresh"))).alias("clean_fresh"), F.min(F.when(conflict, F.least("open_fresh", "closed_fresh"))).alias("conflict_fresh"),
        F.min("closed_fresh").alias("closed_fresh"), F.min("blocked_fresh").alias("blocked_fresh"),
        F.flatten(F.collect_list(F.concat("diagnostics", mark))).alias("diagnostics"),
        F.collect_set(F.when(is_closed, F.col("territorial_basis"))).alias("closed_bases"),
        F.bool_or("future").alias("future"), F.bool_or("expired").alias("expired"), F.min("first_home").alias("first_home"),
        *(F.bool_or(c).alias(c) for c in ("has_fact", "inside", "withdrawn", "unresolved")), F.min("first_span").alias("first_span"),
    )
    state = F.coalesce("state", F.lit("NONE"))
    possible = possible_routes(F.col("first_home.home"), F.col("asked_basis"))
    shut = (F.size(possible) > 0) & (F.size(F.array_except(possible, F.col("closed_bases"))) == 0)
    roots = roots.withColumn("state", root_state(F.col("valid_at")))
    roots = roots.withColumn("applies", F.col("root_key").isNotNull() & root_can_hold(F.col("root_key"), F.col("activity")) & (state != "ABSENT"))
    root_closed, on_open = (state == "CLOSED") | ((state != "UNRESOLVED") & shut), state == "OPEN"
    found = roots.groupBy(*QUESTION_KEYS).agg(
        *(F.bool_or(c).alias(c) for c in ("clean", "conflict", "closed", "blocked")),
        *(F.flatten(F.collect_list(f"{c}_ids")).alias(f"{c}_ids") for c in ("clean", "conflict", "closed", "blocked")),
        *(F.min(f"{c}_fresh").alias(f"{c}_fresh") for c in ("clean", "conflict", "closed", "blocked")),
        F.flatten(F.collect_list("diagnostics")).alias("diagnostics"),
        _yes(F.bool_and(F.when(F.col("applies"), root_closed))).alias("all_closed"),
        _yes(F.bool_and(F.when(F.col("applies"), state == "CLOSED"))).alias("all_withdrawn"),
        F.bool_or(on_open & F.col("future")).alias("future"), F.bool_or(on_open & F.col("expired")).alias("expired"),
    )
    unresolved = F.lit("TERRITORIAL_ENTITLEMENT_UNRESOLVED")
    ladder = [
        *_identity_cases(),
        (F.col("clean"), "CONFIRMED_ENTITLED", F.lit("ACTIVE_ENTITLEMENT_EVIDENCED"), "clean"),
        (F.col("conflict"), "INDETERMINATE", F.lit("ROUTE_CONFLICT"), "conflict"),
        (F.col("all_closed"), "CONFIRMED_NOT_ENTITLED", F.when(F.col("all_withdrawn"), "ROOT_FAMILY_WITHDRAWN").otherwise("ALL_AVAILABLE_ROUTES_CLOSED"), "closed"),
        (F.col("blocked"), "INDETERMINATE", F.lit("NEGATIVE_EVIDENCE_BLOCKED"), "blocked"),
        (F.col("future"), "INDETERMINATE", unresolved, None),
        (F.col("expired"), "NO_ENTITLEMENT_EVIDENCED", F.lit("ENTITLEMENT_EXPIRED"), None),
        (F.col("closed"), "INDETERMINATE", unresolved, None),
        (F.lit(True), "NO_ENTITLEMENT_EVIDENCED", F.lit("NO_ASSERTIONS_IN_SCOPE"), None),
    ]
    return _climbed(found, ladder)


def _identity_cases() -> list[tuple]:
    reasons = {"AMBIGUOUS": "AMBIGUOUS_IDENTITY", "NOT_FOUND": "IDENTITY_NOT_FOUND", "CONFLICTING_IDENTIFIERS": "CONFLICTING_IDENTIFIERS"}
    return [(F.col("identity_state") == s, "INDETERMINATE", F.lit(r), None) for s, r in reasons.items()]


def _climbed(found: DataFrame, ladder: list[tuple]) -> DataFrame:
    """The first case of the ladder that holds: verdict, reason, the evidence it used and, where a case has a fifth member, what it adds to the diagnostics."""

    def pick(values: list[Column], last: Column) -> Column:
        return reduce(lambda acc, tv: F.when(tv[0], tv[1]).otherwise(acc), list(zip([c[0] for c in ladder], values, strict=True))[::-1], last)

    text, day = F.lit(None).cast("string"), F.lit(None).cast("date")
    joined = lambda ids: F.array_join(F.array_sort(ids), ",")
    added = pick([c[4] if len(c) > 4 else text for c in ladder], text)
    identity = F.when(F.col("identity_state") != "EXACT", F.concat(F.lit("identity:"), "identity_reason"))
    return found.select(
        *QUESTION, "identity_state",
        pick([F.lit(c[1]) for c in ladder], text).alias("verdict"),
        pick([c[2] for c in ladder], text).alias("reason"),
        pick([joined(F.col(f"{c[3]}_ids")) if c[3] else F.lit("") for c in ladder], F.lit("")).alias("used_ids"),
        pick([F.col(f"{c[3]}_fresh") if c[3] else day for c in ladder], day).alias("response_freshness"),
        F.coalesce(identity, joined(F.array_compact(F.array_append("diagnostics", added)))).alias("diagnostics"),
    )


def fact_reason() -> Column:
    """Why facts alone don't answer, over aggregates of a question's facts; the first that holds."""
    return (
        F.when(F.col("f_agent"), "AGENT_DELEGATED_ROUTE_NO_INDEPENDENT_ENTITLEMENT")
        .when(F.col("f_limited"), "TERRITORIAL_ROUTE_UNRESOLVED_LIMITED_LP")
        .when(F.col("f_parent"), "PARENT_STATUS_NOT_CHILD_ENTITLEMENT")
        .when(F.col("f_basis"), "INSUFFICIENT_LEGAL_BASIS")
        .when(F.col("f_withdrawn"), "WITHDRAWAL_SEMANTICS_DEFERRED")
        .when(F.col("f_deferred"), "TERRITORIAL_ENTITLEMENT_UNRESOLVED")
        .otherwise("MALFORMED_STATUS_SEQUENCE")
    )


def assess(questions: DataFrame, assertions: DataFrame, sources: DataFrame, facts: DataFrame, contracts: DataFrame, rules: DataFrame, version: str = "V2", aliases: dict[str, str] | None = None) -> DataFrame:
    """The ladders without routes: V1, and V2, where reported facts block or explain.

    V1 says AUTHORISED where V2 says ENTITLED.
    """
    if version not in ("V1", "V2"):
        raise ValueError(f"unknown version {version}")
    judged = gated(matched(questions, assertions, sources), contracts, rules, aliases).withColumn("blocked", F.lit(False))
    usable = facts_asked(questions, facts, contracts).where("bucket = 'usable'")
    rows = _dealt(questions, judged, usable)
    facts_said = F.concat(F.lit("reported_facts:"), F.array_join(F.array_sort(F.collect_list(F.col("fact_id").cast("string"))), ","))
    pair, sound = F.col("assertion_id").isNotNull(), F.col("assertion_id").isNotNull() & F.col("diagnostic").isNull()
    effect, fresh = F.col("legal_effect"), F.col("fresh_at")
    kinds = {"pos": effect == ENTITLED, "neg": effect == NOT_ENTITLED, "unk": effect == "UNKNOWN"}
    failed = lambda d: F.bool_or(_yes(F.col("diagnostic") == d)).alias(f"d_{d}")
    says = lambda part: F.bool_or(_yes(F.col("rule_id").contains(part)))
    status = lambda s: F.bool_or(_yes(F.col("reported_status") == s))
    found = rows.groupBy(*QUESTION_KEYS).agg(
        F.bool_or(pair).alias("matching"),
        *(_ids(sound & t).alias(f"{k}_ids") for k, t in kinds.items()),
        *(F.min(F.when(sound & t, fresh)).alias(f"{k}_fresh") for k, t in kinds.items()),
        _ids(sound).alias("all_ids"), F.min(F.when(sound, fresh)).alias("all_fresh"),
        *(failed(d) for d in ("agent_missing_principal", "out_of_source_scope", "not_in_effect", "stale_evidence")),
        F.bool_or(_yes(pair & (effect == ENTITLED) & (F.col("effective_to") < F.col("valid_at")))).alias("expired"),
        _yes(F.bool_and(F.when(sound & kinds["unk"], F.col("territorial_basis") == SERVICES))).alias("only_services"),
        F.collect_list(_diagnosis()).alias("diagnostics"), F.bool_or(F.col("fact_id").isNotNull()).alias("has_fact"),
        says("agent-parent-status").alias("f_agent"), says("limited-lp").alias("f_limited"), says("parent-status").alias("f_parent"), says("insufficient-basis").alias("f_basis"),
        status("WITHDRAWN").alias("f_withdrawn"), status("TERRITORIAL_ENTITLEMENT_DEFERRED").alias("f_deferred"), facts_said.alias("facts_said"),
    )
    two = version == "V2"
    yes, no, open_, nothing = ("CONFIRMED_ENTITLED" if two else "CONFIRMED_AUTHORISED", "CONFIRMED_NOT_ENTITLED" if two else "CONFIRMED_NOT_AUTHORISED", "INDETERMINATE", "NO_ENTITLEMENT_EVIDENCED")
    has = {k: F.size(f"{k}_ids") > 0 for k in ("pos", "neg", "unk")}
    none = ~(has["pos"] | has["neg"] | has["unk"])
    facts_block, contradicted = F.lit(two) & F.col("has_fact"), F.lit(two) & F.col("f_withdrawn")
    ladder = [
        *_identity_cases(),
        (none & facts_block, open_, fact_reason(), None, F.col("facts_said")),
        (none & ~F.col("matching"), nothing, F.lit("NO_ASSERTIONS_IN_SCOPE"), None),
        (none & F.col("d_agent_missing_principal"), open_, F.lit("AGENT_ASSERTION_MISSING_PRINCIPAL"), None),
        (none & F.col("d_out_of_source_scope"), nothing, F.lit("ASSERTION_OUT_OF_SOURCE_SCOPE"), None),
        (none & F.col("d_not_in_effect"), nothing, F.when(F.col("expired"), "ENTITLEMENT_EXPIRED").otherwise("NO_ASSERTIONS_IN_SCOPE"), None),
        (none & F.col("d_stale_evidence"), open_, F.lit("ALL_EVIDENCE_STALE"), None),
        (none, open_, F.lit("UNINTERPRETABLE_EVIDENCE"), None),
        (has["pos"] & has["neg"], open_, F.lit("CONFLICTING_ASSERTIONS"), "all", F.lit("conflicting_legal_effects")),
        (has["neg"], no, F.lit("EXPLICIT_NEGATIVE_EVIDENCE"), "neg"),
        (has["pos"] & contradicted, open_, F.lit("CONFLICTING_ASSERTIONS"), "all", F.lit("conflicting_reported_fact:withdrawn")),
        (has["pos"], yes, F.lit("ACTIVE_ENTITLEMENT_EVIDENCED" if two else "SUPPORTED_BY_ACTIVE_ASSERTIONS"), "pos"),
        (F.lit(two) & F.col("only_services"), open_, F.lit("TERRITORIAL_ENTITLEMENT_UNRESOLVED"), "unk"),
        (F.lit(True), open_, F.lit("UNINTERPRETABLE_EVIDENCE"), "unk"),
    ]
    return _climbed(found, ladder)


def evaluations(questions: DataFrame, assertions: DataFrame, sources: DataFrame) -> DataFrame:
    """What each usable assertion of a question says at its date, sound or not."""
    pairs = matched(questions, assertions, sources).where("bucket = 'usable'")
    effect = effect_at(F.col("valid_at"), F.col("legal_effect"), F.col("effective_from"), F.col("effective_to"), F.col("exclusive_end"))
    return pairs.withColumn("e", effect).select(*QUESTION, "assertion_id", "register_id", "legal_effect", F.col("e.effect").alias("effect_at"), F.col("e.reason").alias("reason"))


def audit(questions: DataFrame, assertions: DataFrame, sources: DataFrame, facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Per question, the sorted ids of usable, later and untraceable assertions and facts."""
    pairs = matched(questions, assertions, sources).select(*QUESTION, "bucket", F.col("assertion_id").cast("string").alias("id"), F.lit("assertion").alias("of"))
    known = facts_asked(questions, facts, contracts).select(*QUESTION, "bucket", F.col("fact_id").cast("string").alias("id"), F.lit("fact").alias("of"))
    empty = questions.select(*QUESTION, F.lit(None).cast("string").alias("bucket"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("of"))
    rows = pairs.unionByName(known).unionByName(empty)

    def ids(of: str, b: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when((F.col("of") == of) & (F.col("bucket") == b), F.col("id")))), ",").alias(f"{b}_{of}_ids")

    lost = F.collect_list(F.when(F.col("bucket") == "untraceable", F.concat(F.lit("no_source_assertions:"), "id")))
    return rows.groupBy(*QUESTION).agg(
        *(ids(of, b) for of in ("assertion", "fact") for b in ("usable", "after_k", "untraceable")), F.array_join(F.array_sort(lost), ",").alias("diagnostics")
    )
