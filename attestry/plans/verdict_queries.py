"""Queries of the verdict engine, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions import scalars as S
from attestry.operators import operations as O
from attestry.operators import verdict as V
from attestry.plans import lens as L

_IN_EFFECT = "effective_from <= {at} and not coalesce(case when exclusive_end then {at} >= effective_to else {at} > effective_to end, false)"

_PAIRS = f"""{L.SQL.rstrip()},
knowledge as (
  select assertion_id, max(retrieved_at) as knowledge_time, max(coalesce(source_as_of, retrieved_at)) as fresh_at, count(*) as n_sources
  from sources group by assertion_id),
cited as (
  select assertion_id, register_id as cited, case register_id when 'VIEW0' then 'REG0' else register_id end as governing, max(coalesce(source_as_of, retrieved_at)) as fresh
  from sources group by all),
pairs as (
  select q.*, a.assertion_id, a.legal_effect, a.territorial_basis, a.effective_from, a.effective_to, a.exclusive_end, a.blocked, a.root_key, a.root_home, a.register_id,
    a.entity_class, a.principal_id, a.composition, k.knowledge_time, k.fresh_at, k.n_sources,
    case when k.knowledge_time is null then 'untraceable' when k.knowledge_time <= q.known_at then 'usable' else 'after_k' end as bucket
  from questions q join assertions a on q.entity_id = a.entity_id and q.activity = a.activity and q.jurisdiction = a.jurisdiction
  left join knowledge k on a.assertion_id = k.assertion_id
  where q.asked_basis is null or q.asked_basis = a.territorial_basis),
places as (
  select distinct register_id, entity_class, activity, jurisdiction, territorial_basis, valid_at from pairs where bucket = 'usable'
  union
  select distinct c.governing, p.entity_class, p.activity, p.jurisdiction, p.territorial_basis, p.valid_at
  from pairs p join cited c on p.assertion_id = c.assertion_id where p.bucket = 'usable' and p.composition = 'ALL_REQUIRED'),
scopes as (
  select p.*, min(r.ordinal) filter (where r.scope = 'OUT') as out_ord, min(r.ordinal) filter (where r.scope = 'IN') as in_ord
  from places p left join coverage_rules r on p.register_id = r.register_id
    and (r.rule_class is null or r.rule_class = p.entity_class) and (r.rule_activities is null or list_contains(r.rule_activities, p.activity))
    and (r.rule_jurisdictions is null or list_contains(r.rule_jurisdictions, p.jurisdiction)) and (r.rule_bases is null or list_contains(r.rule_bases, p.territorial_basis))
    and (r.valid_from is null or p.valid_at >= r.valid_from) and (r.valid_to is null or p.valid_at <= r.valid_to)
  group by all),
decided as (
  select s.*, c.positive_days, c.negative_days, c.capability,
    case when out_ord is not null or (without_banks and entity_class = 'BANK') or (without_e_money and activity = 'E_MONEY_ISSUANCE') or (only_j0 and jurisdiction <> 'J0') then 'OUT_OF_SCOPE'
      when in_ord is not null then 'IN_SCOPE' else 'UNKNOWN' end as status,
    case when out_ord is not null then 'RULE' || out_ord when without_banks and entity_class = 'BANK' then 'contract-excluded-entity-classes'
      when without_e_money and activity = 'E_MONEY_ISSUANCE' then 'contract-activities-coverage' when only_j0 and jurisdiction <> 'J0' then 'contract-jurisdiction-coverage'
      when in_ord is not null then 'RULE' || in_ord end as scope_rule,
    case when out_ord is not null then 'EXPLICIT_EXCLUSION' when without_banks and entity_class = 'BANK' then 'EXCLUDED_ENTITY_CLASS'
      when without_e_money and activity = 'E_MONEY_ISSUANCE' then 'ACTIVITY_NOT_COVERED_BY_REGISTER' when only_j0 and jurisdiction <> 'J0' then 'JURISDICTION_NOT_COVERED_BY_REGISTER'
      when in_ord is not null then 'COVERED_BY_RULE' else 'NO_RULE_MATCHES' end as why
  from scopes s join contracts c on s.register_id = c.register_id),
failing as (
  select p.assertion_id, p.valid_at, p.known_at, c.cited,
    case when d.status is null then 'no_contract' when d.status = 'OUT_OF_SCOPE' then 'out_of_source_scope'
      when coalesce((p.valid_at - c.fresh) > case when p.legal_effect = 'NOT_ENTITLED' then d.negative_days else d.positive_days end, true) then 'stale_required_source' end as kind
  from pairs p join cited c on p.assertion_id = c.assertion_id
  left join decided d on d.register_id = c.governing and d.entity_class = p.entity_class and d.activity = p.activity and d.jurisdiction = p.jurisdiction
    and d.territorial_basis = p.territorial_basis and d.valid_at = p.valid_at
  where p.bucket = 'usable' and p.composition = 'ALL_REQUIRED'),
failed as (select assertion_id, valid_at, known_at, min(cited) as cited, arg_min(kind, cited) as kind from failing where kind is not null group by all),
own as (
  select p.*, case when d.status is null then 'no_contract' when d.status = 'OUT_OF_SCOPE' then 'out_of_source_scope'
      when d.status = 'UNKNOWN' and coalesce(n_sources, 0) = 0 then 'unknown_scope_no_evidence'
      when list_contains(p.entity_classes, 'PSP_AGENT') and principal_id is null then 'agent_missing_principal'
      when not ({_IN_EFFECT.format(at="p.valid_at")}) then 'not_in_effect'
      when coalesce((p.valid_at - fresh_at) > case when legal_effect = 'NOT_ENTITLED' then negative_days else positive_days end, true) then 'stale_evidence' end as first_gate
  from pairs p left join decided d on p.register_id = d.register_id and p.entity_class = d.entity_class and p.activity = d.activity and p.jurisdiction = d.jurisdiction
    and p.territorial_basis = d.territorial_basis and p.valid_at = d.valid_at
  where bucket = 'usable'),
gated as (
  select o.*, coalesce(first_gate, f.kind) as diagnostic,
    case when blocked then 'blocked_evidence:' || o.assertion_id when first_gate = 'no_contract' then 'no_contract:' || register_id
      when first_gate is not null then first_gate || ':' || o.assertion_id when f.kind = 'no_contract' then 'no_contract:' || f.cited
      when f.kind is not null then f.kind || ':' || o.assertion_id || ':' || f.cited end as said,
    case when first_gate = 'no_contract' then 'no_contract:' || register_id
      when first_gate is not null then first_gate || ':' || o.assertion_id when f.kind = 'no_contract' then 'no_contract:' || f.cited
      when f.kind is not null then f.kind || ':' || o.assertion_id || ':' || f.cited end as said_unblocked
  from own o left join failed f on o.assertion_id = f.assertion_id and o.valid_at = f.valid_at and o.known_at = f.known_at),
asked_facts as (
  select q.*, f.fact_id, f.rule_id, f.reported_status, f.root_key, f.root_home, f.negative_class, f.effective_from, f.span_from, f.span_to,
    case when f.knowledge_time is null then 'untraceable' when f.knowledge_time <= q.known_at then 'usable' else 'after_k' end as bucket,
    coalesce((q.valid_at - f.fresh_at) <= c.negative_days, false) as fresh
  from questions q join facts f on q.entity_id = f.entity_id left join contracts c on f.register_id = c.register_id),
root_states as (
  select {{Q}}, root_key,
    case when min(span_from) filter (where fresh) is not null then
        case when coalesce(bool_or(fresh and span_from <= valid_at and (span_to is null or valid_at < span_to)), false) then 'OPEN'
             when valid_at >= min(span_from) filter (where fresh) then 'CLOSED' else 'ABSENT' end
      when coalesce(bool_or(fresh and negative_class = 'EXPLICIT_WITHDRAWAL' and effective_from <= valid_at), false) then 'CLOSED'
      when coalesce(bool_or(fresh and effective_from is not null and (negative_class in ('ENTITY_BAJA', 'UNRESOLVED_MOTIVO') or (negative_class is null and reported_status = 'WITHDRAWN'))), false) then 'UNRESOLVED'
      else 'OPEN' end as root_state
  from asked_facts where bucket = 'usable' and root_key is not null group by {{Q}}, root_key)
""".replace("{Q}", "entity_id, activity, jurisdiction, asked_basis, valid_at, known_at")

_Q = "entity_id, activity, jurisdiction, asked_basis, valid_at, known_at"

_ROUTES = f"""{_PAIRS.rstrip()},
exact as (select * from gated where identity_state = 'EXACT'),
routes as (
  select {_Q}, coalesce(root_key, 'UNSCOPED|' || register_id) as scope, territorial_basis,
    count(*) filter (where diagnostic is null and not blocked and legal_effect = 'ENTITLED_TO_PROVIDE') as n_open,
    count(*) filter (where diagnostic is null and not blocked and legal_effect = 'NOT_ENTITLED') as n_closed
  from exact group by all)
"""

_SAME = " and ".join(f"{{a}}.{c} is not distinct from {{b}}.{c}" for c in _Q.split(", "))

_VERDICT = f"""{_ROUTES.rstrip()},
used as (
  select g.*, r.n_open > 0 and r.n_closed = 0 and g.diagnostic is null and not blocked and legal_effect = 'ENTITLED_TO_PROVIDE' as in_clean,
    r.n_open > 0 and r.n_closed > 0 and g.diagnostic is null and not blocked and legal_effect in ('ENTITLED_TO_PROVIDE', 'NOT_ENTITLED') as in_conflict,
    g.diagnostic is null and not blocked and legal_effect = 'NOT_ENTITLED' as in_closed
  from exact g join routes r on {_SAME.format(a="g", b="r")} and coalesce(g.root_key, 'UNSCOPED|' || g.register_id) = r.scope and g.territorial_basis = r.territorial_basis),
roots as (select {_Q}, root_key, min(root_home) as home from (
    select {_Q}, root_key, root_home from exact where root_key is not null
    union all select {_Q}, root_key, root_home from asked_facts where bucket = 'usable' and root_key is not null and identity_state = 'EXACT') group by all),
judged_roots as (
  select r.*, s.root_state, coalesce(s.root_state, 'NONE') <> 'ABSENT' and case split_part(r.root_key, '|', 2)
      when 'PSD_AISP' then r.activity = 'ACCOUNT_INFORMATION_SERVICES' when 'PSD_PI' then r.activity <> 'E_MONEY_ISSUANCE' else true end as applies,
    (select count(distinct t.territorial_basis) from routes t where {_SAME.format(a="t", b="r")} and t.scope = r.root_key and t.n_closed > 0
      and t.territorial_basis in ('DOMESTIC') and r.home = 'ES') as shut_home,
    (select count(distinct t.territorial_basis) from routes t where {_SAME.format(a="t", b="r")} and t.scope = r.root_key and t.n_closed > 0
      and t.territorial_basis in ('BRANCH', 'FREEDOM_TO_PROVIDE_SERVICES') and (r.asked_basis is null or t.territorial_basis = r.asked_basis)) as shut_abroad
  from roots r left join root_states s on {_SAME.format(a="s", b="r")} and s.root_key = r.root_key),
closures as (
  select {_Q},
    coalesce(bool_and(coalesce(root_state, 'NONE') = 'CLOSED' or (coalesce(root_state, 'NONE') <> 'UNRESOLVED'
      and case when home is not distinct from 'ES' then (asked_basis is null or asked_basis = 'DOMESTIC') and shut_home = 1
               else shut_abroad = case when asked_basis is null then 2 when asked_basis = 'DOMESTIC' then 9 else 1 end end)) filter (where applies), false) as all_closed,
    coalesce(bool_and(coalesce(root_state, 'NONE') = 'CLOSED') filter (where applies), false) as all_withdrawn
  from judged_roots group by all),
per_question as (
  select {_Q}, bool_or(in_clean) as clean, bool_or(in_conflict) as conflict, bool_or(in_closed) as closed, bool_or(blocked) as has_blocked,
    string_agg(cast(assertion_id as varchar), ',' order by cast(assertion_id as varchar)) filter (where in_clean) as clean_ids,
    string_agg(cast(assertion_id as varchar), ',' order by cast(assertion_id as varchar)) filter (where in_conflict) as conflict_ids,
    string_agg(cast(assertion_id as varchar), ',' order by cast(assertion_id as varchar)) filter (where in_closed) as closed_ids,
    string_agg(cast(assertion_id as varchar), ',' order by cast(assertion_id as varchar)) filter (where blocked) as blocked_ids,
    min(fresh_at) filter (where in_clean) as clean_fresh, min(fresh_at) filter (where in_conflict) as conflict_fresh,
    min(fresh_at) filter (where in_closed) as closed_fresh, min(fresh_at) filter (where blocked) as blocked_fresh,
    bool_or(legal_effect = 'ENTITLED_TO_PROVIDE' and effective_from > valid_at and is_open) as future,
    bool_or(legal_effect = 'ENTITLED_TO_PROVIDE' and effective_to <= valid_at and is_open) as expired
  from (select u.*, exists (select 1 from root_states s where {_SAME.format(a="s", b="u")} and s.root_key = u.root_key and s.root_state = 'OPEN') as is_open from used u)
  group by all),
said as (select {_Q}, string_agg(what, ',' order by what) as diagnostics from (
    select {_Q}, said as what from exact where said is not null
    union all select {_Q}, 'route_conflict:' || scope || ':' || territorial_basis from routes where n_open > 0 and n_closed > 0) group by all),
flags as (
  select q.*, p.* exclude ({_Q}), coalesce(c.all_closed, false) as all_closed, coalesce(c.all_withdrawn, false) as all_withdrawn, s.diagnostics,
    case when q.identity_state <> 'EXACT' then 0 when p.clean then 1 when p.conflict then 2 when c.all_closed then 3 when p.has_blocked then 4
      when p.future then 5 when p.expired then 6 when p.closed then 7 else 8 end as step
  from questions q left join per_question p on {_SAME.format(a="p", b="q")} left join closures c on {_SAME.format(a="c", b="q")} left join said s on {_SAME.format(a="s", b="q")})
select {_Q}, identity_state,
  case step when 1 then 'CONFIRMED_ENTITLED' when 3 then 'CONFIRMED_NOT_ENTITLED' when 6 then 'NO_ENTITLEMENT_EVIDENCED' when 8 then 'NO_ENTITLEMENT_EVIDENCED' else 'INDETERMINATE' end as verdict,
  case step when 0 then case identity_state when 'AMBIGUOUS' then 'AMBIGUOUS_IDENTITY' when 'NOT_FOUND' then 'IDENTITY_NOT_FOUND' else identity_state end
    when 1 then 'ACTIVE_ENTITLEMENT_EVIDENCED' when 2 then 'ROUTE_CONFLICT' when 3 then case when all_withdrawn then 'ROOT_FAMILY_WITHDRAWN' else 'ALL_AVAILABLE_ROUTES_CLOSED' end
    when 4 then 'NEGATIVE_EVIDENCE_BLOCKED' when 6 then 'ENTITLEMENT_EXPIRED' when 8 then 'NO_ASSERTIONS_IN_SCOPE' else 'TERRITORIAL_ENTITLEMENT_UNRESOLVED' end as reason,
  coalesce(case step when 1 then clean_ids when 2 then conflict_ids when 3 then closed_ids when 4 then blocked_ids end, '') as used_ids,
  case step when 1 then clean_fresh when 2 then conflict_fresh when 3 then closed_fresh when 4 then blocked_fresh end as response_freshness,
  case when step = 0 then 'identity:WHY_' || identity_state else coalesce(diagnostics, '') end as diagnostics
from flags
"""


def _assess_sql(two: bool) -> str:
    """The ladders without routes, in SQL; ``two`` is V2."""
    yes, no = ("CONFIRMED_ENTITLED", "CONFIRMED_NOT_ENTITLED") if two else ("CONFIRMED_AUTHORISED", "CONFIRMED_NOT_AUTHORISED")
    active = "ACTIVE_ENTITLEMENT_EVIDENCED" if two else "SUPPORTED_BY_ACTIVE_ASSERTIONS"
    ids = "string_agg(cast(assertion_id as varchar), ',' order by cast(assertion_id as varchar)) filter (where diagnostic is null{})"
    return f"""{_PAIRS.rstrip()},
e as (
  select {_Q}, count(*) as n, count(*) filter (where diagnostic is null) as n_sound,
    count(*) filter (where diagnostic is null and legal_effect = 'ENTITLED_TO_PROVIDE') as n_pos, count(*) filter (where diagnostic is null and legal_effect = 'NOT_ENTITLED') as n_neg,
    {ids.format("")} as all_ids, {ids.format(" and legal_effect = 'ENTITLED_TO_PROVIDE'")} as pos_ids, {ids.format(" and legal_effect = 'NOT_ENTITLED'")} as neg_ids,
    {ids.format(" and legal_effect = 'UNKNOWN'")} as unk_ids,
    min(fresh_at) filter (where diagnostic is null) as all_fresh, min(fresh_at) filter (where diagnostic is null and legal_effect = 'ENTITLED_TO_PROVIDE') as pos_fresh,
    min(fresh_at) filter (where diagnostic is null and legal_effect = 'NOT_ENTITLED') as neg_fresh, min(fresh_at) filter (where diagnostic is null and legal_effect = 'UNKNOWN') as unk_fresh,
    bool_and(territorial_basis = 'FREEDOM_TO_PROVIDE_SERVICES') filter (where diagnostic is null and legal_effect = 'UNKNOWN') as only_services,
    bool_or(diagnostic = 'agent_missing_principal') as d_agent, bool_or(diagnostic = 'out_of_source_scope') as d_out, bool_or(diagnostic = 'not_in_effect') as d_window,
    bool_or(diagnostic = 'stale_evidence') as d_stale, bool_or(legal_effect = 'ENTITLED_TO_PROVIDE' and effective_to < valid_at) as expired,
    list(said_unblocked) filter (where said_unblocked is not null) as diagnostics
  from gated where identity_state = 'EXACT' group by {_Q}),
f as (
  select {_Q}, bool_or(rule_id like '%agent-parent-status%') as f1, bool_or(rule_id like '%limited-lp%') as f2, bool_or(rule_id like '%parent-status%') as f3,
    bool_or(rule_id like '%insufficient-basis%') as f4, bool_or(reported_status = 'WITHDRAWN') as f5, bool_or(reported_status = 'TERRITORIAL_ENTITLEMENT_DEFERRED') as f6,
    'reported_facts:' || string_agg(fact_id::varchar, ',' order by fact_id::varchar) as facts_said
  from asked_facts where bucket = 'usable' and identity_state = 'EXACT' group by {_Q}),
g as (
  select q.*, e.* exclude ({_Q}), f.* exclude ({_Q}),
    case when q.identity_state <> 'EXACT' then 0
      when coalesce(n_sound, 0) = 0 then case when {two} and f1 is not null then 1 when n is null then 2 when d_agent then 3 when d_out then 4 when d_window then 5 when d_stale then 6 else 7 end
      when n_pos > 0 and n_neg > 0 then 8 when n_neg > 0 then 9 when n_pos > 0 and {two} and f5 then 8 when n_pos > 0 then 10 when {two} and only_services then 11 else 12 end as step
  from questions q left join e on {_SAME.format(a="e", b="q")} left join f on {_SAME.format(a="f", b="q")})
select {_Q}, identity_state,
  case when step = 9 then '{no}' when step = 10 then '{yes}' when step in (2, 4, 5) then 'NO_ENTITLEMENT_EVIDENCED' else 'INDETERMINATE' end as verdict,
  case step when 0 then case identity_state when 'AMBIGUOUS' then 'AMBIGUOUS_IDENTITY' when 'NOT_FOUND' then 'IDENTITY_NOT_FOUND' else identity_state end
    when 1 then case when f1 then 'AGENT_DELEGATED_ROUTE_NO_INDEPENDENT_ENTITLEMENT' when f2 then 'TERRITORIAL_ROUTE_UNRESOLVED_LIMITED_LP' when f3 then 'PARENT_STATUS_NOT_CHILD_ENTITLEMENT'
      when f4 then 'INSUFFICIENT_LEGAL_BASIS' when f5 then 'WITHDRAWAL_SEMANTICS_DEFERRED' when f6 then 'TERRITORIAL_ENTITLEMENT_UNRESOLVED' else 'MALFORMED_STATUS_SEQUENCE' end
    when 2 then 'NO_ASSERTIONS_IN_SCOPE' when 3 then 'AGENT_ASSERTION_MISSING_PRINCIPAL' when 4 then 'ASSERTION_OUT_OF_SOURCE_SCOPE'
    when 5 then case when expired then 'ENTITLEMENT_EXPIRED' else 'NO_ASSERTIONS_IN_SCOPE' end when 6 then 'ALL_EVIDENCE_STALE' when 8 then 'CONFLICTING_ASSERTIONS'
    when 9 then 'EXPLICIT_NEGATIVE_EVIDENCE' when 10 then '{active}' when 11 then 'TERRITORIAL_ENTITLEMENT_UNRESOLVED' else 'UNINTERPRETABLE_EVIDENCE' end as reason,
  coalesce(case when step = 8 then all_ids when step = 9 then neg_ids when step = 10 then pos_ids when step in (11, 12) then unk_ids end, '') as used_ids,
  case when step = 8 then all_fresh when step = 9 then neg_fresh when step = 10 then pos_fresh when step in (11, 12) then unk_fresh end as response_freshness,
  case when step = 0 then 'identity:WHY_' || identity_state else coalesce(array_to_string(list_sort(list_concat(coalesce(diagnostics, []), case when step = 1 then [facts_said]
    when step = 8 and n_neg > 0 then ['conflicting_legal_effects'] when step = 8 then ['conflicting_reported_fact:withdrawn'] else [] end)), ','), '') end as diagnostics
from g
"""


def _evidence(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return L.questions(s, d), L.assertions(s, d), L.sources(s, d)


def _rest(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return L.facts(s, d), L.contracts(s, d), L.coverage_rules(s, d)


def _gated(s: SparkSession, d: str) -> DataFrame:
    return V.gated(V.matched(*_evidence(s, d)), L.contracts(s, d), L.coverage_rules(s, d), L.ALIASES)


def bitemporal_verdict(s: SparkSession, d: str) -> DataFrame:
    return V.verdicts(*_evidence(s, d), *_rest(s, d), L.ALIASES)


def verdict_simple(s: SparkSession, d: str) -> DataFrame:
    return V.assess(*_evidence(s, d), *_rest(s, d), "V1", L.ALIASES)


def verdict_with_facts(s: SparkSession, d: str) -> DataFrame:
    return V.assess(*_evidence(s, d), *_rest(s, d), "V2", L.ALIASES)


def evidence_audit(s: SparkSession, d: str) -> DataFrame:
    return V.audit(*_evidence(s, d), L.facts(s, d), L.contracts(s, d))


def assertion_evaluations(s: SparkSession, d: str) -> DataFrame:
    return V.evaluations(*_evidence(s, d))


def visibility_partition(s: SparkSession, d: str) -> DataFrame:
    return V.matched(*_evidence(s, d)).groupBy("valid_at", "known_at", "bucket").agg(F.count("*").alias("n_rows"))


def admissibility_first_failure(s: SparkSession, d: str) -> DataFrame:
    return _gated(s, d).select("entity_id", "assertion_id", "valid_at", "known_at", F.coalesce("diagnostic", F.lit("ADMISSIBLE")).alias("diagnostic"), "failed_register")


def route_aggregate(s: SparkSession, d: str) -> DataFrame:
    none = L.facts(s, d).where("false")
    rows = V._dealt(L.questions(s, d), _gated(s, d), V.facts_asked(L.questions(s, d), none, L.contracts(s, d)))
    found = V.routes(rows.where("assertion_id is not null"))
    return found.select(*V.QUESTION, "scope", "territorial_basis", F.size("open_ids").cast("long").alias("n_open"), F.size("closed_ids").cast("long").alias("n_closed"))


def route_conflict(s: SparkSession, d: str) -> DataFrame:
    return route_aggregate(s, d).where("n_open > 0 and n_closed > 0").select(*V.QUESTION, "scope", "territorial_basis")


def root_state_at(s: SparkSession, d: str) -> DataFrame:
    return V.root_states(L.questions(s, d), L.facts(s, d), L.contracts(s, d))


def knowledge_time(s: SparkSession, d: str) -> DataFrame:
    return V.knowledge(L.sources(s, d)).drop("registers")


def register_freshness(s: SparkSession, d: str) -> DataFrame:
    """How fresh each register's share of an assertion's evidence is."""
    k = V.knowledge(L.sources(s, d)).select("assertion_id", F.posexplode("registers").alias("place", "r"))
    return k.select("assertion_id", F.col("place").cast("long").alias("place"), "r.register", "r.fresh")


def effect_at_date(s: SparkSession, d: str) -> DataFrame:
    a, at = L.assertions(s, d), F.lit("1998-06-01").cast("date")
    effect = V.effect_at(at, F.col("legal_effect"), F.col("effective_from"), F.col("effective_to"), F.col("exclusive_end"))
    return a.select("assertion_id", effect.alias("e")).select("assertion_id", "e.effect", "e.reason")


def window_inclusive_exclusive(s: SparkSession, d: str) -> DataFrame:
    a = L.assertions(s, d).where("effective_to is not null")
    inside = lambda at: V.covers(at, F.col("effective_from"), F.col("effective_to"), F.col("exclusive_end"))
    return a.select("assertion_id", inside(F.col("effective_to")).alias("on_end"), inside(F.date_add("effective_to", 1)).alias("day_after"), inside(F.date_sub("effective_from", 1)).alias("day_before"))


def staleness_gate(s: SparkSession, d: str) -> DataFrame:
    k = V.knowledge(L.sources(s, d)).join(L.assertions(s, d), "assertion_id").join(L.contracts(s, d), "register_id", "left")
    at = F.lit("1998-06-01").cast("date")
    policy = F.when(F.col("legal_effect") == "NOT_ENTITLED", F.col("negative_days")).otherwise(F.col("positive_days"))
    return k.select("assertion_id", S.is_stale(at, F.col("fresh_at"), policy).alias("stale"))


def _decisions(s: SparkSession, d: str) -> DataFrame:
    """Each assertion at its first day, with the coverage decision of its register's contract, if it has one."""
    held = V.with_rules(L.contracts(s, d), L.coverage_rules(s, d))
    a = L.assertions(s, d).withColumn("valid_at", F.col("effective_from")).join(F.broadcast(held.select("register_id", "capability", F.struct(*held.columns).alias("contract"))), "register_id", "left")
    place = [F.col(c) for c in ("entity_class", "activity", "jurisdiction", "territorial_basis", "valid_at")]
    none = F.struct(F.lit("NO_CONTRACT").alias("status"), F.lit(None).cast("string").alias("rule_id"), F.lit("NO_CONTRACT").alias("reason"))
    return a.withColumn("d", F.when(F.col("contract").isNull(), none).otherwise(V.coverage(F.col("contract"), *place)))


def coverage_decision(s: SparkSession, d: str) -> DataFrame:
    return _decisions(s, d).select("assertion_id", F.col("d.status").alias("status"), F.coalesce("d.rule_id", F.lit("")).alias("scope_rule"), F.col("d.reason").alias("why"))


def enumeration_negative_gate(s: SparkSession, d: str) -> DataFrame:
    """Five refusals in order before an absence may count as a negative.

    Identity is the question's own; the snapshot of a register that enumerates was taken under
    the rule that a branch's assertion of the register's first activity has.
    """
    ids = L.questions(s, d).select("entity_id", "identity_state").distinct()
    rules = L.coverage_rules(s, d).where("scope = 'IN'").groupBy("register_id").agg(F.min_by("rule_id", "ordinal").alias("snapshot_rule"))
    rules = rules.where("register_id <> 'REG4'")  # one register has no snapshot
    rows = _decisions(s, d).join(ids, "entity_id").join(F.broadcast(rules), "register_id", "left")
    gate = V.enumeration_negative(F.col("identity_state"), F.col("d"), F.col("capability"), F.col("snapshot_rule"))
    return rows.select("assertion_id", gate.alias("gate"), (gate == "ENUMERATION_NEGATIVE_ALLOWED").alias("allowed"))


def run_metrics(s: SparkSession, d: str) -> DataFrame:
    """All histograms of a run in one pass: by verdict, by reason, and in total."""
    v = bitemporal_verdict(s, d)
    sets = v.rollup("verdict", "reason").agg(F.count("*").alias("n_questions"))
    return sets.select(F.coalesce("verdict", F.lit("*")).alias("verdict"), F.coalesce("reason", F.lit("*")).alias("reason"), "n_questions")


def response_freshness(s: SparkSession, d: str) -> DataFrame:
    """The least fresh date of the evidence that each answered question used."""
    return bitemporal_verdict(s, d).where("response_freshness is not null").select(*V.QUESTION, "response_freshness")


def _requests(s: SparkSession, d: str) -> DataFrame:
    """A request a part, well and badly formed."""
    k = F.col("p_partkey")
    text = lambda c: c.cast("string")
    return L.table(s, d, "part").select(
        k.alias("request_id"),
        F.when(k % 7 == 0, "delete").when(k % 7 < 3, "assess").when(k % 7 == 3, "assess_bitemporal").when(k % 7 == 4, "explain").when(k % 7 == 5, "evidence").otherwise("changes").alias("operation"),
        F.when(k % 11 != 0, text(k * 3)).alias("entity_id"), F.when(k % 13 != 0, "PAYMENT_SERVICES").otherwise("").alias("activity"), F.lit("J0").alias("jurisdiction"),
        F.when(k % 5 == 0, "1998-6-01").otherwise("1998-06-01").alias("valid_at"), F.when(k % 3 != 0, "1999-12-31").alias("known_at"),
        F.when(k % 2 == 0, text(k)).alias("assertion_id"), F.when(k % 2 == 0, text(k)).alias("record_key"), F.when(k % 3 == 0, text(k)).alias("pair"),
    )


def request_check(s: SparkSession, d: str) -> DataFrame:
    c = O.checked(_requests(s, d), L.entities(s, d))
    return c.select("request_id", "operation", "valid_day", "known_day", F.coalesce("error", F.lit("OK")).alias("error"))


def explain_verdicts(s: SparkSession, d: str) -> DataFrame:
    return O.explained(bitemporal_verdict(s, d), assertion_evaluations(s, d))


def evidence_lookup(s: SparkSession, d: str) -> DataFrame:
    return O.evidence_of(L.assertions(s, d).where("blocked"), L.sources(s, d))


def run_cases(s: SparkSession, d: str) -> DataFrame:
    """A run of cases whose expected verdict is the one without routes."""
    two = verdict_with_facts(s, d).select(*V.QUESTION, F.col("verdict").alias("expected"))
    return O.run_summary(O.met(bitemporal_verdict(s, d), two, list(V.QUESTION)))


def contract_faults(s: SparkSession, d: str) -> DataFrame:
    """Contracts and rules checked against a vocabulary without banks and with two bases."""
    contracts = L.contracts(s, d).withColumn("negative_days", F.when(F.col("register_id") == "REG2", 5000).otherwise(F.col("negative_days")))
    return O.contract_faults(contracts, L.coverage_rules(s, d), ["PSP_AGENT", "PAYMENT_INSTITUTION"], list(L.ACTIVITIES), ["BRANCH", "DOMESTIC"])


_DECISIONS = f"""{L.SQL.rstrip()},
a as (select *, effective_from as valid_at from assertions),
scopes as (
  select a.assertion_id, a.entity_id, a.register_id, a.entity_class, a.activity, a.jurisdiction, min(r.ordinal) filter (where r.scope = 'OUT') as out_ord, min(r.ordinal) filter (where r.scope = 'IN') as in_ord
  from a left join coverage_rules r on a.register_id = r.register_id
    and (r.rule_class is null or r.rule_class = a.entity_class) and (r.rule_activities is null or list_contains(r.rule_activities, a.activity))
    and (r.rule_jurisdictions is null or list_contains(r.rule_jurisdictions, a.jurisdiction)) and (r.rule_bases is null or list_contains(r.rule_bases, a.territorial_basis))
    and (r.valid_from is null or a.valid_at >= r.valid_from) and (r.valid_to is null or a.valid_at <= r.valid_to)
  group by all),
decided as (
  select s.*, c.capability, case when out_ord is not null then 1 when without_banks and entity_class = 'BANK' then 2 when without_e_money and activity = 'E_MONEY_ISSUANCE' then 3
    when only_j0 and jurisdiction <> 'J0' then 4 when c.register_id is null then 7 when in_ord is not null then 5 else 6 end as step from scopes s left join contracts c on s.register_id = c.register_id)
"""

QUERIES = {
    "request_check": (
        request_check,
        """with r as (select p_partkey as k, case when p_partkey % 11 <> 0 then p_partkey * 3 end as e, p_partkey % 13 <> 0 as has_activity, p_partkey % 5 <> 0 as good_day, p_partkey % 3 <> 0 as has_known,
  case when p_partkey % 7 = 0 then 'delete' when p_partkey % 7 < 3 then 'assess' when p_partkey % 7 = 3 then 'assess_bitemporal' when p_partkey % 7 = 4 then 'explain' when p_partkey % 7 = 5 then 'evidence' else 'changes' end as operation from part)
select k as request_id, operation, case when good_day then date '1998-06-01' end as valid_day, case when has_known then date '1999-12-31' end as known_day,
  case when operation = 'delete' then 'UNKNOWN_OPERATION'
    when operation in ('assess', 'assess_bitemporal', 'explain') then case when e is null or not has_activity then 'MISSING_ARGUMENT' when not good_day then 'INVALID_DATE'
      when operation <> 'assess' and not has_known then 'INVALID_DATE' when e not in (select c_custkey from customer) then 'UNKNOWN_ENTITY' else 'OK' end
    when operation = 'evidence' then case when k % 2 = 1 then 'MISSING_ARGUMENT' else 'OK' end
    else case when (k % 2 = 0) = (k % 3 = 0) then 'EXACTLY_ONE_SELECTOR' else 'OK' end end as error from r""",
    ),
    "explain_verdicts": (
        explain_verdicts,
        f"""with v as ({_VERDICT}), u as (select * exclude (used_ids), unnest(string_split(used_ids, ',')) as assertion_id from v where used_ids <> ''),
a as (select cast(assertion_id as varchar) as assertion_id, register_id, legal_effect, effective_from, effective_to, exclusive_end from ({L.SQL} select * from assertions))
select u.assertion_id, u.entity_id, u.activity, u.jurisdiction, u.asked_basis, u.valid_at, u.known_at, u.verdict, u.reason, a.register_id,
  case when effective_from > valid_at then 'UNKNOWN' when {_IN_EFFECT.format(at="valid_at")} then legal_effect when legal_effect = 'ENTITLED_TO_PROVIDE' then 'NOT_ENTITLED' else 'UNKNOWN' end as effect_at,
  case when effective_from > valid_at then 'NOT_YET_EFFECTIVE' when {_IN_EFFECT.format(at="valid_at")} then 'IN_EFFECT' when legal_effect = 'ENTITLED_TO_PROVIDE' then 'ENTITLEMENT_EXPIRED' else 'WINDOW_CLOSED' end as effect_reason
from u join a on u.assertion_id = a.assertion_id""",
    ),
    "evidence_lookup": (
        evidence_lookup,
        f"""{L.SQL} select assertion_id, register_id, min(retrieved_at) as first_seen, max(retrieved_at) as last_seen,
  count(distinct cast(retrieved_at as varchar) || coalesce(cast(source_as_of as varchar), '')) as n_sources from sources where assertion_id in (select assertion_id from assertions where blocked) group by all""",
    ),
    "run_cases": (
        run_cases,
        f"""with a as ({_assess_sql(True)}), b as ({_VERDICT}), m as (select a.verdict as expected, a.verdict = b.verdict as ok from a join b on {_SAME.format(a="a", b="b")})
select coalesce(expected, '*') as expected, count(*) as n_cases, count_if(ok) as n_match, count_if(not ok) as n_mismatch from m group by rollup(expected)""",
    ),
    "contract_faults": (
        contract_faults,
        """select 'REG' || r_regionkey as register_id, 'UNKNOWN_CLASS' as fault from region where r_regionkey = 1
union all select 'REG' || r_regionkey, 'NEGATIVE_OUTLASTS_POSITIVE' from region where r_regionkey = 2
union all select 'REG' || n_regionkey, 'UNKNOWN_RULE_BASIS' from nation where n_nationkey % 4 = 2""",
    ),
    "bitemporal_verdict": (bitemporal_verdict, _VERDICT),
    "verdict_simple": (verdict_simple, _assess_sql(False)),
    "verdict_with_facts": (verdict_with_facts, _assess_sql(True)),
    "evidence_audit": (
        evidence_audit,
        f"""{_PAIRS.rstrip()}, seen as (
  select {_Q}, 'a' as kind, bucket, cast(assertion_id as varchar) as id from pairs union all select {_Q}, 'f', bucket, cast(fact_id as varchar) from asked_facts
  union all select {_Q}, null, null, null from questions)
select {_Q}, {", ".join(f"coalesce(string_agg(id, ',' order by id) filter (where kind = '{k[0]}' and bucket = '{b}'), '') as {b}_{k}_ids" for k in ("assertion", "fact") for b in ("usable", "after_k", "untraceable"))},
  coalesce(string_agg('no_source_assertions:' || id, ',' order by id) filter (where bucket = 'untraceable'), '') as diagnostics
from seen group by {_Q}""",
    ),
    "assertion_evaluations": (
        assertion_evaluations,
        f"""{_PAIRS} select {_Q}, assertion_id, register_id, legal_effect,
  case when effective_from > valid_at then 'UNKNOWN' when {_IN_EFFECT.format(at="valid_at")} then legal_effect when legal_effect = 'ENTITLED_TO_PROVIDE' then 'NOT_ENTITLED' else 'UNKNOWN' end as effect_at,
  case when effective_from > valid_at then 'NOT_YET_EFFECTIVE' when {_IN_EFFECT.format(at="valid_at")} then 'IN_EFFECT' when legal_effect = 'ENTITLED_TO_PROVIDE' then 'ENTITLEMENT_EXPIRED' else 'WINDOW_CLOSED' end as reason
from pairs where bucket = 'usable'""",
    ),
    "visibility_partition": (visibility_partition, f"{_PAIRS} select valid_at, known_at, bucket, count(*) as n_rows from pairs group by all"),
    "admissibility_first_failure": (
        admissibility_first_failure,
        f"""{_PAIRS} select g.entity_id, g.assertion_id, g.valid_at, g.known_at, coalesce(diagnostic, 'ADMISSIBLE') as diagnostic, case when first_gate is null then f.cited end as failed_register
from gated g left join failed f on g.assertion_id = f.assertion_id and g.valid_at = f.valid_at and g.known_at = f.known_at""",
    ),
    "route_aggregate": (route_aggregate, f"{_ROUTES} select * from routes"),
    "route_conflict": (route_conflict, f"{_ROUTES} select {_Q}, scope, territorial_basis from routes where n_open > 0 and n_closed > 0"),
    "root_state_at": (root_state_at, f"{_PAIRS} select * from root_states"),
    "knowledge_time": (
        knowledge_time,
        f"{L.SQL} select assertion_id, max(retrieved_at) as knowledge_time, max(coalesce(source_as_of, retrieved_at)) as fresh_at, count(*) as n_sources from sources group by all",
    ),
    "register_freshness": (
        register_freshness,
        f"""{L.SQL} select assertion_id, row_number() over (partition by assertion_id order by register_id) - 1 as place, register_id as register, max(coalesce(source_as_of, retrieved_at)) as fresh
from sources group by assertion_id, register_id""",
    ),
    "effect_at_date": (
        effect_at_date,
        f"""{L.SQL.rstrip()}, e as (select assertion_id, legal_effect, case when effective_from > date '1998-06-01' then 'NOT_YET_EFFECTIVE'
  when {_IN_EFFECT.format(at="date '1998-06-01'")} then 'IN_EFFECT' when legal_effect = 'ENTITLED_TO_PROVIDE' then 'ENTITLEMENT_EXPIRED' else 'WINDOW_CLOSED' end as reason from assertions)
select assertion_id, case reason when 'IN_EFFECT' then legal_effect when 'ENTITLEMENT_EXPIRED' then 'NOT_ENTITLED' else 'UNKNOWN' end as effect, reason from e""",
    ),
    "window_inclusive_exclusive": (
        window_inclusive_exclusive,
        f"""{L.SQL} select assertion_id, {_IN_EFFECT.format(at="effective_to")} as on_end, {_IN_EFFECT.format(at="(effective_to + 1)")} as day_after,
  {_IN_EFFECT.format(at="(effective_from - 1)")} as day_before from assertions where effective_to is not null""",
    ),
    "staleness_gate": (
        staleness_gate,
        f"""{L.SQL.rstrip()}, k as (select assertion_id, max(coalesce(source_as_of, retrieved_at)) as fresh_at from sources group by all)
select assertion_id, coalesce((date '1998-06-01' - fresh_at) > case when legal_effect = 'NOT_ENTITLED' then negative_days else positive_days end, true) as stale
from k join assertions using (assertion_id) left join contracts using (register_id)""",
    ),
    "coverage_decision": (
        coverage_decision,
        f"""{_DECISIONS} select assertion_id, case when step <= 4 then 'OUT_OF_SCOPE' when step = 5 then 'IN_SCOPE' when step = 7 then 'NO_CONTRACT' else 'UNKNOWN' end as status,
  case step when 1 then 'RULE' || out_ord when 2 then 'contract-excluded-entity-classes' when 3 then 'contract-activities-coverage' when 4 then 'contract-jurisdiction-coverage' when 5 then 'RULE' || in_ord else '' end as scope_rule,
  case step when 1 then 'EXPLICIT_EXCLUSION' when 2 then 'EXCLUDED_ENTITY_CLASS' when 3 then 'ACTIVITY_NOT_COVERED_BY_REGISTER' when 4 then 'JURISDICTION_NOT_COVERED_BY_REGISTER' when 5 then 'COVERED_BY_RULE' when 7 then 'NO_CONTRACT' else 'NO_RULE_MATCHES' end as why
from decided""",
    ),
    "enumeration_negative_gate": (
        enumeration_negative_gate,
        f"""{_DECISIONS.rstrip()}, ids as (select distinct entity_id, identity_state from questions),
snapshots as (select register_id, 'RULE' || min(ordinal) as snapshot_rule from coverage_rules where scope = 'IN' and register_id <> 'REG4' group by all), g as (
select assertion_id, case when identity_state <> 'EXACT' then 'IDENTITY_NOT_EXACT' when step <= 4 then 'SCOPE_OUT_OF_SCOPE' when step = 6 then 'SCOPE_UNKNOWN' when step = 7 then 'SCOPE_NO_CONTRACT'
  when capability <> 'COMPLETE_ENUMERATION' then 'SOURCE_CAPABILITY_DOES_NOT_ALLOW_ENUMERATION_NEGATIVE' when snapshot_rule is null then 'MISSING_ENUMERATION_SNAPSHOT'
  when snapshot_rule <> 'RULE' || in_ord then 'COVERAGE_RULE_MISMATCH' else 'ENUMERATION_NEGATIVE_ALLOWED' end as gate
from decided d join ids i on d.entity_id = i.entity_id left join snapshots n on d.register_id = n.register_id)
select assertion_id, gate, gate = 'ENUMERATION_NEGATIVE_ALLOWED' as allowed from g""",
    ),
    "run_metrics": (
        run_metrics,
        f"""select coalesce(verdict, '*') as verdict, coalesce(reason, '*') as reason, count(*) as n_questions from ({_VERDICT}) group by rollup(verdict, reason)""",
    ),
    "response_freshness": (response_freshness, f"select {_Q}, response_freshness from ({_VERDICT}) where response_freshness is not null"),
}
