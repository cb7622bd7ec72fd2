"""Identity indexes and requests answered over the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import answers as A
from attestry.operators import identity as I
from attestry.plans import lens as L
from attestry.plans import register_queries as R
from attestry.plans import verdict_queries as VQ

SET_ID = "star@sha256:0"
_LEI_BODY = "'5493' || lpad(cast(c_custkey as string), 14, '0')"
_CHECK = f"lpad(cast(98 - cast(cast({_LEI_BODY} || '00' as decimal(20, 0)) % 97 as int) as string), 2, '0')"
_LEI = f"case c_custkey % 4 when 0 then {_LEI_BODY} || {_CHECK} when 1 then {_LEI_BODY} || '00' when 2 then '' end"


def identifiers(s: SparkSession, d: str) -> DataFrame:
    """What the register records and the customers' LEIs identify entities by, rejects included."""
    records = R.records(s, d).select("entity_id", "source", F.create_map(F.lit("entity_code"), F.col("entity_code")).alias("texts"))
    leis = L.table(s, d, "customer").selectExpr("c_custkey as entity_id", "'CUSTOMER' as source", f"map('lei', {_LEI}) as texts")
    return I.identifiers(records.unionByName(leis))


def identity_index(s: SparkSession, d: str) -> DataFrame:
    """Entities with the classes that assertions evidence and the identifiers that count."""
    counted = identifiers(s, d).where("diagnostic is null").groupBy("entity_id").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws("=", "kind", "value"))), ",").alias("identifiers"))
    found = I.index(L.entities(s, d), L.assertions(s, d)).join(counted, "entity_id", "left")
    return found.select("entity_id", "legal_name", F.array_join("entity_classes", ",").alias("entity_classes"), F.coalesce("identifiers", F.lit("")).alias("identifiers"))


def invalid_identifiers(s: SparkSession, d: str) -> DataFrame:
    return identifiers(s, d).where("diagnostic is not null")


_K = "p_partkey"
REQUEST = {
    "request_id": _K,
    "operation": f"case {_K} % 9 when 0 then 'delete' when 1 then 'assess' when 2 then 'assess' when 3 then 'assess_bitemporal' when 4 then 'explain' when 5 then 'explain' when 6 then 'evidence' when 7 then 'changes' else 'assess_bitemporal' end",
    "entity_id": f"case when {_K} % 5 = 0 then cast({_K} as string) when {_K} % 10 = 1 and {_K} % 9 = 6 then cast({_K} as string) end",
    "id_kind": f"case {_K} % 5 when 1 then 'BDE_REGISTRY_ID' when 2 then 'LEI' end",
    "id_value": f"case {_K} % 5 when 1 then case when {_K} % 10 = 1 then ' nl_dnb!f' || cast({_K} * 4 as string) else 'ES_BE!' || cast({_K} % 3 as string) end when 2 then '5493' || lpad(cast({_K} as string), 14, '0') || lpad(cast(98 - cast(cast('5493' || lpad(cast({_K} as string), 14, '0') || '00' as decimal(20, 0)) % 97 as int) as string), 2, '0') end",
    "name": f"case {_K} % 5 when 3 then ' customer#' || lpad(cast({_K} as string), 9, '0') end",
    "activity": f"case when {_K} % 23 = 0 then '' else case {_K} % 3 when 0 then 'PAYMENT_SERVICES' when 1 then 'MONEY_REMITTANCE' else 'E_MONEY_ISSUANCE' end end",
    "jurisdiction": f"'J' || cast({_K} % 2 as string)",
    "territorial_basis": f"case when {_K} % 4 = 0 then 'BRANCH' when {_K} % 4 = 1 then '' end",
    "valid_at": f"case when {_K} % 17 = 0 then '1998-6-01' else '1998-06-01' end",
    "known_at": f"case when {_K} % 7 = 0 then '99-12-31' when {_K} % 3 > 0 then '1999-12-31' end",
    "item_id": f"case when {_K} % 9 = 6 and {_K} % 5 > 0 then cast({_K} * 4 as string) when {_K} % 50 = 15 then '1' end",
    "record_key": f"case when {_K} % 2 = 0 then 'K' || cast({_K} % 40 as string) end", "pair": f"case when {_K} % 4 > 1 then 'P' || cast({_K} % 30 as string) end",
    "evidence_set_id": f"case when {_K} % 31 = 0 then 'other@sha256:1' when {_K} % 2 = 0 then '{SET_ID}' end",
}
#: Candidates of 25 compared pairs, one a supplier.
CANDIDATE = {"pair": "'P' || cast(s_suppkey % 25 as string)", "record_key": "'K' || cast(s_suppkey % 60 as string)", "candidate": "'C' || cast(s_suppkey as string)"}


def _evidence(s: SparkSession, d: str) -> A.Evidence:
    candidates = L.table(s, d, "supplier").selectExpr(*(f"{e} as {n}" for n, e in CANDIDATE.items()))
    return A.Evidence(SET_ID, L.entities(s, d), identifiers(s, d), L.assertions(s, d), L.sources(s, d), L.facts(s, d), L.contracts(s, d), L.coverage_rules(s, d), candidates, L.ALIASES)


def _requests(s: SparkSession, d: str) -> DataFrame:
    return L.table(s, d, "part").selectExpr(*(f"{e} as {n}" for n, e in REQUEST.items()))


def resolved_identities(s: SparkSession, d: str) -> DataFrame:
    asked = _requests(s, d).select(F.col("request_id").alias("question_id"), "entity_id", F.col("id_kind").alias("kind"), F.col("id_value").alias("value"), "name")
    return I.resolved(asked, I.index(L.entities(s, d), L.assertions(s, d)), identifiers(s, d))


def answered_requests(s: SparkSession, d: str) -> DataFrame:
    """Every request with its answer; nested parts as texts."""
    found = A.answered(_requests(s, d), _evidence(s, d))
    joined = lambda c, of: F.array_join(F.transform(c, of), ",")
    return found.select(
        "request_id", "operation", "error", "message", "entity_id", "identity_state", "verdict", "reason", "used_ids", "response_freshness", "diagnostics",
        joined("evaluations", lambda e: F.concat_ws(":", e["assertion_id"], e["register_id"], e["legal_effect"], e["effect_at"], e["effect_reason"])).alias("evaluations"),
        F.when(F.col("audit").isNotNull(), F.concat_ws(";", *(F.col(f"audit.{c}") for c in A.AUDIT))).alias("audit"),
        joined("items", lambda i: F.concat_ws("|", i["kind"], i["id"], i["entity_id"], i["says"], F.array_join(i["sources"], "+"))).alias("items"),
        joined("candidates", lambda c: F.concat_ws(":", c["pair"], c["record_key"], c["candidate"])).alias("candidates"), "n_candidates",
    )


# SQL

_IDENTIFIERS = (
    R._RECORDS + f""",
leis as (select c_custkey as entity_id, {_LEI} as lei from customer),
idents as (
  select entity_id, 'BDE_REGISTRY_ID' as kind, entity_code as value, null::varchar as diagnostic from rec where source = 'EBA_PSD2_REGISTER' and entity_code <> ''
  union all select entity_id, 'LEI', lei, case when entity_id % 4 = 0 or {_CHECK.replace("c_custkey", "entity_id")} = '00' then null else 'INVALID_CHECK_DIGITS' end from leis where lei <> '')"""
)
_CLASSES = "classes as (select o_custkey as entity_id, list_sort(list_distinct(list(case when o_custkey % 11 = 0 and o_orderkey % 3 > 0 then 'PSP_AGENT' when o_custkey % 11 = 1 then 'BANK' else 'PAYMENT_INSTITUTION' end))) as classes from orders group by all)"
_RESOLVED = (
    _IDENTIFIERS + ",\n" + _CLASSES + ",\nreq as (select " + ", ".join(f"{e} as {n}" for n, e in REQUEST.items()) + " from part)" + r""",
keys as (
  select 'I' as form, kind || '|' || upper(trim(value)) as key, entity_id from idents where diagnostic is null
  union all select 'N', upper(trim(regexp_replace(c_name, '\s+', ' ', 'g'))), c_custkey from customer
  union all select 'E', c_custkey::varchar, c_custkey from customer),
resolved as (
  select request_id, form, count(distinct k.entity_id) as n, min(k.entity_id) as e
  from (select request_id, case when trim(entity_id) <> '' then 'E' when trim(id_value) <> '' then 'I' when trim(name) <> '' then 'N' end as form,
      case when trim(entity_id) <> '' then trim(entity_id) when trim(id_value) <> '' then id_kind || '|' || upper(trim(id_value)) else upper(trim(name)) end as key from req) q
    left join keys k using (form, key) group by all),
ident as (
  select request_id, case when form is null or n = 0 then 'NOT_FOUND' when form = 'N' then 'AMBIGUOUS' when n = 1 then 'EXACT' else 'CONFLICTING_IDENTIFIERS' end as identity_state,
    case when form is null then 'NO_SELECTOR' when form = 'E' then case when n = 0 then 'UNKNOWN_ENTITY_ID' else 'ENTITY_ID_PROVIDED' end
      when form = 'I' then case n when 0 then 'NO_IDENTIFIER_MATCH' when 1 then 'IDENTIFIER_UNIQUE' else 'IDENTIFIER_MAPS_TO_MULTIPLE_ENTITIES' end
      else case n when 0 then 'NO_NAME_MATCH' when 1 then 'SINGLE_CANDIDATE_NAME_MATCH' else 'MULTIPLE_NAME_CANDIDATES' end end as identity_reason,
    case when form in ('E', 'I') and n = 1 then e end as entity_id
  from resolved)"""
)
_CHECKED = (
    _RESOLVED + f""",
tested as (
  select *, operation in ('assess', 'assess_bitemporal', 'explain') as asks, try_strptime(nullif(case when length(valid_at) = 10 then valid_at end, ''), '%Y-%m-%d')::date as valid_day,
    try_strptime(nullif(case when length(known_at) = 10 then known_at end, ''), '%Y-%m-%d')::date as known_date from req),
chk as (
  select t.*, case when operation = 'delete' then 1 when asks and coalesce(t.entity_id, '') = '' and coalesce(id_value, '') = '' and coalesce(name, '') = '' then 2 when asks and coalesce(activity, '') = '' then 3
      when asks and valid_day is null then 4 when operation = 'assess_bitemporal' and known_date is null or operation = 'explain' and known_at <> '' and known_date is null then 5
      when operation = 'evidence' and (coalesce(item_id, '') <> '') = (coalesce(t.entity_id, '') <> '') then 6 when operation <> 'changes' and evidence_set_id <> '{SET_ID}' then 7 end as fault,
    case when operation in ('assess_bitemporal', 'explain') then known_date end as used_known from tested t),
asked_q as (
  select c.request_id, c.operation, i.entity_id, c.activity, c.jurisdiction, nullif(c.territorial_basis, '') as asked_basis, c.valid_day as valid_at, coalesce(c.used_known, date '9999-12-31') as known_at, c.used_known is not null as dated,
    i.identity_state, i.identity_reason, coalesce(k.classes, []) as entity_classes
  from chk c join ident i using (request_id) left join classes k on k.entity_id = i.entity_id where c.asks and c.fault is null)"""
)


def _asking(sql: str) -> str:
    """SQL of the lens with the requests' exact questions in place of its own."""
    at = L.SQL.index("questions as (")
    own = L.SQL[at:].rstrip()
    mine = f"questions as (select distinct entity_id, activity, jurisdiction, asked_basis, valid_at, known_at, entity_classes, identity_state from ({_CHECKED} select * from asked_q where identity_state = 'EXACT'))"
    return sql.replace(own, mine)


_AUDIT = VQ.QUERIES["evidence_audit"][1]
_SAID = VQ.QUERIES["assertion_evaluations"][1]
_MESSAGES = {
    1: "operation is none of the five", 2: "an entity, identifier or name is needed", 3: "activity and jurisdiction are needed", 4: "valid_at is no date written yyyy-MM-dd",
    5: "known_at is no date written yyyy-MM-dd", 6: "exactly one of item_id and entity_id is needed", 7: "the evidence set is another one",
}
_SAME = VQ._SAME.format(a="x", b="q")
_ANSWERED = (
    _CHECKED.replace("with recursive base", "with recursive base", 1) + f""",
v as ({_asking(VQ._VERDICT)}), said as ({_asking(_SAID)}), aud as ({_asking(_AUDIT)}),
ev as (select q.request_id, string_agg(concat_ws(':', x.assertion_id, x.register_id, x.legal_effect, x.effect_at, x.reason), ',' order by x.assertion_id::varchar) as evaluations
  from asked_q q join said x on {_SAME} where q.operation = 'explain' and q.identity_state = 'EXACT' group by 1),
lens_a as ({L.SQL.rstrip()} select a.*, c.sources from assertions a left join (select assertion_id, string_agg(distinct register_id, '+' order by register_id) as sources from sources group by 1) c using (assertion_id)),
lens_f as ({L.SQL.rstrip()} select * from facts),
items as (
  select 'assertion' as kind, assertion_id::varchar as id, entity_id::varchar as entity_id, concat_ws('|', 'assertion', assertion_id, entity_id, concat_ws(' ', legal_effect, activity, territorial_basis), sources) as item from lens_a
  union all select 'reported_fact', fact_id::varchar, entity_id::varchar, concat_ws('|', 'reported_fact', fact_id, entity_id, concat_ws(' ', reported_status, rule_id), register_id) from lens_f),
evid as (
  select c.request_id, c.item_id, case when c.item_id <> '' then (select min(item) from items i where i.id = c.item_id and i.kind = (select min(kind) from items j where j.id = c.item_id))
    else coalesce((select string_agg(item, ',' order by kind, id) from items i where i.entity_id = c.entity_id), '') end as items
  from chk c where operation = 'evidence' and fault is null),
cand as (select {", ".join(f"{e} as {n}" for n, e in CANDIDATE.items())} from supplier),
chg as (
  select c.request_id, c.pair, c.record_key, c.pair <> '' and not exists (select 1 from cand d where d.pair = c.pair) as missing,
    (select coalesce(string_agg(concat_ws(':', d.pair, d.record_key, d.candidate), ',' order by d.pair, d.record_key, d.candidate), '') from cand d where (c.pair is null or d.pair = c.pair) and (c.record_key is null or d.record_key = c.record_key)) as candidates,
    (select count(*) from cand d where (c.pair is null or d.pair = c.pair) and (c.record_key is null or d.record_key = c.record_key)) as n
  from chk c where operation = 'changes' and fault is null)
select c.request_id, c.operation,
  case when fault = 7 then 'unknown_evidence_set' when fault is not null then 'invalid_input' when e.item_id <> '' and e.items is null then 'not_found' when g.missing then 'not_found' end as error,
  case fault {" ".join(f"when {k} then '{m}'" for k, m in _MESSAGES.items())} else case when e.item_id <> '' and e.items is null then 'no item ' || e.item_id when g.missing then 'no pair ' || g.pair end end as message,
  q.entity_id, q.identity_state,
  case when q.identity_state <> 'EXACT' then 'INDETERMINATE' else x.verdict end as verdict,
  case q.identity_state when 'AMBIGUOUS' then 'AMBIGUOUS_IDENTITY' when 'NOT_FOUND' then 'IDENTITY_NOT_FOUND' when 'CONFLICTING_IDENTIFIERS' then 'CONFLICTING_IDENTIFIERS' else x.reason end as reason,
  case when q.identity_state <> 'EXACT' then '' else x.used_ids end as used_ids, x.response_freshness,
  case when q.identity_state <> 'EXACT' then 'identity:' || q.identity_reason else x.diagnostics end as diagnostics, ev.evaluations,
  case when q.dated and q.identity_state = 'EXACT' then concat_ws(';', {", ".join(f"u.{c}" for c in A.AUDIT)}) end as audit, e.items,
  case when g.missing or (g.pair is null and g.record_key is null) then null else g.candidates end as candidates, case when not coalesce(g.missing, false) then g.n end as n_candidates
from chk c left join asked_q q on q.request_id = c.request_id left join v x on q.identity_state = 'EXACT' and {_SAME} left join aud u on q.identity_state = 'EXACT' and q.dated and {VQ._SAME.format(a="u", b="q")}
  left join ev on ev.request_id = c.request_id left join evid e on e.request_id = c.request_id left join chg g on g.request_id = c.request_id
"""
)

QUERIES = {
    "identity_index": (
        identity_index,
        f"""{_IDENTIFIERS}, {_CLASSES}, counted as (select entity_id, string_agg(distinct kind || '=' || value, ',' order by kind || '=' || value) as identifiers from idents where diagnostic is null group by 1)
select c_custkey as entity_id, c_name as legal_name, coalesce(array_to_string(classes, ','), '') as entity_classes, coalesce(identifiers, '') as identifiers
from customer left join classes on classes.entity_id = c_custkey left join counted on counted.entity_id = c_custkey""",
    ),
    "invalid_identifiers": (invalid_identifiers, f"{_IDENTIFIERS} select * from idents where diagnostic is not null"),
    "resolved_identities": (resolved_identities, f"{_RESOLVED} select request_id as question_id, identity_state, identity_reason, entity_id from ident"),
    "answered_requests": (answered_requests, _ANSWERED),
}
