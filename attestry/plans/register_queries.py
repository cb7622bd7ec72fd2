"""Register records of the star tables, what is derived from them, and the rules run over them.

``BASE`` and ``RECORD`` are one text for Spark and for SQL; each order is one record of a register.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import registers as G
from attestry.operators import rulefile
from attestry.operators.tables import cuts, kept
from attestry.plans import payment_rules
from attestry.plans.lens import table

EVIDENCE_AS_OF = "2001-06-30"
_DAY = "substr(cast(o_orderdate as string), 1, 10)"
BASE = {
    "k": "o_orderkey", "c": "o_custkey", "d": _DAY,
    "h1": "(o_orderkey * 7919 + o_custkey * 104729) % 10007", "h2": "(o_orderkey * 15485863 + o_custkey) % 10009", "h3": "(o_orderkey * 32452843 + 7 * o_custkey) % 9973",
}


def _later(years: int) -> str:
    return f"cast(cast(substr(d, 1, 4) as int) + {years} as string) || substr(d, 5, 6)"


def _spanish(day: str) -> str:
    return f"substr({day}, 9, 2) || '/' || substr({day}, 6, 2) || '/' || substr({day}, 1, 4)"


def _codes(codes: tuple[str, ...], of: str) -> str:
    """Codes that the bits of a number choose, each with a bar behind it."""
    return " || ".join(f"case when ({of} % {97 + 6 * k}) % 3 = 0 then '{c}|' else '' end" for k, c in enumerate(codes))


SOURCE = f"case when h1 % 10 < 4 then '{G.EBA}' when h1 % 10 < 6 then '{G.PAYMENTS}' when h1 % 10 = 6 then '{G.ESTABLISHED}' when h1 % 10 = 7 then '{G.CRYPTO}' when h1 % 10 = 8 then '{G.CATEGORY}' when h2 % 2 = 0 then '{G.HOME_SOURCES[0]}' else '{G.HOME_SOURCES[1]}' end"
_EU, _NAT = "h1 % 10 < 4", "h1 % 10 in (4, 5, 6)"
_TYPE = "case h2 % 6 when 0 then 'PSD_PI' when 1 then 'PSD_EMI' when 2 then 'PSD_AISP' when 3 then 'PSD_AG' else 'PSD_BR' end"
_CODE = f"case when h3 % 17 = 0 then null when h3 % 5 < 3 then case when h3 % 4 = 0 then {_TYPE} || '!' else '' end || 'ES_BE!' || cast(h3 % 3 as string) else 'NL_DNB!F' || cast(k as string) end"
RECORD = {
    "group_ord": "k", "entity_id": "c", "source": SOURCE, "register_id": "'REG' || cast(h1 % 10 as string)",
    "entity_type": f"case when {_EU} then {_TYPE} end", "entity_code": f"case when {_EU} then {_CODE} end", "country": f"case when {_EU} then case h3 % 2 when 0 then 'ES' else 'NL' end end",
    "ent_aut_text": f"case when {_EU} then case h1 % 7 when 0 then '' when 1 then d when 2 then d || '|' || {_later(1)} when 3 then d || '|' || {_later(1)} || '|' || {_later(2)} when 4 then d || '|' || {_later(2)} else d end end",
    "services_text": f"case when {_EU} and h3 % 9 > 0 then {_codes((*payment_rules.EU_CODES, payment_rules.EU_E_MONEY), 'h2')} end",
    "der_chi_ent_aut": f"case when {_EU} then case h3 % 6 when 0 then '' when 1 then 'Removed' when 2 then 'Other' else 'Active' end end",
    "parent_type": f"case when {_EU} and h2 % 6 > 2 then case when h3 % 11 = 0 then '' when h3 % 3 = 0 then 'PSD_PI' else 'PSD_EMI' end end",
    "parent_code": f"case when {_EU} and h2 % 6 > 2 then case when h3 % 13 = 0 then 'XX_NO!1' when h3 % 4 = 0 then 'PSD_PI!ES_BE!' || cast(h2 % 3 as string) else 'ES_BE!' || cast(h2 % 3 as string) end end",
    "codigo_be": f"case when {_NAT} and h3 % 19 > 0 then cast(h3 % 3 as string) end",
    "tipo_entidad": f"case when {_NAT} then case h2 % 6 when 0 then 'Entidad de pago' when 1 then 'Entidad de dinero electrónico' when 2 then 'Sucursal de entidad de pago' when 3 then 'Servicios de información sobre cuentas' when 4 then 'Entidad de pago' else 'Otra' end end",
    "codigo_tipo_entidad": f"case when {_NAT} then case when h1 % 10 = 6 then case h2 % 2 when 0 then 'TESEPC' else 'TESEDC' end else case h2 % 5 when 0 then 'TEEP' when 1 then 'TEEFEP' when 2 then 'TEEFPH' when 3 then 'TEPSIC' else 'TEEDE' end end end",
    "pais_origen": f"case when {_NAT} then case h3 % 4 when 0 then 'NL' when 1 then null else 'ES' end end",
    "fecha_alta": f"case when {_NAT} then case when h3 % 23 = 0 then 'soon' when h3 % 7 = 0 then '' when h3 % 2 = 0 then '01/02/1995' else {_spanish('d')} end end",
    "fecha_baja": f"case when {_NAT} then case when h2 % 7 < 2 then substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || cast(cast(substr(d, 1, 4) as int) + 3 as string) else '' end end",
    "motivo_baja": f"case when {_NAT} and h2 % 7 < 2 then case h3 % 4 when 0 then 'Transformación' when 1 then 'Renuncia' when 2 then 'Revocación CE 3' end end",
    "actividades_text": f"case when {_NAT} and h3 % 8 > 0 then {_codes((*payment_rules.NATIONAL_CODES, 'A', '5', '3.1'), 'h1')} end",
    "cnmv_category": "case when h1 % 10 = 8 then case h3 % 6 when 0 then 'PSC - Limited LP' when 1 then 'Sucursal de PSC' when 2 then 'PSC en régimen de LP' when 3 then 'PSC (España)' when 4 then ' ' else 'Otra' end end",
    "services_from": f"case when h1 % 10 = 8 then case h2 % 3 when 0 then '01/02/1995' else {_spanish('d')} end end",
    "service_countries": "case when h1 % 10 = 7 and h3 % 10 > 0 then case h3 % 3 when 0 then 'DE|ES| FR' when 1 then 'NL|IT' else 'ES' end end",
    "home_member_state": "case when h1 % 10 = 7 then case h2 % 2 when 0 then 'ES' else 'NL' end end",
    "service_codes": "case when h1 % 10 = 7 then case h2 % 4 when 0 then 'a. custody; c. exchange' when 1 then 'providing e. orders' when 2 then 'none' end end",
    "authorisation_notification_date": "case when h1 % 10 = 7 then case h2 % 4 when 0 then '01/02/1995' when 1 then 'n/a' else '02/02/1995' end end",
    "authorisation_end_date": "case when h1 % 10 = 7 then case h3 % 4 when 0 then '01/01/2000' when 1 then ' ' end end",
    "mica_home_route": "case when h1 % 10 = 9 then case h3 % 4 when 0 then 'ART_59_1A' when 1 then 'ART_59_1B' end end",
    "home_mechanism_remark": "case when h1 % 10 = 9 then case h3 % 5 when 0 then 'ART_60_3' end end",
    "home_entity_class_de": "case when h1 % 10 = 9 then case h2 % 3 when 0 then 'Wertpapierinstitut' when 1 then 'Kreditinstitut' end end",
    "home_licences": "case when h1 % 10 = 9 and h3 % 7 = 0 then 'Investment firm' end",
}
DERIVED = (
    "eba_ent_aut_status", "eba_ent_aut_last_auth", "eba_ent_aut_last_withdrawal", "eba_child_status", "eba_home_nca", "eba_parent_status", "eba_parent_entity_type", "eba_parent_class_label", "eba_parent_nca",
    "eba_parent_last_auth", "bde_baja_kind", "fecha_alta_iso", "fecha_baja_iso", "bde_entity_fecha_baja", "bde_entity_baja_kind", "bde_branch_date_conflict", "bde_branch_fecha_alta", "bde_branch_codigo",
    "bde_branch_registered", "cnmv_territorial_route", "mica_es_declared", "mica_service_letters", "mica_foreign_countries", "mica_dates_agree", "mica_status", "mica_home_mechanism",
    "mica_home_mechanism_conflict", "mica_home_legal_ref", "mica_home_entity_class", "root_key", "root_home_jurisdiction",
)
TEXTS = [c for c in RECORD if c not in ("group_ord", "entity_id", "source", "register_id", "ent_aut_text", "services_text", "actividades_text")]


def records(s: SparkSession, d: str) -> DataFrame:
    return _read(table(s, d, "orders"))


def _read(orders: DataFrame, *more: str) -> DataFrame:
    raw = orders.selectExpr(*(f"{e} as {n}" for n, e in BASE.items()), *more).selectExpr(*(f"{e} as {n}" for n, e in RECORD.items()), *more)
    listed = lambda c: F.when(F.col(c).isNotNull(), F.filter(F.split(c, r"\|"), lambda x: x != ""))
    services = listed("services_text")
    return raw.withColumns(
        {"ent_aut": listed("ent_aut_text"), "eba_es_services": F.when(F.size(services) > 0, services), "actividades_codes": listed("actividades_text")}
    ).drop("ent_aut_text", "services_text", "actividades_text")


def _derived(s: SparkSession, d: str) -> DataFrame:
    """``records`` with derived fields; what goes through the exchange is three columns of ``orders``."""
    stored = _stored(s, d)
    return G.derived(records(s, d), stored, lambda rows: _read(rows.withColumnsRenamed(_KEYS), "o_orderdate", "_p"))


_KEYS = {"group_ord": "o_orderkey", "entity_id": "o_custkey"}


def _stored(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.col("o_orderkey").alias("group_ord"), F.col("o_custkey").alias("entity_id"), "o_orderdate")


def register_derivation(s: SparkSession, d: str) -> DataFrame:
    """Every register record with what its entity's other records and its parent say of it."""
    return _derived(s, d).select("group_ord", *DERIVED, F.array_join(F.transform("corroborating", lambda x: x.cast("string")), ",").alias("corroborating"))


def root_key_cases(s: SparkSession, d: str) -> DataFrame:
    """How many records have a root of their own, a parent's, or an inherited one, by source and family."""
    found = G.with_roots(records(s, d))
    return found.groupBy("source", F.substring_index("root_key", "|", 2).alias("root_kind"), "root_home_jurisdiction").agg(F.count("*").alias("n"), F.countDistinct("root_key").alias("roots"))


@cache
def rule_set() -> rulefile.RuleSet:
    return rulefile.load(payment_rules.text())


JOINED, LISTS = "eba_es_services_str", ("eba_es_services", "actividades_codes", "ent_aut")


def _fielded(found: DataFrame) -> DataFrame:
    return found.withColumn(JOINED, F.array_join("eba_es_services", "|"))


def _grouped(found: DataFrame) -> DataFrame:
    """Records as claim groups: the fields that the rules read in maps, a claim for each record and those that corroborate it."""
    named = rulefile.fields(rule_set())
    maps = G.packed(found, [c for c in (*TEXTS, JOINED, *DERIVED) if c in named], [c for c in LISTS if c in named])
    cited = F.transform(F.concat(F.array("group_ord"), "corroborating"), lambda x: F.concat(F.lit("claim-"), x.cast("string")))
    return found.select("group_ord", "entity_id", "source", "register_id", *maps, cited.alias("claim_ids"), F.array(F.struct("source", "register_id")).alias("source_assertions"))


def groups(s: SparkSession, d: str) -> DataFrame:
    return _grouped(_fielded(_derived(s, d)))


def _sent(s: SparkSession, d: str, kind: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], list[int]]:
    """Records for which a rule of a kind fires, what makes groups of them, and cuts of their order."""
    found = rulefile.fired_by(_fielded(_derived(s, d)), {*TEXTS, JOINED, *DERIVED}, set(LISTS), rule_set(), kind)
    told = [c for c in (*DERIVED, "corroborating") if c in {"corroborating", *rulefile.fields(rule_set())} and c not in G.OWN_STATE]  # all else is made again of the stored columns
    read = lambda rows: _grouped(_fielded(G.with_own_state(_read(rows.withColumnsRenamed(_KEYS), *told))))
    return found.select(*_KEYS, "o_orderdate", *told), read, cuts(_stored(s, d), "group_ord")


SHOWN = (
    "register_id", "entity_id", "entity_class", "activity", "jurisdiction", "legal_effect", "entry_mechanism", "territorial_basis", "legal_basis", "effective_from", "effective_to", "scope", "rule_id", "evidence_basis",
    "evidence_composition", "negative_scope", "negative_evidence_class", "source_granularity", "interval_end", "admissibility", "blocker", "coverage_policy_id", "raw_capability_code", "root_key", "root_home_jurisdiction",
)


def _outcomes(s: SparkSession, d: str) -> DataFrame:
    return rulefile.outcomes(groups(s, d), rule_set(), EVIDENCE_AS_OF)


def ruleset_assertions(s: SparkSession, d: str) -> DataFrame:
    """Assertions of the rule set's both passes, numbered in the order of emission."""
    sent, read, at = _sent(s, d, "ASSERTION")
    every = rulefile.numbered_assertions(sent, read, rule_set(), EVIDENCE_AS_OF, "DERIVATION_1", at, "assertion_id", "a-asm")
    return every.select("assertion_id", *SHOWN, "ruleset_version", "derived_by", F.array_join("source_claim_ids", ",").alias("claims"))


def ruleset_facts(s: SparkSession, d: str) -> DataFrame:
    columns = [c for c in rulefile.FACT if c not in ("status_intervals", "source_claim_ids", "source_assertions")]
    cited = [F.array_join("status_intervals", "|").alias("intervals"), F.array_join("source_claim_ids", ",").alias("claims")]
    sent, read, at = _sent(s, d, "FACT")
    return rulefile.numbered_facts(sent, read, rule_set(), EVIDENCE_AS_OF, at, "fact_id", "a-fact").select("fact_id", *columns, *cited)


def ruleset_findings(s: SparkSession, d: str) -> DataFrame:
    found = kept(_outcomes(s, d))
    every = rulefile.assertions(found, rule_set(), "DERIVATION_1")
    return rulefile.numbered(rulefile.findings(found, every, rule_set()), "finding_id", "a-fnd")


def ruleset_header(s: SparkSession, d: str) -> DataFrame:
    """Versions and counts of the artefact; its digests are tested apart."""
    g = groups(s, d)
    found = rulefile.outcomes(g, rule_set(), EVIDENCE_AS_OF)
    return rulefile.header(g, found, rule_set(), "ARTIFACT_1", "DERIVATION_1", pinned=False).drop("claims_sha256", "ruleset_sha256")


# SQL: written against the meaning, by joins and windows instead of maps and folded groupings

_RECORDS = (
    "with recursive base as (select " + ", ".join(f"{e} as {n}" for n, e in BASE.items()) + " from orders),\nraw as (select " + ", ".join(f"{e} as {n}" for n, e in RECORD.items()) + " from base),\n"
    "rec as (select *, case when ent_aut_text is not null then list_filter(string_split(ent_aut_text, '|'), lambda x: x <> '') end as ent_aut,"
    " case when trim(services_text, '|') <> '' then list_filter(string_split(services_text, '|'), lambda x: x <> '') end as eba_es_services,"
    " case when actividades_text is not null then list_filter(string_split(actividades_text, '|'), lambda x: x <> '') end as actividades_codes from raw)"
)
_CORE = "case when {c} <> '' then case when starts_with({c}, {t} || '!') then substr({c}, length({t}) + 2) else {c} end end"
_NCA = "case when contains({c}, '!') then split_part({c}, '!', case when starts_with({c}, 'PSD_') then 2 else 1 end) end"
_KIND = "case when fecha_baja <> '' then case when regexp_matches(lower(coalesce(motivo_baja, '')), 'transformaci|escisi|fusi') then 'TRANSFORMATION' when regexp_matches(lower(coalesce(motivo_baja, '')), 'renuncia|revocac|ce ') then 'WITHDRAWAL' else 'UNRESOLVED_MOTIVO' end end"
_ROUTE = "case when trim({c}) = '' then null when contains(upper({c}), 'LIMITED') then 'LIMITED_LP' when contains(upper({c}), 'SUCURSAL') then 'BRANCH' when contains(upper({c}), 'RÉGIMEN DE LP') then 'LP' when upper({c}) = 'PSC (ESPAÑA)' then 'DOMESTIC' when {c} is not null then 'OTHER' end"
_SPANISH = "try_strptime({c}, '%d/%m/%Y')::date"
_NATIONAL = f"source in ('{G.PAYMENTS}', '{G.ESTABLISHED}')"
_HOME = f"source in ('{G.HOME_SOURCES[0]}', '{G.HOME_SOURCES[1]}')"
_STATED = f"case when contains(coalesce(home_entity_class_de, ''), 'Wertpapierinstitut') or contains(coalesce(home_licences, ''), 'Investment firm') then '{G.INVESTMENT}' when contains(home_entity_class_de, 'Kreditinstitut') then '{G.CREDIT}' end"
_DERIVED = _RECORDS + f""",
own as (
  select *, case when source = '{G.EBA}' then case when coalesce(len(ent_aut), 0) = 0 then 'UNKNOWN' when len(ent_aut) % 2 = 1 then 'ACTIVE' else 'WITHDRAWN' end end as eba_ent_aut_status,
    case when len(ent_aut) % 2 = 1 then ent_aut[-1] when len(ent_aut) > 0 then ent_aut[-2] end as eba_ent_aut_last_auth,
    case when len(ent_aut) > 1 then case when len(ent_aut) % 2 = 1 then ent_aut[-2] else ent_aut[-1] end end as eba_ent_aut_last_withdrawal,
    case when der_chi_ent_aut = 'Active' then 'ACTIVE' when der_chi_ent_aut in ('Removed', 'Withdrawn') then 'WITHDRAWN' when der_chi_ent_aut <> '' then 'UNKNOWN' end as eba_child_status,
    {_NCA.format(c="entity_code")} as eba_home_nca, {_KIND} as kind,
    case when entity_type in ('PSD_BR', 'PSD_AG') then nullif(parent_type, '') else nullif(entity_type, '') end as root_type,
    case when entity_type in ('PSD_BR', 'PSD_AG') then {_CORE.format(c="parent_code", t="parent_type")} else {_CORE.format(c="entity_code", t="entity_type")} end as root_code,
    {_CORE.format(c="entity_code", t="entity_type")} as core,
    case when contains(lower(tipo_entidad), 'sucursal') then 'BRANCH' when contains(lower(tipo_entidad), 'dinero electr') then 'PSD_EMI'
      when regexp_matches(lower(tipo_entidad), 'informaci|cuentas') then 'PSD_AISP' when contains(lower(tipo_entidad), 'pago') then 'PSD_PI' end as family
  from rec),
eba as (
  select *, 'EBA|' || root_type || '|' || root_code as own_root, case when root_type || root_code is not null then regexp_extract(root_code, '(^|!)([A-Za-z]{{2}})_', 2) end as own_home from own where source = '{G.EBA}'),
par as (select * from eba where entity_code is not null qualify row_number() over (partition by entity_type, entity_code order by group_ord desc) = 1),
nat as (select * from own where {_NATIONAL}),
nat_all as (
  select entity_id, count(distinct nullif(fecha_alta, '')) as altas, count(*) filter (fecha_baja <> '') as bajas, string_agg(group_ord::varchar, ',' order by group_ord) as ids from nat group by entity_id),
nat_first as (select * from nat qualify row_number() over (partition by entity_id order by group_ord) = 1),
pay_first as (select * from nat where source = '{G.PAYMENTS}' qualify row_number() over (partition by entity_id order by group_ord) = 1),
cat as (select * from own where source = '{G.CATEGORY}' qualify row_number() over (partition by entity_id order by group_ord desc) = 1),
hom as (
  select entity_id, coalesce(bool_or(mica_home_route = 'ART_59_1A'), false) as auth, coalesce(bool_or(mica_home_route = 'ART_59_1B' or home_mechanism_remark = 'ART_60_3'), false) as note,
    coalesce(bool_or(home_mechanism_remark = 'ART_60_3'), false) as remark, arg_max({_STATED}, group_ord) filter ({_STATED} is not null) as stated, string_agg(group_ord::varchar, ',' order by group_ord) as ids
  from own where {_HOME} group by entity_id),
cand as (
  select entity_id, case when entity_type = 'PSD_BR' then 'BRANCH' else entity_type || '|' || core end as want, count(*) as n, max(own_root) as root, max(own_home) as home
  from eba where entity_type <> 'PSD_AG' and (entity_type <> 'PSD_BR' or own_root is not null) group by all),
der as (
  select o.*, e.own_root, e.own_home,
    case when o.parent_type <> '' and o.parent_code <> '' then coalesce(p.eba_ent_aut_status, 'UNKNOWN') end as eba_parent_status, p.entity_type as eba_parent_entity_type,
    case p.entity_type when 'PSD_PI' then 'PI' when 'PSD_EMI' then 'EMI' end as eba_parent_class_label, case when p.group_ord is not null then {_NCA.format(c="o.parent_code")} end as eba_parent_nca,
    p.eba_ent_aut_last_auth as eba_parent_last_auth, p.group_ord as parent_ord,
    case when {_NATIONAL.replace("source", "o.source")} then o.kind end as bde_baja_kind, {_SPANISH.format(c="o.fecha_alta")} as fecha_alta_iso, {_SPANISH.format(c="o.fecha_baja")} as fecha_baja_iso,
    case when o.source = '{G.EBA}' then y.fecha_baja end as bde_entity_fecha_baja, case when o.source = '{G.EBA}' then y.kind end as bde_entity_baja_kind,
    case when o.entity_type = 'PSD_BR' and a.altas > 1 then 'TRUE' end as bde_branch_date_conflict, case when o.entity_type = 'PSD_BR' and a.altas <= 1 then f.fecha_alta end as bde_branch_fecha_alta,
    case when o.entity_type = 'PSD_BR' then f.codigo_be end as bde_branch_codigo, case when o.entity_type = 'PSD_BR' and a.entity_id is not null then case when a.altas > 0 and a.bajas = 0 then 'TRUE' else 'FALSE' end end as bde_branch_registered,
    case o.source when '{G.CRYPTO}' then {_ROUTE.format(c="c.cnmv_category")} when '{G.CATEGORY}' then {_ROUTE.format(c="o.cnmv_category")} end as cnmv_territorial_route,
    case when o.service_countries is not null then case when list_contains(list_transform(string_split(o.service_countries, '|'), lambda x: trim(x)), 'ES') then 'TRUE' else 'FALSE' end end as mica_es_declared,
    nullif(concat_ws('|', case when regexp_matches(o.service_codes, '(^|[^A-Za-z])a\\.') then 'a' end, case when regexp_matches(o.service_codes, '(^|[^A-Za-z])c\\.') then 'c' end, case when regexp_matches(o.service_codes, '(^|[^A-Za-z])e\\.') then 'e' end), '') as mica_service_letters,
    nullif(array_to_string(list_filter(list_transform(string_split(o.service_countries, '|'), lambda x: trim(x)), lambda x: x <> '' and x <> o.home_member_state), '|'), '') as mica_foreign_countries,
    case when o.source = '{G.CRYPTO}' then case when {_SPANISH.format(c="o.authorisation_notification_date")} = {_SPANISH.format(c="c.services_from")} then 'TRUE' when {_SPANISH.format(c="o.authorisation_notification_date")} is not null and {_SPANISH.format(c="c.services_from")} is not null then 'FALSE' end end as mica_dates_agree,
    case when o.source = '{G.CRYPTO}' then case when trim(o.authorisation_end_date) <> '' then 'ENDED' else 'ACTIVE' end end as mica_status,
    case when o.source = '{G.CRYPTO}' then case when m.auth and not m.note then 'AUTHORISATION' when m.note and not m.auth then 'NOTIFICATION' end end as mica_home_mechanism,
    case when o.source = '{G.CRYPTO}' and m.auth and m.note then 'TRUE' end as mica_home_mechanism_conflict, m.remark, m.stated,
    concat_ws(',', p.group_ord::varchar, case when o.entity_type = 'PSD_BR' then a.ids end, case when o.source = '{G.CRYPTO}' then c.group_ord::varchar end, case when o.source = '{G.CRYPTO}' then m.ids end) as corroborating,
    d.n as cand_n, d.root as cand_root, d.home as cand_home, x.n as branch_n, x.root as branch_root, x.home as branch_home
  from own o left join eba e on e.group_ord = o.group_ord left join par p on p.entity_type = o.parent_type and p.entity_code = o.parent_code
    left join nat_all a on a.entity_id = o.entity_id left join nat_first f on f.entity_id = o.entity_id left join pay_first y on y.entity_id = o.entity_id left join cat c on c.entity_id = o.entity_id
    left join hom m on m.entity_id = o.entity_id
    left join cand d on d.entity_id = o.entity_id and d.want = o.family || '|ES_BE!' || o.codigo_be left join cand x on x.entity_id = o.entity_id and x.want = 'BRANCH'),
full_ as (
  select *, case mica_home_mechanism when 'AUTHORISATION' then '{G.LEGAL_REFS["AUTHORISATION"]}' when 'NOTIFICATION' then case when remark or coalesce(stated = '{G.INVESTMENT}', false) then '{G.LEGAL_REFS["REMARK"]}' else '{G.LEGAL_REFS["NOTIFICATION"]}' end end as mica_home_legal_ref,
    case when mica_home_mechanism is not null then coalesce(stated, '{G.PLAIN_CLASS}') end as mica_home_entity_class,
    case when source = '{G.EBA}' then own_root when not ({_NATIONAL}) then null
      when pais_origen = 'ES' and family in ('PSD_PI', 'PSD_EMI', 'PSD_AISP') then case when cand_n = 1 then cand_root else 'BDE|' || family || '|' || codigo_be end
      when (family = 'BRANCH' or coalesce(pais_origen, 'ES') <> 'ES') and branch_n = 1 then branch_root
      else 'BDE|' || coalesce(family, 'UNKNOWN') || '|' || codigo_be end as root_key,
    case when source = '{G.EBA}' then own_home when not ({_NATIONAL}) then null
      when pais_origen = 'ES' and family in ('PSD_PI', 'PSD_EMI', 'PSD_AISP') then case when cand_n = 1 then 'ES' when codigo_be is not null then 'ES' end
      when (family = 'BRANCH' or coalesce(pais_origen, 'ES') <> 'ES') and branch_n = 1 then branch_home
      when codigo_be is not null then pais_origen end as root_home_jurisdiction
  from der)"""

SQL = {
    "register_derivation": _DERIVED + f" select group_ord, {', '.join(c for c in DERIVED)}, corroborating from full_",
    "root_key_cases": _DERIVED + " select source, array_to_string(string_split(root_key, '|')[:2], '|') as root_kind, root_home_jurisdiction, count(*) as n, count(distinct root_key) as roots from full_ group by all",
}

# The rule set as rows: rules, their conditions, their value maps. A rule fires where none of its
# conditions fails; nothing of the compiled columns is used.
_LIST_FIELDS = ("eba_es_services", "actividades_codes", "ent_aut")


def _sql(value: object) -> str:
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_sql, value)) + "]::varchar[]"
    return "null::varchar" if value is None else "'" + str(value).replace("'", "''") + "'"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    return f"{name}({columns}) as (values " + ",\n  ".join("(" + ", ".join(str(x) if isinstance(x, int) else _sql(x) for x in r) + ")" for r in rows) + ")"


def _rule_rows() -> list[str]:
    rules, conditions, maps, derived = [], [], [], []
    spec = json.loads(payment_rules.text())["ruleset"]
    for k, r in enumerate(spec["rules"]):
        per, fact, finding = r.get("emit_per", {}), r.get("emit_status_fact"), r.get("finding")
        e, it = per.get("emit") or fact or {}, per.get("iterate", {})
        kind = "FACT" if fact else "FINDING" if finding else "ASSERTION"
        dates = [x for c in ("effective_from", "effective_to") for x in ((e[c]["derivation"], e[c].get("field", "eba_ent_aut_last_auth")) if c in e else (None, None))]
        plain = [e.get(c) for c in ("entity_class", "entry_mechanism", "territorial_basis", "legal_effect", "legal_basis", "scope", "evidence_basis", "evidence_composition", "negative_scope", "negative_evidence_class", "source_granularity", "interval_end", "admissibility", "blocker", "coverage_policy_id")]
        rules.append((k, r["rule_id"], r["match"]["source"], kind, r["required_fields"], it.get("mode"), it.get("field"), it.get("universe", []), *dates, *plain, e.get("reported_status"), (e.get("reported_status_from") or {}).get("field"), e.get("effective_from_field"), (finding or fact or {}).get("detail"), (finding or {}).get("classification")))
        conditions += [(k, c["field"], c["op"], c["value"] if isinstance(c.get("value"), list) else [c.get("value")]) for c in r["match"]["conditions"]]
        for c in ("entity_class", "entry_mechanism", "activity", "negative_evidence_class"):
            maps += [(k, c, e[f"{c}_from"]["field"], key, v) for key, v in (e.get(f"{c}_from") or {}).get("map", {}).items()]
    for k, r in enumerate(spec["derived_rules"], 1):
        b, e, f = r["base"], r["emit"], r["untriggered_finding"]
        derived.append((k, r["rule_id"], r["ruleset_version"], b["entity_class"], b["activity"], b.get("legal_effect"), e["activity"], e["legal_effect"], e["entry_mechanism"], e["legal_basis"], e["scope"], f["classification"], f["detail"]))
    return [
        _values("rules", "ord, rule_id, source, kind, required, mode, item_field, universe, from_kind, from_field, to_kind, to_field, entity_class, entry_mechanism, territorial_basis, legal_effect, legal_basis, scope, evidence_basis, evidence_composition, negative_scope, negative_evidence_class, source_granularity, interval_end, admissibility, blocker, coverage_policy_id, reported_status, status_field, fact_date_field, detail, classification", rules),
        _values("conditions", "ord, field, op, args", conditions),
        _values("maps", "ord, name, field, key, value", maps),
        _values("derived_rules", "n, rule_id, version, base_class, base_activity, base_effect, activity, legal_effect, entry_mechanism, legal_basis, scope, classification, detail", derived),
    ]


_FIELDS = [*TEXTS, "eba_es_services_str", *DERIVED]
_DATED = "case {k} when 'EVIDENCE_AS_OF' then '" + EVIDENCE_AS_OF + "' when 'CONSTANT_NULL' then null when 'FIELD_DDMMYYYY' then strftime(try_strptime({f}, '%d/%m/%Y'), '%Y-%m-%d') when 'FIELD_DDMMYYYY_OR_NULL' then strftime(try_strptime({f}, '%d/%m/%Y'), '%Y-%m-%d') else {f} end"


def _field(name: str) -> str:
    return f"texts[{name}]"


_RULESET = (
    _DERIVED + ",\n" + ",\n".join(_rule_rows()) + ",\n"
    + "grp as (select group_ord, entity_id, source, register_id, map_from_entries(list_filter([" + ", ".join(f"('{c}', {c}::varchar)" for c in _FIELDS if c != "eba_es_services_str")
    + ", ('eba_es_services_str', array_to_string(eba_es_services, '|'))], lambda x: x[2] is not null)) as texts, map_from_entries(list_filter([" + ", ".join(f"('{c}', {c})" for c in _LIST_FIELDS)
    + "], lambda x: x[2] is not null)) as lists, 'claim-' || group_ord || case when corroborating <> '' then ',claim-' || replace(corroborating, ',', ',claim-') else '' end as claims from full_),\n"
    + r"""failed as (
  select g.group_ord, c.ord from grp g join rules r on r.source = g.source join conditions c on c.ord = r.ord
  where not case c.op when 'EQ' then texts[c.field] is not distinct from c.args[1] when 'IN' then coalesce(list_contains(c.args, texts[c.field]), false)
    when 'NOT_NULL' then coalesce(texts[c.field] <> '', lists[c.field] is not null) when 'NULL' then coalesce(texts[c.field] = '', lists[c.field] is null)
    when 'ABSENT_IN' then coalesce(not list_contains(lists[c.field], c.args[1]), false) end),
fired as (
  select g.*, r.* exclude (source), list_filter(r.required, lambda f: texts[f] is null and lists[f] is null) as lacking
  from grp g join rules r on r.source = g.source anti join failed f on f.group_ord = g.group_ord and f.ord = r.ord),
split as (
  select *, case when len(lacking) > 0 or mode is null then [null] when mode = 'SPLIT' then string_split(texts[item_field], '|') when mode = 'LIST' then lists[item_field]
    else list_filter(universe, lambda u: not list_contains(lists[item_field], u)) end as items from fired),
firsts as (select *, list_filter(list_distinct(items), lambda x: x is null or x <> '') as _, list_filter(list_transform(items, lambda x, i: case when list_position(items, x) = i and x <> '' then x end), lambda x: x is not null) as own from split),
item as (
  select * exclude (own, _, items), unnest(case when len(lacking) > 0 or mode is null then [null] else own end) as item, unnest(range(case when len(lacking) > 0 or mode is null then 1 else len(own) end)) as item_ord from firsts),
mapped as (
  select i.*, mc.ord is not null as class_mapped, mm.ord is not null as mech_mapped, vc.value as class_value, vm.value as mech_value, va.value as activity, vn.value as neg_value,
    """ + _DATED.format(k="from_kind", f="texts[from_field]") + r""" as eff_from, """ + _DATED.format(k="to_kind", f="texts[to_field]") + r""" as eff_to,
    coalesce(lists['ent_aut'], null) as unused
  from item i left join (select distinct ord, field from maps where name = 'entity_class') mc on mc.ord = i.ord left join maps vc on vc.ord = i.ord and vc.name = 'entity_class' and vc.key = texts[vc.field]
    left join (select distinct ord, field from maps where name = 'entry_mechanism') mm on mm.ord = i.ord left join maps vm on vm.ord = i.ord and vm.name = 'entry_mechanism' and vm.key = texts[vm.field]
    left join maps va on va.ord = i.ord and va.name = 'activity' and va.key = i.item left join maps vn on vn.ord = i.ord and vn.name = 'negative_evidence_class' and vn.key = texts[vn.field]),
refs as (
  select *, list_filter(list_transform(regexp_extract_all(legal_basis || ' ' || scope, '\{[a-z_][a-z0-9_]*\}'), lambda x: x[2:-2]), lambda f: coalesce(texts[f], '') = '') as missing_refs from mapped),
judged as (
  select *, case
      when len(lacking) > 0 then [{'c': 'REQUIRED_FIELD_MISSING', 'd': 'missing: ' || array_to_string(lacking, ', ')}]
      when kind = 'FINDING' then [{'c': classification, 'd': detail}] when kind = 'FACT' then []
      when (class_mapped and class_value is null) or activity is null or (mech_mapped and mech_value is null) then list_filter([
        case when class_mapped and class_value is null then {'c': 'UNSUPPORTED_ENTITY_CLASS', 'd': 'entity_class of ' || (select any_value(field) from maps m where m.ord = refs.ord and m.name = 'entity_class') || ' has no mapping'} end,
        case when activity is null then {'c': 'UNSUPPORTED_ACTIVITY_MAPPING', 'd': 'activity of $ITEM has no mapping'} end,
        case when mech_mapped and mech_value is null then {'c': 'REQUIRED_FIELD_MISSING', 'd': 'entry_mechanism of ' || (select any_value(field) from maps m where m.ord = refs.ord and m.name = 'entry_mechanism') || ' has no mapping'} end], lambda x: x is not null)
      when eff_from is null and from_kind not in ('CONSTANT_NULL', 'EVIDENCE_AS_OF') and not ends_with(from_kind, '_OR_NULL') then [{'c': 'REQUIRED_FIELD_UNDERIVABLE', 'd': 'effective_from cannot be derived'}]
      when eff_to is null and to_kind not in ('CONSTANT_NULL', 'EVIDENCE_AS_OF') and not ends_with(to_kind, '_OR_NULL') then [{'c': 'REQUIRED_FIELD_UNDERIVABLE', 'd': 'effective_to cannot be derived'}]
      when len(missing_refs) > 0 then [{'c': 'REQUIRED_FIELD_MISSING', 'd': 'missing in a text: ' || array_to_string(missing_refs, ', ')}] else [] end as problems
  from refs),
first_pass as (
  select 0 as pass, group_ord as at1, ord as at2, item_ord as at3, 0 as at4, register_id, entity_id, coalesce(class_value, entity_class) as entity_class, activity, 'ES' as jurisdiction, legal_effect,
    coalesce(mech_value, entry_mechanism) as entry_mechanism, territorial_basis,
    replace(replace(replace(legal_basis, '{eba_home_nca}', coalesce(texts['eba_home_nca'], '')), '{eba_parent_nca}', coalesce(texts['eba_parent_nca'], '')), '{bde_branch_fecha_alta}', coalesce(texts['bde_branch_fecha_alta'], '')) as legal_basis,
    eff_from as effective_from, eff_to as effective_to, scope, rule_id, evidence_basis, evidence_composition, negative_scope, negative_evidence_class, source_granularity, interval_end, admissibility, blocker, coverage_policy_id,
    item as raw_capability_code, texts['root_key'] as root_key, texts['root_home_jurisdiction'] as root_home_jurisdiction, 'DERIVATION_1' as ruleset_version, null::varchar as derived_by, claims
  from judged where kind = 'ASSERTION' and len(problems) = 0),
starts as (
  select d.*, f.* exclude (rule_id, activity, legal_effect, entry_mechanism, legal_basis, scope) from first_pass f join derived_rules d on f.entity_class = d.base_class and f.activity = d.base_activity and (d.base_effect is null or f.legal_effect = d.base_effect)
  qualify row_number() over (partition by d.n, f.entity_id, f.jurisdiction, f.territorial_basis order by at1, at2, at3) = 1),
every as (
  select * from first_pass
  union all
  select n, at1, at2, at3, at4, register_id, entity_id, entity_class, activity, jurisdiction, legal_effect, entry_mechanism, territorial_basis, legal_basis, effective_from, effective_to, scope, rule_id,
    null, null, null, null, null, null, null, null, null, null, null, null, version, rule_id, claims from starts),
found_facts as (
  select group_ord as at1, ord as at2, entity_id, source, rule_id, coalesce(reported_status, texts[status_field]) as reported_status, detail, negative_scope, coalesce(neg_value, negative_evidence_class) as negative_evidence_class,
    interval_end, null::varchar as canonical_activity, entry_mechanism, coverage_policy_id, texts[fact_date_field] as effective_from, texts['root_key'] as root_key, texts['root_home_jurisdiction'] as root_home_jurisdiction,
    null::varchar as intervals, claims
  from judged where kind = 'FACT' and len(problems) = 0 and coalesce(reported_status, texts[status_field]) is not null),
found_findings as (
  select 0 as pass, group_ord as at1, ord as at2, item_ord as at3, p.n as at4, entity_id, source, rule_id, p.c as classification, p.d as detail
  from (select *, unnest(list_transform(problems, lambda x, i: {'n': i, 'c': x.c, 'd': x.d})) as p from judged)
  union all
  select d.n, e.entity_id, 0, 0, 0, e.entity_id, null, d.rule_id, d.classification, d.detail
  from derived_rules d join (select distinct entity_id, entity_class from every) e on e.entity_class = d.base_class where not exists (select 1 from starts s where s.n = d.n))"""
)


def _id(prefix: str, order: str) -> str:
    n = f"row_number() over (order by {order})::varchar"
    return f"'{prefix}-' || case when length({n}) < 3 then lpad({n}, 3, '0') else {n} end"


SQL |= {
    "ruleset_assertions": _RULESET + f" select {_id('a-asm', 'pass, at1, at2, at3')} as assertion_id, {', '.join(SHOWN)}, ruleset_version, derived_by, claims from every",
    "ruleset_facts": _RULESET + f" select {_id('a-fact', 'at1, at2')} as fact_id, * exclude (at1, at2) from found_facts",
    "ruleset_findings": _RULESET + f" select {_id('a-fnd', 'pass, at1, at2, at3, at4')} as finding_id, entity_id, source, rule_id, classification, detail from found_findings",
    "ruleset_header": _RULESET + f" select 'ARTIFACT_1' as artifact_version, 'DERIVATION_1' as derivation_version, '{payment_rules.VERSION}' as ruleset_version, (select sum(1 + length(claims) - length(replace(claims, ',', ''))) from grp)::bigint as claims_consumed, (select count(*) from every) as assertions_emitted, (select count(*) from found_findings) as findings_emitted, (select count(*) from found_facts) as reported_facts_emitted, 'NOT_RUN' as assessment",
}
QUERIES = {f.__name__: (f, SQL.get(f.__name__)) for f in (register_derivation, root_key_cases, ruleset_assertions, ruleset_facts, ruleset_findings, ruleset_header)}
