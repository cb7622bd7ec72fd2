"""Orders as fetched register records, the ledger of their claims, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import ledger as K
from attestry.plans.lens import table

TRACES = (
    ("EBA", "code", "ATTR", "EntityCode"), ("EBA", "name", "PROPERTY", "NAM"), ("EBA", "log", "PROPERTY", "AUT"), ("EBA", "log_type", "TYPE_NAME", "AUT"), ("EBA", "codes", "FLATTEN_STRINGS", "Services"),
    ("CSV", "lei", "COPY", "lei"), ("CSV", "lei_valid", "IS_VALID_LEI", "lei"), ("CSV", "lei_state", "LEI_DIAGNOSTIC_V2", "lei"), ("CSV", "end", "EMPTY_TO_NULL", "end"), ("CSV", "code", "COPY_OR_EMPTY", "code"),
    ("TXT", "title", "TEXT_EXTRACT", "h1"), ("TXT", "lei", "NOT_PUBLISHED", None),
)
_K = "o_orderkey"
_S = f"case {_K} % 3 when 0 then 'EBA' when 1 then 'CSV' else 'TXT' end"
_DAY = "substr(cast(o_orderdate as string), 1, 10)"
_RAW = f"""case {_K} % 3 when 0 then '{{"EntityCode":"C' || cast({_K} as string) || '","Properties":[{{"NAM":"' || o_orderstatus || '"}},{{"AUT":' || case when {_K} % 2 = 0 then '["{{D}}"]' else '7' end || '}}],"Services":[{{"ES":["PS_' || substr(trim(o_orderpriority), 1, 1) || '",["PS_9"]]}}]}}'
  when 1 then '{{"code":null,"end":"' || case when {_K} % 2 = 0 then '' else '{{D}}' end || '","lei":"' || case when {_K} % 5 = 0 then '5493001KJTIIGC8Y1R12' else 'short' end || '"}}' else '"Firm ' || o_orderstatus || ' of ' || cast({_K} as string) || '"' end"""
_SEEN = f"""case {_K} % 3 when 0 then '{{"code":"C' || cast({_K} as string) || '","codes":["PS_' || substr(trim(o_orderpriority), 1, 1) || '","PS_9"],"log":' || case when {_K} % 2 = 0 then '["{{D}}"]' else '"7"' end || ',"log_type":"' || case when {_K} % 2 = 0 then 'list' else 'int' end || '","name":"' || o_orderstatus || '"' || case when {_K} % 7 = 0 then ',"extra":1' else '' end || '}}'
  when 1 then '{{"code":"","end":' || case when {_K} % 2 = 0 then 'null' else '"{{D}}"' end || ',"lei":"' || case when {_K} % 5 = 0 then '5493001KJTIIGC8Y1R12' else 'short' end || '","lei_state":"' || case when {_K} % 5 = 0 then 'VALID' else 'INVALID_LENGTH' end || '","lei_valid":' || case when {_K} % 5 < 2 then 'true' else 'false' end || '}}' else '{{"lei":null,"title":"' || case when {_K} % 11 = 0 then 'Nobody' else 'Firm ' || o_orderstatus end || '"}}' end"""


def _attempts(s: SparkSession, d: str) -> DataFrame:
    made = lambda text: f"parse_json(replace({text}, '{{D}}', {_DAY}))"
    return table(s, d, "orders").selectExpr(
        f"cast({_K} as string) as corpus_id", f"{_S} as source", f"case when {_K} % 17 = 0 then 'PARSE_FAILED' else 'PARSE_OK' end as parse_status", f"{_S} || cast({_K} % 5 as string) as snapshot_file",
        f"'K' || cast({_K} as string) as record_key", "'p' as parser", "'run1' as run_version", f"{made(_RAW)} as raw_record", f"{made(_SEEN)} as observed",
    )


def _traces(s: SparkSession) -> DataFrame:
    return s.createDataFrame(list(TRACES), K.TRACE)


def ledger_claims(s: SparkSession, d: str) -> DataFrame:
    manifest = table(s, d, "region").where("r_regionkey < 4").selectExpr("explode(array('EBA', 'CSV', 'TXT')) as source", "r_regionkey").selectExpr(
        "source || cast(r_regionkey as string) as snapshot_file", "'h' || cast(r_regionkey as string) as sha256", "'https://example.org' as source_url", "'2024-01-01' as retrieved_at", "case when r_regionkey = 1 then '2023-12-31' end as source_as_of"
    )
    return K.claims(_attempts(s, d), _traces(s), manifest).drop("raw_record_sha256")


def ledger_verification(s: SparkSession, d: str) -> DataFrame:
    """The ledger derived again from records of which every thirteenth could no longer be read."""
    again = _attempts(s, d).withColumn("parse_status", F.when(F.col("corpus_id").cast("long") % 13 == 0, "PARSE_FAILED").otherwise(F.col("parse_status")))
    none = s.createDataFrame([], "snapshot_file string, sha256 string, source_url string, retrieved_at string, source_as_of string")
    return K.verified(K.claims(_attempts(s, d), _traces(s), none), again)


def untraced_fields(s: SparkSession, d: str) -> DataFrame:
    return K.untraced(_attempts(s, d), _traces(s))


_CLAIMS = f"""with o as (select *, {_K} as k, {_DAY} as day, substr(trim(o_orderpriority), 1, 1) as p from orders where {_K} % 17 <> 0),
c as (
  select k, 'EBA' as source, x.* from o, lateral (values ('code', 'ATTR', 'EntityCode', '"C' || k || '"', '"C' || k || '"'), ('name', 'PROPERTY', 'NAM', '"' || o_orderstatus || '"', '"' || o_orderstatus || '"'),
    ('log', 'PROPERTY', 'AUT', case when k % 2 = 0 then '["' || day || '"]' else '7' end, case when k % 2 = 0 then '["' || day || '"]' else '"7"' end),
    ('log_type', 'TYPE_NAME', 'AUT', case when k % 2 = 0 then '["' || day || '"]' else '7' end, case when k % 2 = 0 then '"list"' else '"int"' end),
    ('codes', 'FLATTEN_STRINGS', 'Services', '[{{"ES":["PS_' || p || '",["PS_9"]]}}]', '["PS_' || p || '","PS_9"]')) x(field, rule, ref, raw_value, normalized_value) where k % 3 = 0
  union all
  select k, 'CSV', x.* from (select *, case when k % 5 = 0 then '5493001KJTIIGC8Y1R12' else 'short' end as lei, case when k % 2 = 0 then '' else day end as ended from o) o, lateral (values ('lei', 'COPY', 'lei', '"' || lei || '"', '"' || lei || '"'),
    ('lei_valid', 'IS_VALID_LEI', 'lei', '"' || lei || '"', case when k % 5 < 2 then 'true' else 'false' end), ('lei_state', 'LEI_DIAGNOSTIC_V2', 'lei', '"' || lei || '"', case when k % 5 = 0 then '"VALID"' else '"INVALID_LENGTH"' end),
    ('end', 'EMPTY_TO_NULL', 'end', '"' || ended || '"', case when k % 2 = 0 then 'null' else '"' || ended || '"' end), ('code', 'COPY_OR_EMPTY', 'code', 'null', '""')) x(field, rule, ref, raw_value, normalized_value) where k % 3 = 1
  union all
  select k, 'TXT', x.* from o, lateral (values ('title', 'TEXT_EXTRACT', 'h1', '"Firm ' || o_orderstatus || ' of ' || k || '"', case when k % 11 = 0 then '"Nobody"' else '"Firm ' || o_orderstatus || '"' end), ('lei', 'NOT_PUBLISHED', null::varchar, 'null', 'null')) x(field, rule, ref, raw_value, normalized_value) where k % 3 = 2)"""
QUERIES = {
    "ledger_claims": (
        ledger_claims,
        f"""{_CLAIMS} select k || '|' || source || '|' || field as claim_id, k::varchar as corpus_id, source, field, rule, ref, case when rule = 'LEI_DIAGNOSTIC_V2' then rule else 'run1' end as rule_version, 'p' as parser, 'run1' as extractor_version, 'K' || k as record_key, source || (k % 5) as snapshot_file,
  case when k % 5 < 4 then 'h' || (k % 5) end as snapshot_sha256, case when k % 5 < 4 then 'https://example.org' end as source_url, case when k % 5 < 4 then '2024-01-01' end as retrieved_at, case when k % 5 = 1 then '2023-12-31' end as source_as_of,
  case when k % 5 = 1 then 'TRUSTED' else 'UNAVAILABLE' end as source_date_reliability, raw_value, normalized_value from c""",
    ),
    "ledger_verification": (
        ledger_verification,
        f"""{_CLAIMS} select k || '|' || source || '|' || field as claim_id, case when k % 13 = 0 then 'NO_ATTEMPT' when field = 'log' and k % 2 = 1 then 'NORMALIZED_MISMATCH' when field = 'lei_valid' and k % 5 = 1 then 'NORMALIZED_MISMATCH' when field = 'title' and k % 11 = 0 then 'NORMALIZED_MISMATCH' else 'VERIFIED' end as state from c""",
    ),
    "untraced_fields": (untraced_fields, f"select {_K}::varchar as corpus_id, 'EBA' as source, 'extra' as field from orders where {_K} % 21 = 0 and {_K} % 17 <> 0"),
}
