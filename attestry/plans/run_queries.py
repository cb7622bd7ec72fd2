"""Attempts, cases and merges made of the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import longitudinal as LG
from attestry.operators import runs as R
from attestry.operators import verdict as V
from attestry.plans import evidence_queries as E
from attestry.plans import lens as L
from attestry.plans import verdict_queries as VQ
from attestry.plans.lens import table


def parse_outcomes(s: SparkSession, d: str) -> DataFrame:
    """Orders as attempts; the records of a snapshot are the orders that were shipped to it, some under another name."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    locator = lambda name: F.create_map(F.lit("code"), text(k), F.lit("name"), name, F.lit("field"), F.lit("x"))
    source = F.when(k % 5 == 0, "NOBODY").when(k % 2 == 0, "EVEN").otherwise("ODD")
    attempts = table(s, d, "orders").select(k.alias("attempt_id"), source.alias("source"), F.concat(F.lit("s"), text(k % 3)).alias("snapshot_file"), F.when(k % 7 > 0, "FETCH_OK").alias("fetch"), locator(F.col("o_orderstatus")).alias("locator"))
    records = table(s, d, "orders").where(k % 4 > 0).select(source.alias("source"), F.concat(F.lit("s"), text(k % 3)).alias("snapshot_file"), locator(F.when(k % 9 == 0, "other").otherwise(F.col("o_orderstatus"))).alias("locator"))
    keys = s.createDataFrame([("EVEN", ["code"]), ("ODD", ["code", "missing"])], "source string, fields array<string>")
    return R.parse_outcomes(attempts, records, keys)


def attempt_summary(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    diverged = F.array_compact(F.array(F.when(k % 11 == 0, F.struct(F.lit("NAME_VARIANT").alias("classification"), (k % 2 == 0).alias("expected"))), F.when(k % 13 == 0, F.struct(F.lit("DATE_DRIFT").alias("classification"), F.lit(None).cast("boolean").alias("expected")))))
    return R.attempt_summary(table(s, d, "orders").select(F.when(k % 7 == 0, "HASH_MISMATCH").otherwise("FETCH_OK").alias("fetch"), F.when(k % 7 > 0, F.when(k % 4 == 0, "PARSE_ERROR").otherwise("PARSE_OK")).alias("parse"), F.col("o_orderstatus").alias("identity"), F.lit(None).cast("string").alias("semantics"), diverged.alias("divergences")))


_VERDICTS, _REASONS = ("CONFIRMED_ENTITLED", "NO_ENTITLEMENT_EVIDENCED"), ("ACTIVE_ENTITLEMENT_EVIDENCED", "NO_ASSERTIONS_IN_SCOPE")


def _results(s: SparkSession, d: str) -> DataFrame:
    """The lens's questions as cases: an entitlement is expected where an order of the entity was fulfilled."""
    q, e = L.questions(s, d), F.col("entity_id")
    cases = q.select(
        F.concat_ws("/", *V.QUESTION).alias("case_id"), *V.QUESTION, F.when(e % 5 == 0, _VERDICTS[0]).otherwise(_VERDICTS[1]).alias("expected_verdict"), F.when(e % 5 == 0, _REASONS[0]).otherwise(_REASONS[1]).alias("expected_reason"),
        F.when(e % 3 == 0, F.array(F.lit("BRANCH"))).when(e % 3 == 1, F.array().cast("array<string>")).alias("expected_bases"), F.when(e % 4 == 0, "M0").alias("expected_mechanism"),
    )
    assertions = L.assertions(s, d).withColumn("entry_mechanism", F.concat(F.lit("M"), (F.col("assertion_id") % 2).cast("string")))
    return R.case_results(cases, VQ.bitemporal_verdict(s, d), assertions)


def case_metrics(s: SparkSession, d: str) -> DataFrame:
    keep = ("case_id", "verdict", "verdict_match", "reason_match", "basis_match", "mechanism_match", "match", "strict_match")
    return _results(s, d).select(*keep, *(F.array_join(c, ",").alias(c) for c in ("bases", "mechanisms", "strict_divergences")))


def case_summary(s: SparkSession, d: str) -> DataFrame:
    return R.case_summary(_results(s, d))


def candidate_summary(s: SparkSession, d: str) -> DataFrame:
    changes = E.snapshot_diff(s, d).withColumn("pair", F.col("record_key") % 25)
    return R.candidate_summary(changes, LG.classified(changes, LG.compared(E._observation_pairs(s, d)), "record_key", "pair"), "pair")


def merged_manifest(s: SparkSession, d: str) -> DataFrame:
    """Three manifests of suppliers, the later ones of fewer."""
    k = F.col("s_suppkey")
    part = lambda n: table(s, d, "supplier").where(k % n == 0).select(F.concat(F.lit("file"), k.cast("string")).alias("snapshot_file"), F.lit(f"h{n}").alias("sha256"), F.when(k % 4 > 0, F.lit(f"d{n}")).alias("source_as_of"))
    return R.merged([part(1), part(2), part(6)], "snapshot_file")


_CASES = f"""with v as ({VQ._VERDICT}), u as (select entity_id, activity, jurisdiction, asked_basis, valid_at, known_at, unnest(string_split(used_ids, ','))::bigint as k from v where used_ids <> ''),
z as (select u.entity_id, u.activity, u.jurisdiction, u.asked_basis, u.valid_at, u.known_at, list_sort(list_distinct(coalesce(list(case k % 3 when 0 then 'DOMESTIC' when 1 then 'BRANCH' else 'FREEDOM_TO_PROVIDE_SERVICES' end) filter (o_orderstatus = 'F'), []))) as bases, list_sort(list_distinct(list('M' || (k % 2)))) as mechanisms
  from u join orders on o_orderkey = k group by all),
r as (
  select concat_ws('/', v.entity_id, v.activity, v.jurisdiction, v.asked_basis, v.valid_at, v.known_at) as case_id, v.verdict, v.verdict = case when v.entity_id % 5 = 0 then '{_VERDICTS[0]}' else '{_VERDICTS[1]}' end as verdict_match, v.reason = case when v.entity_id % 5 = 0 then '{_REASONS[0]}' else '{_REASONS[1]}' end as reason_match,
    coalesce(z.bases, []) as b, coalesce(z.mechanisms, []) as m, v.entity_id % 3 > 0 or list_contains(coalesce(z.bases, []), 'BRANCH') as basis_match, v.entity_id % 4 > 0 or list_contains(coalesce(z.mechanisms, []), 'M0') as mechanism_match,
    case v.entity_id % 3 when 0 then coalesce(z.bases, []) = ['BRANCH'] when 1 then len(coalesce(z.bases, [])) = 0 else false end as strict_b, case when v.entity_id % 4 = 0 then coalesce(z.mechanisms, []) = ['M0'] else len(coalesce(z.mechanisms, [])) = 0 end as strict_m
  from v left join z on {VQ._SAME.format(a="z", b="v")}),
c as (select *, verdict_match and reason_match and basis_match and mechanism_match as match from r)"""
QUERIES = {
    "parse_outcomes": (
        parse_outcomes,
        """with a as (select o_orderkey as k, case when o_orderkey % 7 = 0 then 'SNAPSHOT_NOT_FETCHED' when o_orderkey % 5 = 0 then 'NO_PARSER_FOR_SOURCE' when o_orderkey % 4 = 0 then 'EXPECTED_RECORD_NOT_FOUND_IN_SNAPSHOT' when o_orderkey % 9 = 0 then 'RECORD_KEY_MISMATCH' end as reason from orders)
select k as attempt_id, case when k % 5 = 0 then 'NOBODY' when k % 2 = 0 then 'EVEN' else 'ODD' end as source, case when reason = 'SNAPSHOT_NOT_FETCHED' then 'NOT_RUN' when reason is not null then 'PARSE_ERROR' else 'PARSE_OK' end as status, reason,
  k % 7 > 0 and k % 5 > 0 and k % 4 > 0 as record_found from a""",
    ),
    "attempt_summary": (
        attempt_summary,
        """with k as (select o_orderkey as k, o_orderstatus as st from orders), x as (
  select 'fetch' as counter, case when k % 7 = 0 then 'HASH_MISMATCH' else 'FETCH_OK' end as value, null::boolean as expected from k union all select 'parse', case when k % 4 = 0 then 'PARSE_ERROR' else 'PARSE_OK' end, null from k where k % 7 > 0
  union all select 'identity', st, null from k union all select 'divergence', 'NAME_VARIANT', k % 2 = 0 from k where k % 11 = 0 union all select 'divergence', 'DATE_DRIFT', false from k where k % 13 = 0)
select counter, coalesce(value, '*') as value, count(*) as n, count(*) filter (not expected) as unexpected from x group by grouping sets ((counter, value), (counter))""",
    ),
    "case_metrics": (
        case_metrics,
        f"""{_CASES} select case_id, verdict, verdict_match, reason_match, basis_match, mechanism_match, match, match and strict_b and strict_m as strict_match, array_to_string(b, ',') as bases, array_to_string(m, ',') as mechanisms,
  concat_ws(',', case when not strict_b then 'territorial_basis_set' end, case when not strict_m then 'entry_mechanism_set' end) as strict_divergences from c""",
    ),
    "case_summary": (case_summary, f"{_CASES} select coalesce(verdict, '*') as verdict, count(*) as n_cases, count_if(match)::bigint as n_match, count_if(match and strict_b and strict_m)::bigint as n_strict, count_if(not reason_match)::bigint as n_reason_mismatch from c group by rollup(verdict)"),
    "candidate_summary": (
        candidate_summary,
        f"""with c as ({E.QUERIES["change_classify"][1]}), w as ({E.QUERIES["snapshot_diff"][1]})
select pair, coalesce(added, 0) as added, coalesce(removed, 0) as removed, coalesce(changed, 0) as changed, coalesce(candidates, 0) as candidates, coalesce(supported, 0) as supported, coalesce(blocked, 0) as blocked
from (select record_key % 25 as pair, count(*) filter (kind = 'added') as added, count(*) filter (kind = 'removed') as removed, count(*) filter (kind = 'changed') as changed from w group by 1)
  full join (select pair, count(*) as candidates, count(*) filter (admissibility = 'SUPPORTED') as supported, count(*) filter (admissibility = 'BLOCKED') as blocked from c group by 1) using (pair)""",
    ),
    "merged_manifest": (merged_manifest, "select 'file' || s_suppkey as snapshot_file, 'h' || n as sha256, case when s_suppkey % 4 > 0 then 'd' || n end as source_as_of from (select *, case when s_suppkey % 6 = 0 then 6 when s_suppkey % 2 = 0 then 2 else 1 end as n from supplier)"),
}
