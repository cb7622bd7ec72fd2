"""Artefacts made of the star tables, their projection to seven tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import public_tables as P
from attestry.plans.lens import table

#: Order keys a part of an evidence set: some thousands of orders of one nation, however many there are.
PART = 150_000


def artifacts(s: SparkSession, d: str) -> DataFrame:
    """An evidence set, a comparison and an events file for each nation, as JSON texts; a set has a part for every ``PART`` order keys."""
    customers = table(s, d, "customer").select("c_custkey", "c_nationkey")
    orders = table(s, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    sources = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.struct(F.concat(F.lit("REG"), i.cast("string")).alias("register_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("retrieved_at")))
    item = F.struct(
        F.concat(F.lit("a-"), k.cast("string")).alias("assertion_id"), F.concat(F.lit("e-"), F.col("o_custkey").cast("string")).alias("entity_id"), F.trim("o_orderpriority").alias("activity"),
        F.when(F.col("o_orderstatus") == "F", "ENTITLED_TO_PROVIDE").otherwise("NOT_ENTITLED").alias("legal_effect"), F.when(k % 2 == 0, sources).alias("source_assertions"), (k % 5).alias("n"),
    )
    fact = F.struct(F.concat(F.lit("f-"), k.cast("string")).alias("fact_id"), F.concat(F.lit("e-"), F.col("o_custkey").cast("string")).alias("corpus_id"), F.col("o_orderstatus").alias("reported_status"), sources.alias("source_assertions"))
    sets = orders.groupBy("c_nationkey", F.floor(k / PART).alias("part")).agg(F.collect_list(F.when(k % 4 > 0, item)).alias("assertions"), F.collect_list(F.when(k % 4 == 0, fact)).alias("reported_facts"))
    n = F.col("nation")
    named = lambda df, kind: df.select(F.concat(F.lit(f"{kind}/n"), n.cast("string"), F.lit(".json")).alias("path"), F.lit(kind).alias("kind"), (F.col("part") if "part" in df.columns else F.lit(0).cast("long")).alias("part"), F.to_json(F.struct(*[c for c in df.columns if c not in ("nation", "part")])).alias("content"))
    sets = sets.select(F.col("c_nationkey").alias("nation"), F.concat(F.lit("set-"), F.col("c_nationkey").cast("string")).alias("artifact"), "part", "assertions", "reported_facts")
    supplier, key = table(s, d, "supplier"), F.col("s_suppkey")
    record = F.concat(F.lit("K"), F.lpad(key.cast("string"), 6, "0"))
    changed = F.struct(record.alias("record_key"), F.lit("changed").alias("kind"), F.lit("name").alias("path"), F.lit(None).cast("string").alias("old"), F.col("s_name").alias("new"))
    lists = lambda when, v: F.sort_array(F.collect_list(F.when(when, v)))
    by_nation = supplier.groupBy(F.col("s_nationkey").alias("nation"))
    compared = by_nation.agg(F.struct(lists(key % 3 == 0, record).alias("added"), lists(key % 3 == 1, changed).alias("changed"), lists(key % 3 == 2, record).alias("removed")).alias("changes"))
    compared = compared.select("nation", F.concat(F.lit("cmp-"), n.cast("string")).alias("artifact"), F.struct(F.lit("left").alias("left_observation_id"), F.concat(F.lit("right-"), n.cast("string")).alias("right_observation_id")).alias("comparison"), "changes")
    candidate = F.struct(F.lit("CHANGE").alias("candidate_type"), record.alias("record_key"), F.when(key % 2 == 0, "BLOCKED").otherwise("ADMISSIBLE").alias("admissibility"))
    events = by_nation.agg(F.sort_array(F.collect_list(candidate)).alias("candidates")).select(
        "nation", F.concat(F.lit("ev-"), n.cast("string")).alias("artifact"),
        F.struct(F.when(n % 2 == 0, F.concat(F.lit("comparison/n"), n.cast("string"), F.lit(".json"))).alias("file"), F.lit("slice").alias("kind"), F.concat(F.lit("h"), n.cast("string")).alias("sha256")).alias("source_comparison"),
        F.struct(F.struct(F.size("candidates").alias("added")).alias("input")).alias("summary"), "candidates",
    )
    return named(sets, P.EVIDENCE).union(named(compared, P.COMPARISON)).union(named(events, P.EVENTS))


def _of(name: str, *drop: str):
    def query(s: SparkSession, d: str) -> DataFrame:
        return P.built(artifacts(s, d))[name].drop(*drop)

    query.__name__ = f"projected_{name}"
    return query


def projection_manifest(s: SparkSession, d: str) -> DataFrame:
    """Tables of the projection with their numbers of rows; digests are tested apart."""
    return P.manifest(P.built(artifacts(s, d), once=True), "PROJECTION_1").select("name", "rows")


def projection_faults(s: SparkSession, d: str) -> DataFrame:
    """What contradicts itself once some artefacts, assertions and comparisons are taken away."""
    t = P.built(artifacts(s, d), once=True)  # seven tables are read from them
    t["artifacts"] = t["artifacts"].where("artifact_id <> 'set-3'")
    t["comparisons"] = t["comparisons"].where("comparison_id not in ('cmp-4', 'slice@sha256:h5')")
    t["reported_facts"] = t["reported_facts"].where("reported_status <> 'P'")
    return P.broken(t)


_A = """with o as (select *, 'a-' || o_orderkey as a, 'f-' || o_orderkey as f, 'e-' || o_custkey as e, substr(o_orderdate::varchar, 1, 10) as day, 'set-' || c_nationkey as art from orders join customer on o_custkey = c_custkey),
src as (select 'assertion' as owner_type, a as owner_id, i as ordinal, 'REG' || i as register_id, day from (select *, unnest(range(o_orderkey % 3 + 1)) as i from o where o_orderkey % 4 > 0 and o_orderkey % 2 = 0)
  union all select 'reported_fact', f, i, 'REG' || i, day from (select *, unnest(range(o_orderkey % 3 + 1)) as i from o where o_orderkey % 4 = 0)),
cited as (select owner_id, '[' || string_agg('{"register_id":"' || register_id || '","retrieved_at":"' || day || '"}', ',' order by ordinal) || ']' as cites from src group by 1),
s as (select *, 'K' || lpad(s_suppkey::varchar, 6, '0') as rk, 'cmp-' || s_nationkey as cmp from supplier),
chg as (select cmp, rk, case s_suppkey % 3 when 0 then 'added' when 1 then 'changed' else 'removed' end as kind, s_name from s),
cand as (select case when s_nationkey % 2 = 0 then cmp else 'slice@sha256:h' || s_nationkey end as cmp, rk, case when s_suppkey % 2 = 0 then 'BLOCKED' else 'ADMISSIBLE' end as adm from s),
comps as (select distinct cmp from chg union select distinct cmp from cand)"""
_EFFECT = "case when o_orderstatus = 'F' then 'ENTITLED_TO_PROVIDE' else 'NOT_ENTITLED' end"
QUERIES = {
    "projected_assertions": (
        _of("assertions", "evidence_set_id"),
        f"""{_A} select a as assertion_id, e as entity_id, trim(o_orderpriority) as activity, null::varchar as jurisdiction, {_EFFECT} as legal_effect, null::varchar as entry_mechanism, null::varchar as territorial_basis, null::varchar as effective_from, null::varchar as effective_to,
  art as source_artifact_id, '{{"activity":"' || trim(o_orderpriority) || '","assertion_id":"' || a || '","entity_id":"' || e || '","legal_effect":"' || {_EFFECT} || '","n":' || (o_orderkey % 5) || case when cites is null then '' else ',"source_assertions":' || cites end || '}}' as payload_json
from o left join cited on owner_id = a where o_orderkey % 4 > 0""",
    ),
    "projected_reported_facts": (
        _of("reported_facts"),
        f"""{_A} select f as fact_id, e as corpus_id, null::varchar as rule_id, o_orderstatus as reported_status, art as source_artifact_id,
  '{{"corpus_id":"' || e || '","fact_id":"' || f || '","reported_status":"' || o_orderstatus || '","source_assertions":' || cites || '}}' as payload_json from o join cited on owner_id = f where o_orderkey % 4 = 0""",
    ),
    "projected_source_assertions": (
        _of("source_assertions"),
        f"""{_A} select owner_type, owner_id, ordinal, null::varchar as authority, register_id, null::varchar as source_url, day as retrieved_at, null::varchar as source_as_of, null::varchar as raw_snapshot_sha256,
  '{{"register_id":"' || register_id || '","retrieved_at":"' || day || '"}}' as payload_json from src""",
    ),
    "projected_comparisons": (
        _of("comparisons", "payload_json"),
        f"""{_A} select cmp as comparison_id, 'left' as left_observation_id, 'right-' || substr(cmp, 5) as right_observation_id, null::varchar as succession_state, count(*) filter (kind = 'added') as added_count, count(*) filter (kind = 'removed') as removed_count,
  count(*) filter (kind = 'changed') as changed_count from chg group by cmp union all select cmp, null, null, null, count(*), null, null from cand where cmp like 'slice%' group by cmp""",
    ),
    "projected_structural_changes": (
        _of("structural_changes"),
        f"""{_A} select cmp as comparison_id, row_number() over (partition by cmp order by kind, rk) - 1 as ordinal, kind, rk as record_key,
  case when kind = 'changed' then '{{"kind":"changed","new":"' || s_name || '","path":"name","record_key":"' || rk || '"}}' else '"' || rk || '"' end as payload_json from chg""",
    ),
    "projected_change_candidates": (
        _of("change_candidates"),
        f"""{_A} select cmp as comparison_id, row_number() over (partition by cmp order by rk) - 1 as ordinal, 'CHANGE' as candidate_type, rk as record_key, adm as admissibility, null::varchar as blocker, null::varchar as effective_basis,
  '{{"admissibility":"' || adm || '","candidate_type":"CHANGE","record_key":"' || rk || '"}}' as payload_json from cand""",
    ),
    "projected_artifacts": (
        _of("artifacts", "sha256", "payload_json"),
        """select 'set-' || k as artifact_id, 'evidence-set/n' || k || '.json' as path, 'evidence-set' as kind from (select distinct c_nationkey as k from customer join orders on o_custkey = c_custkey)
union all select p || k, t || '/n' || k || '.json', t from (select distinct s_nationkey as k from supplier), (values ('cmp-', 'comparison'), ('ev-', 'events')) x(p, t)""",
    ),
    "projection_manifest": (
        projection_manifest,
        f"""{_A}, n as (select 'artifacts' as name, (select count(distinct art) from o) + 2 * (select count(distinct s_nationkey) from s) as "rows"
union all select 'assertions', count(*) from o where o_orderkey % 4 > 0 union all select 'reported_facts', count(*) from o where o_orderkey % 4 = 0 union all select 'source_assertions', count(*) from src
union all select 'comparisons', count(*) from comps union all select 'structural_changes', count(*) from chg union all select 'change_candidates', count(*) from cand)
select * from n union all select 'projection', sum("rows")::bigint from n""",
    ),
    "projection_faults": (
        projection_faults,
        f"""{_A} select distinct 'assertions: no artifacts' as fault, 'set-3' as key from o where art = 'set-3' and o_orderkey % 4 > 0 union all select distinct 'reported_facts: no artifacts', 'set-3' from o where art = 'set-3' and o_orderkey % 4 = 0 and o_orderstatus <> 'P'
union all select distinct 'structural_changes: no comparisons', cmp from chg where cmp = 'cmp-4' union all select distinct 'change_candidates: no comparisons', cmp from cand where cmp in ('cmp-4', 'slice@sha256:h5')
union all select distinct 'source_assertions: no owner', 'reported_fact/' || f from o where o_orderkey % 4 = 0 and o_orderstatus = 'P'""",
    ),
}
