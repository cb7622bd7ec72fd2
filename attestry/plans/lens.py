"""Star-schema tables seen as evidence: the same integer rules in Spark and in SQL.

Each view has a Spark builder here and a common table expression in ``SQL``; queries are
written against the views, so the same operators run on real evidence tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (valid_at, known_at) of the asked questions.
DATES = (("1998-06-01", "1999-12-31"), ("2000-06-01", "2001-12-31"))
#: Activity that stands for each order priority.
ACTIVITY_OF = {
    "1-URGENT": "PAYMENT_INITIATION_SERVICES",
    "2-HIGH": "ACCOUNT_INFORMATION_SERVICES",
    "3-MEDIUM": "MONEY_REMITTANCE",
    "4-NOT SPECIFIED": "E_MONEY_ISSUANCE",
    "5-LOW": "PAYMENT_SERVICES",
}
ACTIVITIES = tuple(ACTIVITY_OF.values())
#: Views of registers and the contracts that govern them.
ALIASES = {"VIEW0": "REG0"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("legal_name"),
        F.col("c_mktsegment").alias("entity_class"),
        F.col("n_name").alias("home"),
        F.concat(F.lit("REG"), F.col("n_regionkey")).alias("register_id"),
    )


def _activity(priority: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in ACTIVITY_OF.items() for x in kv))[F.trim(priority)]


def _root(k: Column, e: Column) -> Column:
    kind = (F.floor(k / 5) % 4).cast("int")
    name = F.when(kind == 0, "PSD_PI").when(kind == 1, "PSD_AISP").when(kind == 2, "PSD_EMI").otherwise("OTHER")
    return F.when(e % 10 == 7, "ROOT|OTHER|0").when(k % 19 != 0, F.concat(F.lit("ROOT|"), name, F.lit("|"), (k % 2).cast("string")))


def _home(entity: Column) -> Column:
    return F.when(entity % 3 == 0, "ES").when(entity % 3 == 1, "FR")


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e = F.col("o_orderkey"), F.col("o_custkey")
    start = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        k.alias("assertion_id"),
        e.alias("entity_id"),
        _activity(F.col("o_orderpriority")).alias("activity"),
        F.concat(F.lit("J"), (k % 2).cast("string")).alias("jurisdiction"),
        F.when(F.col("o_orderstatus") == "F", "ENTITLED_TO_PROVIDE").when(F.col("o_orderstatus") == "O", "NOT_ENTITLED").otherwise("UNKNOWN").alias("legal_effect"),
        F.when(k % 3 == 0, "DOMESTIC").when(k % 3 == 1, "BRANCH").otherwise("FREEDOM_TO_PROVIDE_SERVICES").alias("territorial_basis"),
        start.alias("effective_from"),
        F.when(k % 4 != 0, F.date_add(start, (30 + k % 400).cast("int"))).alias("effective_to"),
        (k % 2 == 0).alias("exclusive_end"),
        (k % 17 == 0).alias("blocked"),
        _root(k, F.col("o_custkey")).alias("root_key"),
        _home(e).alias("root_home"),
        F.concat(F.lit("REG"), (k % 6).cast("string")).alias("register_id"),
        F.when((e % 11 == 0) & (k % 3 > 0), "PSP_AGENT").when(e % 11 == 1, "BANK").otherwise("PAYMENT_INSTITUTION").alias("entity_class"),
        F.when(k % 4 == 1, k + 1).alias("principal_id"),
        F.when(k % 3 == 1, "ALL_REQUIRED").alias("composition"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, n = F.to_date("l_shipdate"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("assertion_id"),
        F.when(n == 4, "VIEW0").when(n == 6, "REG9").otherwise(F.concat(F.lit("REG"), ((F.col("l_orderkey") + n % 2) % 6).cast("string"))).alias("register_id"),
        day.alias("retrieved_at"),
        F.when(n % 3 != 0, F.date_sub(day, n.cast("int"))).alias("source_as_of"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that every third order reports of its customer; the other orders report none."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    rule = F.when(k % 8 == 0, "r-agent-parent-status").when(k % 8 == 1, "r-limited-lp").when(k % 8 == 2, "r-parent-status").when(k % 8 == 3, "r-insufficient-basis").otherwise("r-status")
    known = F.when(k % 13 != 0, F.date_add(day, 10))
    return table(spark, sf_dir, "orders").where(k % 3 == 0).select(
        k.alias("fact_id"),
        F.col("o_custkey").alias("entity_id"),
        rule.alias("rule_id"),
        F.when(k % 7 < 3, "WITHDRAWN").when(k % 7 == 3, "TERRITORIAL_ENTITLEMENT_DEFERRED").otherwise("ACTIVE").alias("reported_status"),
        F.concat(F.lit("REG"), (k % 6).cast("string")).alias("register_id"),
        _root(k, F.col("o_custkey")).alias("root_key"),
        _home(F.col("o_custkey")).alias("root_home"),
        F.when(k % 5 == 0, "EXPLICIT_WITHDRAWAL").when(k % 5 == 1, "ENTITY_BAJA").when(k % 5 == 2, "UNRESOLVED_MOTIVO").alias("negative_class"),
        F.when(k % 23 != 0, day).alias("effective_from"),
        F.when(k % 4 == 1, F.array(F.struct(day.alias("from"), F.when(k % 12 == 9, F.date_add(day, 500)).alias("to")))).alias("spans"),
        known.alias("knowledge_time"),
        F.when(known.isNotNull(), F.date_add(day, (k % 9).cast("int"))).alias("fresh_at"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One register a region; the fifth has no policy, the sixth (REG5) no contract."""
    k = F.col("r_regionkey")
    every = F.array(*map(F.lit, ACTIVITIES))
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("REG"), k.cast("string")).alias("register_id"),
        F.when(k < 4, 900 + 300 * k).cast("long").alias("positive_days"),
        F.when(k < 4, 800 + 200 * k).cast("long").alias("negative_days"),
        F.when(k % 2 == 0, "COMPLETE_ENUMERATION").otherwise("EXPLICIT_NEGATIVE_ONLY").alias("capability"),
        F.when(k == 1, F.array(F.lit("BANK"))).otherwise(F.array().cast("array<string>")).alias("excluded_classes"),
        F.when(k == 2, F.array_except(every, F.array(F.lit("E_MONEY_ISSUANCE")))).otherwise(every).alias("activities"),
        F.when(k == 3, F.array(F.lit("J0"))).otherwise(F.array(F.lit("EEA"))).alias("jurisdictions"),
    )


def coverage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    few = F.array(F.lit("MONEY_REMITTANCE"), F.lit("PAYMENT_SERVICES"))
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("REG"), F.col("n_regionkey").cast("string")).alias("register_id"),
        k.cast("long").alias("ordinal"),
        F.concat(F.lit("RULE"), k.cast("string")).alias("rule_id"),
        F.when(k % 5 == 0, "OUT").otherwise("IN").alias("scope"),
        F.when(k % 7 == 3, "PSP_AGENT").alias("rule_class"),
        F.when(k % 6 == 2, few).alias("rule_activities"),
        F.when(k % 5 == 0, F.array(F.lit("J1"))).when(k % 3 == 1, F.array(F.lit("J0"), F.lit("J2"))).alias("rule_jurisdictions"),
        F.when(k % 4 == 1, F.array(F.lit("BRANCH"))).when(k % 4 == 2, F.array(F.lit("FREEDOM_TO_PROVIDE_SERVICES"), F.lit("DOMESTIC"))).alias("rule_bases"),
        F.when(k % 5 == 0, F.lit("1997-01-01")).cast("date").alias("valid_from"),
        F.when(k % 10 == 0, F.lit("1999-12-31")).cast("date").alias("valid_to"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity and activity at each pair of dates; some ask for one basis only, some for each of two."""
    dates = F.array(*(F.struct(F.lit(v).cast("date").alias("valid_at"), F.lit(k).cast("date").alias("known_at")) for v, k in DATES))
    e = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"))
    k = F.col("entity_id")
    state = F.when(k % 29 == 0, "AMBIGUOUS").when(k % 31 == 0, "NOT_FOUND").when(k % 37 == 0, "CONFLICTING_IDENTIFIERS").otherwise("EXACT")
    e = e.select("entity_id", F.explode(F.array(*map(F.lit, ACTIVITIES))).alias("activity"), dates.alias("dates"))
    return e.select(
        "entity_id",
        "activity",
        F.concat(F.lit("J"), (F.col("entity_id") % 2).cast("string")).alias("jurisdiction"),
        F.explode(F.when(k % 12 == 0, F.array(F.lit("BRANCH"), F.lit("DOMESTIC"))).otherwise(F.array(F.when(k % 6 == 0, "BRANCH")))).alias("asked_basis"),
        F.when(k % 11 == 0, F.array(F.lit("PAYMENT_INSTITUTION"), F.lit("PSP_AGENT"))).when(k % 11 == 1, F.array(F.lit("BANK"))).otherwise(F.array(F.lit("PAYMENT_INSTITUTION"))).alias("entity_classes"),
        state.alias("identity_state"),
        F.concat(F.lit("WHY_"), state).alias("identity_reason"),
        "dates",
    ).select("*", F.inline("dates")).drop("dates")


_ACTIVITIES = ", ".join(f"('{a}')" for a in ACTIVITIES)
_DATES = ", ".join(f"(date '{v}', date '{k}')" for v, k in DATES)

_CASE = "case trim(o_orderpriority) " + " ".join(f"when '{k}' then '{v}'" for k, v in ACTIVITY_OF.items()) + " end"
_ROOT = (
    "case when o_custkey % 10 = 7 then 'ROOT|OTHER|0' when o_orderkey % 19 <> 0 then 'ROOT|' || case (o_orderkey // 5) % 4 when 0 then 'PSD_PI' when 1 then 'PSD_AISP' when 2 then 'PSD_EMI' else 'OTHER' end "
    "|| '|' || (o_orderkey % 2) end"
)

SQL = f"""with entities as (
  select c_custkey as entity_id, c_name as legal_name, c_mktsegment as entity_class, n_name as home, 'REG' || n_regionkey as register_id
  from customer join nation on c_nationkey = n_nationkey),
assertions as (
  select o_orderkey as assertion_id, o_custkey as entity_id, {_CASE} as activity, 'J' || (o_orderkey % 2) as jurisdiction,
    case o_orderstatus when 'F' then 'ENTITLED_TO_PROVIDE' when 'O' then 'NOT_ENTITLED' else 'UNKNOWN' end as legal_effect,
    case o_orderkey % 3 when 0 then 'DOMESTIC' when 1 then 'BRANCH' else 'FREEDOM_TO_PROVIDE_SERVICES' end as territorial_basis,
    cast(o_orderdate as date) as effective_from,
    case when o_orderkey % 4 <> 0 then cast(o_orderdate as date) + cast(30 + o_orderkey % 400 as integer) end as effective_to,
    o_orderkey % 2 = 0 as exclusive_end, o_orderkey % 17 = 0 as blocked, {_ROOT} as root_key,
    case o_custkey % 3 when 0 then 'ES' when 1 then 'FR' end as root_home, 'REG' || (o_orderkey % 6) as register_id,
    case when o_custkey % 11 = 0 and o_orderkey % 3 > 0 then 'PSP_AGENT' when o_custkey % 11 = 1 then 'BANK' else 'PAYMENT_INSTITUTION' end as entity_class,
    case when o_orderkey % 4 = 1 then o_orderkey + 1 end as principal_id, case when o_orderkey % 3 = 1 then 'ALL_REQUIRED' end as composition
  from orders),
sources as (
  select l_orderkey as assertion_id, case l_linenumber when 4 then 'VIEW0' when 6 then 'REG9' else 'REG' || ((l_orderkey + l_linenumber % 2) % 6) end as register_id,
    cast(l_shipdate as date) as retrieved_at,
    case when l_linenumber % 3 <> 0 then cast(l_shipdate as date) - cast(l_linenumber as integer) end as source_as_of
  from lineitem),
facts as (
  select o_orderkey as fact_id, o_custkey as entity_id,
    case o_orderkey % 8 when 0 then 'r-agent-parent-status' when 1 then 'r-limited-lp' when 2 then 'r-parent-status' when 3 then 'r-insufficient-basis' else 'r-status' end as rule_id,
    case when o_orderkey % 7 < 3 then 'WITHDRAWN' when o_orderkey % 7 = 3 then 'TERRITORIAL_ENTITLEMENT_DEFERRED' else 'ACTIVE' end as reported_status,
    'REG' || (o_orderkey % 6) as register_id, {_ROOT} as root_key, case o_custkey % 3 when 0 then 'ES' when 1 then 'FR' end as root_home,
    case o_orderkey % 5 when 0 then 'EXPLICIT_WITHDRAWAL' when 1 then 'ENTITY_BAJA' when 2 then 'UNRESOLVED_MOTIVO' end as negative_class,
    case when o_orderkey % 23 <> 0 then cast(o_orderdate as date) end as effective_from,
    case when o_orderkey % 4 = 1 then cast(o_orderdate as date) end as span_from,
    case when o_orderkey % 12 = 9 then cast(o_orderdate as date) + 500 end as span_to,
    case when o_orderkey % 13 <> 0 then cast(o_orderdate as date) + 10 end as knowledge_time,
    case when o_orderkey % 13 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 9 as integer) end as fresh_at
  from orders where o_orderkey % 3 = 0),
contracts as (
  select 'REG' || r_regionkey as register_id, case when r_regionkey < 4 then 900 + 300 * r_regionkey end as positive_days,
    case when r_regionkey < 4 then 800 + 200 * r_regionkey end as negative_days,
    case when r_regionkey % 2 = 0 then 'COMPLETE_ENUMERATION' else 'EXPLICIT_NEGATIVE_ONLY' end as capability,
    r_regionkey = 1 as without_banks, r_regionkey = 2 as without_e_money, r_regionkey = 3 as only_j0
  from region),
coverage_rules as (
  select 'REG' || n_regionkey as register_id, n_nationkey as ordinal, 'RULE' || n_nationkey as rule_id,
    case when n_nationkey % 5 = 0 then 'OUT' else 'IN' end as scope,
    case when n_nationkey % 7 = 3 then 'PSP_AGENT' end as rule_class,
    case when n_nationkey % 6 = 2 then ['MONEY_REMITTANCE', 'PAYMENT_SERVICES'] end as rule_activities,
    case when n_nationkey % 5 = 0 then ['J1'] when n_nationkey % 3 = 1 then ['J0', 'J2'] end as rule_jurisdictions,
    case n_nationkey % 4 when 1 then ['BRANCH'] when 2 then ['FREEDOM_TO_PROVIDE_SERVICES', 'DOMESTIC'] end as rule_bases,
    case when n_nationkey % 5 = 0 then date '1997-01-01' end as valid_from,
    case when n_nationkey % 10 = 0 then date '1999-12-31' end as valid_to
  from nation),
questions as (
  select c_custkey as entity_id, a.activity, 'J' || (c_custkey % 2) as jurisdiction,
    unnest(case when c_custkey % 12 = 0 then ['BRANCH', 'DOMESTIC'] when c_custkey % 6 = 0 then ['BRANCH'] else [null] end) as asked_basis, d.valid_at, d.known_at,
    case c_custkey % 11 when 0 then ['PAYMENT_INSTITUTION', 'PSP_AGENT'] when 1 then ['BANK'] else ['PAYMENT_INSTITUTION'] end as entity_classes,
    case when c_custkey % 29 = 0 then 'AMBIGUOUS' when c_custkey % 31 = 0 then 'NOT_FOUND' when c_custkey % 37 = 0 then 'CONFLICTING_IDENTIFIERS' else 'EXACT' end as identity_state
  from customer, (values {_ACTIVITIES}) a(activity), (values {_DATES}) d(valid_at, known_at))
"""
