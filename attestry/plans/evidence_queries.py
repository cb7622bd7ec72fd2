"""Queries of scalars, identity, claims, rules, snapshots and projection, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions import conditions as C
from attestry.functions import scalars as S
from attestry.operators import claims as CL
from attestry.operators import identity as I
from attestry.operators import longitudinal as LG
from attestry.operators import projection as P
from attestry.operators import rules as R
from attestry.plans import lens as L

_T = L.table


# --- scalars -------------------------------------------------------------------------------


def lei_diagnostic(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    body = F.concat(F.lit("5493"), F.lpad(k.cast("string"), 14, "0"))
    check = F.lpad((98 - _mod97(body)).cast("string"), 2, "0")
    lei = (
        F.when(k % 5 == 0, F.concat(body, check)).when(k % 5 == 1, F.concat(F.lit(" "), F.lower(body), F.lit("00"))).when(k % 5 == 2, F.substring(body, 1, 15)).when(k % 5 == 3, F.concat(F.lit("*"), F.substring(body, 2, 17), F.lit("00"))).otherwise(F.lit(" "))
    )
    return _T(s, d, "part").select("p_partkey", S.lei_diagnostic(lei).alias("diagnostic"))


def _mod97(body):
    # "5493" and zero-padded digits only, so the number itself fits a decimal
    return (F.concat(body, F.lit("00")).cast("decimal(20,0)") % 97).cast("int")


def tax_id_checksum(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    n = (k * 7919) % 100000000
    nif = F.concat(F.lpad(n.cast("string"), 8, "0"), F.substring(F.lit(S.NIF_LETTERS), (n % 23 + 1).cast("int"), F.lit(1)))
    made = F.when(k % 3 == 0, nif).when(k % 3 == 1, F.concat(F.substring(nif, 1, 8), F.lit("I"))).otherwise(F.lit("12345"))
    return _T(s, d, "supplier").select("s_suppkey", S.valid_tax_id(made).alias("valid"))


def strict_iso_date(s: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-M-d")).when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM-dd")).otherwise(F.lit("1999-13-01"))
    return _T(s, d, "orders").select("o_orderkey", S.strict_date(text).isNotNull().alias("ok"))


def ddmmyyyy_parse(s: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit(" "), F.date_format("o_orderdate", "d/M/yyyy"))
    return _T(s, d, "orders").select("o_orderkey", S.spanish_date(F.when(F.col("o_orderkey") % 4 == 0, F.lit("31/02/2000")).otherwise(text)).alias("parsed"))


def name_normalise(s: SparkSession, d: str) -> DataFrame:
    return _T(s, d, "customer").select("c_custkey", S.normal_name(F.concat(F.lit("  "), F.lower("c_name"), F.lit("  \t x "))).alias("name"))


def split_iterate(s: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws("|", F.col("p_brand"), F.lit(" "), F.col("p_type"), F.col("p_brand"))
    return _T(s, d, "part").select("p_partkey", F.posexplode(S.split_items(text)).alias("pos", "item")).select("p_partkey", F.col("pos").cast("long").alias("pos"), "item")


def absent_from_set(s: SparkSession, d: str) -> DataFrame:
    seen = L.assertions(s, d).groupBy("entity_id").agg(F.collect_set("activity").alias("seen"))
    item = R.Iterate("seen", "ABSENT_FROM_SET", universe=L.ACTIVITIES).items()
    return seen.select("entity_id", F.explode(item).alias("activity"))


def condition_ops(s: SparkSession, d: str) -> DataFrame:
    o = _T(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).when(F.col("o_orderkey") % 5 == 1, "").otherwise(F.col("o_orderstatus")).alias("v"))
    v = F.col("v")
    return o.select("o_orderkey", C.equals(v, None).alias("eq_null"), C.equals(v, "F").alias("eq_f"), C.present(v).alias("not_null"), C.one_of(v, ["F", "O"]).alias("is_in"), C.none_of(v, ["F", "O"]).alias("not_in"))


def template_interpolate(s: SparkSession, d: str) -> DataFrame:
    c = _T(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"))
    return c.select("c_custkey", S.template("entity {c_custkey} of {segment}", {"c_custkey": F.col("c_custkey"), "segment": F.col("segment")}).alias("text"))


def canonical_hash(s: SparkSession, d: str) -> DataFrame:
    return _T(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


def json_property(s: SparkSession, d: str) -> DataFrame:
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    return _T(s, d, "events").select("event_id", k.alias("k"))


def html_title_extract(s: SparkSession, d: str) -> DataFrame:
    p = _T(s, d, "pages")
    links = F.size(F.regexp_extract_all("html", F.lit(r"<a href=\"[^\"]*\""), F.lit(0)))
    return p.select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), links.cast("long").alias("n_links"))


def _register_fields(s: SparkSession, d: str) -> DataFrame:
    """Parts as register entries with the texts that derived fields are made from."""
    k = F.col("p_partkey")
    return _T(s, d, "part").select(
        "p_partkey",
        F.when(k % 7 != 0, F.concat(F.lit("a. x; "), F.when(k % 2 == 0, "c. y").otherwise("bc. y"), F.when(k % 3 == 0, " | j.z").otherwise(""))).alias("services"),
        F.when(k % 5 != 0, F.concat(F.lit("FR| ES|"), F.when(k % 2 == 0, "DE").otherwise("FR"))).alias("countries"),
        F.when(k % 3 == 0, "FR").when(k % 3 == 1, "ES").alias("home"),
        F.when(k % 4 == 0, "IE_CBI!C1").when(k % 4 == 1, "PSD_PI!PT_BP!87").when(k % 4 == 2, "plain").alias("code"),
        F.when(k % 8 == 0, "LIMITED PSC EN REGIMEN DE LP").when(k % 8 == 1, "psc en régimen de lp").when(k % 8 == 2, "PSC a través de sucursal").when(k % 8 == 3, "PSC (España)").when(k % 8 == 4, " ").when(k % 8 == 5, "x").alias("category"),
        F.when(k % 4 == 1, "Fusión por absorción").when(k % 4 == 2, "Renuncia").when(k % 4 == 3, "otra").alias("reason"),
        F.when(k % 6 != 0, "01/02/2020").otherwise("").alias("closed_on"),
        F.when(k % 9 != 0, F.lit("2020-01-01")).cast("date").alias("one"), F.when(k % 2 == 0, F.lit("2020-01-01")).when(k % 11 != 0, F.lit("2020-01-02")).cast("date").alias("other"),
    )


def register_derived_fields(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    services = F.array(F.create_map(F.lit("ES"), F.array(F.lit("PS_2"), c("home"))), F.create_map(F.lit("FR"), F.array(F.lit("PS_9"))), F.create_map(F.lit("ES"), F.array(F.lit("PS_1"), F.lit("PS_2"))))
    return _register_fields(s, d).select(
        "p_partkey", S.service_letters(c("services")).alias("letters"), S.foreign_countries(c("countries"), c("home")).alias("foreign_list"), S.lists_country(c("countries")).alias("es_listed"),
        S.authority_code(c("code")).alias("authority"), S.territorial_route(c("category")).alias("route"), S.closure_kind(c("closed_on"), c("reason")).alias("closure"),
        S.dates_agree(c("one"), c("other")).alias("agree"), F.array_join(F.array_compact(S.country_services(services, "ES")), "|").alias("es_codes"),
        S.plain_header(F.concat(F.lit("  Código \t De "), "category")).alias("header"), S.is_valid_lei(F.concat(F.lit("529900T8BM49AURSDO5"), (c("p_partkey") % 10).cast("string"))).alias("lei_ok"),
        S.slug("ES", F.concat(F.lit("A-"), c("p_partkey").cast("string"))).alias("slug"), S.calendar_date(F.concat(c("one").cast("string"), F.lit("T10:00:00Z"))).alias("day"),
    )


_REGISTER_FIELDS = """with r as (select p_partkey as k,
  case when p_partkey % 5 <> 0 then case when p_partkey % 2 = 0 then ['FR', 'ES', 'DE'] else ['FR', 'ES', 'FR'] end end as countries,
  case p_partkey % 3 when 0 then 'FR' when 1 then 'ES' end as home,
  case p_partkey % 8 when 0 then 'LIMITED PSC EN REGIMEN DE LP' when 1 then 'psc en régimen de lp' when 2 then 'PSC a través de sucursal' when 3 then 'PSC (España)' when 4 then ' ' when 5 then 'x' end as category,
  case when p_partkey % 9 <> 0 then date '2020-01-01' end as one, case when p_partkey % 2 = 0 then date '2020-01-01' when p_partkey % 11 <> 0 then date '2020-01-02' end as other from part)
select k as p_partkey, case when k % 7 <> 0 then 'a' || case when k % 2 = 0 then '|c' else '' end || case when k % 3 = 0 then '|j' else '' end end as letters,
  nullif(array_to_string(list_filter(countries, lambda x: x is distinct from home), '|'), '') as foreign_list, case when countries is not null then 'TRUE' end as es_listed,
  case k % 4 when 0 then 'IE_CBI' when 1 then 'PT_BP' end as authority,
  case k % 8 when 0 then 'LIMITED_LP' when 1 then 'LP' when 2 then 'BRANCH' when 3 then 'DOMESTIC' when 5 then 'OTHER' end as route,
  case when k % 6 <> 0 then case k % 4 when 1 then 'TRANSFORMATION' when 2 then 'WITHDRAWAL' else 'UNRESOLVED_MOTIVO' end end as closure,
  case when one = other then 'TRUE' when one is not null and other is not null then 'FALSE' end as agree,
  'PS_2' || coalesce('|' || home, '') || '|PS_1' as es_codes,
  case k % 8 when 0 then 'codigo de limited psc en regimen de lp' when 1 then 'codigo de psc en regimen de lp' when 2 then 'codigo de psc a traves de sucursal' when 3 then 'codigo de psc (espana)' when 4 then 'codigo de' when 5 then 'codigo de x' end as header,
  k % 10 = 5 as lei_ok, 'ES-a' || k as slug, one as day from r"""


def effective_dates(s: SparkSession, d: str) -> DataFrame:
    """Dates of orders by each derivation, and whether a rule may use them."""
    k = F.col("o_orderkey")
    o = _T(s, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    iso, es = F.when(k % 3 != 0, F.col("day").cast("string")), F.when(k % 3 != 1, F.date_format("day", "dd/MM/yyyy")).otherwise("31/02/2020")
    log = F.slice(F.array("day", F.date_add("day", 1), F.date_add("day", 2)), F.lit(1), (k % 4).cast("int"))
    kinds = {"CONSTANT_NULL": None, "EVIDENCE_AS_OF": None, "FIELD_COPY": iso, "FIELD_COPY_OR_NULL": iso, "FIELD_DDMMYYYY": es, "FIELD_DDMMYYYY_OR_NULL": es, "LAST_AUTHORISATION": log}
    each = [F.struct(F.lit(n).alias("kind"), R.effective_date(n, c, F.col("day")).alias("e")) for n, c in kinds.items()]
    return o.select("o_orderkey", F.explode(F.array(*each)).alias("x")).select("o_orderkey", "x.kind", "x.e.day", "x.e.ok")


_EFFECTIVE = """with o as (select o_orderkey as k, cast(o_orderdate as date) as d from orders), e as (
  select k, 'CONSTANT_NULL' as kind, cast(null as date) as day, true as ok from o union all select k, 'EVIDENCE_AS_OF', d, true from o
  union all select k, 'FIELD_COPY', case when k % 3 <> 0 then d end, k % 3 <> 0 from o union all select k, 'FIELD_COPY_OR_NULL', case when k % 3 <> 0 then d end, true from o
  union all select k, 'FIELD_DDMMYYYY', case when k % 3 <> 1 then d end, k % 3 <> 1 from o union all select k, 'FIELD_DDMMYYYY_OR_NULL', case when k % 3 <> 1 then d end, true from o
  union all select k, 'LAST_AUTHORISATION', case k % 4 when 1 then d when 2 then d when 3 then d + 2 end, k % 4 <> 0 from o)
select k as o_orderkey, kind, day, ok from e"""


def run_uuid(s: SparkSession, d: str) -> DataFrame:
    return _T(s, d, "customer").select("c_custkey", S.uuid5(S.NAMESPACE_URL, F.col("c_name")).alias("run_id"))


# --- identity ------------------------------------------------------------------------------


def _identifiers(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return _T(s, d, "supplier").select(k.alias("entity_id"), F.lit("VAT").alias("kind"), F.concat(F.lit("v"), (k % 37).cast("string")).alias("value"))


def identity_by_identifier(s: SparkSession, d: str) -> DataFrame:
    asked = _T(s, d, "part").select(F.col("p_partkey").alias("question_id"), F.lit("VAT").alias("kind"), F.concat(F.lit(" V"), (F.col("p_partkey") % 90).cast("string")).alias("value"))
    return I.by_identifier(asked, _identifiers(s, d))


def _names(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _T(s, d, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.concat(F.lit("Firm  "), (F.col("s_suppkey") % 61).cast("string")).alias("legal_name"))
    return _T(s, d, "part").select(F.col("p_partkey").alias("question_id"), F.concat(F.lit(" firm "), (F.col("p_partkey") % 80).cast("string")).alias("name")), e


def identity_by_name(s: SparkSession, d: str) -> DataFrame:
    return I.by_name(*_names(s, d))


def identifier_adoption(s: SparkSession, d: str) -> DataFrame:
    ids = _identifiers(s, d).withColumn("kind", F.when(F.col("entity_id") % 2 == 0, "LEI").otherwise("VAT"))
    return I.adopted(*_names(s, d), ids, "LEI")


# --- claims --------------------------------------------------------------------------------


def claim_unpivot(s: SparkSession, d: str) -> DataFrame:
    return CL.unpivoted(_T(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), ["s_suppkey"], ["s_name", "s_nationkey"])


def claim_group(s: SparkSession, d: str) -> DataFrame:
    o = L.assertions(s, d)
    claims = o.select("entity_id", F.col("activity").alias("field"), F.col("legal_effect").alias("raw_value"), F.col("assertion_id").alias("ord"), F.col("assertion_id").cast("string").alias("claim_id"))
    g = CL.grouped(claims, ["entity_id"], "ord")
    text = F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return g.select("entity_id", text.alias("fields"), F.array_join("claim_ids", ",").alias("claim_ids"))


def claim_verify(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    base = _T(s, d, "orders").select(k.cast("string").alias("claim_id"), F.col("o_orderstatus").alias("raw_value"), F.lower("o_orderstatus").alias("normal_value"), k.alias("k"))
    again = base.where(F.col("k") % 11 != 0).select("claim_id", F.when(F.col("k") % 7 == 0, "?").otherwise(F.col("raw_value")).alias("raw_value"), F.when(F.col("k") % 5 == 0, "!").otherwise(F.col("normal_value")).alias("normal_value"))
    return CL.verified(base, again)


def parent_child_join(s: SparkSession, d: str) -> DataFrame:
    parents = _T(s, d, "nation").where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("parent_key"), F.col("n_name").alias("status"), F.col("n_nationkey").alias("ord"))
    kids = _T(s, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey")).alias("parent_key"))
    return CL.with_parent(kids, parents, "parent_key", "status").select("s_suppkey", "parent_value")


def primary_register_join(s: SparkSession, d: str) -> DataFrame:
    o = _T(s, d, "orders").select(F.col("o_custkey").alias("entity_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("ord"))
    return CL.primary(o, "entity_id", "status")


def root_key_inherit(s: SparkSession, d: str) -> DataFrame:
    parents = _T(s, d, "nation").select(F.col("n_regionkey").alias("g"), F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("root_key")).where("g < 2 or root_key in ('P8', 'P9', 'P12')")
    kids = _T(s, d, "customer").select("c_custkey", (F.col("c_custkey") % 6).cast("int").alias("g"))
    return CL.inherited_root(kids, parents, "g", F.concat(F.lit("OWN"), F.col("c_custkey").cast("string"))).select("c_custkey", "root_key")


def derived_dedup(s: SparkSession, d: str) -> DataFrame:
    return CL.first_per_key(L.assertions(s, d), ["entity_id", "activity"], ["assertion_id"]).select("entity_id", "activity", "assertion_id", "legal_effect")


def orphan_claims(s: SparkSession, d: str) -> DataFrame:
    c = _T(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).otherwise("").alias("n"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")).alias("m"))
    return CL.orphans(c, ["n", "m"]).select("c_custkey")


# --- rules ---------------------------------------------------------------------------------

RULES = [
    R.Rule("R-OPEN", "F", (("priority", "IN", ["1-URGENT", "2-HIGH"]),), ("customer",), "EMIT", emit={"activity": "{priority}", "legal_effect": "{status}", "detail": "open for {customer}"}, mapping={"legal_effect": {"F": "ENTITLED"}}),
    R.Rule("R-PER", "O", (("priority", "NOT_IN", ["5-LOW"]),), (), "EMIT_PER", R.Iterate("codes", "SPLIT"), {"activity": "$ITEM", "legal_effect": "NOT_ENTITLED"}),
    R.Rule("R-FACT", "P", (("customer", "NOT_NULL"),), (), "STATUS_FACT", emit={"detail": "status {status}"}),
    R.Rule("R-FIND", "P", (("customer", "NULL"),), (), "FINDING", emit={"detail": "no customer"}),
]


def _groups(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _T(s, d, "orders").select(
        k.alias("gid"), F.col("o_orderstatus").alias("source"), F.col("o_orderstatus").alias("status"), F.trim("o_orderpriority").alias("priority"),
        F.when(k % 13 != 0, F.col("o_custkey").cast("string")).alias("customer"), F.concat_ws("|", F.lit("A"), (k % 3).cast("string"), F.lit(""), F.lit("A")).alias("codes"),
    )


def rule_derivation(s: SparkSession, d: str) -> DataFrame:
    r = R.derive(_groups(s, d), RULES, "gid")
    return r.select("gid", "rule_id", F.col("item_ord").cast("long").alias("item_ord"), "kind", "activity", "legal_effect", "detail")


def derived_second_pass(s: SparkSession, d: str) -> DataFrame:
    r = R.second_pass(R.derive(_groups(s, d), RULES, "gid"), "gid", {"rule_id": "R-OPEN"}, {"legal_effect": "ENTITLED_ABROAD"})
    return r.select("gid", "activity", "legal_effect")


def sequential_ids(s: SparkSession, d: str) -> DataFrame:
    r = R.derive(_groups(s, d), RULES, "gid").where("kind <> 'FINDING'")
    return R.numbered(r, "gid").select("gid", "rule_id", F.col("item_ord").cast("long").alias("item_ord"), "seq")


_GROUPS = """with g as (
  select o_orderkey as gid, o_orderstatus as status, trim(o_orderpriority) as priority, case when o_orderkey % 13 <> 0 then cast(o_custkey as varchar) end as customer,
    cast(o_orderkey % 3 as varchar) as code from orders),
r as (
  select gid, 'R-OPEN' as rule_id, 0 as rule_ord, 0 as item_ord, case when customer is null then 'FINDING' else 'EMIT' end as kind,
    case when customer is not null then priority end as activity, case when customer is not null then 'ENTITLED' end as legal_effect,
    case when customer is null then 'missing customer' else 'open for ' || customer end as detail from g where status = 'F' and priority in ('1-URGENT', '2-HIGH')
  union all select gid, 'R-PER', 1, 0, 'EMIT_PER', 'A', 'NOT_ENTITLED', null from g where status = 'O' and priority <> '5-LOW'
  union all select gid, 'R-PER', 1, 1, 'EMIT_PER', code, 'NOT_ENTITLED', null from g where status = 'O' and priority <> '5-LOW'
  union all select gid, 'R-FACT', 2, 0, 'STATUS_FACT', null, null, 'status P' from g where status = 'P' and customer is not null
  union all select gid, 'R-FIND', 3, 0, 'FINDING', null, null, 'no customer' from g where status = 'P' and customer is null)
"""


# --- snapshots -----------------------------------------------------------------------------


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as records of two snapshots: a name, a set of codes and a log of dates."""
    k = F.col("record_key")
    day = lambda n: F.date_add("day", n).cast("string")
    text = lambda *items: F.to_json(F.array(*items))
    o = _T(s, d, "orders").select(F.col("o_orderkey").alias("record_key"), F.col("o_orderstatus").alias("name"), F.substring(F.trim("o_orderpriority"), 1, 1).alias("p"), F.to_date("o_orderdate").alias("day"))
    code = F.concat(F.lit("PS_"), "p")
    left = o.where(k % 10 != 0).select("record_key", F.col("name").alias("properties.ENT_NAM"), code.alias("services.ES"), text(day(0), day(9)).alias("properties.ENT_AUT"))
    log = F.when(k % 4 == 1, text(day(0), day(9), day(20))).when(k % 4 == 2, text(day(0), day(9), day(20), day(30))).when(k % 4 == 3, text(day(1), day(9), day(20))).otherwise(text(day(0), day(9)))
    codes = F.when(k % 6 == 0, text(code, F.lit("PS_9"))).when(k % 6 == 1, F.lit("PS_8")).when(k % 6 != 2, code)
    right = o.where(k % 10 != 1).select("record_key", F.when(k % 7 == 0, "X").otherwise(F.col("name")).alias("properties.ENT_NAM"), codes.alias("services.ES"), log.alias("properties.ENT_AUT"))

    def long(x: DataFrame) -> DataFrame:
        return x.unpivot(["record_key"], [F.col(f"`{c}`") for c in x.columns[1:]], "path", "value")

    return long(left), long(right).where("not (path = 'services.ES' and record_key % 12 = 5)")


_SIDES = """with o as (select o_orderkey as record_key, o_orderstatus as name, 'PS_' || substr(trim(o_orderpriority), 1, 1) as code, cast(o_orderdate as date) as day from orders),
n as (select record_key, name, code, day, '["' || day || '","' || (day + 9) || '"' as log from o),
l as (select record_key, 'properties.ENT_NAM' as path, name as value from n where record_key % 10 <> 0 union all select record_key, 'services.ES', code from n where record_key % 10 <> 0
  union all select record_key, 'properties.ENT_AUT', log || ']' from n where record_key % 10 <> 0),
r as (select record_key, 'properties.ENT_NAM' as path, case when record_key % 7 = 0 then 'X' else name end as value from n where record_key % 10 <> 1
  union all select record_key, 'services.ES', case record_key % 6 when 0 then '["' || code || '","PS_9"]' when 1 then 'PS_8' when 2 then null else code end from n where record_key % 10 <> 1 and record_key % 12 <> 5
  union all select record_key, 'properties.ENT_AUT', case record_key % 4 when 1 then log || ',"' || (day + 20) || '"]' when 2 then log || ',"' || (day + 20) || '","' || (day + 30) || '"]'
    when 3 then '["' || (day + 1) || '","' || (day + 9) || '","' || (day + 20) || '"]' else log || ']' end from n where record_key % 10 <> 1),
rec as (select coalesce(a.record_key, b.record_key) as record_key, a.record_key is not null as in_l, b.record_key is not null as in_r
  from (select distinct record_key from l) a full join (select distinct record_key from r) b on a.record_key = b.record_key),
ch as (
  select record_key, case when not in_l then 'added' else 'removed' end as kind, cast(null as varchar) as change, '' as path, cast(null as varchar) as old, cast(null as varchar) as new from rec where not (in_l and in_r)
  union all
  select coalesce(l.record_key, r.record_key), 'changed', case when l.record_key is null then 'added' when r.record_key is null then 'removed' else 'changed' end, coalesce(l.path, r.path), l.value, r.value
  from l full join r on l.record_key = r.record_key and l.path = r.path
  where coalesce(l.record_key, r.record_key) in (select record_key from rec where in_l and in_r)
    and (l.record_key is null or r.record_key is null or l.value is distinct from r.value))
"""


def snapshot_diff(s: SparkSession, d: str) -> DataFrame:
    return LG.structural_diff(*_sides(s, d), "record_key", "path", "value")


def _observation_pairs(s: SparkSession, d: str) -> DataFrame:
    """A pair of observations a nation, in all states that a pair can be in."""
    k = F.col("n_nationkey")
    day = F.lit("2024-03-01").cast("date")
    side = lambda name, **c: [v.alias(f"{name}_{f}") for f, v in c.items()]
    series = F.when(k % 6 == 5, "other-register|x").otherwise("eba-psd2-register|all")
    left = side("left", register_id=F.lit("REG"), series_key=series, content_hash=F.sha2(k.cast("string"), 256), retrieved_at=day, source_as_of=F.when(k % 8 != 1, day), completeness=F.lit("complete"), normalization=F.lit("V1"))
    as_of = F.when(k % 8 == 2, day).when(k % 8 == 3, F.date_sub(day, 5)).when(k % 8 != 4, F.date_add(day, 7))
    right = side("right", register_id=F.lit("REG"), series_key=F.when(k == 24, "third").otherwise(series), content_hash=F.sha2(F.when(k % 9 == 8, k).otherwise(-k).cast("string"), 256), retrieved_at=F.date_add(day, 9), source_as_of=as_of, completeness=F.when(k % 3 == 0, "partial").otherwise("complete"), normalization=F.when(k % 11 == 10, "V2").otherwise("V1"))
    return _T(s, d, "nation").select(k.cast("long").alias("pair"), *left, *right)


def observation_comparison(s: SparkSession, d: str) -> DataFrame:
    c = LG.compared(_observation_pairs(s, d))
    return c.select("pair", "left_observation_id", "right_observation_id", "invocation_error", "succession_state", "comparable", "identical_content", "removal_admissible", F.array_join("findings", ",").alias("findings"))


_PAIRED = """k as (select cast(n_nationkey as bigint) as pair, case when n_nationkey % 6 = 5 then 'other-register|x' else 'eba-psd2-register|all' end as series from nation),
c as (
  select pair, series, 'REG|2024-03-01|' || substr(sha256(cast(pair as varchar)), 1, 16) as left_observation_id,
    'REG|2024-03-10|' || substr(sha256(cast(case when pair % 9 = 8 then pair else -pair end as varchar)), 1, 16) as right_observation_id,
    case when pair = 24 then 'SERIES_DIFFER' end as invocation_error,
    case when pair % 8 in (1, 4) then 'UNKNOWN_SOURCE_AS_OF' when pair % 8 = 2 then 'SAME_AS_OF_REVISION' when pair % 8 = 3 then 'SOURCE_AS_OF_REGRESSION' else 'NORMAL_SUCCESSION' end as succession_state,
    pair % 11 <> 10 as comparable, pair % 9 = 8 or pair = 0 as identical_content, pair % 3 <> 0 as removal_admissible from k)
"""


def change_classify(s: SparkSession, d: str) -> DataFrame:
    changes = snapshot_diff(s, d).withColumn("pair", F.col("record_key") % 25)
    return LG.classified(changes, LG.compared(_observation_pairs(s, d)), "record_key", "pair")


def changes_of_records(s: SparkSession, d: str) -> DataFrame:
    asked = _T(s, d, "customer").select((F.col("c_custkey") * 4).alias("record_key"))
    return LG.changes_of(snapshot_diff(s, d), "record_key", asked).select("record_key", "kind", "path")


def record_normalise(s: SparkSession, d: str) -> DataFrame:
    """Suppliers as register records: a name twice in some, lists in any order, an empty service."""
    k = F.col("s_suppkey")
    twice = F.when(k % 10 == 0, F.lit(',{"ENT_NAM":"again"}')).otherwise(F.lit(""))
    text = F.concat(
        F.lit('{"EntityType":"PSD_PI","EntityCode":"'), (k - F.when(k % 50 == 1, 0).otherwise(0)).cast("string"), F.lit('","CA_OwnerID":'), F.when(k % 3 == 0, F.lit("null")).otherwise(F.lit('"ES_BE"')),
        F.lit(',"Properties":[{"ENT_NAM":"'), "s_name", F.lit('"}'), twice, F.lit(',{"ENT_TYP":["b","a"]}],"Services":[{"ES":["PS_2","PS_1"]},{"FR":"PS_3"}]}'),
    )
    return LG.normalized(_T(s, d, "supplier").select(text.alias("record")))


def _logs(s: SparkSession, d: str) -> DataFrame:
    return _T(s, d, "orders").groupBy(F.col("o_custkey").alias("entity_id")).agg(F.array_sort(F.collect_set(F.to_date("o_orderdate"))).alias("log"))


def transition_log_intervals(s: SparkSession, d: str) -> DataFrame:
    return _logs(s, d).select("entity_id", F.explode(LG.intervals_of_log(F.col("log"))).alias("i")).select("entity_id", F.col("i.from").alias("valid_from"), F.col("i.to").alias("valid_to"))


def last_authorisation(s: SparkSession, d: str) -> DataFrame:
    return _logs(s, d).select("entity_id", LG.last_authorisation(F.col("log")).alias("authorised"))


def append_only_check(s: SparkSession, d: str) -> DataFrame:
    logs = _logs(s, d).where(F.size("log") >= 2)
    old = F.when(F.col("entity_id") % 3 == 0, F.slice("log", F.lit(2), F.size("log") - 1)).otherwise(F.slice("log", F.lit(1), F.size("log") - 1 - (F.col("entity_id") % 2).cast("int")))
    return LG.log_candidates(logs.select("entity_id", old.alias("old_log"), F.col("log").alias("new_log")), "entity_id")


def set_diff_codes(s: SparkSession, d: str) -> DataFrame:
    codes = lambda name: F.array_sort(F.collect_set(F.when(F.col("assertion_id") % 4 != name, F.col("activity")))).alias
    c = L.assertions(s, d).groupBy("entity_id").agg(codes(0)("old_codes"), codes(1)("new_codes"))
    return LG.code_candidates(c, "entity_id")


def series_succession(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    obs = _T(s, d, "orders").select(
        F.col("o_custkey").alias("series"), k.alias("observation_id"), F.to_date("o_orderdate").alias("retrieved_at"),
        F.when(k % 5 != 0, F.date_sub(F.trunc("o_orderdate", "year"), (k % 2 * 400).cast("int"))).alias("source_as_of"), (k % 4).alias("content_hash"),
    )
    return LG.successors(obs, "series")


# --- projection ----------------------------------------------------------------------------


def projection_digest(s: SparkSession, d: str) -> DataFrame:
    a = L.assertions(s, d).select("assertion_id", "entity_id", "activity", "legal_effect", "effective_to")
    return P.table_digest(a, "assertion_id", ["entity_id", "activity", "legal_effect", "effective_to"])


def search_terms(s: SparkSession, d: str) -> DataFrame:
    e = L.entities(s, d).withColumns({"alias": F.when(F.col("entity_id") % 3 == 0, F.col("home")).otherwise(""), "legal_name": F.col("legal_name")})
    return e.select("entity_id", F.array_join(P.search_terms("legal_name", "alias", "entity_class"), "|").alias("terms"))


def timeline_union(s: SparkSession, d: str) -> DataFrame:
    a, f = L.assertions(s, d), L.facts(s, d)
    return P.timeline(
        a.select("entity_id", F.col("effective_from").alias("day"), F.lit("STARTED").alias("kind")),
        a.where("effective_to is not null").select("entity_id", F.col("effective_to").alias("day"), F.lit("ENDED").alias("kind")),
        f.where("negative_class is not null").select("entity_id", F.col("effective_from").alias("day"), F.col("negative_class").alias("kind")),
    )


def coverage_denominators(s: SparkSession, d: str) -> DataFrame:
    a = L.assertions(s, d).groupBy("entity_id").agg(
        F.count_if(F.col("legal_effect") == "ENTITLED_TO_PROVIDE").alias("n_entitled"), F.count_if(F.col("blocked")).alias("n_blocked"), F.size(F.collect_set("root_key")).cast("long").alias("n_roots")
    )
    out = L.entities(s, d).select("entity_id").join(a, "entity_id", "left").fillna(0)
    return out.select("*", F.when(F.col("n_entitled") > 0, "COVERED").when(F.col("n_roots") > 0, "PARTIAL").otherwise("UNKNOWN").alias("permissions"))


def orphan_refs(s: SparkSession, d: str) -> DataFrame:
    return P.orphan_refs(L.assertions(s, d).select("assertion_id"), L.sources(s, d), "assertion_id")


def lineage_edges(s: SparkSession, d: str) -> DataFrame:
    jobs = L.assertions(s, d).groupBy(F.concat(F.lit("derive-"), F.col("entity_id").cast("string")).alias("job")).agg(
        F.collect_set("register_id").alias("inputs"), F.collect_set("root_key").alias("outputs")
    )
    return P.lineage_edges(jobs)


def lineage_events(s: SparkSession, d: str) -> DataFrame:
    runs = L.entities(s, d).select("entity_id", F.md5(F.concat(F.lit("run/"), F.col("entity_id").cast("string"))).alias("run_id"), F.concat(F.lit("derive-"), "home").alias("job"))
    return P.lineage_events(runs)


def name_mentions(s: SparkSession, d: str) -> DataFrame:
    notices = _T(s, d, "documents").select(F.col("doc_id").alias("notice_id"), "text")
    e = _T(s, d, "benchmark").select(F.col("item_id").alias("entity_id"), F.concat(F.element_at(F.split("text", " "), 2), F.lit(", S.A.")).alias("legal_name"))
    return P.name_mentions(notices, e)


_IDS = "ids as (select s_suppkey as entity_id, 'VAT|V' || (s_suppkey % 37) as key from supplier)"
_NAMES = """e as (select s_suppkey as entity_id, 'FIRM ' || (s_suppkey % 61) as key from supplier),
q as (select p_partkey as question_id, 'FIRM ' || (p_partkey % 80) as key from part)"""
_LOGS = """logs as (select o_custkey as entity_id, cast(o_orderdate as date) as day from orders group by all),
n as (select entity_id, day, row_number() over (partition by entity_id order by day) as i, count(*) over (partition by entity_id) as c,
  lead(day) over (partition by entity_id order by day) as nxt from logs)"""

QUERIES = {
    "lei_diagnostic": (lei_diagnostic, "select p_partkey, case p_partkey % 5 when 0 then 'VALID' when 1 then case when lpad(cast(98 - (cast('5493' || lpad(cast(p_partkey as varchar), 14, '0') || '00' as hugeint) % 97) as varchar), 2, '0') = '00' then 'VALID' else 'INVALID_CHECK_DIGITS' end when 2 then 'INVALID_LENGTH' when 3 then 'INVALID_CHARSET' else 'MISSING' end as diagnostic from part"),
    "tax_id_checksum": (tax_id_checksum, f"select s_suppkey, s_suppkey % 3 = 0 as valid from supplier where 'I' <> '{S.NIF_LETTERS[0]}'"),
    "strict_iso_date": (strict_iso_date, "select o_orderkey, case o_orderkey % 3 when 0 then month(o_orderdate) >= 10 and day(o_orderdate) >= 10 when 1 then true else false end as ok from orders"),
    "ddmmyyyy_parse": (ddmmyyyy_parse, "select o_orderkey, case when o_orderkey % 4 <> 0 then cast(o_orderdate as date) end as parsed from orders"),
    "name_normalise": (name_normalise, "select c_custkey, upper(trim(regexp_replace('  ' || lower(c_name) || '  ' || chr(9) || ' x ', '\\s+', ' ', 'g'))) as name from customer"),
    "split_iterate": (split_iterate, "select p_partkey, 0 as pos, trim(p_brand) as item from part union all select p_partkey, 1, trim(p_type) from part where trim(p_type) <> trim(p_brand)"),
    "absent_from_set": (absent_from_set, f"{L.SQL} select e.entity_id, v.activity from (select distinct entity_id from assertions) e, (values {L._ACTIVITIES}) v(activity) where not exists (select 1 from assertions a where a.entity_id = e.entity_id and a.activity = v.activity)"),
    "condition_ops": (condition_ops, "with t as (select o_orderkey, case o_orderkey % 5 when 0 then null when 1 then '' else o_orderstatus end as v from orders) select o_orderkey, v is null as eq_null, coalesce(v = 'F', false) as eq_f, coalesce(v <> '', false) as not_null, coalesce(v in ('F', 'O'), false) as is_in, coalesce(v not in ('F', 'O'), true) as not_in from t"),
    "template_interpolate": (template_interpolate, "select c_custkey, case when c_custkey % 7 <> 0 then 'entity ' || c_custkey || ' of ' || c_mktsegment end as text from customer"),
    "canonical_hash": (canonical_hash, "select doc_id, sha256(text) as sha256 from documents"),
    "json_property": (json_property, "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events"),
    "html_title_extract": (html_title_extract, r"""select page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title, cast(len(regexp_extract_all(html, '<a href="[^"]*"')) as bigint) as n_links from pages"""),
    "register_derived_fields": (register_derived_fields, _REGISTER_FIELDS),
    "effective_dates": (effective_dates, _EFFECTIVE),
    "run_uuid": (run_uuid, """with h as (select c_custkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(c_name)) as x from customer)
select c_custkey, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-'
  || case when substr(x, 17, 1) in ('0', '4', '8', 'c') then '8' when substr(x, 17, 1) in ('1', '5', '9', 'd') then '9' when substr(x, 17, 1) in ('2', '6', 'a', 'e') then 'a' else 'b' end
  || substr(x, 18, 3) || '-' || substr(x, 21, 12) as run_id from h"""),
    "identity_by_identifier": (identity_by_identifier, f"""with {_IDS}, q as (select p_partkey as question_id, 'VAT|V' || (p_partkey % 90) as key from part),
f as (select question_id, count(entity_id) as n, min(entity_id) as e from q left join ids using (key) group by all)
select question_id, case when n = 1 then 'EXACT' when n > 1 then 'CONFLICTING_IDENTIFIERS' else 'NOT_FOUND' end as state, case when n = 1 then e end as entity_id,
  case when n = 1 then 'IDENTIFIER_UNIQUE' when n > 1 then 'IDENTIFIER_MAPS_TO_MULTIPLE_ENTITIES' else 'NO_IDENTIFIER_MATCH' end as reason, n as n_candidates from f"""),
    "identity_by_name": (identity_by_name, f"""with {_NAMES}, f as (select question_id, count(entity_id) as n from q left join e using (key) group by all)
select question_id, case when n > 0 then 'AMBIGUOUS' else 'NOT_FOUND' end as state,
  case when n = 1 then 'SINGLE_CANDIDATE_NAME_MATCH' when n > 1 then 'MULTIPLE_NAME_CANDIDATES' else 'NO_NAME_MATCH' end as reason, n as n_candidates from f"""),
    "identifier_adoption": (identifier_adoption, f"""with {_NAMES}, b as (select * from e where entity_id % 2 = 0), f as (select question_id, count(entity_id) as n, min(entity_id) as sole from q left join b using (key) group by all)
select question_id, case when n = 1 then 'EXACT' when n > 1 then 'AMBIGUOUS' else 'NOT_FOUND' end as state, case when n = 1 then sole end as entity_id,
  case when n = 1 then 'ADOPTED_FROM_IDENTIFIER_BEARING_SOURCE' when n > 1 then 'MULTIPLE_NAME_CANDIDATES' else 'NO_NAME_MATCH' end as reason from f"""),
    "claim_unpivot": (claim_unpivot, "select s_suppkey, 's_name' as field, s_name as raw_value, s_suppkey || '|s_name' as claim_id from supplier union all select s_suppkey, 's_nationkey', cast(s_nationkey as varchar), s_suppkey || '|s_nationkey' from supplier"),
    "claim_group": (claim_group, f"""{L.SQL.rstrip()}, l as (select entity_id, activity, arg_max(legal_effect, assertion_id) as v from assertions group by all),
f as (select entity_id, string_agg(activity || '=' || v, ';' order by activity) as fields from l group by all),
i as (select entity_id, string_agg(cast(assertion_id as varchar), ',' order by assertion_id) as claim_ids from assertions group by all)
select entity_id, fields, claim_ids from f join i using (entity_id)"""),
    "claim_verify": (claim_verify, "select cast(o_orderkey as varchar) as claim_id, case when o_orderkey % 11 = 0 then 'NO_ATTEMPT' when o_orderkey % 7 = 0 then 'RAW_MISMATCH' when o_orderkey % 5 = 0 then 'NORMALIZED_MISMATCH' else 'VERIFIED' end as state from orders"),
    "parent_child_join": (parent_child_join, "select s_suppkey, case when s_suppkey % 4 <> 0 then coalesce(n_name, 'UNKNOWN') end as parent_value from supplier left join (select * from nation where n_nationkey % 3 <> 0) on s_nationkey = n_nationkey and s_suppkey % 4 <> 0"),
    "primary_register_join": (primary_register_join, "select o_custkey as entity_id, arg_min(o_orderstatus, o_orderkey) as primary_value, count(distinct o_orderstatus) > 1 as conflict, count(*) as n_groups from orders group by all"),
    "root_key_inherit": (root_key_inherit, """with p as (select n_regionkey as g, 'P' || n_nationkey as root_key from nation where n_regionkey < 2 or n_nationkey in (8, 9, 12)),
s as (select g, min(root_key) as root from p group by g having count(*) = 1) select c_custkey, coalesce(root, 'OWN' || c_custkey) as root_key from customer left join s on c_custkey % 6 = g"""),
    "derived_dedup": (derived_dedup, f"{L.SQL} select entity_id, activity, min(assertion_id) as assertion_id, arg_min(legal_effect, assertion_id) as legal_effect from assertions group by all"),
    "orphan_claims": (orphan_claims, "select c_custkey from customer where c_custkey % 9 = 0 or c_custkey % 10 = 0"),
    "rule_derivation": (rule_derivation, f"{_GROUPS} select gid, rule_id, item_ord, kind, activity, legal_effect, detail from r"),
    "derived_second_pass": (derived_second_pass, f"{_GROUPS} select distinct gid, activity, 'ENTITLED_ABROAD' as legal_effect from r where rule_id = 'R-OPEN' and kind <> 'FINDING'"),
    "sequential_ids": (sequential_ids, f"{_GROUPS} select gid, rule_id, item_ord, row_number() over (order by gid, rule_ord, item_ord) as seq from r where kind <> 'FINDING'"),
    "snapshot_diff": (snapshot_diff, f"{_SIDES} select record_key, kind, change, path, old, new from ch"),
    "observation_comparison": (observation_comparison, f"""with {_PAIRED} select pair, left_observation_id, right_observation_id, invocation_error, succession_state, comparable, identical_content, removal_admissible,
  concat_ws(',', case when not comparable then 'NON_COMPARABLE_NORMALIZATION_VERSION' end,
    case when succession_state = 'SOURCE_AS_OF_REGRESSION' or (succession_state = 'SAME_AS_OF_REVISION' and not identical_content) then succession_state end) as findings from c"""),
    "changes_of_records": (changes_of_records, f"{_SIDES} select record_key, kind, path from ch where record_key in (select c_custkey * 4 from customer)"),
    "record_normalise": (record_normalise, """with s as (select 'PSD_PI:' || s_suppkey as record_key, s_suppkey % 10 = 0 as twice, s_suppkey % 3 = 0 as no_owner, s_name from supplier)
select record_key, 'ca_owner_id' as path, case when not no_owner then 'ES_BE' end as value, cast(null as varchar) as problem from s
union all select record_key, 'properties.ENT_NAM', case when not twice then s_name end, case when twice then 'DUPLICATE_PROPERTY' end from s
union all select record_key, 'properties.ENT_TYP', '["a","b"]', null from s union all select record_key, 'services.ES', '["PS_1","PS_2"]', null from s union all select record_key, 'services.FR', 'PS_3', null from s"""),
    "change_classify": (change_classify, f"""{_SIDES.rstrip()}, {_PAIRED.rstrip()},
p as (select ch.*, ch.record_key % 25 as pair, c.series, c.removal_admissible, n.day, n.code from ch join c on ch.record_key % 25 = c.pair join n on ch.record_key = n.record_key
  where comparable and not identical_content and invocation_error is null),
u as (
  select record_key, pair, kind, path, 'UNCLASSIFIED_STRUCTURAL_CHANGE' as candidate, 'NO_PREREGISTERED_RULE' as blocker, 'UNKNOWN' as basis, cast(null as varchar) as effective_from, cast(null as bigint) as place, cast(null as varchar) as codes
    from p where series not like 'eba-psd2-register%' or path = 'properties.ENT_NAM'
  union all select record_key, pair, kind, path, 'ENTITY_RECORD_APPEARED', null, 'EVIDENCE_AS_OF', null, null, null from p where series like 'eba%' and kind = 'added'
  union all select record_key, pair, kind, path, 'ENTITY_RECORD_DISAPPEARED', case when not removal_admissible then 'NO_REMOVAL_ADMISSIBLE' end, case when removal_admissible then 'EVIDENCE_AS_OF' else 'UNKNOWN' end, null, null, null
    from p where series like 'eba%' and kind = 'removed'
  union all select record_key, pair, kind, path, 'UNCLASSIFIED_STRUCTURAL_CHANGE', 'ENT_AUT_SEQUENCE_REWRITTEN', 'UNKNOWN', null, null, null from p where series like 'eba%' and path = 'properties.ENT_AUT' and record_key % 4 = 3
  union all select record_key, pair, kind, path, 'ROOT_REAUTHORISATION_CANDIDATE', null, 'SOURCE_DECLARED', cast(day + 20 as varchar), 3, null from p where series like 'eba%' and path = 'properties.ENT_AUT' and record_key % 4 in (1, 2)
  union all select record_key, pair, kind, path, 'ROOT_WITHDRAWAL_CANDIDATE', null, 'SOURCE_DECLARED', cast(day + 30 as varchar), 4, null from p where series like 'eba%' and path = 'properties.ENT_AUT' and record_key % 4 = 2
  union all select record_key, pair, kind, path, 'CAPABILITY_APPEARED_CANDIDATE', null, 'EVIDENCE_AS_OF', null, null, case record_key % 6 when 0 then 'PS_9' else 'PS_8' end from p
    where series like 'eba%' and path = 'services.ES' and record_key % 6 in (0, 1)
  union all select record_key, pair, kind, path, 'CAPABILITY_DISAPPEARED_CANDIDATE', null, 'EVIDENCE_AS_OF', null, null, code from p where series like 'eba%' and path = 'services.ES' and record_key % 6 <> 0)
select *, '2024-03-01' as observed_after, '2024-03-10' as observed_by, case when blocker is null then 'SUPPORTED' else 'BLOCKED' end as admissibility from u"""),
    "transition_log_intervals": (transition_log_intervals, f"with {_LOGS} select entity_id, day as valid_from, nxt as valid_to from n where i % 2 = 1"),
    "last_authorisation": (last_authorisation, f"with {_LOGS} select entity_id, max(day) as authorised from n where i % 2 = 1 group by all"),
    "append_only_check": (append_only_check, f"""with {_LOGS}, k as (select *, c - 1 - entity_id % 2 as had from n where c >= 2)
select distinct entity_id, 'UNCLASSIFIED' as candidate, 'BLOCKED' as admissibility, cast(null as date) as effective_from, cast(null as bigint) as place from k where entity_id % 3 = 0
union all select entity_id, case when i % 2 = 0 then 'ROOT_WITHDRAWAL' else 'ROOT_REAUTHORISATION' end, 'SUPPORTED', day, i from k where entity_id % 3 <> 0 and i > had"""),
    "set_diff_codes": (set_diff_codes, f"""{L.SQL.rstrip()}, o as (select distinct entity_id, activity from assertions where assertion_id % 4 <> 0), n as (select distinct entity_id, activity from assertions where assertion_id % 4 <> 1)
select entity_id, 'CAPABILITY_APPEARED' as candidate, string_agg(activity, ',' order by activity) as codes from (select * from n except select * from o) group by entity_id
union all select entity_id, 'CAPABILITY_DISAPPEARED', string_agg(activity, ',' order by activity) from (select * from o except select * from n) group by entity_id"""),
    "series_succession": (series_succession, """with o as (select o_custkey as series, o_orderkey as observation_id, cast(o_orderdate as date) as retrieved_at,
  case when o_orderkey % 5 <> 0 then cast(date_trunc('year', o_orderdate) as date) - cast(o_orderkey % 2 * 400 as integer) end as a, o_orderkey % 4 as h from orders),
p as (select *, lag(a) over w as pa, lag(h) over w as ph, row_number() over w as n from o window w as (partition by series order by retrieved_at, observation_id))
select series, observation_id, case when a is null or pa is null then 'UNKNOWN_SOURCE_AS_OF' when a = pa then 'SAME_AS_OF_REVISION' when a < pa then 'SOURCE_AS_OF_REGRESSION' else 'NORMAL_SUCCESSION' end as state,
  h <> ph and a is not distinct from pa as suspect_as_of, h = ph as identical from p where n > 1"""),
    "projection_digest": (projection_digest, f"""{L.SQL.rstrip()}, h as (select sha256(assertion_id || '|' || entity_id || '|' || activity || '|' || legal_effect || '|' || coalesce(cast(effective_to as varchar), '~')) as h from assertions),
t as (select count(*) as n, (count(*) + 9999) // 10000 as buckets from h),
b as (select cast('0x' || substr(h, 1, 8) as bigint) % buckets as bucket, sha256(string_agg(h, '' order by h)) as h from h, t group by 1)
select case when count(*) = 1 and any_value(buckets) = 1 then min(h) else sha256(string_agg(h, '' order by h)) end as digest, any_value(n) as n_rows from b, t"""),
    "search_terms": (search_terms, f"""{L.SQL.rstrip()}, t as (select entity_id, legal_name as x from entities union select entity_id, home from entities where entity_id % 3 = 0 union select entity_id, entity_class from entities)
select entity_id, string_agg(x, '|' order by x) as terms from t where x <> '' group by entity_id"""),
    "timeline_union": (timeline_union, f"""{L.SQL} select entity_id, effective_from as day, 'STARTED' as kind from assertions union all select entity_id, effective_to, 'ENDED' from assertions where effective_to is not null
union all select entity_id, effective_from, negative_class from facts where negative_class is not null"""),
    "coverage_denominators": (coverage_denominators, f"""{L.SQL.rstrip()}, a as (select entity_id, count_if(legal_effect = 'ENTITLED_TO_PROVIDE') as n_entitled, count_if(blocked) as n_blocked, count(distinct root_key) as n_roots from assertions group by all),
x as (select entity_id, cast(coalesce(n_entitled, 0) as bigint) as n_entitled, cast(coalesce(n_blocked, 0) as bigint) as n_blocked, coalesce(n_roots, 0) as n_roots from entities left join a using (entity_id))
select *, case when n_entitled > 0 then 'COVERED' when n_roots > 0 then 'PARTIAL' else 'UNKNOWN' end as permissions from x"""),
    "orphan_refs": (orphan_refs, f"{L.SQL} select assertion_id from assertions where assertion_id not in (select assertion_id from sources)"),
    "lineage_edges": (lineage_edges, f"""{L.SQL} select distinct 'derive-' || a.entity_id as job, a.register_id as input, b.root_key as output from assertions a join assertions b using (entity_id) where b.root_key is not null"""),
    "lineage_events": (lineage_events, f"""{L.SQL.rstrip()}, r as (select entity_id, md5('run/' || entity_id) as run_id, 'derive-' || home as job from entities)
select r.*, '{{"job":{{"namespace":"attestry","name":"' || job || '"}},"run":{{"runId":"' || run_id || '"}}}}' as body, event_type from r, (values ('START'), ('COMPLETE')) e(event_type)"""),
    "name_mentions": (name_mentions, """with t as (select item_id as entity_id, upper(split_part(split_part(text, ' ', 2) || ', S.A.', ',', 1)) as token from benchmark),
n as (select doc_id as notice_id, upper(text) as text from documents where not contains(upper(text), '(CLON'))
select distinct notice_id, entity_id from n join t on contains(n.text, t.token) where length(token) >= 5"""),
}
