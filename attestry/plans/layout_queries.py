"""Pages, expectations, lineage and documents made of the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import ground_truth as G
from attestry.operators import lineage as N
from attestry.operators import longitudinal as LG
from attestry.plans.lens import table
from attestry.sources import layouts as Y

_COLUMNS = ("a. Valores", "b. Fondos", "Minoristas", "Profesionales")


def pages(s: SparkSession, d: str) -> DataFrame:
    """A register page a supplier: a menu, a table of pairs, a list of acts and two matrices of services."""
    k = "s_suppkey"
    mark = lambda of: f"case when ({k} * {of}) % 3 = 0 then '<img alt=\"Si\">' else '<img alt=\"No\">' end"
    row = lambda name, at: f"'<tr><td>{name}</td>'" + "".join(f" || '<td>' || {mark(at + j)} || '</td>'" for j in range(4)) + " || '</tr>'"
    heads = "".join(f"<th>{c}</th>" for c in _COLUMNS)
    html = f"""'<table><tr><td>menu</td><td>x</td></tr><tr><td>a</td><td>b</td></tr></table>Contenido<table><tr><th>Nombre</th><th>Direcci&oacute;n</th></tr><tr><td>' || s_name || '</td><td> Calle&nbsp;<b>' || cast(s_nationkey as string) || '</b></td></tr></table>'
      || '<table><tr><th>Fecha</th><th>Acto</th></tr><tr><td>' || cast({k} as string) || '/1</td><td>Alta</td></tr>' || case when {k} % 2 = 0 then '<tr><td>' || cast({k} as string) || '/2</td><td>Baja &#38; fin</td></tr>' else '' end || '</table>'
      || '<table><tr><th>Servicios de inversi&oacute;n</th></tr><tr>{heads}</tr>' || {row("Custodia", 1)} || {row("Gesti&oacute;nCarteras", 2)} || '</table><table><tr><th>Servicios auxiliares</th></tr><tr>{heads}</tr>' || {row("Cambio", 3)} || '</table>'"""
    return table(s, d, "supplier").selectExpr(f"{k} as page_id", f"{html} as html")


def _cells(s: SparkSession, d: str) -> DataFrame:
    return Y.cells(pages(s, d), "page_id", "html", "Contenido")


def page_pairs(s: SparkSession, d: str) -> DataFrame:
    return Y.pairs(_cells(s, d), "page_id")


def page_lists(s: SparkSession, d: str) -> DataFrame:
    return Y.listed(_cells(s, d), "page_id", "fecha")


def service_matrix(s: SparkSession, d: str) -> DataFrame:
    return Y.service_matrix(_cells(s, d), "page_id").select("page_id", "kind", "service", F.array_join("instruments", "").alias("instruments"), F.array_join("clients", ",").alias("clients"))


def home_permissions(s: SparkSession, d: str) -> DataFrame:
    """A home authority's page a customer, with up to two permissions."""
    k = "c_custkey"
    one = lambda letter, service, day: f"'<tr><td>Handel mit Kryptowerte (Art. 59 Abs. 1{letter} i.V.m. Art. 3 Abs. 1 Nr. 16 {service} MiCA-R)</td> <td>{day}</td></tr>'"
    html = f"'<dt>Bafin-ID:</dt><dd>' || cast({k} as string) || '&nbsp;</dd><h2>Unternehmen</h2><p><strong>' || c_name || '</strong>' || case when {k} % 3 > 0 then {one('a', 'b', '01.02.2025')} else '' end || case when {k} % 4 > 1 then {one('b', 'a', '03.02.2025')} when {k} % 4 = 1 then {one('a', 'c', '01.02.2025')} else '' end"
    return Y.home_permissions(table(s, d, "customer").selectExpr(f"{k} as page_id", f"{html} as html"), "page_id", "html").drop("permission_texts")


TYPES = ("PSD_PI", "PSD_EMI")
FACTS = ("home_state_ES", "lei_present", "cross_source_name_variant", "entity_type_PSD_PI", "service_PS_080", "multiple_ent_aut_dates", "ent_aut_raw_is_date_array", "old_registration_date", "no_lei_in_summary", "source_is_partial_classification")


def ground_truth_status(s: SparkSession, d: str) -> DataFrame:
    """Orders as records of their customers; each customer expects three of ten facts, some one that nobody knows."""
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = lambda when, v: F.when(when, v)
    null = F.lit(None).cast("string")
    columns = {c: null for c in (*G.PRESENT.values(), "authorisation_notification_date", "category")}
    columns |= {
        "lei": text(k % 5 == 0, "L"), "home_member_state": text(k % 7 == 0, F.when(k % 2 == 0, "ES").otherwise("FR")), "legal_name": text(k % 3 == 0, F.concat(F.lit(" Name "), (k % 2).cast("string"))), "entity_type": text(k % 4 == 0, F.element_at(F.array(*map(F.lit, TYPES)), ((k / 4).cast("int") % 2 + 1).cast("int"))),
        "registration_date": text(k % 9 == 0, F.lit("01/02/2010")), "official_number": text(k % 11 == 0, F.lit("7")),
    }
    records = table(s, d, "orders").select(
        F.col("o_custkey").alias("entity_id"), *(v.alias(c) for c, v in columns.items()), F.when(k % 13 == 0, F.array(F.lit("PS_080"))).alias("service_codes"), F.when(k % 6 == 0, F.array(day)).when(k % 17 == 0, F.array(day, F.lit("soon"))).alias("ent_aut_raw")
    )
    e, facts = F.col("c_custkey"), F.array(*map(F.lit, FACTS))
    pick = lambda n: F.element_at(facts, ((e * n) % len(FACTS) + 1).cast("int"))
    asked = table(s, d, "customer").select(e.alias("entity_id"), F.array_distinct(F.concat(F.array(pick(1), pick(3), pick(7)), F.when(e % 19 == 0, F.array(F.lit("unheard_of"))).otherwise(F.array().cast("array<string>")))).alias("facts"))
    found = G.checked(asked, records, TYPES)
    return found.select("entity_id", *(F.array_join(c, ",").alias(c) for c in ("observed", "missing", "unknown")), "status")


def _lineage(s: SparkSession, d: str) -> DataFrame:
    """Customers' runs read two snapshots (one may be lost) and write one artefact; every fourth has no time."""
    names = N.Names("https://example.org/attestry", "attestry", "snapshots", "artifacts", "https://example.org/facets")
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    text = lambda c: c.cast("string")
    snapshots = table(s, d, "nation").where(n != 7).select(
        F.concat(F.lit("s"), text(n)).alias("ref"), F.col("n_name").alias("snapshot_file"), F.concat(F.lit("hash"), text(n)).alias("sha256"), F.lit("https://example.org").alias("source_url"), F.lit(1).alias("bytes"), F.lit("2024-01-01").alias("retrieved_at"),
        F.when(n % 2 == 0, "2023-12-31").alias("source_as_of"), F.lit("S").alias("source"), F.lit("R").alias("register_id"), F.lit("A").alias("authority"),
    )
    none = F.lit(None).cast("string")
    artifacts = table(s, d, "customer").select(F.concat(F.lit("a"), text(k)).alias("ref"), F.lit("ledger").alias("artifact_kind"), F.concat(F.lit("out/"), text(k)).alias("path"), none.alias("sha256"), none.alias("artifact_version"), none.alias("result_sha256"))
    nation = F.col("c_nationkey")
    runs = table(s, d, "customer").select(
        F.concat(F.lit("r"), text(k)).alias("run"), F.concat(F.lit("job"), text(k % 10)).alias("job"), F.when(k % 4 > 0, "2024-02-02T00:00:00Z").alias("executed_at"), F.lit("2025-01-01T00:00:00Z").alias("observed_at"),
        F.array(F.concat(F.lit("s"), text(nation)), F.concat(F.lit("s"), text((nation + 1) % 25))).alias("inputs"), F.array(F.concat(F.lit("a"), text(k))).alias("outputs"), F.lit("V").alias("run_version"), none.alias("gate"), none.alias("input_sha256"),
        none.alias("output_sha256"), none.alias("code_sha256"),
    )
    return N.events(runs, N.datasets(names, snapshots, artifacts), names)


def lineage_run_events(s: SparkSession, d: str) -> DataFrame:
    """Every event, with what its JSON says."""
    at = lambda path: F.get_json_object("event", path)
    return _lineage(s, d).select("file", at("$.eventType").alias("event_type"), at("$.eventTime").alias("event_time"), at("$.run.runId").alias("run_id"), F.json_array_length(at("$.inputs")).cast("long").alias("n_inputs"), at("$.outputs[0].name").alias("output"), F.array_join("missing", ",").alias("missing"))


def lineage_event_edges(s: SparkSession, d: str) -> DataFrame:
    return N.edges(_lineage(s, d))


def typed_snapshot_diff(s: SparkSession, d: str) -> DataFrame:
    """Orders as documents of two snapshots that differ in value, type, depth or presence."""
    k = "o_orderkey"
    left = f"'{{\"name\":\"' || o_orderstatus || '\",\"n\":' || cast({k} as string) || ',\"deep\":{{\"a\":{{\"b\":[1,2],\"c\":null}}}}}}'"
    n = f"case when {k} % 4 = 1 then '\"' || cast({k} as string) || '\"' else cast({k} as string) end"
    deep = f"case when {k} % 5 = 1 then '{{\"a\":{{\"b\":[2,1],\"c\":null}}}}' when {k} % 5 = 2 then '{{\"a\":{{\"b\":[1,2]}}}}' when {k} % 5 = 3 then '{{\"a\":{{\"b\":[1,2],\"c\":0}},\"x\":{{\"y\":1}}}}' when {k} % 5 = 4 then '7' else '{{\"a\":{{\"b\":[1,2],\"c\":null}}}}' end"
    right = f"'{{\"deep\":' || {deep} || ',\"n\":' || {n} || ',\"name\":\"' || o_orderstatus || '\"}}'"
    side = lambda text, keep: table(s, d, "orders").where(keep).selectExpr(f"{k} as record_key", f"parse_json({text}) as doc")
    found = LG.typed_diff(side(left, f"{k} % 13 <> 0"), side(right, f"{k} % 17 <> 0"), "record_key", "doc")
    return found.withColumn("path", F.array_join("path", "/"))


def address_stretches(s: SparkSession, d: str) -> DataFrame:
    """Orders as historical states of their customers, whose address the order's priority is."""
    states = table(s, d, "orders").select(F.col("o_custkey").alias("entity_id"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("#"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("as_of"), F.when(F.col("o_orderkey") % 6 == 0, "UNKNOWN").when(F.col("o_orderkey") % 3 == 0, "Calle 1").otherwise("Calle 2").alias("address"))
    present = table(s, d, "customer").where("c_custkey % 10 > 0").select(F.col("c_custkey").alias("entity_id"), F.when(F.col("c_custkey") % 10 == 1, "UNKNOWN").otherwise("Calle 1").alias("address"), F.lit("2020-01-01").alias("observed_at"))
    return LG.address_changes(states, present)


_MARK = "(s_suppkey * {}) % 3 = 0"


def _matrix_row(kind: str, service: str, at: int) -> str:
    letters = " || ".join(f"case when {_MARK.format(at + j)} then '{c[0]}' else '' end" for j, c in enumerate(_COLUMNS[:2]))
    clients = ", ".join(f"case when {_MARK.format(at + 2 + j)} then '{c}' end" for j, c in enumerate(_COLUMNS[2:]))
    return f"select s_suppkey as page_id, '{kind}' as kind, '{service}' as service, {letters} as instruments, concat_ws(',', {clients}) as clients from supplier"


_TRUTH = """with r as (select o_custkey as e, o_orderkey as k from orders),
shown as (select distinct e, fact from (
  select e, unnest([case when k % 14 = 0 then 'home_state_ES' end, case when k % 5 = 0 then 'lei_present' end, case when k % 8 = 0 then 'entity_type_PSD_PI' end, case when k % 13 = 0 then 'service_PS_080' end, case when k % 17 = 0 and k % 6 <> 0 then 'multiple_ent_aut_dates' end,
    case when k % 6 = 0 then 'ent_aut_raw_is_date_array' end, case when k % 9 = 0 then 'old_registration_date' end, case when k % 11 = 0 and k % 5 <> 0 then 'no_lei_in_summary' end]) as fact from r
  union all select e, 'cross_source_name_variant' from r where k % 3 = 0 group by e having count(distinct k % 2) > 1
  union all select c_custkey, 'source_is_partial_classification' from customer) where fact is not null),
asked as (select c_custkey as e, list_distinct([{F}[c_custkey % 10 + 1], {F}[c_custkey * 3 % 10 + 1], {F}[c_custkey * 7 % 10 + 1]]) as _, [{F}[c_custkey % 10 + 1], {F}[c_custkey * 3 % 10 + 1], {F}[c_custkey * 7 % 10 + 1]] || case when c_custkey % 19 = 0 then ['unheard_of'] else [] end as facts from customer),
each as (select e, fact, min(i) as i from (select e, unnest(facts) as fact, unnest(range(len(facts))) as i from asked) group by all)
select x.e as entity_id, coalesce(string_agg(x.fact, ',' order by i) filter (where s.fact is not null), '') as observed, coalesce(string_agg(x.fact, ',' order by i) filter (where s.fact is null and x.fact <> 'unheard_of'), '') as missing,
  coalesce(max(x.fact) filter (where x.fact = 'unheard_of'), '') as unknown, case when bool_or(x.fact = 'unheard_of') then 'UNKNOWN_FACT' when bool_or(s.fact is null) then 'DIVERGENCE' else 'MATCH' end as status
from each x left join shown s on s.e = x.e and s.fact = x.fact group by x.e""".replace("{F}", "[" + ", ".join(f"'{f}'" for f in FACTS) + "]")

_RUNS = """with r as (select c_custkey as k, 'job' || (c_custkey % 10) as job, c_nationkey as n, (c_nationkey + 1) % 25 as m from customer),
h as (select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('attestry/' || job || '/r' || k)) as x from r)"""
_UUID = "substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || case when substr(x, 17, 1) in ('0', '4', '8', 'c') then '8' when substr(x, 17, 1) in ('1', '5', '9', 'd') then '9' when substr(x, 17, 1) in ('2', '6', 'a', 'e') then 'a' else 'b' end || substr(x, 18, 3) || '-' || substr(x, 21, 12)"

QUERIES = {
    "page_pairs": (page_pairs, "select s_suppkey as page_id, 'Nombre' as header, s_name as value from supplier union all select s_suppkey, 'Dirección', 'Calle ' || s_nationkey from supplier union all select s_suppkey, 'Fecha', s_suppkey || '/1' from supplier where s_suppkey % 2 = 1 union all select s_suppkey, 'Acto', 'Alta' from supplier where s_suppkey % 2 = 1"),
    "page_lists": (page_lists, "select s_suppkey as page_id, r as \"row\", unnest(['Fecha', 'Acto']) as header, unnest([s_suppkey || '/' || r, case r when 1 then 'Alta' else 'Baja & fin' end]) as text from supplier, (values (1), (2)) t(r) where r = 1 or s_suppkey % 2 = 0"),
    "service_matrix": (service_matrix, " union all ".join((_matrix_row("investment", "Custodia", 1), _matrix_row("investment", "Gestión", 2), _matrix_row("auxiliary", "Cambio", 3)))),
    "home_permissions": (
        home_permissions,
        """with p as (select *, c_custkey % 3 > 0 as one, c_custkey % 4 > 1 as two, c_custkey % 4 = 1 as three from customer)
select c_custkey as page_id, c_name as legal_name, c_custkey::varchar as register_number, null::varchar as entity_class, case when (one or three) and two then 'MIXED' when one or three then 'ART_59_1A' when two then 'ART_59_1B' end as mica_home_route,
  case when (one or three) and two then null when one or three then '01.02.2025' when two then '03.02.2025' end as permission_date, nullif(concat_ws('|', case when two then 'a' end, case when one then 'b' end, case when three then 'c' end), '') as permission_services from p""",
    ),
    "ground_truth_status": (ground_truth_status, _TRUTH),
    "lineage_run_events": (
        lineage_run_events,
        f"""{_RUNS}, t as (select *, unnest(case when k % 4 > 0 then ['START', 'COMPLETE'] else [null] end) as kind from h)
select job || '.r' || k || '.' || coalesce(lower(kind), 'jobevent') || '.json' as file, kind as event_type, case when k % 4 > 0 then '2024-02-02T00:00:00Z' else '2025-01-01T00:00:00Z' end as event_time, case when k % 4 > 0 then {_UUID} end as run_id,
  case when n = 7 or m = 7 then 1 else 2 end as n_inputs, 'out/' || k as output, case when n = 7 or m = 7 then 's7' else '' end as missing from t""",
    ),
    "lineage_event_edges": (lineage_event_edges, f"{_RUNS} select distinct 'hash' || i as input, job, 'out/' || k as output from (select *, unnest([n, m]) as i from r) where i <> 7"),
    "typed_snapshot_diff": (
        typed_snapshot_diff,
        """with o as (select o_orderkey as k, o_orderkey % 13 <> 0 as l, o_orderkey % 17 <> 0 as r, o_orderstatus as st from orders),
x as (select k, 'changed' as kind, 'n' as path, k::varchar as old, '"' || k || '"' as new from o where l and r and k % 4 = 1
  union all select k, 'changed', 'deep/a/b', '[1,2]', '[2,1]' from o where l and r and k % 5 = 1 union all select k, 'removed', 'deep/a/c', 'null', null from o where l and r and k % 5 = 2
  union all select k, 'changed', 'deep/a/c', 'null', '0' from o where l and r and k % 5 = 3 union all select k, 'added', 'deep/x', null, '{"y":1}' from o where l and r and k % 5 = 3
  union all select k, 'changed', 'deep', '{"a":{"b":[1,2],"c":null}}', '7' from o where l and r and k % 5 = 4
  union all select k, 'removed', '', '{"deep":{"a":{"b":[1,2],"c":null}},"n":' || k || ',"name":"' || st || '"}', null from o where l and not r
  union all select k, 'added', '', null, '{"deep":' || case k % 5 when 1 then '{"a":{"b":[2,1],"c":null}}' when 2 then '{"a":{"b":[1,2]}}' when 3 then '{"a":{"b":[1,2],"c":0},"x":{"y":1}}' when 4 then '7' else '{"a":{"b":[1,2],"c":null}}' end
    || ',"n":' || case when k % 4 = 1 then '"' || k || '"' else k::varchar end || ',"name":"' || st || '"}' from o where r and not l)
select k as record_key, kind, path, old, new from x""",
    ),
    "address_stretches": (
        address_stretches,
        """with s as (select o_custkey as e, substr(o_orderdate::varchar, 1, 10) || '#' || lpad(o_orderkey::varchar, 10, '0') as t, case when o_orderkey % 3 = 0 then 'Calle 1' else 'Calle 2' end as a from orders where o_orderkey % 6 <> 0),
g as (select *, row_number() over (partition by e order by t) - row_number() over (partition by e, a order by t) as grp from s),
i as (select e, a, min(t) as first_as_of, max(t) as last_as_of, count(*) as n from g group by e, a, grp),
f as (select *, lead(a) over w as nxt, lead(first_as_of) over w as upto from i window w as (partition by e order by first_as_of))
select e as entity_id, a as address, first_as_of, last_as_of, n as n_states, coalesce(nxt, now) as next_address, coalesce(upto, day) as "by"
from f left join (select c_custkey as c, 'Calle 1' as now, '2020-01-01' as day from customer where c_custkey % 10 > 1) on c = e where coalesce(nxt, now) <> a""",
    ),
}
