"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import bpe, classifier, fingerprint, minhash, packing, pii, quality, repair, secrets, substring, token_files, trie, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.word_lengths(_table(spark, sf_dir, "documents")))


#: Rules of op2: host, path, verdict.
URL_RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judged(_table(spark, sf_dir, "pages"), listing)


OP2_SQL = r"""
with parsed as (
  select page_id,
    coalesce(case when contains(url, '://') then translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end, '') as host,
    coalesce(case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) end, '') as path
  from pages),
fits as (
  select *,
    (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/en/') as com,
    (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/7') as example_com,
    (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/de/') as net,
    (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/de/8') as example_net,
    (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/es/') as org
  from parsed)
select page_id, host, path,
  case when example_com then 'example.com/en/7' when com then 'com/en/' when example_net then 'example.net/de/8'
       when net then 'net/de/' when org then 'org/es/' end as rule,
  case when example_com then 'allow' when com or example_net or net or org then 'block' else 'allow' end as verdict
from fits
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = bpe.encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


OP4_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as g from w, unnest(range(1, len(ws) - 2)) t(i) where len(ws) >= 4
  union select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 3),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach as (select a, b from (select a, b from e union all select b, a from e) union select r.a, x.b from reach r join (select a, b from e union all select b, a from e) x on r.b = x.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) as component_id, r.m is null or r.m >= d.doc_id as kept
from documents d left join n on d.doc_id = n.doc_id left join (select a, min(b) as m from reach group by a) r on d.doc_id = r.a
"""


OP5_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select doc_id, i, array_to_string(ws[i:i + 49], ' ') as k from w, unnest(range(1, len(ws) - 48)) t(i) where len(ws) >= 50),
f as (select k, min(doc_id) as first from p group by k),
gone as (select distinct p.doc_id, i + o as place from p join f using (k), unnest(range(0, 50)) t(o) where first < p.doc_id),
kept as (
  select x.doc_id, string_agg(word, ' ' order by x.place) as text, count(*) as n
  from (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as place from w) x anti join gone using (doc_id, place) group by x.doc_id)
select w.doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256 from w left join kept using (doc_id)
"""


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judged(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", *base, "p_good")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, in order, joined by a comma."""
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(text, ",")


def _counts(spans: Column, kinds: tuple[str, ...]) -> list[Column]:
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(k) for k in kinds]


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    return pii.found(_table(spark, sf_dir, "documents")).select(
        "doc_id", *_counts(base, pii.KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return secrets.found(_table(spark, sf_dir, "documents")).select(
        "doc_id", *_counts(base, secrets.BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


#: Id that op11 sets after every document.
END_ID = 2


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = token_files.written(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_files.documents(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations (as of ``trie.sequences``) that share first turns with the first of their five ids."""
    heads = convs.select(F.col("conv_id").alias("head"), F.slice("keys", 1, 8).alias("first_keys"), F.slice("sizes", 1, 8).alias("first_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    some = lambda first, own: F.concat(F.coalesce(F.slice(first, F.lit(1), h), F.slice(own, F.lit(1), F.lit(0))), F.slice(own, h + 1, F.size(own)))  # noqa: E731
    joined = convs.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head"), "left")
    return joined.select("conv_id", some("first_keys", "keys").alias("keys"), some("first_sizes", "sizes").alias("sizes"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(rebuilt(trie.sequences(_table(spark, sf_dir, "conversations"))))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults that follow from their ids and turns; ``present`` is false for a row that is gone."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repaired(damaged(_table(spark, sf_dir, "conversations")), present_col="present")
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({}, ''), lambda c: ord(c)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"
OP12_SQL = (
    r"""
with h as (select distinct conv_id as c, """
    + _CRC.format("conv_id::varchar")
    + r""" % 9 as h from conversations where conv_id is not null),
t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, md5(concat(strlen(coalesce(role, '')), ':', role, text))) as pos,
    md5(concat(strlen(coalesce(role, '')), ':', role, text)) as k, strlen(coalesce(text, '')) as bytes
  from conversations where conv_id is not null),
n as (select c, count(*) as n from t group by c),
built as (
  select h.c, t.pos, t.k, t.bytes from h join t on t.c = h.c - h.c % 5 and t.pos <= h.h
  union all
  select h.c, least(h.h, coalesce(n.n, 0)) + t.pos - h.h, t.k, t.bytes from h join t on t.c = h.c and t.pos > h.h left join n on n.c = h.c - h.c % 5),
member as (
  select c, pos as d, bytes, string_agg(k, '') over (partition by c order by pos) as p from built
  union all select c, 0, 0, '' from h),
node as (select d, p, min(c) as conv_id, count(*) as n_convs, max(bytes) as bytes from member group by d, p),
steps as (select m.c, m.d, n.conv_id from member m join node n using (d, p)),
lasts as (select conv_id, d, string_agg(c::varchar, ',' order by c) as ids from (select c, max(d) as d from member group by c) join steps using (c, d) group by conv_id, d),
up as (select n.conv_id, n.d, s.conv_id as parent_conv_id from node n left join steps s on s.c = n.conv_id and s.d = n.d - 1),
kids as (select parent_conv_id as conv_id, d - 1 as d, count(*) as n_children from up where d > 0 group by all),
under as (
  select s.conv_id, s.d, count(*) filter (k.n_children is null) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
  from node n join steps s on s.c = n.conv_id and s.d <= n.d left join kids k on k.conv_id = n.conv_id and k.d = n.d group by s.conv_id, s.d)
select n.conv_id, n.d::bigint as depth, u.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, x.n_leaves, x.saved_tokens::bigint as saved_tokens,
  sha256(coalesce(l.ids, '')) as ends_sha256
from node n join up u on u.conv_id = n.conv_id and u.d = n.d join under x on x.conv_id = n.conv_id and x.d = n.d
  left join kids k on k.conv_id = n.conv_id and k.d = n.d left join lasts l on l.conv_id = n.conv_id and l.d = n.d
"""
)
OP13_SQL = (
    r"""
with recursive kinds as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, """
    + _CRC.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")
    + r""" % 20 as kind from conversations),
rows as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(range(case when kind = 3 then 2 else 1 end)) from kinds where kind <> 0)),
ends as (
  select *, right(rtrim(text, e' 	

'), 1) as last, row_number() over w as i, lag(left(role, 1)) over w || left(role, 1) as pair
  from rows window w as (partition by conv_id order by turn nulls first, role, text)),
x as (
  select conv_id, i, turn, role, text, last = '' as blank, last <> '' and again as twice, last not in ('', '.', '!', '?') and not again as cut,
    coalesce(pair not in ('su', 'ua', 'au'), false) as illegal, case left(role, 1) when 's' then 1 when 'u' then 2 when 'a' then 3 else 0 end as kind
  from (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again from ends)),
n as (select conv_id, max(i) as n from x group by conv_id),
v as (
  select conv_id, n + 1 as i, 0 as v0, 6 as v1, 3 as v2, 0 as v3 from n
  union all
  select conv_id, i, least(b0, 3 + least(b2, 3 + b3)) as v0, least(b1, 3 + least(b2, 3 + b3)) as v1, least(b2, 3 + b3) as v2, least(b3, 3 + least(b2, 3 + b3)) as v3
  from (
    select v.conv_id, x.i,
      least(4 + v0, case when blank or twice then 1000000000 else e + least(3 + v2, case kind when 1 then v1 when 2 then v2 else 1000000000 end) end) as b0,
      least(4 + v1, case when blank or twice then 1000000000 else e + least(3 + v2, case kind when 2 then v2 else 1000000000 end) end) as b1,
      least(4 + v2, case when blank or twice then 1000000000 else e + least(3 + v3, case kind when 3 then v3 else 1000000000 end) end) as b2,
      least(4 + v3, case when blank or twice then 1000000000 else e + least(3 + v2, case kind when 2 then v2 else 1000000000 end) end) as b3
    from v join (select *, case when cut then 3 else 0 end as e from x) x on x.conv_id is not distinct from v.conv_id and x.i = v.i - 1)),
here as (
  select v.conv_id, v.i, [v0, v1, v2, v3] as togo, lead([v0, v1, v2, v3]) over (partition by v.conv_id order by v.i) as later,
    kind, blank or twice as bad, case when cut then 3 else 0 end as e, role, text
  from v left join x on x.conv_id is not distinct from v.conv_id and x.i = v.i),
walk as (
  select conv_id, 1 as i, 0 as s, '' as audit, []::varchar[] as done from n
  union all
  select conv_id, case when step = 'I' then i else i + 1 end,
    case step when 'D' then s when 'K' then kind else f end, audit || step,
    case step when 'D' then done when 'I' then list_append(done, fr || ':') when 'K' then list_append(done, role || ':' || text) else list_append(done, fr || ':' || text) end
  from (
    select w.*, h.kind, h.role, h.text, case when s = 2 then 3 else 2 end as f, case when s = 2 then 'assistant' else 'user' end as fr,
      case when later is not null and togo[s + 1] = 4 + later[s + 1] then 'D'
           when togo[s + 1] = 3 + togo[case when s = 2 then 4 else 3 end] then 'I'
           when later is null then null
           when not bad and ((kind = 1 and s = 0) or (kind = 2 and s <> 2) or (kind = 3 and s = 2)) and togo[s + 1] = e + later[kind + 1] then 'K' else 'R' end as step
    from walk w join here h on h.conv_id is not distinct from w.conv_id and h.i = w.i)
  where step is not null),
final as (select conv_id, arg_max(audit, length(audit)) as audit, arg_max(done, length(audit)) as done from walk group by conv_id),
faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (twice) as duplicate,
    count(*) filter (cut) as truncated, count(*) filter (illegal) as illegal
  from x group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(v0, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(done, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join faults f on f.conv_id is not distinct from a.conv_id
  left join final l on l.conv_id is not distinct from a.conv_id left join v on v.conv_id is not distinct from a.conv_id and v.i = 1
"""
)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_urls, op3_bpe, op4_minhash, op5_substring, op6_quality, op7_fingerprint, op8_classifier, op9_pii, op10_secrets, op11_tokens, op12_trie, op13_repair, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_urls": OP2_SQL, "op4_minhash": OP4_SQL, "op5_substring": OP5_SQL, "op12_trie": OP12_SQL, "op13_repair": OP13_SQL}
