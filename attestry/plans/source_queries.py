"""Queries of sources and the arrival stream, each with its SQL where SQL reads the same input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions.scalars import cell_text
from attestry.plans import lens as L
from attestry.sources import registers
from attestry.streaming import observations


def html_entries(s: SparkSession, d: str) -> DataFrame:
    """Links of each page as entries: their place, address and text."""
    fields = {"href": r'<a href="([^"]*)"', "label": r"(?s)<a [^>]*>(.*?)</a>"}
    e = registers.html_entries(L.table(s, d, "pages"), "page_id", "html", r"<a href=", fields)
    return e.select("page_id", F.col("entry").cast("long").alias("entry"), F.coalesce("href", F.lit("")).alias("href"), F.coalesce("label", F.lit("")).alias("label"))


def html_table_cells(s: SparkSession, d: str) -> DataFrame:
    """Cells of tables made of suppliers' names."""
    k = F.col("s_suppkey")
    html = F.concat(F.lit("<p>x</p><table border=1><tr><th>Name</th><td>"), "s_name", F.lit(" &amp; <b>Co</b></td></tr></table><TABLE><tr><td> 1 </td></tr><tr><td>"), k.cast("string"), F.lit("</td></tr></TABLE>"))
    c = registers.html_tables(L.table(s, d, "supplier").select("s_suppkey", html.alias("html")), "s_suppkey", "html")
    return c.select("s_suppkey", *(F.col(x).cast("long").alias(x) for x in ("table", "row", "cell")), "text")


def strict_json(s: SparkSession, d: str) -> DataFrame:
    e = L.table(s, d, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("props", r"\}", '.5}')).otherwise(F.col("props"))
    return e.select("event_id", registers.strict_json(text).isNotNull().alias("ok"))


def cell_texts(s: SparkSession, d: str) -> DataFrame:
    html = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return L.table(s, d, "pages").select("page_id", cell_text(html).alias("text"))


def arrival_partition(s: SparkSession, d: str) -> DataFrame:
    return observations.arrivals(L.table(s, d, "events"), "user_id", "ts", "2024-01-15")


def _cell(html: str) -> str:
    """SQL of the text of markup."""
    inner = f"regexp_replace({html}, '<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        inner = f"replace({inner}, '{entity}', '{char}')"
    return f"trim(regexp_replace({inner}, '\\s+', ' ', 'g'))"


QUERIES = {
    "html_entries": (
        html_entries,
        r"""with e as (select page_id, unnest(string_split(html, '<a href=')[2:]) as x, unnest(range(0, len(string_split(html, '<a href=')) - 1)) as entry from pages)
select page_id, entry, {href} as href, {label} as label from e""".replace("{href}", _cell("regexp_extract(x, '^\"([^\"]*)\"', 1)")).replace("{label}", _cell("regexp_extract('<a href=' || x, '(?s)<a [^>]*>(.*?)</a>', 1)")),
    ),
    "html_table_cells": (
        html_table_cells,
        """select s_suppkey, t as "table", r as "row", c as cell, case when t = 0 then case c when 0 then 'Name' else s_name || ' & Co' end when r = 0 then '1' else cast(s_suppkey as varchar) end as text
from supplier, (values (0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 1, 0)) v(t, r, c)""",
    ),
    "strict_json": (strict_json, "select event_id, event_id % 3 <> 0 as ok from events"),
    "cell_texts": (
        cell_texts,
        r"""select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) as text from pages""",
    ),
    "arrival_partition": (
        arrival_partition,
        "select user_id, cast(ts as date) as day, count_if(ts <= timestamp '2024-01-15') as usable, count_if(ts > timestamp '2024-01-15') as after_k from events group by all",
    ),
}
