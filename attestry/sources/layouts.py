"""Layouts of register pages: tables of cells, pairs, lists, service matrices, pages read by patterns.

Pages are rows of a key and their markup. Nested repetition becomes rows: a table's cells are
exploded with their places, so a header is met by an equi-join of places and not by loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import cell_text

# what a service matrix says (fixed values)
MATRIX_HEADS, AUXILIARY, MARK = ("Servicios",), "auxiliar", "Si"
CLIENTS = ("Minoristas", "Profesionales", "Contrapartes elegibles")
INSTRUMENT = "^([a-k])"
# permissions of a home authority's page and what they cite (fixed values)
PERMISSION = r"<td>([^<]*Kryptowerte[^<]*\(Art\.\s*59\s*Abs\.?\s*\.?\s*1([ab])\s*i\.V\.m\.\s*Art\.\s*3\s*Abs\.\s*1\s*Nr\.\s*16\s*([a-j])\s*MiCA-R\)[^<]*)</td>\s*<td>(\d{2}\.\d{2}\.\d{4})</td>"
HOME_FIELDS = {"legal_name": r"<h2>Unternehmen</h2>\s*<p>\s*<strong>([^<]+)", "register_number": r"Bafin-ID:</dt>\s*<dd>([^&<]+)", "entity_class": r"Gattung:</dt>\s*<dd>([^<]+)"}
REMARK_FIELDS = {"legal_name": r'"name":"([^"]+)"', "register_number": r'"finanstilsynetId":"([^"]+)"', "remark": r'"remarks":"([^"]*)"'}
REMARK, REMARK_PATTERN, LICENCE = "ART_60_3", r"MiCA\s+Article\s+60\(3\)", r'"licenceCode":"([^"]+)"'


def cells(pages: DataFrame, key: str, html: str, after: str = "") -> DataFrame:
    """Cells of all tables of each page behind the mark ``after``: key, table, row, cell, text, alts, width.

    ``alts`` are the texts of a cell's images, ``width`` is how many cells its row has. Rows without
    text or image are left out and not counted.
    """
    body = F.when(F.instr(html, after) > 0, F.substr(F.col(html), F.instr(html, after))).otherwise(F.col(html)) if after else F.col(html)
    inner = lambda col, tag: F.regexp_extract_all(col, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    cell = lambda c: F.struct(cell_text(c).alias("text"), F.regexp_extract_all(c, F.lit('(?i)alt="([^"]*)"'), F.lit(1)).alias("alts"))
    rows = pages.select(F.col(key), F.posexplode(inner(body, "table")).alias("table", "_t")).select(key, "table", F.posexplode(inner(F.col("_t"), "tr")).alias("at", "_r"))
    rows = rows.select(key, "table", "at", F.transform(inner(F.col("_r"), "t[dh]"), cell).alias("cells"))
    rows = rows.where(F.exists("cells", lambda c: (c["text"] != "") | (F.size(c["alts"]) > 0)))
    table = rows.groupBy(key, "table").agg(F.sort_array(F.collect_list(F.struct("at", "cells"))).alias("rows"))
    row = table.select(key, "table", F.posexplode("rows").alias("row", "_r"))
    return row.select(key, "table", "row", F.size("_r.cells").alias("width"), F.posexplode("_r.cells").alias("cell", "_c")).select(key, "table", "row", "cell", "_c.text", "_c.alts", "width")


def pairs(found: DataFrame, key: str) -> DataFrame:
    """Header and value of tables of just two rows of one width; of equal headers the last counts."""
    shape = found.groupBy(key, "table").agg(F.max("row").alias("last"), F.min("width").alias("low"), F.max("width").alias("high")).where("last = 1 and low = high").select(key, "table")
    cell = found.join(shape, [key, "table"], "left_semi").groupBy(key, "table", "cell").agg(F.max(F.when(F.col("row") == 0, F.col("text"))).alias("header"), F.max(F.when(F.col("row") == 1, F.col("text"))).alias("value"))
    return cell.where("header <> ''").groupBy(key, "header").agg(F.max_by("value", F.struct("table", "cell")).alias("value"))


def listed(found: DataFrame, key: str, first_header: str) -> DataFrame:
    """Rows of a page's first table whose first header begins with ``first_header``: key, row, header, text."""
    head = found.where(F.col("row") == 0)
    tables = head.where((F.col("cell") == 0) & F.lower("text").startswith(first_header.lower())).groupBy(key).agg(F.min("table").alias("table"))
    headers = head.join(tables, [key, "table"], "left_semi").select(key, "cell", F.col("text").alias("header"))
    body = found.where(F.col("row") > 0).join(tables, [key, "table"], "left_semi")
    return body.join(headers, [key, "cell"]).select(key, F.col("row"), "header", "text")


def service_matrix(found: DataFrame, key: str) -> DataFrame:
    """Services of a matrix of marks: key, table, row, kind, service, instruments, clients.

    The first row names the matrix, the second its columns from the second cell on; a mark is the
    alternative text of an image. A name stops where a second capitalised text is stuck to it.
    """
    first = found.where((F.col("row") == 0) & (F.col("cell") == 0))
    kind = F.when(F.lower("text").contains(AUXILIARY), "auxiliary").otherwise("investment")
    heads = first.where(F.col("text").startswith(MATRIX_HEADS[0])).select(key, "table", kind.alias("kind"))
    columns = found.where(F.col("row") == 1).select(key, "table", (F.col("cell") + 1).alias("cell"), F.col("text").alias("column"))
    rows = found.where(F.col("row") > 1).join(heads, [key, "table"]).join(columns, [key, "table", "cell"], "left")
    marked = (F.col("cell") > 0) & F.exists("alts", lambda a: a.contains(MARK))
    letter = F.regexp_extract(F.coalesce("column", F.lit("")), INSTRUMENT, 1)
    client = F.when(F.col("column").isin(*CLIENTS), F.col("column"))
    taken = lambda value: F.transform(F.array_sort(F.collect_list(F.when(marked & value.isNotNull(), F.struct("cell", value.alias("v"))))), lambda x: x["v"])
    name = F.trim(F.get(F.split(F.max(F.when(F.col("cell") == 0, F.col("text"))), r"(?<=[a-záéíóúñ)])(?=[A-ZÁÉÍÓÚÑ][a-z])"), F.lit(0)))
    out = rows.groupBy(key, "table", "row", "kind").agg(name.alias("service"), taken(F.nullif(letter, F.lit(""))).alias("instruments"), taken(F.when(letter == "", client)).alias("clients"))
    return out.where("service <> ''")


def _first(html: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.replace(F.replace(F.regexp_extract(html, f"(?s){pattern}", 1), F.lit("&nbsp;"), F.lit("")), F.lit(" "), F.lit(" "))), F.lit(""))


def home_permissions(pages: DataFrame, key: str, html: str) -> DataFrame:
    """A home authority's page: its fields and what all its permissions cite.

    One route if all permissions cite the same paragraph, MIXED if not, none without permissions;
    a date only if it is the same for all.
    """
    h = F.col(html)
    all_of = lambda group: F.regexp_extract_all(h, F.lit(f"(?s){PERMISSION}"), F.lit(group))
    routes, dates, services, texts = F.array_distinct(all_of(2)), F.array_distinct(all_of(4)), F.array_sort(F.array_distinct(all_of(3))), F.transform(all_of(1), F.trim)
    route = F.when(F.size(routes) == 1, F.concat(F.lit("ART_59_1"), F.upper(routes[0]))).when(F.size(routes) > 1, "MIXED")
    some = lambda a, by: F.when(F.size(a) > 0, F.array_join(a, by))
    return pages.select(
        key, *(_first(h, p).alias(n) for n, p in HOME_FIELDS.items()), route.alias("mica_home_route"), F.when(F.size(dates) == 1, F.get(dates, F.lit(0))).alias("permission_date"),
        some(services, "|").alias("permission_services"), some(texts, " || ").alias("permission_texts"),
    )


def remarked_licences(pages: DataFrame, key: str, html: str) -> DataFrame:
    """A home authority's page with licences as data: fields, licences in order, and what the remark cites."""
    h = F.col(html)
    licences = F.array_sort(F.array_distinct(F.regexp_extract_all(h, F.lit(LICENCE), F.lit(1))))
    fields = {n: _first(h, p) for n, p in REMARK_FIELDS.items()}
    return pages.select(key, *(c.alias(n) for n, c in fields.items()), F.when(F.size(licences) > 0, F.array_join(licences, "|")).alias("licences"), F.when(fields["remark"].rlike(REMARK_PATTERN), REMARK).alias("home_mechanism_remark"))
