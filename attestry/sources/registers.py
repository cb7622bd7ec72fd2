"""Readers of frozen register snapshots: delimited text, JSON, markup.

All of them are Spark readers with a fixed schema; a register row keeps its empty strings,
which mean something else than an absent value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions.scalars import cell_text


def register_csv(
    spark: SparkSession, path: str, required: list[str], empty_to_null: tuple[str, ...] = (), separator: str = ",", renamed: dict[str, str] | None = None, targets: tuple[str, list[str]] | None = None
) -> DataFrame:
    """A delimited register: byte-order mark dropped, header checked, empty cells kept as ''.

    ``renamed`` keeps these columns under new names; ``targets`` keeps the rows whose column
    (by its old name) is one of the values.
    """
    df = spark.read.csv(path, header=True, multiLine=True, sep=separator, escape='"', encoding="UTF-8")
    df = df.select(*(F.col(f"`{c}`").alias(c.lstrip("﻿").strip()) for c in df.columns))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    if targets:
        df = df.where(F.col(f"`{targets[0]}`").isin(targets[1]))
    named = [c for c in df.columns if c and not c.startswith("_c") and (renamed is None or c in renamed)]
    new = renamed or {}
    return df.select(*((F.col(f"`{c}`") if c in empty_to_null else F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(new.get(c, c)) for c in named))


def strict_json(text: Column) -> Column:
    """VARIANT of a JSON text, NULL where it has a fraction, an exponent or a key twice.

    The reader of VARIANT turns 1.0 into 1, so numbers are looked at in the text, outside of
    its strings.
    """
    outside = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', '""')
    return F.when(~outside.rlike(r"[0-9](?:\.[0-9]|[eE])|NaN|Infinity"), F.try_parse_json(text))


def verified_snapshots(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Each listed file with how fetching it went: present, of the size and hash of the manifest."""
    files = spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("snapshot_file"), F.col("length").alias("got_bytes"), F.sha2("content", 256).alias("got_sha256")
    )
    state = (
        F.when(F.col("got_bytes").isNull(), "SNAPSHOT_MISSING")
        .when(F.col("got_bytes") != F.col("bytes"), "SIZE_MISMATCH")
        .when(F.col("got_sha256") != F.col("sha256"), "HASH_MISMATCH")
        .otherwise("FETCH_OK")
    )
    return manifest.join(files, "snapshot_file", "left").select(*manifest.columns, state.alias("fetch"))


def evidence_set_id(spark: SparkSession, path: str) -> DataFrame:
    """Identity of versioned evidence files: stem and hash of their bytes."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return spark.read.format("binaryFile").load(path).select(name.alias("file"), F.concat(stem, F.lit("@sha256:"), F.sha2("content", 256)).alias("evidence_set_id"))


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of all tables of a page: key, table, row, cell, text."""
    tables = F.regexp_extract_all(html, F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1))
    t = pages.select(key, F.posexplode(tables).alias("table", "_t"))
    r = t.select(key, "table", F.posexplode(F.regexp_extract_all("_t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "_r"))
    c = r.select(key, "table", "row", F.posexplode(F.regexp_extract_all("_r", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).alias("cell", "_c"))
    return c.select(key, "table", "row", "cell", cell_text(F.col("_c")).alias("text"))


def html_entries(pages: DataFrame, key: str, html: str, anchor: str, fields: dict[str, str]) -> DataFrame:
    """Entries of a page that begin at each match of ``anchor``; a field is a pattern with one group."""
    parts = F.split(F.regexp_replace(html, f"({anchor})", "\u0001$1"), "\u0001")
    entries = pages.select(key, F.posexplode(F.slice(parts, 2, F.size(parts))).alias("entry", "_e"))
    return entries.select(key, "entry", *(F.nullif(cell_text(F.regexp_extract("_e", p, 1)), F.lit("")).alias(n) for n, p in fields.items()))
