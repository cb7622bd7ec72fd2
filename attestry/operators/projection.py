"""Lookup tables, digests, read model and lineage of the public projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import upper_alone


def row_digest(*columns: str) -> Column:
    """SHA-256 of the columns' canonical text, NULLs marked."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns)), 256)


def table_digest(rows: DataFrame, key: str, columns: list[str], bucket_rows: int = 10_000) -> DataFrame:
    """A digest of a table that no order of rows changes, in as many levels as its size needs.

    Rows are dealt by their digest into buckets of about ``bucket_rows``; a bucket's digest covers
    its rows' digests in order. Buckets are dealt alike until one is left.
    """
    level = rows.select(row_digest(key, *columns).alias("h"), F.lit(1).cast("long").alias("n"))
    left = rows.count()
    if not left:
        return rows.agg(F.count("*").alias("n_rows")).select(F.sha2(F.lit(""), 256).alias("digest"), "n_rows")
    while True:
        buckets = -(-left // bucket_rows)
        own = F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(buckets))
        level = level.groupBy(own.alias("bucket")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"), F.sum("n").alias("n"))
        if buckets == 1:
            return level.select(F.col("h").alias("digest"), F.col("n").alias("n_rows"))
        left = buckets


def search_terms(entity: str, *terms: str) -> Column:
    """Distinct terms of an entity without empty ones, sorted."""
    return F.array_sort(F.array_except(F.array_distinct(F.array_compact(F.array(*(F.col(t).cast("string") for t in (entity, *terms))))), F.array(F.lit(""))))


def timeline(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_refs(children: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    return children.join(parents.select(on).distinct(), on, "left_anti")


def lineage_events(runs: DataFrame) -> DataFrame:
    """A START and a COMPLETE event of each run (run_id, job, at), with run and job in a body."""
    body = F.to_json(
        F.named_struct(
            F.lit("job"), F.named_struct(F.lit("namespace"), F.lit("attestry"), F.lit("name"), F.col("job")), F.lit("run"), F.named_struct(F.lit("runId"), F.col("run_id"))
        )
    )
    return runs.select("*", body.alias("body"), F.explode(F.array(F.lit("START"), F.lit("COMPLETE"))).alias("event_type"))


def lineage_edges(jobs: DataFrame) -> DataFrame:
    """Input to output edges of jobs with arrays ``inputs`` and ``outputs``."""
    return jobs.select("job", F.explode("inputs").alias("input"), "outputs").select("job", "input", F.explode("outputs").alias("output"))


#: Notices that tell of a clone of an entity carry this mark (fixed value) and are no mentions.
CLONE_MARK, GRAM = "(CLON", 5


def name_mentions(notices: DataFrame, entities: DataFrame) -> DataFrame:
    """Notices that contain an entity's first name token, of five characters or more.

    The token is what stands before the name's first comma and blank. Containment without a
    nested loop: a token has its first five characters in some word of the notice, so it meets
    the five-character grams of the notices' words that some token begins with, and ``contains``
    confirms.
    """
    token = upper_alone(F.substring_index(F.substring_index("legal_name", ",", 1), " ", 1))
    tokens = entities.select("entity_id", token.alias("token")).where(F.length("token") >= GRAM).withColumn("gram", F.substring("token", 1, GRAM))
    words = notices.where(~F.col("text").rlike(rf"(?i)\Q{CLONE_MARK}\E")).select("notice_id", F.explode(F.array_distinct(F.split(upper_alone(F.col("text")), " "))).alias("word")).where(F.length("word") >= GRAM)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM))))
    found = words.select("notice_id", "word", F.explode(grams).alias("gram")).join(tokens, "gram").where(F.contains("word", "token"))
    return found.select("notice_id", "entity_id").distinct()
