"""Claims: one row a field with its provenance, and the records they make up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unpivoted(records: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One claim a field: keys, field, raw value as text, and the claim's id."""
    wide = records.select(*keys, *(F.col(f).cast("string").alias(f) for f in fields))
    long = wide.unpivot(keys, fields, "field", "raw_value")
    return long.withColumn("claim_id", F.concat_ws("|", *(F.col(k).cast("string") for k in keys), "field"))


def grouped(claims: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Records from claims: the last value of each field, and the ids in order."""
    last = claims.groupBy(*keys, "field").agg(F.max_by("raw_value", order).alias("value"))
    fields = last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("fields"))
    ids = claims.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), "claim_id"))).alias("ids"))
    return fields.join(ids.select(*keys, F.col("ids.claim_id").alias("claim_ids")), keys)


def verified(claims: DataFrame, again: DataFrame) -> DataFrame:
    """The first way in which a claim differs from the claim derived again, or VERIFIED.

    A claim that was not derived again has NO_ATTEMPT; values may be NULL on both sides. Where
    both tables have ``raw_sha256``, the hash of the snapshot read, it must be equal first.
    """
    hashed = "raw_sha256" in claims.columns and "raw_sha256" in again.columns
    fields = ["raw_value", "normal_value", *(["raw_sha256"] if hashed else [])]
    pair = claims.join(again.select("claim_id", *(F.col(f).alias(f"{f}_again") for f in fields), F.lit(True).alias("tried")), "claim_id", "left")
    differs = lambda f: ~F.col(f).eqNullSafe(F.col(f"{f}_again"))
    state = F.when(F.col("tried").isNull(), "NO_ATTEMPT")
    if hashed:
        state = state.when(differs("raw_sha256"), "RAW_HASH_MISMATCH")
    state = state.when(differs("raw_value"), "RAW_MISMATCH").when(differs("normal_value"), "NORMALIZED_MISMATCH").otherwise("VERIFIED")
    return pair.select("claim_id", state.alias("state"))


def with_parent(children: DataFrame, parents: DataFrame, key: str, value: str) -> DataFrame:
    """Parent's value for each child; a declared parent that is missing is UNKNOWN, the last of several wins."""
    last = parents.groupBy(key).agg(F.max_by(value, "ord").alias("parent_value"))
    joined = children.join(last, key, "left")
    return joined.withColumn("parent_value", F.when(F.col(key).isNotNull(), F.coalesce("parent_value", F.lit("UNKNOWN"))))


def primary(groups: DataFrame, key: str, value: str) -> DataFrame:
    """The first group of each key, and whether the groups disagree."""
    return groups.groupBy(key).agg(
        F.min_by(value, "ord").alias("primary_value"), (F.size(F.collect_set(value)) > 1).alias("conflict"), F.count("*").alias("n_groups")
    )


def inherited_root(children: DataFrame, parents: DataFrame, key: str, own: Column) -> DataFrame:
    """The parent's root where exactly one parent matches, else the child's own."""
    sole = parents.groupBy(key).agg(F.count("*").alias("n"), F.min("root_key").alias("parent_root")).where("n = 1").drop("n")
    return children.join(sole, key, "left").withColumn("root_key", F.coalesce("parent_root", own))


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def orphans(claims: DataFrame, required: list[str]) -> DataFrame:
    """Claims with a provenance field that is missing or empty."""
    bad = F.exists(F.array(*(F.col(c).cast("string") for c in required)), lambda x: x.isNull() | (x == ""))
    return claims.where(bad)
