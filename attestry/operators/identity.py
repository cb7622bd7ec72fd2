"""Identity of asked names and identifiers, decided for a whole table at once.

A name alone never proves an identity: one candidate is still ambiguous.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import lei_diagnostic, normal_identifier, normal_name

#: Fields of register records that are identifiers, and their kinds (fixed values).
KINDS = {("EBA_PSD2_REGISTER", "entity_code"): "BDE_REGISTRY_ID", ("CNMV_ESI_FPS", "official_number"): "CNMV_REGISTRY_ID", ("BDE_MFI_CLASSIFICATION_ES", "european_code"): "BDE_REGISTRY_ID"}
EXACT = "EXACT"


def _candidates(asked: DataFrame, key: str, matches: DataFrame) -> DataFrame:
    """How many entities each question's key has and the least of them; matches are counted by
    key before they are joined, so a common name is one row."""
    found = matches.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("entity_id").alias("n_candidates"), F.min("entity_id").alias("first_candidate"))
    return asked.select("question_id", key).join(found, key, "left").select("question_id", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), "first_candidate")


def by_identifier(asked: DataFrame, identifiers: DataFrame) -> DataFrame:
    """asked(question_id, kind, value) against identifiers(entity_id, kind, value)."""
    key = F.concat_ws("|", F.col("kind"), normal_identifier(F.col("value")))
    found = _candidates(asked.select("question_id", key.alias("key")), "key", identifiers.select("entity_id", key.alias("key")))
    n = F.col("n_candidates")
    return found.select(
        "question_id",
        F.when(n == 1, "EXACT").when(n > 1, "CONFLICTING_IDENTIFIERS").otherwise("NOT_FOUND").alias("state"),
        F.when(n == 1, F.col("first_candidate")).alias("entity_id"),
        F.when(n == 1, "IDENTIFIER_UNIQUE").when(n > 1, "IDENTIFIER_MAPS_TO_MULTIPLE_ENTITIES").otherwise("NO_IDENTIFIER_MATCH").alias("reason"),
        "n_candidates",
    )


def by_name(asked: DataFrame, entities: DataFrame) -> DataFrame:
    """asked(question_id, name) against entities(entity_id, legal_name); never EXACT."""
    found = _candidates(asked.select("question_id", normal_name(F.col("name")).alias("key")), "key", entities.select("entity_id", normal_name(F.col("legal_name")).alias("key")))
    n = F.col("n_candidates")
    return found.select(
        "question_id",
        F.when(n > 0, "AMBIGUOUS").otherwise("NOT_FOUND").alias("state"),
        F.when(n == 1, "SINGLE_CANDIDATE_NAME_MATCH").when(n > 1, "MULTIPLE_NAME_CANDIDATES").otherwise("NO_NAME_MATCH").alias("reason"),
        "n_candidates",
    )


def adopted(asked: DataFrame, entities: DataFrame, identifiers: DataFrame, kind: str) -> DataFrame:
    """By name among entities that bear an identifier of ``kind``; a sole one is EXACT."""
    bearing = entities.join(identifiers.where(F.col("kind") == kind).select("entity_id").distinct(), "entity_id", "left_semi")
    key = lambda c: normal_name(F.col(c)).alias("key")
    found = _candidates(asked.select("question_id", key("name")), "key", bearing.select("entity_id", key("legal_name")))
    n = F.col("n_candidates")
    return found.select(
        "question_id",
        F.when(n == 1, "EXACT").when(n > 1, "AMBIGUOUS").otherwise("NOT_FOUND").alias("state"),
        F.when(n == 1, F.col("first_candidate")).alias("entity_id"),
        F.when(n == 1, "ADOPTED_FROM_IDENTIFIER_BEARING_SOURCE").when(n > 1, "MULTIPLE_NAME_CANDIDATES").otherwise("NO_NAME_MATCH").alias("reason"),
    )


def identifiers(records: DataFrame) -> DataFrame:
    """What register records (entity_id, source, texts) identify entities by: entity_id, kind, value, diagnostic.

    Codes of registers count as they stand; a LEI counts if its diagnostic is VALID. ``diagnostic``
    is NULL of what counts, so rejected ones are the rows that have one.
    """
    lei = F.try_element_at("texts", F.lit("lei"))
    state = lei_diagnostic(lei)
    found = [F.when(lei != "", F.struct(F.lit("LEI").alias("kind"), lei.alias("value"), F.when(state != "VALID", state).alias("diagnostic")))]
    for (source, field), kind in KINDS.items():
        value = F.try_element_at("texts", F.lit(field))
        found.append(F.when((F.col("source") == source) & (value != ""), F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(None).cast("string").alias("diagnostic"))))
    return records.select("entity_id", F.explode(F.array_compact(F.array(*found))).alias("i")).select("entity_id", "i.*")


def index(entities: DataFrame, assertions: DataFrame) -> DataFrame:
    """Entities (entity_id, legal_name) with the classes that their assertions evidence, sorted."""
    classes = assertions.groupBy("entity_id").agg(F.sort_array(F.collect_set("entity_class")).alias("entity_classes"))
    return entities.select("entity_id", "legal_name").join(classes, "entity_id", "left").withColumn("entity_classes", F.coalesce("entity_classes", F.array().cast("array<string>")))


def resolved(asked: DataFrame, entries: DataFrame, known: DataFrame) -> DataFrame:
    """State, reason and entity of each question, whichever way it names one.

    ``asked`` has question_id and, of entity_id (as text), kind with value, and name, the first
    that is given counts. ``entries`` is an ``index``, ``known`` the identifiers that count.
    Identifiers and names are counted by key before they are met, so a question meets one row.
    """
    given = lambda c: F.col(c).isNotNull() & (F.trim(c) != "")
    form = F.when(given("entity_id"), "E").when(given("value"), "I").when(given("name"), "N")
    key = F.when(form == "E", F.trim("entity_id")).when(form == "I", F.concat_ws("|", F.coalesce("kind", F.lit("")), normal_identifier(F.col("value")))).when(form == "N", normal_name(F.col("name")))
    candidates = (
        entries.select(F.lit("E").alias("form"), F.col("entity_id").cast("string").alias("key"), "entity_id")
        .unionByName(known.where("diagnostic is null").select(F.lit("I").alias("form"), F.concat_ws("|", "kind", normal_identifier(F.col("value"))).alias("key"), "entity_id"))
        .unionByName(entries.select(F.lit("N").alias("form"), normal_name(F.col("legal_name")).alias("key"), "entity_id"))
    )
    found = candidates.groupBy("form", "key").agg(F.min("entity_id").alias("low"), F.max("entity_id").alias("high"))
    met = asked.select("question_id", form.alias("form"), key.alias("key")).join(found, ["form", "key"], "left")
    met = met.withColumn("n", F.when(F.col("low").isNull(), 0).when(F.col("low") == F.col("high"), 1).otherwise(2))

    def case(**of: tuple[str, str, str]) -> Column:
        out = F.lit(None).cast("string")
        for f, by_count in of.items():
            for n, value in enumerate(by_count):
                out = F.when((F.col("form") == f) & (F.col("n") == n), value).otherwise(out)
        return out

    state = F.coalesce(case(E=("NOT_FOUND", EXACT, EXACT), I=("NOT_FOUND", EXACT, "CONFLICTING_IDENTIFIERS"), N=("NOT_FOUND", "AMBIGUOUS", "AMBIGUOUS")), F.lit("NOT_FOUND"))
    reason = case(
        E=("UNKNOWN_ENTITY_ID", "ENTITY_ID_PROVIDED", "ENTITY_ID_PROVIDED"), I=("NO_IDENTIFIER_MATCH", "IDENTIFIER_UNIQUE", "IDENTIFIER_MAPS_TO_MULTIPLE_ENTITIES"),
        N=("NO_NAME_MATCH", "SINGLE_CANDIDATE_NAME_MATCH", "MULTIPLE_NAME_CANDIDATES"),
    )
    return met.select("question_id", state.alias("identity_state"), F.coalesce(reason, F.lit("NO_SELECTOR")).alias("identity_reason"), F.when(state == EXACT, F.col("low")).alias("entity_id"))
