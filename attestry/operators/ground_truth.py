"""Expected facts of entities against what their records show, in one conditional aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import normal_name

#: Facts that hold where some record has a field (fixed values).
PRESENT = {
    "lei_present": "lei", "services_present": "service_codes_raw", "passport_countries_present": "service_countries_raw", "commercial_name_present": "commercial_name", "commercial_name_may_be_present": "commercial_name",
    "eba_entity_code_present": "entity_code", "entity_code_present": "entity_code", "national_reference_present": "national_reference_code", "fps_listing_present": "official_number",
    "official_number_present": "official_number", "country_present": "country", "mfi_row_present": "european_code", "european_code_present": "european_code",
}
#: Facts that hold where some record has one of the values (fixed values).
EQUAL = {
    "home_state_ES": ("home_member_state", ("ES",)), "transition_boundary_candidate": ("authorisation_notification_date", ("30/06/2026",)),
    "post_transition_date_candidate": ("authorisation_notification_date", ("10/07/2026", "31/07/2026")), "category_credit_institution": ("category", ("Entidad de crédito",)),
}
OLD_YEARS, TYPE, CODE = ("/2006", "/2010", "/2012"), "entity_type_", "service_PS_080"
ALWAYS = ("source_is_partial_classification",)


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def predicates(types: tuple[str, ...]) -> dict[str, Column]:
    """Aggregates of an entity's records by the fact that each of them shows.

    Records are columns of texts, with arrays ``service_codes`` and ``ent_aut_raw``. That a record
    has a field at all is that it is not NULL; the empty text is a field without a value.
    """
    some = lambda c: F.coalesce(F.bool_or(F.coalesce(c, F.lit(False))), F.lit(False))
    dates = F.col("ent_aut_raw").isNotNull() & F.forall("ent_aut_raw", lambda d: F.coalesce(d.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False)))
    name = F.when(_filled("legal_name"), normal_name(F.col("legal_name")))
    found = {fact: some(_filled(c)) for fact, c in PRESENT.items()} | {fact: some(F.col(c).isin(*values)) for fact, (c, values) in EQUAL.items()}
    return found | {f"{TYPE}{t}": some(F.col("entity_type") == t) for t in types} | {fact: F.lit(True) for fact in ALWAYS} | {
        "esma_lei_present": some(_filled("lei") & F.col("home_member_state").isNotNull()), "cross_source_name_variant": F.coalesce(F.min(name) != F.max(name), F.lit(False)), CODE: some(F.array_contains("service_codes", "PS_080")),
        "ent_aut_raw_is_date_array": some(dates), "status_semantics_unresolved": some(dates), "multiple_ent_aut_dates": some(F.size("ent_aut_raw") > 1),
        "no_lei_in_summary": some(F.col("official_number").isNotNull() & ~_filled("lei")), "old_registration_date": some(F.col("registration_date").rlike(f"({'|'.join(OLD_YEARS)})$")),
    }


def checked(expected: DataFrame, records: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Each entity's expected facts (entity_id, facts) with whether they were observed, and its status.

    MATCH if all of them were, else DIVERGENCE. A fact that no predicate knows makes an entity
    UNKNOWN_FACT, with the fact in ``unknown``. An entity without records has observed only what
    always holds.
    """
    tests = predicates(types)
    shown = records.groupBy("entity_id").agg(F.array_compact(F.array(*(F.when(c, F.lit(fact)) for fact, c in tests.items()))).alias("shown"))
    rows = expected.join(shown, "entity_id", "left").withColumn("shown", F.coalesce("shown", F.array(*map(F.lit, ALWAYS))))
    known = F.array(*map(F.lit, tests))
    unknown, missing = F.array_except("facts", known), F.array_except("facts", "shown")
    status = F.when(F.size(unknown) > 0, "UNKNOWN_FACT").when(F.size(missing) > 0, "DIVERGENCE").otherwise("MATCH")
    return rows.select("entity_id", F.array_intersect("facts", "shown").alias("observed"), F.array_except(missing, unknown).alias("missing"), unknown.alias("unknown"), status.alias("status"))
