"""Claims ledger: one claim a traced field of each parsed record, and the check that derives it again.

How a field comes from a raw record is data: source, field, rule and reference. The table of
traces is small and broadcast; a record meets those of its source in one join, so sources and
rules of all kinds share a plan. Raw records and observed fields are VARIANTs, values in claims
are JSON texts, so a number never equals a text.

    COPY, ATTR          the attribute that the reference names
    COPY_OR_EMPTY       the same; the empty text for what is missing, null or empty
    EMPTY_TO_NULL       the same; null for what is empty
    PROPERTY            the first property of that name in the list ``Properties``
    TYPE_NAME           the type of that property
    IS_VALID_LEI, LEI_DIAGNOSTIC_V2   of the attribute
    FLATTEN_STRINGS     all texts in the attribute at any depth, in order (an object's fields by name)
    TEXT_EXTRACT        some part of the record, which is a text
    NOT_PUBLISHED       null
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import lei_diagnostic

RULES = ("COPY", "ATTR", "COPY_OR_EMPTY", "EMPTY_TO_NULL", "PROPERTY", "TYPE_NAME", "IS_VALID_LEI", "LEI_DIAGNOSTIC_V2", "FLATTEN_STRINGS", "TEXT_EXTRACT", "NOT_PUBLISHED")
#: Names of types as ledgers write them (fixed values).
TYPE_NAMES = {"STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType", "ARRAY": "list", "OBJECT": "dict"}
TRACE = "source string, field string, rule string, ref string"
NULL = "null"


def faulty(traces: DataFrame) -> DataFrame:
    """Traces with a rule that is none, without a reference where their rule needs one, or twice for one field."""
    needs = ~F.col("rule").isin("TEXT_EXTRACT", "NOT_PUBLISHED") & F.col("ref").isNull()
    twice = traces.groupBy("source", "field").count().where("count > 1").select("source", "field", F.lit("TWICE").alias("fault"))
    return traces.select("source", "field", F.when(~F.col("rule").isin(*RULES), "UNKNOWN_RULE").when(needs, "NO_REFERENCE").alias("fault")).where("fault is not null").union(twice)


def _text(v: Column) -> Column:
    """Canonical JSON of a VARIANT; what is missing is null."""
    return F.coalesce(F.to_json(v), F.lit(NULL))


def _raw(record: Column, rule: Column, ref: Column) -> Column:
    """Raw value of a claim as JSON text."""
    attribute = F.try_element_at(F.try_variant_get(record, "$", "map<string,variant>"), ref)
    entries = F.flatten(F.transform(F.try_variant_get(record, "$.Properties", "array<map<string,variant>>"), F.map_entries))
    named = F.get(F.filter(entries, lambda e: e["key"] == ref), F.lit(0))["value"]
    return F.when(rule.isin("PROPERTY", "TYPE_NAME"), _text(named)).when(rule == "TEXT_EXTRACT", _text(record)).when(rule == "NOT_PUBLISHED", NULL).otherwise(_text(attribute))


def flattened(text: Column) -> Column:
    """Texts among the values of a JSON text, at any depth, in order of appearance, as a JSON text."""
    # a text that no colon follows is a value, one that a colon follows a key; texts are taken whole, so none begins inside another
    texts = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*+"(?:\s*+:)?'), F.lit(0))
    values = F.filter(texts, lambda t: ~t.endswith(":"))
    return F.to_json(F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>"))


def derived(raw: Column, rule: Column) -> Column:
    """Normalised value of a claim as JSON text, from its raw value; NULL of a text extract, which has none of its own."""
    empty = raw.isin(NULL, '""', "[]", "{}", "false", "0")
    plain = F.when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v"))
    kind = F.schema_of_variant(F.try_parse_json(raw))
    name = F.coalesce(*(F.when(kind.startswith(k), v) for k, v in TYPE_NAMES.items()))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    diagnostic = lei_diagnostic(plain)
    return (
        F.when(rule.isin("COPY", "ATTR", "PROPERTY", "NOT_PUBLISHED"), raw)
        .when(rule == "COPY_OR_EMPTY", F.when(empty, '""').otherwise(raw))
        .when(rule == "EMPTY_TO_NULL", F.when(empty, NULL).otherwise(raw))
        .when(rule == "IS_VALID_LEI", F.when(diagnostic == "VALID", "true").otherwise("false"))
        .when(rule == "LEI_DIAGNOSTIC_V2", quoted(diagnostic))
        .when(rule == "FLATTEN_STRINGS", flattened(raw))
        .when(rule == "TYPE_NAME", quoted(name))
    )


def _once(records: DataFrame) -> DataFrame:
    """Records with the hash that all their claims share, made before they meet the traces."""
    return records.withColumn("_hash", F.sha2(F.to_json("raw_record"), 256))


def claims(attempts: DataFrame, traces: DataFrame, manifest: DataFrame) -> DataFrame:
    """A claim for every traced field of every record that parsed, with its provenance.

    ``attempts`` has corpus_id, source, parse_status, snapshot_file, record_key, raw_record and observed
    (VARIANTs), parser and run_version; ``manifest`` snapshot_file, sha256, source_url, retrieved_at and
    source_as_of. A snapshot that the manifest lacks leaves its provenance NULL, which ``orphans``
    of the claims finds; a source date that is not declared is UNAVAILABLE, never made up.
    """
    parsed = attempts.where("parse_status = 'PARSE_OK'").join(manifest.select("snapshot_file", "sha256", "source_url", "retrieved_at", "source_as_of"), "snapshot_file", "left")
    rows = _once(parsed).withColumn("_seen", F.try_variant_get("observed", "$", "map<string,variant>")).join(F.broadcast(traces), "source")
    observed = F.try_element_at(F.col("_seen"), F.col("field"))
    version = F.when(F.col("rule") == "LEI_DIAGNOSTIC_V2", "LEI_DIAGNOSTIC_V2").otherwise(F.col("run_version"))
    return rows.select(
        F.concat_ws("|", "corpus_id", "source", "field").alias("claim_id"), "corpus_id", "source", "field", "rule", "ref", version.alias("rule_version"), "parser", F.col("run_version").alias("extractor_version"), "record_key", "snapshot_file",
        F.col("sha256").alias("snapshot_sha256"), "source_url", "retrieved_at", "source_as_of", F.when(F.col("source_as_of").isNotNull(), "TRUSTED").otherwise("UNAVAILABLE").alias("source_date_reliability"),
        F.col("_hash").alias("raw_record_sha256"), _raw(F.col("raw_record"), F.col("rule"), F.col("ref")).alias("raw_value"), _text(observed).alias("normalized_value"),
    )


def untraced(attempts: DataFrame, traces: DataFrame) -> DataFrame:
    """Observed fields of parsed records that no trace tells the origin of: corpus_id, source, field."""
    seen = attempts.where("parse_status = 'PARSE_OK'").select("corpus_id", "source", F.explode(F.map_keys(F.try_variant_get("observed", "$", "map<string,variant>"))).alias("field"))
    return seen.join(F.broadcast(traces.select("source", "field")), ["source", "field"], "left_anti")


def verified(ledger: DataFrame, attempts: DataFrame) -> DataFrame:
    """claim_id and state of every claim, derived again from the attempts' raw records: the first that fails, or VERIFIED.

    NO_ATTEMPT where no record of the source was parsed, RAW_MISMATCH, NORMALIZED_MISMATCH,
    RAW_HASH_MISMATCH. A text extract holds if it is a text that the record has somewhere.
    """
    read = _once(attempts.where("parse_status = 'PARSE_OK'")).select("corpus_id", "source", "raw_record", "_hash", F.lit(True).alias("tried"))
    rows = ledger.join(read, ["corpus_id", "source"], "left")
    again = _raw(F.col("raw_record"), F.col("rule"), F.col("ref"))
    rows = rows.withColumn("again", again)
    inside = lambda c: F.expr(f"try_variant_get(try_parse_json({c}), '$', 'string')")
    extract = F.col("normalized_value").startswith('"') & F.coalesce(F.contains(inside("again"), inside("normalized_value")), F.lit(False))
    same = F.when(F.col("rule") == "TEXT_EXTRACT", extract).otherwise(F.col("normalized_value").eqNullSafe(derived(F.col("again"), F.col("rule"))))
    state = (
        F.when(F.col("tried").isNull(), "NO_ATTEMPT").when(~F.col("raw_value").eqNullSafe(F.col("again")), "RAW_MISMATCH").when(~same, "NORMALIZED_MISMATCH")
        .when(~F.col("raw_record_sha256").eqNullSafe(F.col("_hash")), "RAW_HASH_MISMATCH").otherwise("VERIFIED")
    )
    return rows.select("claim_id", state.alias("state"))
