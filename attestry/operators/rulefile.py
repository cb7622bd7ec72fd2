"""Rule files: a rule set as JSON, checked, compiled and run over claim groups as one plan.

``load`` checks the text of a rule file and gives a ``RuleSet``; its digest pins what was run.
``run`` takes claim groups and gives assertions, reported facts and findings with their numbers.

The conditions of all rules become Boolean columns of one projection, which yields the ordinals
of the rules that fire; one explode later, each pair of group and rule meets the rule's own data
(literals, value maps, parsed templates, dates to derive) in a broadcast table of one row a rule.
So the plan has the same size for any number of rules, and groups are read once.

A group has ``group_ord`` (unique; the order of emission), ``entity_id``, ``source``,
``register_id``, ``texts`` (map of text fields), ``lists`` (map of list fields), ``claim_ids`` and
``source_assertions``. A field that is missing, and one that is NULL, are the same.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions.conditions import OPS, all_of
from attestry.functions.scalars import spanish_date
from attestry.operators.projection import table_digest
from attestry.operators.tables import cuts, in_sequence, kept, ordinal, part_of, ranged
from attestry.sources.artifacts import strict_object

# vocabulary of rule files (fixed values)
MODES = ("SPLIT", "DICT_KEYS", "LIST", "ABSENT_FROM_SET")
DERIVATIONS = ("CONSTANT_NULL", "EVIDENCE_AS_OF", "FIELD_COPY", "FIELD_COPY_OR_NULL", "FIELD_DDMMYYYY", "FIELD_DDMMYYYY_OR_NULL", "EBA_ENT_AUT_LAST_AUTH")
LAST_AUTHORISATION_FIELD, INTERVALS_FIELD = "eba_ent_aut_last_auth", "eba_ent_aut_intervals"
RESOLVED = {"entity_class": "UNSUPPORTED_ENTITY_CLASS", "activity": "UNSUPPORTED_ACTIVITY_MAPPING", "jurisdiction": "UNSUPPORTED_ACTIVITY_MAPPING", "entry_mechanism": "REQUIRED_FIELD_MISSING"}
MISSING, UNDERIVABLE = "REQUIRED_FIELD_MISSING", "REQUIRED_FIELD_UNDERIVABLE"
LITERALS = ("legal_effect", "territorial_basis", "evidence_basis", "evidence_composition", "negative_scope", "negative_evidence_class", "source_granularity", "interval_end", "admissibility", "blocker", "coverage_policy_id")
FACT_MAPPED = ("negative_scope", "negative_evidence_class", "interval_end", "canonical_activity", "entry_mechanism", "coverage_policy_id")
ENUMS = {
    "evidence_basis": ("NCA_REPORTED_VIA_EBA", "NCA_PRIMARY", "STATISTICAL"), "evidence_composition": ("ALL_REQUIRED",), "negative_scope": ("ROOT_FAMILY", "ROUTE_CAPABILITY"),
    "negative_evidence_class": ("EXPLICIT_WITHDRAWAL", "EXPIRY", "ENUMERATED_ABSENCE", "ENTITY_BAJA"), "source_granularity": ("ATOMIC", "COMPOSITE"),
    "interval_end": ("INCLUSIVE", "EXCLUSIVE"), "admissibility": ("ADMISSIBLE", "BLOCKED"),
}
STATUSES = ("ACTIVE", "WITHDRAWN", "UNKNOWN", "TERRITORIAL_ENTITLEMENT_DEFERRED", "TERRITORIAL_ROUTE_UNRESOLVED")
ITEM = "$ITEM"
FIELD_REF = re.compile(r"\{([a-z_][a-z0-9_]*)\}")

_MAPPING = "struct<field:string,map:map<string,string>>"
_DATE = "struct<derivation:string,field:string>"
_TEMPLATE = "array<struct<text:string,field:string>>"
_RULE = (
    "rule_ord int, rule_id string, kind string, required array<string>, mode string, item_field string, separator string, universe array<string>, excludes array<string>, excludes_field string, "
    + ", ".join(f"{c} string, {c}_from {_MAPPING}" for c in dict.fromkeys((*RESOLVED, *FACT_MAPPED, *LITERALS)))
    + f", legal_basis {_TEMPLATE}, scope {_TEMPLATE}, effective_from {_DATE}, effective_to {_DATE}, raw_capability_code string, reported_status string, reported_status_field string,"
    " status_intervals_field string, root_key_field string, root_home_field string, provenance boolean, effective_literal string, classification string, detail string"
)


class RuleFileError(ValueError):
    """All faults of a rule file, one a line."""

    def __init__(self, faults: list[str]):
        super().__init__("\n".join(faults))
        self.faults = faults


@dataclass(frozen=True)
class RuleSet:
    version: str
    rules: tuple[dict, ...]
    derived: tuple[dict, ...]
    sha256: str


def load(text: str) -> RuleSet:
    """A checked rule set; raises RuleFileError that names every fault by its place."""
    spec = strict_object(text).get("ruleset")
    if not isinstance(spec, dict):
        raise RuleFileError(["ruleset: missing"])
    faults: list[str] = []
    rules, derived = spec.get("rules"), spec.get("derived_rules", [])
    if not isinstance(spec.get("ruleset_version"), str):
        faults.append("ruleset.ruleset_version: missing")
    for name, found in (("rules", rules), ("derived_rules", derived)):
        if not isinstance(found, list):
            faults.append(f"ruleset.{name}: not a list")
    if faults:
        raise RuleFileError(faults)
    seen: set[str] = set()
    for k, rule in enumerate(rules):
        faults += [f"rules[{k}]{f}" for f in _rule_faults(rule)]
    for k, rule in enumerate(derived):
        lacks = [c for c in ("rule_id", "ruleset_version", "base", "emit", "untriggered_finding") if c not in rule]
        lacks += [f"emit.{c}" for c in ("activity", "legal_effect", "entry_mechanism", "legal_basis", "scope") if c not in rule.get("emit", {})]
        lacks += [f"untriggered_finding.{c}" for c in ("classification", "detail") if c not in rule.get("untriggered_finding", {})]
        faults += [f"derived_rules[{k}].{c}: missing" for c in lacks]
        if "entity_class" not in rule.get("base", {}):
            faults.append(f"derived_rules[{k}].base.entity_class: missing")
    for rule in (*rules, *derived):
        if rule.get("rule_id") in seen:
            faults.append(f"{rule['rule_id']}: twice")
        seen.add(rule.get("rule_id"))
    if faults:
        raise RuleFileError(faults)
    return RuleSet(spec["ruleset_version"], tuple(rules), tuple(derived), hashlib.sha256(text.encode()).hexdigest())


def _rule_faults(rule: dict) -> list[str]:
    match, faults = rule.get("match", {}), []
    faults += [f".{c}: missing" for c in ("rule_id", "match") if c not in rule]
    if not isinstance(match.get("source"), str):
        faults.append(".match.source: missing")
    for k, c in enumerate(match.get("conditions", [])):
        if c.get("op") not in OPS or "field" not in c or ("value" not in c and c["op"] not in ("NULL", "NOT_NULL")):
            faults.append(f".match.conditions[{k}]: not a condition")
    outcomes = [c for c in ("emit_per", "emit_status_fact", "finding") if c in rule] + (["emit"] if rule.get("emit") is not None else [])
    if len(outcomes) != 1:
        return [*faults, f": one outcome is needed, has {outcomes}"]
    if outcomes == ["finding"]:
        return faults + [f".finding.{c}: missing" for c in ("classification", "detail") if c not in rule["finding"]]
    if outcomes == ["emit_status_fact"]:
        fact = rule["emit_status_fact"]
        if ("reported_status" in fact) == ("reported_status_from" in fact):
            faults.append(".emit_status_fact: one of reported_status and reported_status_from is needed")
        elif fact.get("reported_status", STATUSES[0]) not in STATUSES:
            faults.append(".emit_status_fact.reported_status: unknown")
        return faults + _value_faults(".emit_status_fact", fact)
    emit, at = rule.get("emit"), ".emit"
    if outcomes == ["emit_per"]:
        emit, at = rule["emit_per"].get("emit", {}), ".emit_per.emit"
        iterate = rule["emit_per"].get("iterate", {})
        if iterate.get("mode") not in MODES or "field" not in iterate:
            faults.append(".emit_per.iterate: unknown mode or no field")
        elif {"SPLIT": "separator", "ABSENT_FROM_SET": "universe"}.get(iterate["mode"], "field") not in iterate:
            faults.append(f".emit_per.iterate: {iterate['mode']} lacks its argument")
    faults += [f"{at}.{c}: missing" for c in ("territorial_basis", "legal_effect", "legal_basis", "scope", "effective_from", "effective_to") if c not in emit]
    faults += [f"{at}.{c}: missing" for c in RESOLVED if c not in emit and f"{c}_from" not in emit]
    for c in ("effective_from", "effective_to"):
        if c in emit and (emit[c].get("derivation") not in DERIVATIONS or ("FIELD" in emit[c]["derivation"]) != ("field" in emit[c])):
            faults.append(f"{at}.{c}: unknown derivation or field")
    return faults + _value_faults(at, emit)


def _value_faults(at: str, block: dict) -> list[str]:
    faults = [f"{at}.{c}: not one of {allowed}" for c, allowed in ENUMS.items() if block.get(c, allowed[0]) not in allowed]
    for c, value in block.items():
        if c.endswith("_from") and c[:-5] in (*RESOLVED, *FACT_MAPPED) and not ({"field", "map"} <= set(value)):
            faults.append(f"{at}.{c}: no field or map")
    return faults


def _template(text: str) -> list[tuple[str | None, str | None]]:
    parts, at = [], 0
    for found in FIELD_REF.finditer(text):
        parts += [(text[at : found.start()], None), (None, found[1])]
        at = found.end()
    return [*parts, (text[at:], None)]


def _name(declared: str | dict | None) -> str | None:
    return declared["field"] if isinstance(declared, dict) else declared


def _row(order: int, rule: dict) -> dict:
    """The data of one rule, by the columns of ``_RULE``."""
    per, fact, finding = rule.get("emit_per"), rule.get("emit_status_fact"), rule.get("finding")
    emit = per["emit"] if per else fact or rule.get("emit") or {}
    iterate = per["iterate"] if per else {}
    row = {
        "rule_ord": order, "rule_id": rule["rule_id"], "kind": "FACT" if fact else "FINDING" if finding else "ASSERTION", "required": rule.get("required_fields", []),
        "mode": iterate.get("mode"), "item_field": iterate.get("field"), "separator": iterate.get("separator"), "universe": iterate.get("universe"),
        "excludes": iterate.get("exclude_values", []), "excludes_field": iterate.get("exclude_field_value"), "raw_capability_code": emit.get("raw_capability_code"),
        "reported_status": emit.get("reported_status"), "reported_status_field": _name(emit.get("reported_status_from")), "status_intervals_field": INTERVALS_FIELD if fact else _name(emit.get("status_intervals_from")),
        "root_key_field": _name(emit.get("root_key_from")), "root_home_field": _name(emit.get("root_home_jurisdiction_from")), "provenance": bool(emit.get("emit_source_provenance")) or not fact,
        "classification": (finding or {}).get("classification"), "detail": (finding or fact or {}).get("detail"),
    }
    for c in dict.fromkeys((*RESOLVED, *FACT_MAPPED, *LITERALS)):
        mapped = emit.get(f"{c}_from")
        row[c], row[f"{c}_from"] = emit.get(c), (mapped["field"], mapped["map"]) if mapped else None
    for c in ("legal_basis", "scope"):
        row[c] = _template(emit[c]) if not fact and c in emit else None
    for c in ("effective_from", "effective_to"):
        spec = emit.get(c) if isinstance(emit.get(c), dict) else None
        row[c] = (spec["derivation"], LAST_AUTHORISATION_FIELD if spec["derivation"] == "EBA_ENT_AUT_LAST_AUTH" else spec.get("field")) if spec else None
    if fact:
        row["effective_literal"] = emit.get("effective_from")
        row["effective_from"] = ("FIELD_COPY_OR_NULL", emit["effective_from_field"]) if "effective_from_field" in emit else None
    return row


def _table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(_RULE)
    rows = [_row(k, r) for k, r in enumerate(rules.rules)]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def fields(rules: RuleSet) -> set[str]:
    """Names of the fields of a group that the rules read; without the others they give the same."""
    found = {c["field"] for r in rules.rules for c in r["match"].get("conditions", [])}
    for k, rule in enumerate(rules.rules):
        row = _row(k, rule)
        found |= {*row["required"], *(row[c] for c in ("item_field", "excludes_field", "reported_status_field", "status_intervals_field", "root_key_field", "root_home_field"))}
        found |= {row[f"{c}_from"][0] for c in dict.fromkeys((*RESOLVED, *FACT_MAPPED, *LITERALS)) if row[f"{c}_from"]}
        found |= {field for c in ("legal_basis", "scope") for _, field in row[c] or ()} | {row[c][1] for c in ("effective_from", "effective_to") if row[c]}
    return {f for f in found if f and f != ITEM}


def _text(field: Column) -> Column:
    return F.try_element_at("texts", field)


def _list(field: Column) -> Column:
    return F.try_element_at("lists", field)


def _holds(condition: dict, text_of: Callable[[str], Column], list_of: Callable[[str], Column]) -> Column:
    name = condition["field"]
    if condition["op"] == "ABSENT_IN":
        return OPS["ABSENT_IN"](list_of(name), condition["value"])
    text = text_of(name)
    if condition["op"] in ("NULL", "NOT_NULL"):  # a list counts as a value
        text = F.coalesce(text, F.when(list_of(name).isNotNull(), F.lit("[]")))
    return OPS[condition["op"]](text, condition.get("value"))


def _fires(rule: dict, text_of: Callable[[str], Column], list_of: Callable[[str], Column]) -> Column:
    return (F.col("source") == rule["match"]["source"]) & all_of([_holds(c, text_of, list_of) for c in rule["match"].get("conditions", [])])


def fired_by(records: DataFrame, texts: set[str], lists: set[str], rules: RuleSet, kind: str) -> DataFrame:
    """Those of ``records``, whose fields are columns yet, for which a rule of ``kind`` fires."""
    text_of = lambda n: F.col(n).cast("string") if n in texts else F.lit(None).cast("string")
    list_of = lambda n: F.col(n) if n in lists else F.lit(None).cast("array<string>")
    any_of = F.lit(False)
    for k, r in enumerate(rules.rules):
        if _row(k, r)["kind"] == kind:
            any_of = any_of | F.coalesce(_fires(r, text_of, list_of), F.lit(False))
    return records.where(any_of)


def _laid_out(groups: DataFrame, rules: RuleSet) -> DataFrame:
    names = sorted({c["field"] for r in rules.rules for c in r["match"].get("conditions", [])})
    return groups.select("*", *(_text(F.lit(n)).alias(f"text {n}") for n in names), *(_list(F.lit(n)).alias(f"list {n}") for n in names))


def _items() -> Column:
    """Items of a rule that emits one row an item, first ones of equals, without empty or excluded ones."""
    raw, every, item = _text(F.col("item_field")), _list(F.col("item_field")), F.col("mode")
    found = (
        F.when(item == "SPLIT", F.when(F.trim(raw) != "", F.transform(F.split(raw, F.concat(F.lit("\\Q"), F.col("separator"), F.lit("\\E"))), lambda x: F.trim(x))))
        .when(item == "ABSENT_FROM_SET", F.when(every.isNotNull(), F.array_except("universe", every)))
        .otherwise(every)
    )
    out = F.coalesce(_text(F.col("excludes_field")), F.lit(""))
    kept = F.filter(found, lambda x: (x != "") & ~F.array_contains("excludes", x) & (x != out))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def _resolved(name: str) -> Column:
    """A value by map, by the item or as it stands."""
    mapped = F.col(f"{name}_from")
    source = F.when(mapped["field"] == ITEM, F.col("item")).otherwise(_text(mapped["field"]))
    return F.when(mapped.isNotNull(), F.try_element_at(mapped["map"], source)).when(F.col(name) == ITEM, F.col("item")).otherwise(F.col(name))


def _filled(name: str) -> tuple[Column, Column]:
    """A template filled in, and the fields that it lacks."""
    parts = F.col(name)
    text = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], _text(p["field"]))), "")
    lacks = F.filter(F.transform(parts, lambda p: p["field"]), lambda f: f.isNotNull() & (F.coalesce(_text(f), F.lit("")) == ""))
    return text, F.coalesce(lacks, F.array().cast("array<string>"))


def _dated(name: str, evidence_as_of: str) -> Column:
    """A date as text."""
    kind, text = F.col(f"{name}.derivation"), _text(F.col(f"{name}.field"))
    return F.when(kind == "EVIDENCE_AS_OF", F.lit(evidence_as_of)).when(kind.startswith("FIELD_DDMMYYYY"), F.date_format(spanish_date(text), "yyyy-MM-dd")).when(kind != "CONSTANT_NULL", text)


def _underived(name: str) -> Column:
    kind = F.col(f"{name}.derivation")
    return ~kind.isin("CONSTANT_NULL", "EVIDENCE_AS_OF") & ~kind.endswith("_OR_NULL") & F.col(f"{name} day").isNull()


def outcomes(groups: DataFrame, rules: RuleSet, evidence_as_of: str) -> DataFrame:
    """Every emission of every rule that fires, with its values and its problems; order: group_ord, rule_ord, item_ord."""
    fires = [F.when(_fires(r, lambda n: F.col(f"text {n}"), lambda n: F.col(f"list {n}")), F.lit(k)) for k, r in enumerate(rules.rules)]
    keys = ["group_ord", "entity_id", "source", "register_id", "texts", "lists", "claim_ids", "source_assertions"]
    fired = _laid_out(groups, rules).select(*keys, F.explode(F.array_compact(F.array(*fires, F.lit(None).cast("int")))).alias("rule_ord"))
    rows = fired.join(F.broadcast(_table(groups.sparkSession, rules)), "rule_ord")
    lacking = F.filter("required", lambda f: _text(f).isNull() & _list(f).isNull())
    each = F.when(F.size(lacking) > 0, F.array(F.lit(None).cast("string"))).when(F.col("mode").isNotNull(), _items()).otherwise(F.array(F.lit(None).cast("string")))
    rows = rows.withColumn("lacking", lacking).select("*", F.posexplode(each).alias("item_ord", "item"))
    names, texts, dates = tuple(dict.fromkeys((*RESOLVED, *FACT_MAPPED))), ("legal_basis", "scope"), ("effective_from", "effective_to")
    made = {f"{c} value": _resolved(c) for c in names} | {f"{c} lacks": _filled(c)[1] for c in texts} | {f"{c} text": _filled(c)[0] for c in texts} | {f"{c} day": _dated(c, evidence_as_of) for c in dates}
    rows = rows.withColumns(made)
    failed = lambda c: F.col(f"{c}_from").isNotNull() & F.col(f"{c} value").isNull()
    problem = lambda classification, detail: F.struct(classification.alias("classification"), detail.alias("detail"))
    unmapped = F.array_compact(F.array(*(F.when(failed(c), problem(F.lit(code), F.concat(F.lit(f"{c} of "), F.col(f"{c}_from")["field"], F.lit(" has no mapping")))) for c, code in RESOLVED.items())))
    refs = F.concat(*(F.col(f"{c} lacks") for c in texts))
    one = lambda when, p: F.when(when, F.array(p))
    none = F.array().cast("array<struct<classification:string,detail:string>>")
    problems = F.coalesce(
        one(F.size("lacking") > 0, problem(F.lit(MISSING), F.concat(F.lit("missing: "), F.array_join("lacking", ", ")))),
        one(F.col("kind") == "FINDING", problem(F.col("classification"), F.col("detail"))),
        F.when(F.col("kind") == "FACT", none),
        F.when(F.size(unmapped) > 0, unmapped),
        *(one(_underived(c), problem(F.lit(UNDERIVABLE), F.lit(f"{c} cannot be derived"))) for c in dates),
        one(F.size(refs) > 0, problem(F.lit(MISSING), F.concat(F.lit("missing in a text: "), F.array_join(refs, ", ")))),
        none,
    )
    raw = F.when(F.col("raw_capability_code") == ITEM, F.col("item")).otherwise(F.col("raw_capability_code"))
    status = F.coalesce("reported_status", _text(F.col("reported_status_field")))
    cited = lambda c: F.when(F.col("provenance"), F.col(c))
    plain = [c for c in LITERALS if c not in FACT_MAPPED]
    return rows.select(
        "group_ord", "rule_ord", "item_ord", "kind", "entity_id", "source", "register_id", "rule_id", problems.alias("problems"),
        *(F.col(f"{c} value").alias(c) for c in names), *plain, *(F.col(f"{c} text").alias(c) for c in texts),
        F.coalesce("effective_literal", "effective_from day").alias("effective_from"), F.col("effective_to day").alias("effective_to"), raw.alias("raw_capability_code"),
        status.alias("reported_status"), F.when(F.col("kind") == "FACT", F.col("detail")).alias("detail"), _list(F.col("status_intervals_field")).alias("status_intervals"),
        _text(F.col("root_key_field")).alias("root_key"), _text(F.col("root_home_field")).alias("root_home_jurisdiction"), cited("claim_ids").alias("source_claim_ids"), cited("source_assertions").alias("source_assertions"),
    )


ASSERTION = (
    "register_id", "entity_id", "entity_class", "activity", "jurisdiction", "legal_effect", "entry_mechanism", "territorial_basis", "legal_basis", "effective_from", "effective_to", "scope", "rule_id",
    "source_claim_ids", "source_assertions", "evidence_basis", "reported_status", "status_intervals", "evidence_composition", "negative_scope", "negative_evidence_class", "source_granularity",
    "interval_end", "admissibility", "blocker", "coverage_policy_id", "raw_capability_code", "root_key", "root_home_jurisdiction",
)
FACT = (
    "entity_id", "source", "rule_id", "reported_status", "status_intervals", "detail", "negative_scope", "negative_evidence_class", "interval_end", "canonical_activity", "entry_mechanism",
    "coverage_policy_id", "effective_from", "root_key", "root_home_jurisdiction", "source_claim_ids", "source_assertions",
)
#: Order of emission: first pass by group, rule and item; then derived rules, by the order of what they start from.
ORDER = ("pass", "at1", "at2", "at3", "at4")


def _ordered(pass_: int, *at: Column) -> list[Column]:
    at = [*at, *[F.lit(0)] * (4 - len(at))]
    return [F.lit(pass_).alias("pass"), *(c.cast("long").alias(f"at{k}") for k, c in enumerate(at, 1))]


def _first_pass(found: DataFrame, version: str) -> DataFrame:
    return found.where((F.col("kind") == "ASSERTION") & (F.size("problems") == 0)).select(
        *_ordered(0, F.col("group_ord"), F.col("rule_ord"), F.col("item_ord")), *ASSERTION, F.lit(version).alias("ruleset_version"), F.lit(None).cast("string").alias("derived_by")
    )


def _may_emit(row: dict, values: dict) -> bool:
    """Whether a rule, by its row, may emit these values; what its row does not tell it may."""
    if row["kind"] != "ASSERTION":
        return False
    for c, value in values.items():
        if c in (*RESOLVED, *FACT_MAPPED) and row.get(f"{c}_from"):
            if value not in row[f"{c}_from"][1].values() and value is not None:
                return False
        elif c in (*RESOLVED, *FACT_MAPPED, *LITERALS) and row[c] not in (ITEM, value):
            return False
    return True


def _sources(rules: RuleSet, n: int, values: dict) -> tuple[list[int], list[int]]:
    """Ordinals of the rules, and of the first ``n`` derived ones, that may emit these values."""
    known = lambda r: r["emit"] | {"entity_class": r["base"]["entity_class"]}
    own = [k for k, r in enumerate(rules.rules) if _may_emit(_row(k, r), values)]
    return own, [j for j, r in enumerate(rules.derived[:n]) if all(known(r).get(c, v) == v for c, v in values.items())]


def _among(first: DataFrame, later: list[DataFrame], own: list[int], derived: list[int]) -> DataFrame:
    """Assertions of these rules: of the first pass by ``at2``, and of derived ones."""
    out = first.where(F.col("at2").isin(own))
    for j in derived:
        out = out.unionByName(later[j])
    return out


def _derived(first: DataFrame, rules: RuleSet, put: Callable[[int, DataFrame], DataFrame] = lambda k, rows: rows) -> list[DataFrame]:
    """Assertions of each derived rule, as ``put`` leaves them."""
    made_: list[DataFrame] = []
    for k, rule in enumerate(rules.derived):
        hit = _starts(_among(first, made_, *_sources(rules, k, rule["base"])), rule)
        order = F.struct(*ORDER)
        once = ["entity_id", "jurisdiction", "territorial_basis"]  # the other three are the rule's own
        kept = ("register_id", "entity_class", "effective_from", "effective_to", "source_claim_ids", "source_assertions")
        one = hit.groupBy(*once).agg(F.min_by(F.struct(*ORDER, *kept), order).alias("base")).select(*once, "base.*")
        emit = rule["emit"]
        made = {c: F.lit(emit[c]) for c in ("activity", "legal_effect", "entry_mechanism", "legal_basis", "scope")} | {"rule_id": F.lit(rule["rule_id"])}
        place = _ordered(k + 1, F.col("pass") * (1 << 32) + F.col("at1"), F.col("at2"), F.col("at3"), F.col("at4"))
        columns = [(made.get(c) if c in made else F.col(c) if c in one.columns else F.lit(None).cast(first.schema[c].dataType)).alias(c) for c in ASSERTION]
        made_.append(put(k, one.select(*place, *columns, F.lit(rule["ruleset_version"]).alias("ruleset_version"), F.lit(rule["rule_id"]).alias("derived_by"))))
    return made_


def assertions(found: DataFrame, rules: RuleSet, version: str) -> DataFrame:
    """Assertions of both passes, unnumbered: ``ORDER``, ``ASSERTION``, ruleset_version and derived_by.

    A derived rule starts from assertions that equal its base, those of earlier derived rules
    included, and emits one row for each entity, activity, place, basis, effect and mechanism: that
    of the first one emitted.
    """
    every = _first_pass(found, version)
    for more in _derived(every, rules):
        every = every.union(more)
    return every


def _starts(every: DataFrame, rule: dict) -> DataFrame:
    return every.where(all_of([F.col(c).eqNullSafe(F.lit(v)) for c, v in rule["base"].items()]))


def facts(found: DataFrame) -> DataFrame:
    """Reported facts, unnumbered; one without a status is none."""
    kept = (F.col("kind") == "FACT") & (F.size("problems") == 0) & F.col("reported_status").isNotNull()
    return found.where(kept).select(*_ordered(0, F.col("group_ord"), F.col("rule_ord")), *FACT)


def findings(found: DataFrame, every: DataFrame, rules: RuleSet) -> DataFrame:
    """Findings of both passes, unnumbered: ``ORDER``, who (the last of the order), entity_id, source, rule_id, classification, detail.

    A derived rule that starts from nothing gives one for each entity that has its base's class.
    """
    columns = ("entity_id", "source", "rule_id", "classification", "detail")
    out = found.select("group_ord", "rule_ord", "item_ord", "entity_id", "source", "rule_id", F.posexplode("problems").alias("n", "p")).select(
        *_ordered(0, F.col("group_ord"), F.col("rule_ord"), F.col("item_ord"), F.col("n")), F.lit(None).cast(found.schema["entity_id"].dataType).alias("who"), "entity_id", "source", "rule_id", "p.classification", "p.detail"
    )
    for k in range(len(rules.derived)):
        out = out.union(_idle(every, rules, k))
    return out


def _idle(every: DataFrame, rules: RuleSet, k: int) -> DataFrame:
    """Findings of a derived rule that starts from nothing."""
    rule = rules.derived[k]

    def before(values: dict) -> DataFrame:  # what stood when the rule ran, of rules that may emit the values
        own = _sources(rules, k, values)[0]
        return every.where((F.col("pass") <= k) & ((F.col("pass") > 0) | F.col("at2").isin(own)))

    columns = ("entity_id", "source", "rule_id", "classification", "detail")
    named = {"entity_class": rule["base"]["entity_class"]}
    idle = before(named).where(F.col("entity_class") == named["entity_class"]).select("entity_id").distinct().withColumn("rule_id", F.lit(rule["rule_id"]))
    if any(_sources(rules, k, rule["base"])):
        idle = idle.where(_starts(before(rule["base"]), rule).limit(1).agg(F.count("*")).scalar() == 0)
    spec = rule["untriggered_finding"]
    row = {"source": F.lit(None).cast("string"), "classification": F.lit(spec["classification"]), "detail": F.lit(spec["detail"])}
    return idle.select(*_ordered(k + 1), F.col("entity_id").alias("who"), *((row[c] if c in row else F.col(c)).alias(c) for c in columns))


def numbered(rows: DataFrame, name: str, prefix: str) -> DataFrame:
    """``rows`` with an id in the order of emission: ``<prefix>-001`` and on."""
    order = [c for c in (*ORDER, "who") if c in rows.columns]
    return _with_id(ordinal(rows, order), name, prefix).drop(*order)


def _with_id(seq: DataFrame, name: str, prefix: str) -> DataFrame:
    number = F.col("seq").cast("string")
    return seq.withColumn(name, F.concat(F.lit(f"{prefix}-"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))).drop("seq")


def numbered_assertions(records: DataFrame, read: Callable[[DataFrame], DataFrame], rules: RuleSet, evidence_as_of: str, version: str, at: list[int], name: str, prefix: str) -> DataFrame:
    """Assertions of both passes as ``numbered`` gives them, for any number of groups: none of their rows is written.

    ``records`` has the groups for which a rule may emit, in few columns, and ``read`` makes groups of
    them. They go through one exchange, in ranges of ``group_ord`` between the cuts ``at``; assertions
    are made of them there in order. Those of derived rules go through one more.
    """
    held = ranged(records, "group_ord", at)

    def first(in_order: bool) -> DataFrame:
        return _first_pass(outcomes(read(held.sortWithinPartitions("group_ord") if in_order else held), rules, evidence_as_of), version)

    def each(rows: DataFrame) -> Callable[[bool], DataFrame]:
        return lambda in_order: rows.sortWithinPartitions(*ORDER) if in_order else rows

    spans, starts = _spans(rules, at), [any(_sources(rules, k, r["base"])) for k, r in enumerate(rules.derived)]
    later = _derived(first(False), rules, lambda k, rows: ranged(rows, "at1", spans[k]))
    tables = [(first, part_of(F.col("at1"), at)), *((each(rows), part_of(F.col("at1"), spans[k])) for k, rows in enumerate(later) if starts[k])]
    return _with_id(in_sequence(tables), name, prefix).drop(*ORDER)


def _spans(rules: RuleSet, at: list[int]) -> list[list[int]]:
    """Cuts of ``at1`` for each derived rule: those of groups, again for each pass that it may start from."""
    high, spans = [0], []
    for k, rule in enumerate(rules.derived):
        high.append(max((j + 1 + high[j + 1] for j in _sources(rules, k, rule["base"])[1]), default=0))
        spans.append(sorted({*at, *(c + (p << 32) for p in range(1, high[-1] + 1) for c in (0, *at))}))
    return spans


def numbered_facts(records: DataFrame, read: Callable[[DataFrame], DataFrame], rules: RuleSet, evidence_as_of: str, at: list[int], name: str, prefix: str) -> DataFrame:
    """Reported facts likewise."""
    held = ranged(records, "group_ord", at)
    rows = lambda in_order: facts(outcomes(read(held.sortWithinPartitions("group_ord") if in_order else held), rules, evidence_as_of))
    return _with_id(in_sequence([(rows, part_of(F.col("at1"), at))]), name, prefix).drop(*ORDER)


def run(groups: DataFrame, rules: RuleSet, evidence_as_of: str, version: str, prefix: str) -> dict[str, DataFrame]:
    """Tables ``assertions``, ``facts`` and ``findings``, each with ids of its own."""
    found = kept(outcomes(groups, rules, evidence_as_of))  # written once, read by all three
    every = assertions(found, rules, version)
    return {
        "assertions": numbered(every, "assertion_id", f"{prefix}-asm"),
        "facts": numbered(facts(found), "fact_id", f"{prefix}-fact"),
        "findings": numbered(findings(found, every, rules), "finding_id", f"{prefix}-fnd"),
    }


def _tallies(found: DataFrame, rules: RuleSet, version: str) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Tables and what their rows add to the counts of ``header``.

    Where derived rules start from the first pass alone, all is one grouping by entity: a derived
    rule emits for each place and basis that an entity starts from.
    """
    one, zero, none = F.lit(1), F.lit(0), F.size("problems") == 0
    emits = none & (F.col("kind") == "ASSERTION")
    of = lambda which: F.when(which, one).otherwise(zero)
    own = {"assertions_emitted": of(emits), "findings_emitted": F.size("problems"), "reported_facts_emitted": of(none & (F.col("kind") == "FACT") & F.col("reported_status").isNotNull())}
    if any(_sources(rules, k, r["base"])[1] for k, r in enumerate(rules.derived)) or any(c not in found.columns for r in rules.derived for c in r["base"]):
        first, tables = _first_pass(found, version), [(found, own)]
        every, derived = first, _derived(first, rules)
        for k, rows in enumerate(derived):
            tables += [(_idle(every, rules, k), {"findings_emitted": one}), (rows, {"assertions_emitted": one})]
            every = every.union(rows)
        return tables
    by_entity = {c: F.sum(n).alias(c) for c, n in own.items()}
    for k, rule in enumerate(rules.derived):
        starts = emits & all_of([F.col(c).eqNullSafe(F.lit(v)) for c, v in rule["base"].items()])
        by_entity |= {f"starts {k}": F.size(F.collect_set(F.when(starts, F.struct("jurisdiction", "territorial_basis")))).alias(f"starts {k}")}
        by_entity |= {f"named {k}": F.max(of(emits & (F.col("entity_class") == rule["base"]["entity_class"]))).alias(f"named {k}")}
    total = found.groupBy("entity_id").agg(*by_entity.values()).agg(*(F.sum(c).alias(c) for c in by_entity))
    ks = range(len(rules.derived))
    idle = sum((F.when(F.col(f"starts {k}") == 0, F.col(f"named {k}")).otherwise(zero) for k in ks), F.col("findings_emitted"))
    return [(total, {"assertions_emitted": sum((F.col(f"starts {k}") for k in ks), F.col("assertions_emitted")), "findings_emitted": idle, "reported_facts_emitted": F.col("reported_facts_emitted")})]


def header(groups: DataFrame, found: DataFrame, rules: RuleSet, artifact_version: str, version: str, pinned: bool = True) -> DataFrame:
    """One row that pins what an artefact was made of and how much it holds.

    The digest of the groups is that of their rows, in whatever order or layout they are stored; it
    is NULL unless ``pinned``. What the rules made is counted in one reading, without what it says.
    """
    zero = F.lit(0).cast("long")

    def counted(rows: DataFrame, **n: Column) -> DataFrame:
        names = ("claims_consumed", "assertions_emitted", "findings_emitted", "reported_facts_emitted")
        return rows.select(F.lit(None).cast("string").alias("claims_sha256"), *(n.get(c, zero).cast("long").alias(c) for c in names))

    parts = counted(groups, claims_consumed=F.size("claim_ids"))
    for rows, n in _tallies(found, rules, version):
        parts = parts.union(counted(rows, **n))
    if pinned:
        content = [c for c in groups.columns if c != "group_ord"]
        digest = table_digest(groups.select("group_ord", *(F.to_json(F.struct(c)).alias(c) for c in content)), "group_ord", content)
        parts = parts.union(digest.select(F.col("digest"), *[zero] * 4))
    return parts.agg(F.max("claims_sha256").alias("claims_sha256"), *(F.sum(c).alias(c) for c in parts.columns[1:])).select(
        F.lit(artifact_version).alias("artifact_version"), F.lit(version).alias("derivation_version"), F.lit(rules.version).alias("ruleset_version"), F.lit(rules.sha256).alias("ruleset_sha256"), "*",
        F.lit("NOT_RUN").alias("assessment"),
    )


def dumps(version: str, rules: list[dict], derived: list[dict]) -> str:
    """The text of a rule file: keys in order, one rule set whatever order its parts were written in."""
    return json.dumps({"ruleset": {"ruleset_version": version, "rules": rules, "derived_rules": derived}}, sort_keys=True, ensure_ascii=False, indent=1)
