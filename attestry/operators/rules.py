"""Declarative rules compiled to columns.

A rule is data: a source, conditions, required fields and one of four outcomes (assertion,
assertion per item, status fact, finding). The compiler makes one struct a rule; a row gets
the structs of the rules that fire by one explode, so all rules share a single scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.conditions import all_of, condition, missing_fields
from attestry.functions.scalars import spanish_date, split_items, template
from attestry.operators.tables import ordinal


@dataclass(frozen=True)
class Iterate:
    """Items of a list-like field: SPLIT, LIST, DICT_KEYS or ABSENT_FROM_SET."""

    field: str
    mode: str
    separator: str = r"\|"
    universe: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()
    excludes_field: str | None = None

    def items(self) -> Column:
        col = F.col(self.field)
        if self.mode == "SPLIT":
            found = split_items(col, self.separator)
        elif self.mode == "LIST":
            found = col
        elif self.mode == "DICT_KEYS":
            found = F.map_keys(col)  # of one map
        elif self.mode == "ABSENT_FROM_SET":
            found = F.array_except(F.array(*map(F.lit, self.universe)), col)  # a list that is missing says nothing
        else:
            raise ValueError(f"unknown mode {self.mode}")
        kept = F.filter(found, lambda x: (x != "") & ~x.isin(list(self.excludes)) if self.excludes else x != "")
        if self.excludes_field:
            kept = F.filter(kept, lambda x: ~x.eqNullSafe(F.col(self.excludes_field)))
        return F.array_distinct(F.coalesce(kept, F.array().cast("array<string>")))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    source: str
    conditions: tuple[tuple, ...] = ()
    required: tuple[str, ...] = ()
    kind: str = "EMIT"  # EMIT, EMIT_PER, STATUS_FACT or FINDING
    iterate: Iterate | None = None
    emit: dict[str, str] = field(default_factory=dict)  # output: literal, {template} or $ITEM
    mapping: dict[str, dict[str, str]] = field(default_factory=dict)  # output: {value of its template: mapped}


OUTPUT = ("activity", "legal_effect", "detail")


def effective_date(kind: str, of: Column | None = None, evidence_as_of: Column | None = None) -> Column:
    """A date by one of seven derivations, and whether it is there: a struct of day and ok.

    A rule whose date is not ok yields a finding. The kinds that end in OR_NULL and CONSTANT_NULL
    are always ok.
    """
    day = {
        "CONSTANT_NULL": lambda: F.lit(None).cast("date"),
        "EVIDENCE_AS_OF": lambda: evidence_as_of,
        "FIELD_COPY": lambda: F.try_to_date(of, "yyyy-MM-dd"),
        "FIELD_DDMMYYYY": lambda: spanish_date(of),
        "LAST_AUTHORISATION": lambda: F.when(F.size(of) > 0, F.when(F.size(of) % 2 == 1, F.get(of, F.size(of) - 1)).otherwise(F.get(of, F.size(of) - 2))),
    }
    name = kind.removesuffix("_OR_NULL")
    if name not in day or (kind != name and name not in ("FIELD_COPY", "FIELD_DDMMYYYY")):
        raise ValueError(f"unknown derivation {kind}")
    found = day[name]()
    return F.struct(found.alias("day"), (F.lit(True) if kind == "CONSTANT_NULL" or kind != name else found.isNotNull()).alias("ok"))


def _value(rule: Rule, name: str, fields: dict[str, Column], item: Column | None) -> Column:
    text = rule.emit.get(name)
    if text is None:
        return F.lit(None).cast("string")
    value = item if text == "$ITEM" else template(text, fields)
    if name in rule.mapping:
        pairs = [F.lit(x) for p in rule.mapping[name].items() for x in p]
        value = F.try_element_at(F.create_map(*pairs), value)
    return value


def _outcome(rule: Rule, order: int, fields: dict[str, Column]) -> Column:
    """An array of structs: none if the rule doesn't fire, findings if something is missing."""
    fires = (F.col("source") == rule.source) & all_of([condition(F.col(c[0]), *c[1:]) for c in rule.conditions])
    missing = missing_fields(list(rule.required)) if rule.required else F.array().cast("array<string>")

    def row(item: Column | None, at: Column) -> Column:
        values = {name: _value(rule, name, fields, item) for name in OUTPUT}
        unresolved = reduce(lambda a, b: a | b, [values[n].isNull() for n in OUTPUT if n in rule.emit], F.lit(False))
        kind = F.when(F.lit(rule.kind == "FINDING"), "FINDING").when(unresolved, "FINDING").otherwise(rule.kind)
        return F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(order).alias("rule_ord"), at.cast("int").alias("item_ord"), kind.alias("kind"), *(values[n].alias(n) for n in OUTPUT))

    if rule.kind == "EMIT_PER":
        rows = F.transform(rule.iterate.items(), lambda x, i: row(x, i))
    else:
        rows = F.array(row(None, F.lit(0)))
    lacking = F.array(
        F.struct(
            F.lit(rule.rule_id).alias("rule_id"), F.lit(order).alias("rule_ord"), F.lit(0).alias("item_ord"), F.lit("FINDING").alias("kind"),
            F.lit(None).cast("string").alias("activity"), F.lit(None).cast("string").alias("legal_effect"), F.concat(F.lit("missing "), F.array_join(missing, ",")).alias("detail"),
        )
    )
    return F.when(fires & (F.size(missing) > 0), lacking).when(fires, rows).otherwise(F.slice(lacking, 1, 0))


def derive(groups: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """Rows and findings of all rules: key, rule_id, rule_ord, item_ord, kind, activity, legal_effect, detail."""
    fields = {c: F.col(c) for c in groups.columns}
    fired = F.flatten(F.array(*(_outcome(r, k, fields) for k, r in enumerate(rules))))
    return groups.select(key, F.explode(fired).alias("r")).select(key, "r.*")


def second_pass(derived: DataFrame, key: str, base: dict[str, str], emit: dict[str, str], once: tuple[str, ...] = ("activity",)) -> DataFrame:
    """Rows derived from emitted rows that equal ``base``, with some columns replaced: of each key and ``once`` the first emitted."""
    hit = derived.where(all_of([F.col(c) == v for c, v in base.items()]) & (F.col("kind") != "FINDING"))
    rows = hit.withColumns({c: F.lit(v) for c, v in emit.items()})
    first = rows.groupBy(key, *once).agg(F.min_by(F.struct(*rows.columns), F.struct("rule_ord", "item_ord")).alias("_r"))
    return first.select("_r.*")


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Ids by (key, rule_ord, item_ord) in one sequence, without one task for all rows."""
    return ordinal(rows, [key, "rule_ord", "item_ord"])
