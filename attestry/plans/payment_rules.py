"""A rule set for payment institutions in two kinds of register, as rule file text.

Twenty-six rules come from three tables: vectors (a list of service codes of a record says which
services it may provide, and, being complete, which it may not), facts and findings.
"""

from __future__ import annotations

from attestry.operators import registers as G
from attestry.operators.rulefile import dumps

VERSION = "PAYMENT_RULES_1"

# codes, classes and mechanisms that must equal those of the registers (fixed values)
_ACTIVITIES = (
    "PAYMENT_ACCOUNT_CASH_PLACEMENT", "PAYMENT_ACCOUNT_CASH_WITHDRAWAL", "PAYMENT_DIRECT_DEBIT_EXECUTION", "PAYMENT_CARD_TRANSACTION_EXECUTION", "PAYMENT_CREDIT_TRANSFER_EXECUTION",
    "PAYMENT_DIRECT_DEBIT_EXECUTION_CREDIT_LINE", "PAYMENT_CARD_TRANSACTION_EXECUTION_CREDIT_LINE", "PAYMENT_CREDIT_TRANSFER_EXECUTION_CREDIT_LINE", "PAYMENT_INSTRUMENT_ISSUING",
    "PAYMENT_TRANSACTION_ACQUIRING", "MONEY_REMITTANCE", "PAYMENT_INITIATION_SERVICES", "ACCOUNT_INFORMATION_SERVICES",
)
EU_CODES = ("PS_010", "PS_020", "PS_03A", "PS_03B", "PS_03C", "PS_04A", "PS_04B", "PS_04C", "PS_05A", "PS_05B", "PS_060", "PS_070", "PS_080")
NATIONAL_CODES = ("1", "2", "3.A", "3.B", "3.C", "4.A", "4.B", "4.C", "5.A", "5.B", "6", "7", "8")
E_MONEY, EU_E_MONEY, NATIONAL_E_MONEY = "E_MONEY_ISSUANCE", "ES_010", ("A", "B", "C")
#: National families of codes, and older codes that forbid a negative of the family.
FAMILIES = (("base", ("1", "2", "6", "7", "8"), ()), ("f3", ("3.A", "3.B", "3.C"), ("3.1", "3.2", "3.3")), ("f4", ("4.A", "4.B", "4.C"), ("4.1", "4.2", "4.3")), ("f5", ("5.A", "5.B"), ("5",)))
PI, EMI, AISP = "PAYMENT_INSTITUTION", "E_MONEY_INSTITUTION", "ACCOUNT_INFORMATION_SERVICE_PROVIDER"
EU_CLASS = {"PSD_PI": PI, "PSD_EMI": EMI, "PSD_AISP": AISP}
NATIONAL_CLASS = {"TEEP": PI, "TEEFEP": PI, "TEEFPH": PI, "TEEDE": EMI, "TEPSIC": AISP, "TESEPC": PI, "TESEDC": EMI}
DOMESTIC_TYPES, BRANCH_TYPES = ("TEEP", "TEEFEP", "TEEFPH", "TEPSIC"), ("TESEPC", "TESEDC")
CLOSURE_CLASS = {"WITHDRAWAL": "EXPLICIT_WITHDRAWAL", "TRANSFORMATION": "ENTITY_BAJA", "UNRESOLVED_MOTIVO": "ENTITY_BAJA"}
BLOCKER = "TRANSFORMATION_SUCCESSOR_SEMANTICS_UNRESOLVED"

EU_MAP = dict(zip(EU_CODES, _ACTIVITIES, strict=True)) | {EU_E_MONEY: E_MONEY}
NATIONAL_MAP = dict(zip(NATIONAL_CODES, _ACTIVITIES, strict=True)) | dict.fromkeys(NATIONAL_E_MONEY, E_MONEY)


def _mechanisms(classes: dict[str, str]) -> dict[str, str]:
    """Account information services are registered, all others authorised."""
    return {k: "REGISTRATION" if v == AISP else "AUTHORISATION" for k, v in classes.items()}


def _is(field: str, value: object = None, op: str | None = None) -> dict:
    if op is None:
        op = "IN" if isinstance(value, tuple) else "EQ"
    return {"field": field, "op": op} | ({} if op in ("NULL", "NOT_NULL") else {"value": list(value) if isinstance(value, tuple) else value})


def _there(field: str) -> dict:
    return _is(field, op="NOT_NULL")


def _none(field: str) -> dict:
    return _is(field, op="NULL")


def _date(kind: str, field: str | None = None) -> dict:
    return {"derivation": kind} | ({"field": field} if field else {})


def _rule(rule_id: str, source: str, conditions: list[dict], required: tuple[str, ...] = (), **outcome: object) -> dict:
    return {"rule_id": rule_id, "match": {"source": source, "conditions": conditions}, "required_fields": list(required)} | outcome


def _emit(codes: dict, classes: dict | str, class_field: str, mechanism: dict | str, basis: str, law: str, scope: str, dates: tuple[dict, dict], **more: object) -> dict:
    """A row of one service: a code mapped to an activity, class and mechanism stated or mapped."""
    named = {"entity_class": classes} if isinstance(classes, str) else {"entity_class_from": {"field": class_field, "map": classes}}
    named |= {"entry_mechanism": mechanism} if isinstance(mechanism, str) else {"entry_mechanism_from": {"field": class_field, "map": mechanism}}
    return named | {
        "activity_from": {"field": "$ITEM", "map": codes}, "raw_capability_code": "$ITEM", "source_granularity": "ATOMIC", "jurisdiction": "ES", "legal_effect": "ENTITLED_TO_PROVIDE",
        "territorial_basis": basis, "legal_basis": law, "scope": scope, "effective_from": dates[0], "effective_to": dates[1], "root_key_from": "root_key", "root_home_jurisdiction_from": "root_home_jurisdiction",
    } | more


def _absent(emit: dict, policy: str, blocked: bool = False) -> dict:
    """The negative of a vector that is complete: it holds on the day of the evidence."""
    dated = {"effective_from": _date("EVIDENCE_AS_OF"), "effective_to": _date("CONSTANT_NULL"), "legal_effect": "NOT_ENTITLED"}
    evidence = {"negative_scope": "ROUTE_CAPABILITY", "negative_evidence_class": "ENUMERATED_ABSENCE", "coverage_policy_id": policy}
    return emit | dated | evidence | ({"admissibility": "BLOCKED", "blocker": BLOCKER} if blocked else {"admissibility": "ADMISSIBLE"})


def _each(field: str, mode: str, emit: dict, **more: object) -> dict:
    return {"emit_per": {"iterate": {"field": field, "mode": mode} | more, "emit": emit}}


def _eu_rules() -> list[dict]:
    listed, text = "eba_es_services", "eba_es_services_str"
    active, now, never = _is("eba_ent_aut_status", "ACTIVE"), (_date("EVIDENCE_AS_OF"), _date("CONSTANT_NULL")), _date("CONSTANT_NULL")
    via = {"evidence_basis": "NCA_REPORTED_VIA_EBA"}
    rules = []

    def present(rule_id: str, conditions: list[dict], required: tuple[str, ...], emit: dict) -> None:
        rules.append(_rule(rule_id, G.EBA, conditions, required, **_each(text, "SPLIT", emit, separator="|")))

    def absent(rule_id: str, conditions: list[dict], emit: dict, universe: tuple[str, ...] = EU_CODES) -> None:
        rules.append(_rule(rule_id, G.EBA, conditions, ("entity_code", listed), **_each(listed, "ABSENT_FROM_SET", emit, universe=list(universe))))

    def passport(classes: dict | str) -> dict:
        law = "Directive 2015/2366 art. 28 and 18: {eba_home_nca} to ES, listed in Services{ES}"
        return _emit(EU_MAP, classes, "entity_type", "AUTHORISATION", "FREEDOM_TO_PROVIDE_SERVICES", law, "one listed service", now, **via)

    present("eba-psd2-fps-es-service-entitled", [_is("entity_type", ("PSD_PI", "PSD_EMI")), active, _there(listed)], ("entity_code", text, "eba_home_nca"), passport(EU_CLASS))
    for kind, name, universe in (("PSD_PI", "pi", EU_CODES), ("PSD_EMI", "emi", (*EU_CODES, EU_E_MONEY))):
        absent(f"eba-psd2-fps-es-service-absent-{name}", [_is("entity_type", kind), active, _there(listed)], _absent(passport(EU_CLASS[kind]) | {"legal_basis": "Directive 2015/2366: not in the complete list Services{ES}"}, "eba-fps-services-vector"), universe)

    branch = [_is("entity_type", "PSD_BR"), _is("eba_child_status", "ACTIVE"), _is("eba_parent_status", "ACTIVE"), _is("bde_branch_registered", "TRUE"), _there(listed)]
    law = "Directive 2015/2366 art. 28: branch of {eba_parent_nca}, registered on {bde_branch_fecha_alta}"
    by_branch = _emit(EU_MAP, EU_CLASS, "eba_parent_entity_type", "AUTHORISATION", "BRANCH", law, "one service of the branch", (_date("FIELD_DDMMYYYY", "bde_branch_fecha_alta"), never), evidence_composition="ALL_REQUIRED", **via)
    present("eba-psd2-branch-es-service-entitled", branch, ("entity_code", text, "bde_branch_fecha_alta"), by_branch)
    absent("eba-psd2-branch-es-service-absent", branch, _absent(by_branch | {"legal_basis": "Directive 2015/2366: not in the branch's complete list"}, "eba-branch-services-vector"))

    info = [_is("entity_type", "PSD_AISP"), active, _there(listed)]
    by_info = _emit(EU_MAP, AISP, "", "REGISTRATION", "DOMESTIC", "Directive 2015/2366 art. 33: registered service", "one listed service", now, **via)
    present("eba-psd2-aisp-service-entitled", info, ("entity_code", text), by_info)
    for name, closed, blocked in (("", _none("bde_entity_baja_kind"), False), ("-blocked", _is("bde_entity_baja_kind", "TRANSFORMATION"), True)):
        absent(f"eba-psd2-aisp-service-absent{name}", [*info, closed], _absent(by_info, "eba-aisp-services-vector", blocked))

    closed = [_is("entity_type", tuple(EU_CLASS)), _is("eba_ent_aut_status", "WITHDRAWN"), _is("country", "ES"), _there(listed)]
    dates = (_date("EBA_ENT_AUT_LAST_AUTH"), _date("FIELD_COPY", "eba_ent_aut_last_withdrawal"))
    was = _emit(EU_MAP, EU_CLASS, "entity_type", _mechanisms(EU_CLASS), "DOMESTIC", "Directive 2015/2366: from authorisation until withdrawal", "one listed service", dates, interval_end="EXCLUSIVE", **via)
    present("eba-psd2-domestic-closed-service-entitled", closed, ("entity_code", text, "eba_ent_aut_last_withdrawal"), was)

    fact = {"interval_end": "EXCLUSIVE", "root_key_from": "root_key", "root_home_jurisdiction_from": "root_home_jurisdiction", "emit_source_provenance": True}
    rules.append(_rule("eba-psd2-root-status-fact", G.EBA, [_is("entity_type", tuple(EU_CLASS))], emit_status_fact=fact | {"reported_status_from": {"field": "eba_ent_aut_status"}, "detail": "log of authorisations and withdrawals"}))
    for name, types, mechanism in (("", ("PSD_PI", "PSD_EMI"), "AUTHORISATION"), ("-aisp", ("PSD_AISP",), "REGISTRATION")):
        gone = fact | {
            "reported_status": "WITHDRAWN", "negative_scope": "ROOT_FAMILY", "negative_evidence_class": "EXPLICIT_WITHDRAWAL", "effective_from_field": "eba_ent_aut_last_withdrawal",
            "entry_mechanism": mechanism, "detail": "the root was withdrawn",
        }
        rules.append(_rule(f"eba-psd2-root-withdrawal{name}", G.EBA, [_is("entity_type", types), _is("eba_ent_aut_status", "WITHDRAWN")], emit_status_fact=gone))
    return rules


def _national_rules() -> list[dict]:
    listed, kind = "actividades_codes", "codigo_tipo_entidad"
    start, end = _date("FIELD_DDMMYYYY", "fecha_alta"), _date("FIELD_DDMMYYYY", "fecha_baja")
    open_end = _date("FIELD_DDMMYYYY_OR_NULL", "fecha_baja")
    rules = []

    def vector(name: str, source: str, types: tuple[str, ...], basis: str, policy: str, law: str) -> dict:
        conditions = [_is(kind, types), _none("fecha_baja"), _there(listed)]
        emit = _emit(NATIONAL_MAP, NATIONAL_CLASS, kind, _mechanisms(NATIONAL_CLASS), basis, law, "one registered service", (start, open_end), evidence_basis="NCA_PRIMARY")
        rules.append(_rule(f"{name}-service-entitled", source, conditions, ("codigo_be", "fecha_alta", listed), **_each(listed, "LIST", emit)))
        for family, universe, older in FAMILIES:
            guarded = [*conditions, *(_is(listed, code, "ABSENT_IN") for code in older)]
            rules.append(_rule(f"{name}-service-absent-{family}", source, guarded, ("codigo_be", listed), **_each(listed, "ABSENT_FROM_SET", _absent(emit, policy), universe=list(universe))))
        return emit

    def closed(rule_id: str, source: str, scope: str, detail: str) -> None:
        fact = {
            "reported_status": "WITHDRAWN", "negative_scope": scope, "negative_evidence_class_from": {"field": "bde_baja_kind", "map": CLOSURE_CLASS}, "effective_from_field": "fecha_baja_iso",
            "interval_end": "EXCLUSIVE", "detail": detail, "root_key_from": "root_key", "root_home_jurisdiction_from": "root_home_jurisdiction", "emit_source_provenance": True,
        }
        rules.append(_rule(rule_id, source, [_there("fecha_baja")], emit_status_fact=fact))

    domestic = vector("bde-psp-domestic", G.PAYMENTS, DOMESTIC_TYPES, "DOMESTIC", "bde-domestic-pi-activities", "national register, list of activities")
    was = domestic | {"effective_to": end, "interval_end": "EXCLUSIVE", "legal_basis": "national register, from start until closure"}
    rules.append(_rule("bde-psp-closed-service-entitled", G.PAYMENTS, [_is(kind, DOMESTIC_TYPES), _there("fecha_baja"), _there(listed)], ("codigo_be", "fecha_alta", "fecha_baja", listed), **_each(listed, "LIST", was)))
    closed("bde-psp-entity-baja", G.PAYMENTS, "ROOT_FAMILY", "the entity was closed in the national register")
    finding = {"classification": BLOCKER, "detail": "closed by a change of form: nothing says who has its capabilities now"}
    rules.append(_rule("bde-psp-transformation-successor-finding", G.PAYMENTS, [_is("bde_baja_kind", "TRANSFORMATION")], emit=None, finding=finding))
    vector("bde-ce-branch", G.ESTABLISHED, BRANCH_TYPES, "BRANCH", "bde-branch-pi-activities", "Directive 2015/2366 art. 28: registered branch, list of activities")
    closed("bde-ce-branch-baja", G.ESTABLISHED, "ROUTE_CAPABILITY", "the branch was closed in the national register")
    return rules


#: Whoever may issue e-money under an authorisation may also remit money, once a place and basis.
DERIVED = [
    {
        "rule_id": "emi-implies-remittance", "ruleset_version": VERSION, "type": "DERIVED",
        "base": {"entity_class": EMI, "activity": E_MONEY, "legal_effect": "ENTITLED_TO_PROVIDE"},
        "emit": {"activity": "MONEY_REMITTANCE", "legal_effect": "ENTITLED_TO_PROVIDE", "entry_mechanism": "STATUTORY_ENTITLEMENT", "legal_basis": "Directive 2009/110 art. 6(1)(a)", "scope": "by law"},
        "untriggered_finding": {"classification": "DERIVED_RULE_NOT_TRIGGERED", "detail": "no e-money issuance to start from"},
    },
    {
        "rule_id": "advice-by-information", "ruleset_version": VERSION, "type": "DERIVED",
        "base": {"entity_class": AISP, "activity": "ADVICE"},
        "emit": {"activity": "ADVICE_ON_ACCOUNTS", "legal_effect": "ENTITLED_TO_PROVIDE", "entry_mechanism": "STATUTORY_ENTITLEMENT", "legal_basis": "none", "scope": "none"},
        "untriggered_finding": {"classification": "DERIVED_RULE_NOT_TRIGGERED", "detail": "no register lists advice"},
    },
]


def text() -> str:
    return dumps(VERSION, [*_eu_rules(), *_national_rules()], DERIVED)
