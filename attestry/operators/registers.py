"""What register records tell of each other: parents, branches, categories, mechanisms, roots.

Records are rows of ``group_ord`` (their order), ``entity_id``, ``source`` and the registers' own
fields, NULL where a source has none. What an entity's other records say are windows over the
entity, so records are dealt by entity once; what a record under another code says is one
equi-join of keys. Nothing compares records in pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions import scalars as S
from attestry.operators.tables import parts_for, whole

# sources (fixed values)
EBA, PAYMENTS, ESTABLISHED = "EBA_PSD2_REGISTER", "BDE_REGISTRO_SERVICIOS_PAGO", "BDE_REGISTRO_CON_ESTABLECIMIENTO"
CRYPTO, CATEGORY = "ESMA_MICA_REGISTER", "CNMV_PSC_REGISTER"
HOME_SOURCES = ("BAFIN_UNTERNEHMENSDATENBANK", "FINANSTILSYNET_REGISTRY")
NATIONAL = (PAYMENTS, ESTABLISHED)
CHILD_TYPES, ROOT_FAMILIES, BRANCH_TYPE = ("PSD_BR", "PSD_AG"), ("PSD_PI", "PSD_EMI", "PSD_AISP"), "PSD_BR"
NATIONAL_PREFIX, HERE = "ES_BE!", "ES"
# what home authorities' records say of the mechanism (fixed values)
AUTHORISED, NOTIFIED, REMARK = "ART_59_1A", "ART_59_1B", "ART_60_3"
LEGAL_REFS = {"AUTHORISATION": "art. 63 (art. 59(1)(a))", "REMARK": "art. 60(3) (art. 59(1)(b))", "NOTIFICATION": "art. 60 (art. 59(1)(b))"}
INVESTMENT, CREDIT, PLAIN_CLASS = "INVESTMENT_FIRM_ESI", "CREDIT_INSTITUTION", "CASP"


#: What ``with_own_state`` makes.
OWN_STATE = ("eba_ent_aut_status", "eba_ent_aut_last_auth", "eba_ent_aut_last_withdrawal", "eba_child_status", "eba_home_nca")


def _filled(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def with_own_state(records: DataFrame) -> DataFrame:
    """State of a payment register's record by its log of authorisations and withdrawals (array ``ent_aut`` of dates).

    An even count of dates ends in a withdrawal; without any date the state is unknown.
    """
    log = F.col("ent_aut")
    n = F.when(F.col("source") == EBA, F.coalesce(F.size(log), F.lit(0)))
    last = lambda back: F.get(log, F.size(log) - back)
    odd = n % 2 == 1
    return records.withColumns(
        {
            "eba_ent_aut_status": F.when(n <= 0, "UNKNOWN").when(odd, "ACTIVE").when(n > 0, "WITHDRAWN"),
            "eba_ent_aut_last_auth": F.when(n > 0, F.when(odd, last(1)).otherwise(last(2))),
            "eba_ent_aut_last_withdrawal": F.when(n > 1, F.when(odd, last(2)).otherwise(last(1))),
            "eba_child_status": F.when(F.col("source") == EBA, S.child_state(F.col("der_chi_ent_aut"))),
            "eba_home_nca": F.when(F.col("source") == EBA, S.authority_code(F.col("entity_code"))),
        }
    )


def _parents(records: DataFrame) -> DataFrame:
    """The last record of each type and code, as ``_p``."""
    named = records.where((F.col("source") == EBA) & F.col("entity_type").isNotNull() & F.col("entity_code").isNotNull())
    return named.groupBy(F.col("entity_type").alias("parent_type"), F.col("entity_code").alias("parent_code")).agg(F.max_by(F.struct("eba_ent_aut_status", "eba_ent_aut_last_auth", "group_ord"), "group_ord").alias("_p"))


def _names_parent() -> Column:
    return (F.col("source") == EBA) & (F.col("parent_type") != "") & (F.col("parent_code") != "")


def with_parents(records: DataFrame) -> DataFrame:
    """State, type and authority of the parent that a record names by type and code.

    Of several records under one type and code the last counts. A parent that is named and not
    found is UNKNOWN; a record that names none has NULL. ``parent_ord`` is the parent's record.
    Records that name none, often most of them, are dealt by ``group_ord`` (in a code that no
    parent's row is asked for): under keys of NULL all would go to one task.
    """
    code = F.when(_names_parent(), F.col("parent_code")).otherwise(F.concat(F.lit("~"), F.col("group_ord").cast("string")))
    joined = records.withColumn("_code", code).join(_parents(records).withColumnRenamed("parent_code", "_code"), ["parent_type", "_code"], "left")
    return _told_of_parents(joined, records.columns)


def _told_of_parents(joined: DataFrame, columns: list[str]) -> DataFrame:
    names = _names_parent()
    found = names & F.col("_p").isNotNull()
    return joined.select(
        *columns, F.when(names, F.coalesce("_p.eba_ent_aut_status", F.lit("UNKNOWN"))).alias("eba_parent_status"), F.when(found, F.col("parent_type")).alias("eba_parent_entity_type"),
        F.when(found, S.labelled(F.col("parent_type"), S.CLASS_LABELS)).alias("eba_parent_class_label"), F.when(found, S.authority_code(F.col("parent_code"))).alias("eba_parent_nca"),
        F.when(found, F.col("_p.eba_ent_aut_last_auth")).alias("eba_parent_last_auth"), F.when(found, F.col("_p.group_ord")).alias("parent_ord"),
    )


def _dealt(rows: DataFrame, records: DataFrame) -> DataFrame:
    """``rows`` (``entity_id``, ``group_ord`` and more) by entity, with ``_p``, the parent that the record in ``records`` names.

    Keys alone meet the parents; what is found goes to the record's entity beside the rows.
    """
    asks = records.where(_names_parent()).select("entity_id", "group_ord", "parent_type", "parent_code")
    found = asks.join(_parents(records), ["parent_type", "parent_code"]).select("entity_id", "group_ord", "_p", F.lit(True).alias("_found"))
    beside = rows.unionByName(found, allowMissingColumns=True).repartition(parts_for(rows.sparkSession, rows.count()), "entity_id")
    return whole(beside).withColumn("_p", F.max("_p").over(Window.partitionBy("entity_id", "group_ord"))).where(F.col("_found").isNull()).drop("_found")


def with_entity_facts(records: DataFrame) -> DataFrame:
    """What the entity's records in other registers say, by windows over the entity.

    National registers: a branch is registered when some record has a starting date and none a
    closing one; several starting dates are a conflict and give no date; of an entity's records the
    first counts. Category register: the last record gives the category. Home authorities: both
    mechanisms together are a conflict and give none; of stated classes the last counts.
    """
    source, at = F.col("source"), F.col("group_ord")
    national, payments, category, home = source.isin(*NATIONAL), source == PAYMENTS, source == CATEGORY, source.isin(*HOME_SOURCES)
    kind = S.closure_kind(F.col("fecha_baja"), F.col("motivo_baja"))
    stated = (
        F.when(F.coalesce(F.col("home_entity_class_de"), F.lit("")).contains("Wertpapierinstitut") | F.coalesce(F.col("home_licences"), F.lit("")).contains("Investment firm"), INVESTMENT)
        .when(F.col("home_entity_class_de").contains("Kreditinstitut"), CREDIT)
    )
    first = lambda which, *c: F.min_by(F.struct(*c), F.when(which, at))
    says = lambda c: F.max(F.coalesce(home & c, F.lit(False)))
    ords = lambda which: F.collect_list(F.when(which, at))
    facts = {
        "_alta_1": F.min(F.when(national, _filled("fecha_alta"))), "_alta_2": F.max(F.when(national, _filled("fecha_alta"))), "_baja": F.max(F.when(national, _filled("fecha_baja"))),
        "_branch": first(national, "fecha_alta", "codigo_be"), "_entity": first(payments, F.col("fecha_baja"), kind.alias("kind")),
        "_category": F.max_by(F.struct("cnmv_category", "services_from"), F.when(category, at)), "_authorised": says(F.col("mica_home_route") == AUTHORISED),
        "_notified": says((F.col("mica_home_route") == NOTIFIED) | (F.col("home_mechanism_remark") == REMARK)), "_remark": says(F.col("home_mechanism_remark") == REMARK),
        "_class": F.max_by(stated, F.when(home & stated.isNotNull(), at)), "_national": ords(national), "_home": ords(home), "_category_ord": F.max(F.when(category, at)),
    }
    # records of no entity say nothing of each other
    said = records.withColumns({k: F.when(F.col("entity_id").isNotNull(), v.over(Window.partitionBy("entity_id"))) for k, v in facts.items()})
    eba, crypto = source == EBA, source == CRYPTO
    branch = eba & (F.col("entity_type") == BRANCH_TYPE) & F.col("_branch").isNotNull()
    many = F.col("_alta_1") != F.col("_alta_2")
    own_date, given_date = S.spanish_date(F.col("authorisation_notification_date")), S.spanish_date(F.col("_category.services_from"))
    route = S.territorial_route(F.col("_category.cnmv_category"))
    conflict = F.col("_authorised") & F.col("_notified")
    mechanism = F.when(crypto & ~conflict, F.when(F.col("_authorised"), "AUTHORISATION").when(F.col("_notified"), "NOTIFICATION"))
    remarked = F.col("_remark") | F.coalesce(F.col("_class") == INVESTMENT, F.lit(False))
    ref = F.when(mechanism == "AUTHORISATION", LEGAL_REFS["AUTHORISATION"]).when(mechanism.isNotNull(), F.when(remarked, LEGAL_REFS["REMARK"]).otherwise(LEGAL_REFS["NOTIFICATION"]))
    none = F.array().cast("array<long>")
    cites = F.concat(
        F.when(F.col("parent_ord").isNotNull(), F.array("parent_ord")).otherwise(none), F.when(branch, F.sort_array("_national")).otherwise(none),
        F.when(crypto & F.col("_category_ord").isNotNull(), F.array("_category_ord")).otherwise(none), F.when(crypto, F.coalesce(F.sort_array("_home"), none)).otherwise(none),
    )
    columns = {
        "bde_baja_kind": F.when(national, kind), "fecha_alta_iso": F.when(national, S.spanish_date(F.col("fecha_alta"))), "fecha_baja_iso": F.when(national, S.spanish_date(F.col("fecha_baja"))),
        "bde_entity_fecha_baja": F.when(eba, F.col("_entity.fecha_baja")), "bde_entity_baja_kind": F.when(eba, F.col("_entity.kind")),
        "bde_branch_date_conflict": F.when(branch & many, "TRUE"), "bde_branch_fecha_alta": F.when(branch & ~F.coalesce(many, F.lit(False)), F.col("_branch.fecha_alta")),
        "bde_branch_codigo": F.when(branch, F.col("_branch.codigo_be")), "bde_branch_registered": F.when(branch, F.when(F.col("_alta_1").isNotNull() & F.col("_baja").isNull(), "TRUE").otherwise("FALSE")),
        "cnmv_territorial_route": F.when(crypto, route).when(category, S.territorial_route(F.col("cnmv_category"))),
        "mica_es_declared": F.when(crypto, S.lists_country(F.col("service_countries"))), "mica_service_letters": F.when(crypto, S.service_letters(F.col("service_codes"))),
        "mica_foreign_countries": F.when(crypto, S.foreign_countries(F.col("service_countries"), F.col("home_member_state"))),
        "mica_dates_agree": F.when(crypto, S.dates_agree(own_date, given_date)), "mica_status": F.when(crypto, S.ended(F.col("authorisation_end_date"))),
        "mica_home_mechanism": mechanism, "mica_home_mechanism_conflict": F.when(crypto & conflict, "TRUE"), "mica_home_legal_ref": ref,
        "mica_home_entity_class": F.when(mechanism.isNotNull(), F.coalesce("_class", F.lit(PLAIN_CLASS))), "corroborating": cites,
    }
    return said.select(*records.columns, *(v.alias(k) for k, v in columns.items()))


def with_roots(records: DataFrame) -> DataFrame:
    """``root_key`` and ``root_home_jurisdiction`` of every record.

    A record of the payment register is its own root by type and code, a branch or agent has its
    parent's. A domestic record of a national register has the root of the entity's only payment
    record of its family under the national code; one of a branch, or of another country, that of
    the entity's only branch record. Where none or several would do it is a root of its own, by
    family and code. Candidates are counted by a window over entity and key; no record is both a
    candidate and asks for one.
    """
    eba, national = F.col("source") == EBA, F.col("source").isin(*NATIONAL)
    core, parent = S.code_core(F.col("entity_type"), F.col("entity_code")), S.code_core(F.col("parent_type"), F.col("parent_code"))
    child = F.coalesce(F.col("entity_type").isin(*CHILD_TYPES), F.lit(False))
    kind, code = F.when(child, _filled("parent_type")).otherwise(_filled("entity_type")), F.when(child, parent).otherwise(core)
    own = records.withColumns({"_core": F.when(eba, core), "_root": F.when(eba, F.concat(F.lit("EBA|"), kind, F.lit("|"), code))})
    own = own.withColumn("_home", F.when(F.col("_root").isNotNull(), S.home_country(code)))
    key = F.when(F.col("entity_type") == BRANCH_TYPE, F.when(F.col("_root").isNotNull(), BRANCH_TYPE)).when(F.col("entity_type").isin(*ROOT_FAMILIES), F.concat("entity_type", F.lit("|"), "_core"))
    family = S.psd_family(F.col("tipo_entidad"))
    domestic = (F.col("pais_origen") == HERE) & family.isin(*ROOT_FAMILIES)
    abroad = (family == "BRANCH") | ((F.col("pais_origen") != "") & (F.col("pais_origen") != HERE))
    wanted = F.when(national & domestic, F.concat(family, F.lit("|" + NATIONAL_PREFIX), F.coalesce("codigo_be", F.lit("None")))).when(national & abroad, BRANCH_TYPE)
    met = own.withColumn("_key", F.when(F.col("entity_id").isNotNull(), F.when(eba, key).otherwise(wanted)))
    by_key = Window.partitionBy("entity_id", "_key")
    theirs = {"_n": F.count(F.when(eba, 1)), "_theirs": F.max(F.when(eba, F.col("_root"))), "_their_home": F.max(F.when(eba, F.col("_home")))}
    met = met.withColumns({k: v.over(by_key) for k, v in theirs.items()}).withColumn("_theirs", F.when(national & F.col("_key").isNotNull() & (F.col("_n") == 1), F.col("_theirs")))
    alone = F.when(national & (F.col("codigo_be") != ""), F.concat(F.lit("BDE|"), F.coalesce(family, F.lit("UNKNOWN")), F.lit("|"), "codigo_be"))
    inherited = F.col("_theirs").isNotNull()
    home = F.when(national, F.when(inherited, F.when(domestic, HERE).otherwise(F.col("_their_home"))).when(alone.isNotNull(), F.col("pais_origen"))).otherwise(F.col("_home"))
    return met.select(*records.columns, F.coalesce("_root", "_theirs", alone).alias("root_key"), home.alias("root_home_jurisdiction"))


def derived(records: DataFrame, stored: DataFrame | None = None, read: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """All derived fields of register records.

    Records go through one exchange, by entity. Where they are made of fewer columns, ``stored`` has
    those beside ``entity_id`` and ``group_ord``: they go through it instead, and ``read`` makes records of them.
    """
    found = _dealt(records if stored is None else stored, with_own_state(records))
    own = with_own_state(read(found))
    return with_roots(with_entity_facts(_told_of_parents(own, [c for c in own.columns if c != "_p"])))


def with_evidence(records: DataFrame, claims: DataFrame, manifest: DataFrame) -> DataFrame:
    """Claims and source assertions of each record, its own before those that corroborate it.

    ``claims`` has group_ord, claim_id and snapshot_file; ``manifest`` snapshot_file and source_url.
    A snapshot that the manifest lacks has no URL, and the record says so in ``unsourced``.
    """
    named = claims.join(manifest.select("snapshot_file", "source_url"), "snapshot_file", "left")
    own = named.groupBy("group_ord").agg(F.sort_array(F.collect_list("claim_id")).alias("ids"), F.min("snapshot_file").alias("snapshot_file"), F.min("source_url").alias("source_url"))
    cites = records.select(F.col("group_ord").alias("of"), F.posexplode(F.concat(F.array("group_ord"), "corroborating")).alias("at", "group_ord"))
    one = F.struct("at", "ids", F.struct("snapshot_file", "source_url").alias("source"))
    found = cites.join(own, "group_ord").groupBy("of").agg(F.sort_array(F.collect_list(one)).alias("e"))
    evidence = found.select(
        F.col("of").alias("group_ord"), F.flatten("e.ids").alias("claim_ids"), F.col("e.source").alias("source_assertions"), F.exists("e", lambda x: x["source"]["source_url"].isNull()).alias("unsourced")
    )
    return records.join(evidence, "group_ord", "left")


def packed(records: DataFrame, texts: list[str], lists: list[str]) -> list[Column]:
    """``texts`` and ``lists``: maps of the fields that have a value, as rule files read them."""
    entries = lambda names, kind: F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(c), F.col(c).cast(kind)) for c in names)), lambda e: e["col2"].isNotNull()))
    return [entries(texts, "string").alias("texts"), entries(lists, "array<string>").alias("lists")]
