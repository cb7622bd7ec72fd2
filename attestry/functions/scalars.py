"""Scalar functions of the evidence model as Column builders: all built-in, no UDFs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# control characters of Spanish tax ids, and the letters that demand a letter control (fixed values)
NIF_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
CIF_LETTERS = "JABCDEFGHI"
CIF_LETTER_ONLY = "KPQSNWR"

NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def normal_name(name: Column) -> Column:
    """Trimmed, upper case, white space collapsed."""
    return F.upper(F.trim(F.regexp_replace(name, r"\s+", " ")))


def normal_identifier(value: Column) -> Column:
    return F.upper(F.trim(value))


def strict_date(text: Column) -> Column:
    """A date written as yyyy-MM-dd and no other way, else NULL."""
    return F.when(F.length(text) == 10, F.try_to_date(text, "yyyy-MM-dd"))


def spanish_date(text: Column) -> Column:
    """d/M/yyyy, else NULL."""
    return F.try_to_date(F.trim(text), "d/M/yyyy")


def calendar_date(text: Column) -> Column:
    """The date part of a date or date-time text."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def freshness(source_as_of: Column, retrieved_at: Column) -> Column:
    return F.coalesce(source_as_of, retrieved_at)


def is_stale(at: Column, fresh: Column, max_days: Column) -> Column:
    """No policy or no date means stale."""
    return F.coalesce(F.datediff(at, fresh) > max_days, F.lit(True))


def lei_diagnostic(lei: Column) -> Column:
    """MISSING, INVALID_LENGTH, INVALID_CHARSET, INVALID_CHECK_DIGITS or VALID, in that order."""
    v = normal_identifier(lei)
    digits = F.split(F.concat(F.substring(v, 1, 18), F.lit("00")), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda acc, c: ((acc * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int")
    remainder = F.aggregate(F.filter(digits, lambda c: c != ""), F.lit(0), step)
    check = F.lpad((98 - remainder).cast("string"), 2, "0")
    return (
        F.when(F.coalesce(F.trim(lei), F.lit("")) == "", "MISSING")
        .when(F.length(v) != 20, "INVALID_LENGTH")
        .when(~v.rlike("^[0-9A-Z]{20}$"), "INVALID_CHARSET")
        .when(check != F.substring(v, 19, 2), "INVALID_CHECK_DIGITS")
        .otherwise("VALID")
    )


def valid_tax_id(nif: Column) -> Column:
    """Control character of a Spanish tax id of a person, a foreigner or an organisation."""
    v = normal_identifier(nif)
    control, first = F.substring(v, 9, 1), F.substring(v, 1, 1)
    pick = lambda letters, at: F.substring(F.lit(letters), (at + 1).cast("int"), F.lit(1))
    person = pick(NIF_LETTERS, F.substring(v, 1, 8).try_cast("int") % 23)
    foreign = pick(NIF_LETTERS, F.translate(F.substring(v, 1, 8), "XYZ", "012").try_cast("int") % 23)
    digit = lambda i: F.substring(v, i, 1).try_cast("int")
    doubled = [2 * digit(i) - F.when(2 * digit(i) > 9, 9).otherwise(0) for i in (2, 4, 6, 8)]
    total = (sum(doubled[1:], doubled[0]) + digit(3) + digit(5) + digit(7)) % 10
    letter = pick(CIF_LETTERS, total)
    organisation = (control == letter) | (~F.lit(CIF_LETTER_ONLY).contains(first) & (control == total.cast("string")))
    ok = (
        F.when(F.length(v) != 9, False)
        .when(v.rlike("^[0-9]{8}"), person == control)
        .when(v.rlike("^[XYZ][0-9]{7}"), foreign == control)
        .when(v.rlike("^[A-Z][0-9]{7}"), organisation)
        .otherwise(False)
    )
    return F.coalesce(ok, F.lit(False))


def split_items(text: Column, separator: str = r"\|") -> Column:
    """Trimmed, non-empty parts in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != ""))


# named characters of registers' pages (fixed values); & comes last
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "ntilde": "ñ", "uuml": "ü", "ccedil": "ç", "Aacute": "Á", "Eacute": "É",
    "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "Uuml": "Ü", "Ccedil": "Ç", "ordf": "ª", "ordm": "º", "laquo": "«", "raquo": "»", "iquest": "¿", "iexcl": "¡", "euro": "€", "amp": "&",
}


def unescaped(html: Column) -> Column:
    """Text with its character references decoded: decimal and hexadecimal ones of the basic plane, and those of ``ENTITIES``."""
    number = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")

    def part(p: Column, i: Column) -> Column:
        decimal, hexa = F.regexp_extract(p, "^([0-9]{1,5});", 1), F.regexp_extract(p, "^[xX]([0-9a-fA-F]{1,4});", 1)
        code = F.coalesce(F.when(decimal != "", decimal.cast("long")), F.when(hexa != "", F.conv(hexa, 16, 10).cast("long")))
        rest = F.regexp_replace(p, "^[^;]*;", "")
        return F.when(i == 0, p).when((code > 0) & (code < 65536), F.concat(number(code), rest)).otherwise(F.concat(F.lit("&#"), p))

    html = F.array_join(F.transform(F.split(html, "&#"), part), "")
    for name, char in ENTITIES.items():
        html = F.replace(html, F.lit(f"&{name};"), F.lit(char))
    return html


def cell_text(html: Column) -> Column:
    """Text of markup: tags to blanks, entities decoded, white space collapsed."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(html, r"<[^>]*>", " ")), r"\s+", " "))


def slug(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.regexp_replace(F.lower(key), "[^a-z0-9]", ""))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID, version 5."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8")))
    variant = F.lower(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8).cast("string"))
    nibble = F.lower(F.hex(variant.cast("int")))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(nibble, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def canonical_json(*columns: str) -> Column:
    """One JSON text of the columns by name order, NULLs kept."""
    return F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


def template(text: str, fields: dict[str, Column]) -> Column:
    """``text`` with {field} filled in; NULL when a field is NULL or empty. Braces round anything but a field's name stay."""
    parts, at = [], 0
    for found in re.finditer(r"\{([a-z_][a-z0-9_]*)\}", text):
        field = fields[found[1]].cast("string")
        parts += [F.lit(text[at : found.start()]), F.when(field != "", field)]
        at = found.end()
    return F.concat(*parts, F.lit(text[at:]))


def is_valid_lei(lei: Column) -> Column:
    return lei_diagnostic(lei) == "VALID"


def service_letters(text: Column, letters: str = "abcdefghij") -> Column:
    """The service letters that a text lists, each a letter with a point after no other letter."""
    found = F.array_compact(F.array(*(F.when(text.rlike(f"(?<![A-Za-z]){c}\\."), c) for c in letters)))
    return F.when(F.size(found) > 0, F.array_join(found, "|"))


def foreign_countries(text: Column, home: Column) -> Column:
    """The listed countries but for the home one, in order; NULL if there are none."""
    every = F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.eqNullSafe(home))
    return F.when(F.size(every) > 0, F.array_join(every, "|"))


def lists_country(text: Column, country: str = "ES") -> Column:
    """TRUE or FALSE as text; NULL for a missing list."""
    return F.when(text.isNull(), None).when(F.array_contains(split_items(text), country), "TRUE").otherwise("FALSE")


def country_services(services: Column, country: str) -> Column:
    """Distinct codes of a country in an array of maps of lists, in order; NULL if there are none."""
    every = F.array_distinct(F.flatten(F.transform(services, lambda m: F.coalesce(F.try_element_at(m, F.lit(country)), F.array().cast("array<string>")))))
    return F.when(F.size(every) > 0, every)


def country_services_json(services: Column, country: str) -> Column:
    """The same of a JSON text, in which a country has a list of codes or a single one as text."""
    at = lambda kind: F.from_json(services, f"array<map<string,{kind}>>")
    lists = F.transform(at("string"), lambda m: F.try_element_at(m, F.lit(country)))
    codes = F.flatten(F.transform(F.array_compact(lists), lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v))))
    every = F.array_distinct(F.array_compact(codes))
    return F.when(F.size(every) > 0, every)


def first_match(text: Column, table: tuple[tuple[str, str | None], ...]) -> Column:
    """The outcome of the first pattern of ``table`` that is found in the text; NULL if none is."""
    return F.coalesce(*(F.when(text.rlike(pattern), F.struct(F.lit(outcome).cast("string").alias("v"))) for pattern, outcome in table), F.struct(F.lit(None).cast("string").alias("v")))["v"]


# what registers' texts say, first match first (fixed values); (?i) where capitals do not count
ROUTES = ((r"^\s*$", None), ("(?i)LIMITED", "LIMITED_LP"), ("(?i)SUCURSAL", "BRANCH"), ("(?iu)R[EÉ]GIMEN DE LP", "LP"), ("(?iu)^(PSC|ENTIDAD DE CRÉDITO) \\(ESPAÑA\\)$", "DOMESTIC"), ("", "OTHER"))
ROUTE_LABELS = {"LP": "LP", "BRANCH": "sucursal", "LIMITED_LP": "LP limitada", "DOMESTIC": "domestica"}
CLOSURES = (("(?i)transformaci|escisi|fusi", "TRANSFORMATION"), ("(?i)renuncia|revocac|ce ", "WITHDRAWAL"), ("", "UNRESOLVED_MOTIVO"))
FAMILIES = (("(?i)sucursal", "BRANCH"), ("(?i)dinero electr", "PSD_EMI"), ("(?i)informaci|cuentas", "PSD_AISP"), ("(?i)pago", "PSD_PI"))
CHILD_STATES = (("^Active$", "ACTIVE"), ("^(Removed|Withdrawn)$", "WITHDRAWN"), (".", "UNKNOWN"))
CLASS_LABELS = {"PSD_PI": "PI", "PSD_EMI": "EMI"}


def labelled(value: Column, labels: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)), value)


def authority_code(entity_code: Column) -> Column:
    """The authority in a composite code: its first part, or the second after a type (``PSD_``)."""
    parts = F.split(entity_code, "!")
    return F.when(F.size(parts) > 1, F.get(parts, F.when(entity_code.startswith("PSD_"), 1).otherwise(0)))


def code_core(entity_type: Column, entity_code: Column) -> Column:
    """A composite code without its own type in front; NULL for an empty one."""
    front = F.concat(entity_type, F.lit("!"))
    has = F.coalesce(F.startswith(entity_code, front), F.lit(False))
    return F.when(entity_code != "", F.when(has, F.substr(entity_code, F.length(front) + 1)).otherwise(entity_code))


def home_country(core: Column) -> Column:
    """The country of the first part of a code that reads ``CC_...``."""
    return F.substring(F.get(F.filter(F.split(core, "!"), lambda p: p.rlike("^\\p{L}{2}_")), F.lit(0)), 1, 2)


def territorial_route(category: Column) -> Column:
    """Route that a register's category names; the limited one is looked for before the full one."""
    return first_match(category, ROUTES)


def closure_kind(closed_on: Column, reason: Column) -> Column:
    """What a stated closure is: a change of form, a withdrawal, or unresolved; NULL without a date."""
    return F.when(closed_on != "", first_match(F.coalesce(reason, F.lit("")), CLOSURES))


def psd_family(entity_kind: Column) -> Column:
    """The family of a register's kind of entity."""
    return first_match(entity_kind, FAMILIES)


def child_state(text: Column) -> Column:
    """State of a branch or agent as its register tells it; NULL if it tells nothing."""
    return first_match(text, CHILD_STATES)


def ended(end_date: Column) -> Column:
    return F.when(F.trim(end_date) != "", "ENDED").otherwise("ACTIVE")


def dates_agree(a: Column, b: Column) -> Column:
    """TRUE or FALSE as text; NULL where one of the dates is missing."""
    return F.when(a == b, "TRUE").when(a.isNotNull() & b.isNotNull(), "FALSE")


def plain_header(text: Column) -> Column:
    """A header without accents, in lower case, white space collapsed."""
    accents, plain = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"
    return F.trim(F.regexp_replace(F.lower(F.translate(text, accents, plain)), r"\s+", " "))


#: Sharp s and its capital; other characters that grow when upper-cased, and what stands for each as one character (its title case, else itself).
_SHARP, _CAPITAL_SHARP = "\u00df", "\u1e9e"
_GROWING = "".join(chr(c) for c in range(0xE0, 0xFFFF) if not 0xD800 <= c < 0xE000 and len(chr(c).upper()) > 1)
_ALONE = "".join(c.title() if len(c.title()) == 1 else c for c in _GROWING)


def upper_alone(text: Column) -> Column:
    """Upper case character by character, as SQL engines have it: a sharp s does not become two letters."""
    kind = f"[{_GROWING}]"
    some = f"(?=[{_GROWING[0]}-{_GROWING[-1]}]){kind}"  # the range is tried first, as nearly every character is outside it
    upper = lambda c: F.upper(F.replace(c, F.lit(_SHARP), F.lit(_CAPITAL_SHARP)))
    parts = F.split(text, f"(?={kind})|(?<={kind})")
    alone = F.transform(parts, lambda p: F.when(p.rlike(kind), F.translate(p, _GROWING, _ALONE)).otherwise(upper(p)))
    return F.when(text.rlike(some), F.array_join(alone, "")).otherwise(upper(text))
