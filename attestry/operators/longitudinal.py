"""Successive snapshots: differences, their comparability, and what they may mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestry.operators.tables import kept


def normalized(records: DataFrame, key: str = "record") -> DataFrame:
    """Register records (JSON texts of entity, value pairs and services) as one row a path.

    Columns: record_key, path, value, problem. Lists count as sets: their items are sorted. A
    record key that occurs twice, and a property or service that occurs twice in a record, are
    problems; so is a record without a type or code, whose rows have no key. Nothing is made up
    for what is missing.
    """
    shape = "EntityType string, EntityCode string, CA_OwnerID variant, Properties array<map<string, variant>>, Services array<map<string, variant>>"
    r = records.select(F.from_json(key, shape).alias("r")).select("r.*")
    name = F.concat("EntityType", F.lit(":"), "EntityCode")  # without a code there is no key
    pair = "array<struct<path:string,value:variant>>"

    def entries(of: str, prefix: str) -> Column:
        each = F.flatten(F.transform(F.coalesce(of, F.array().cast("array<map<string,variant>>")), F.map_entries))
        return F.transform(each, lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("path"), e["value"].alias("value"))).cast(pair)

    owner = F.array(F.struct(F.lit("ca_owner_id").alias("path"), F.col("CA_OwnerID").alias("value"))).cast(pair)
    rows = r.select(name.alias("record_key"), F.explode(F.concat(owner, entries("Properties", "properties."), entries("Services", "services."))).alias("e"))
    many = F.schema_of_variant("e.value").startswith("ARRAY")
    items = F.to_json(F.array_sort(F.try_variant_get("e.value", "$", "array<string>")))
    value = F.when(many, items).otherwise(F.try_variant_get("e.value", "$", "string"))
    rows = rows.select("record_key", F.col("e.path").alias("path"), value.alias("value"))
    found = rows.groupBy("record_key", "path").agg(F.min("value").alias("value"), F.count("*").alias("n"))
    # each record has one owner entry
    problem = F.when(F.col("record_key").isNull(), "NO_RECORD_KEY").when(F.col("n") > 1, F.when(F.col("path") == "ca_owner_id", "DUPLICATE_RECORD_KEY").otherwise("DUPLICATE_PROPERTY"))
    return found.select("record_key", "path", F.when(problem.isNull(), F.col("value")).alias("value"), problem.alias("problem"))


def structural_diff(left: DataFrame, right: DataFrame, key: str, path: str, value: str) -> DataFrame:
    """Differences of two long tables of one row a path: key, kind, change, path, old, new.

    ``kind`` tells of the record (added, removed, changed), ``change`` of the path in it. That a
    path is missing is told apart from a value that is NULL. One grouping by record: a record's
    paths are few.
    """
    side = lambda df, n: df.select(key, F.struct(F.col(path).alias("path"), F.col(value).cast("string").alias("value")).alias("e"), F.lit(n).alias("side"))
    rows = side(left, 0).unionByName(side(right, 1)).groupBy(key).agg(*(F.collect_list(F.when(F.col("side") == n, F.col("e"))).alias(c) for n, c in enumerate(("l", "r"))))
    maps = rows.select(key, F.map_from_entries("l").alias("l"), F.map_from_entries("r").alias("r"))
    none = F.lit(None).cast("string")
    row = lambda kind, change, p, old, new: F.struct(F.lit(kind).alias("kind"), change.alias("change"), p.alias("path"), old.alias("old"), new.alias("new"))

    def change(p: Column) -> Column:
        kind = F.when(~F.map_contains_key(F.col("l"), p), "added").when(~F.map_contains_key(F.col("r"), p), "removed").otherwise("changed")
        return row("changed", kind, p, F.try_element_at(F.col("l"), p), F.try_element_at(F.col("r"), p))

    every = F.transform(F.array_union(F.map_keys("l"), F.map_keys("r")), change)
    differ = F.filter(every, lambda c: (c["change"] != "changed") | ~c["old"].eqNullSafe(c["new"]))
    whole = lambda kind: F.array(row(kind, none, F.lit(""), none, none))
    found = F.when(F.size("l") == 0, whole("added")).when(F.size("r") == 0, whole("removed")).otherwise(differ)
    return maps.select(key, F.explode(found).alias("c")).select(key, "c.*")


def typed_diff(left: DataFrame, right: DataFrame, key: str, doc: str) -> DataFrame:
    """Differences of two sets of documents (VARIANT) at any depth: key, kind, path, old, new.

    Values keep their types: 1 and "1" differ, and a missing field differs from one that is null.
    Objects are compared field by field, everything else, lists included, as a whole; ``old`` and
    ``new`` are JSON texts. A document on one side alone is one row with an empty path. Records
    meet once, in one join; each level of nesting is then taken apart without a shuffle, as many
    levels as the documents have.
    """
    pair = left.select(key, F.col(doc).alias("o"), F.lit(True).alias("has_o")).join(right.select(key, F.col(doc).alias("n"), F.lit(True).alias("has_n")), key, "full")
    level = kept(pair.select(key, F.array().cast("array<string>").alias("path"), "o", "n", F.coalesce("has_o", F.lit(False)).alias("has_o"), F.coalesce("has_n", F.lit(False)).alias("has_n")))
    found = None
    while True:
        both = F.col("has_o") & F.col("has_n")
        objects = both & F.coalesce(F.schema_of_variant("o").startswith("OBJECT") & F.schema_of_variant("n").startswith("OBJECT"), F.lit(False))
        old, new = F.when(F.col("has_o"), F.coalesce(F.to_json("o"), F.lit("null"))), F.when(F.col("has_n"), F.coalesce(F.to_json("n"), F.lit("null")))
        kind = F.when(~F.col("has_o"), "added").when(~F.col("has_n"), "removed").otherwise("changed")
        ends = level.where(~objects).select(key, kind.alias("kind"), "path", old.alias("old"), new.alias("new")).where(~F.col("old").eqNullSafe(F.col("new")))
        found = ends if found is None else found.union(ends)
        inner = level.where(objects)
        if inner.isEmpty():
            return found
        fields = lambda c: F.try_variant_get(c, "$", "map<string,variant>")
        maps = inner.select(key, "path", fields("o").alias("mo"), fields("n").alias("mn"))
        names = F.explode(F.array_union(F.map_keys("mo"), F.map_keys("mn"))).alias("f")
        step = maps.select("*", names)
        level = kept(
            step.select(
                key, F.array_append("path", F.col("f")).alias("path"), F.try_element_at("mo", F.col("f")).alias("o"), F.try_element_at("mn", F.col("f")).alias("n"),
                F.map_contains_key("mo", F.col("f")).alias("has_o"), F.map_contains_key("mn", F.col("f")).alias("has_n"),
            )
        )


def address_changes(states: DataFrame, present: DataFrame, unknown: str = "UNKNOWN") -> DataFrame:
    """Addresses that an entity had before the one it has, each as the stretch it was seen in.

    ``states`` has entity_id, as_of and address, ``present`` entity_id, address and observed_at. States
    that follow each other with one address are one stretch: entity_id, address, first_as_of,
    last_as_of, n_states, next_address and by (when the next one was first seen: the next stretch,
    else the present observation). An unknown address ends no stretch and is none; a stretch that
    the present only continues is no change.
    """
    at = Window.partitionBy("entity_id").orderBy("as_of", "address")
    known = states.where(F.col("address").isNotNull() & (F.col("address") != unknown))
    began = known.withColumn("new", (~F.col("address").eqNullSafe(F.lag("address").over(at))).cast("int"))
    stretch = began.withColumn("stretch", F.sum("new").over(at)).groupBy("entity_id", "stretch", "address").agg(F.min("as_of").alias("first_as_of"), F.max("as_of").alias("last_as_of"), F.count("*").alias("n_states"))
    order = Window.partitionBy("entity_id").orderBy("stretch")
    followed = stretch.withColumns({"_next": F.lead("address").over(order), "_at": F.lead("first_as_of").over(order)})
    now = present.select("entity_id", F.col("address").alias("_now"), "observed_at")
    rows = followed.join(now, "entity_id", "left").withColumns({"next_address": F.coalesce("_next", "_now"), "by": F.coalesce("_at", F.when(F.col("_next").isNull(), F.col("observed_at")))})
    return rows.where(F.col("next_address").isNotNull() & (F.col("next_address") != unknown) & (F.col("next_address") != F.col("address"))).select("entity_id", "address", "first_as_of", "last_as_of", "n_states", "next_address", "by")


def succession_state(as_of: Column, previous: Column) -> Column:
    """What a pair's declared dates say; a missing one says nothing."""
    return (
        F.when(as_of.isNull() | previous.isNull(), "UNKNOWN_SOURCE_AS_OF")
        .when(as_of > previous, "NORMAL_SUCCESSION")
        .when(as_of == previous, "SAME_AS_OF_REVISION")
        .otherwise("SOURCE_AS_OF_REGRESSION")
    )


def successors(series: DataFrame, key: str) -> DataFrame:
    """Each observation with the state of its pair with the one before it.

    For the suspicion that content changed under one date, NULL equals NULL.
    """
    w = Window.partitionBy(key).orderBy("retrieved_at", "observation_id")
    pairs = series.withColumns({"previous_as_of": F.lag("source_as_of").over(w), "previous_hash": F.lag("content_hash").over(w), "n": F.row_number().over(w)})
    suspect = (F.col("content_hash") != F.col("previous_hash")) & F.col("source_as_of").eqNullSafe(F.col("previous_as_of"))
    return pairs.where("n > 1").select(
        key, "observation_id", succession_state(F.col("source_as_of"), F.col("previous_as_of")).alias("state"), suspect.alias("suspect_as_of"), (F.col("content_hash") == F.col("previous_hash")).alias("identical")
    )


def observation_id(register: Column, retrieved_at: Column, content_hash: Column) -> Column:
    return F.concat_ws("|", register, retrieved_at.cast("string"), F.substring(content_hash, 1, 16))


def observed_at(observation: Column) -> Column:
    """The date in an observation's id (register, date, hash); NULL where the id has another form."""
    parts = F.split(F.reverse(observation), r"\|", 3)
    return F.when((F.size(parts) == 3) & (F.get(parts, 1) != ""), F.reverse(F.get(parts, 1)))


def compared(pairs: DataFrame) -> DataFrame:
    """Whether two observations may be compared, and what may be concluded from it.

    ``pairs`` has left_ and right_ register_id, series_key, content_hash, retrieved_at,
    source_as_of, completeness and normalization. Observations of different series are no pair:
    ``invocation_error``.
    """
    l, r = (lambda c: F.col(f"left_{c}")), (lambda c: F.col(f"right_{c}"))  # noqa: E731, E741
    state = succession_state(r("source_as_of"), l("source_as_of"))
    same = l("content_hash") == r("content_hash")
    comparable = l("normalization") == r("normalization")
    findings = F.array_compact(
        F.array(
            F.when(~comparable, "NON_COMPARABLE_NORMALIZATION_VERSION"),
            F.when(state == "SOURCE_AS_OF_REGRESSION", state).when((state == "SAME_AS_OF_REVISION") & ~same, state),
        )
    )
    return pairs.select(
        "*",
        observation_id(l("register_id"), l("retrieved_at"), l("content_hash")).alias("left_observation_id"),
        observation_id(r("register_id"), r("retrieved_at"), r("content_hash")).alias("right_observation_id"),
        F.when(l("series_key") != r("series_key"), "SERIES_DIFFER").alias("invocation_error"),
        state.alias("succession_state"),
        comparable.alias("comparable"),
        same.alias("identical_content"),
        ((l("completeness") == "complete") & (r("completeness") == "complete")).alias("removal_admissible"),
        findings.alias("findings"),
    )


def intervals_of_log(log: Column) -> Column:
    """Odd places open an interval, even places close it; a last odd one stays open."""
    n = F.size(log)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(F.get(log, i).alias("from"), F.get(log, i + 1).alias("to")))


def last_authorisation(log: Column) -> Column:
    n = F.size(log)
    return F.when(n % 2 == 1, F.get(log, n - 1)).otherwise(F.get(log, n - 2))


def is_strict_append(old: Column, new: Column) -> Column:
    return (F.size(new) > F.size(old)) & (F.slice(new, F.lit(1), F.size(old)) == old)


def log_candidates(changes: DataFrame, key: str) -> DataFrame:
    """Of each change of a transition log, one candidate a date added, or one blocked."""
    append = is_strict_append(F.col("old_log"), F.col("new_log"))
    added = F.when(append, F.slice("new_log", F.size("old_log") + 1, F.greatest(F.size("new_log") - F.size("old_log"), F.lit(0)))).otherwise(F.array(F.lit(None).cast("date")))
    rows = changes.select(key, append.alias("append"), F.size("old_log").alias("had"), F.posexplode(added).alias("i", "effective_from"))
    place = F.col("had") + F.col("i") + 1
    kind = F.when(~F.col("append"), "UNCLASSIFIED").when(place % 2 == 0, "ROOT_WITHDRAWAL").otherwise("ROOT_REAUTHORISATION")
    return rows.select(
        key, kind.alias("candidate"), F.when(F.col("append"), "SUPPORTED").otherwise("BLOCKED").alias("admissibility"), "effective_from", F.when(F.col("append"), place).cast("long").alias("place")
    )


def code_candidates(changes: DataFrame, key: str) -> DataFrame:
    """Codes gained and lost; losing one is never a negative by itself."""
    gained, lost = F.array_sort(F.array_except("new_codes", "old_codes")), F.array_sort(F.array_except("old_codes", "new_codes"))
    both = F.array(F.struct(F.lit("CAPABILITY_APPEARED").alias("candidate"), gained.alias("codes")), F.struct(F.lit("CAPABILITY_DISAPPEARED").alias("candidate"), lost.alias("codes")))
    return changes.select(key, F.explode(F.filter(both, lambda c: F.size(c["codes"]) > 0)).alias("c")).select(key, "c.candidate", F.array_join("c.codes", ",").alias("codes"))


#: The series that the catalogue is about, and its two paths (fixed values).
CATALOGUE_SERIES, LOG_PATH, CODES_PATH = "eba-psd2-register", "properties.ENT_AUT", "services.ES"


def classified(changes: DataFrame, comparisons: DataFrame, key: str, on: str) -> DataFrame:
    """Candidates for events from the changes of comparable observations; what no rule names is blocked.

    ``changes`` (of ``structural_diff``, with the comparison ``on``) meets ``comparisons`` (of
    ``compared``). A transition log that was only appended to gives a candidate a date, a set of
    codes one for what appeared and one for what disappeared.
    """
    c = comparisons.where("comparable and not identical_content and invocation_error is null").select(on, F.col("right_series_key").alias("series_key"), "removal_admissible", "left_observation_id", "right_observation_id")
    rows = changes.join(c, on)
    ours = F.col("series_key").startswith(CATALOGUE_SERIES)

    def candidate(kind: str, blocker: str | None, basis: str, day: Column | None = None, place: Column | None = None, codes: Column | None = None) -> Column:
        none = F.lit(None)
        return F.struct(
            F.lit(kind).alias("candidate"), F.lit("BLOCKED" if blocker else "SUPPORTED").alias("admissibility"), F.lit(blocker).cast("string").alias("blocker"), F.lit(basis).alias("basis"),
            (none if day is None else day).cast("string").alias("effective_from"), (none if place is None else place).cast("long").alias("place"), (none if codes is None else F.array_join(codes, ",")).cast("string").alias("codes"),
        )

    unclassified = lambda why: F.array(candidate("UNCLASSIFIED_STRUCTURAL_CHANGE", why, "UNKNOWN"))
    texts = lambda c: F.from_json(F.col(c), "array<string>")
    listed = lambda c: F.col(c).startswith("[") & texts(c).isNotNull()
    old_log, new_log = F.when(F.col("change") == "added", F.array().cast("array<string>")).when(listed("old"), texts("old")), F.when(listed("new"), texts("new"))
    append = (F.size(new_log) > F.size(old_log)) & (F.slice(new_log, F.lit(1), F.size(old_log)) == old_log)

    def step(day: Column, i: Column) -> Column:
        place = F.size(old_log) + i + 1
        return F.when(place % 2 == 0, candidate("ROOT_WITHDRAWAL_CANDIDATE", None, "SOURCE_DECLARED", day, place)).otherwise(candidate("ROOT_REAUTHORISATION_CANDIDATE", None, "SOURCE_DECLARED", day, place))

    log = F.when(append, F.transform(F.slice(new_log, F.size(old_log) + 1, F.greatest(F.size(new_log) - F.size(old_log), F.lit(0))), step)).otherwise(unclassified("ENT_AUT_SEQUENCE_REWRITTEN"))
    code_set = lambda c: F.when(F.col(c).isNull(), F.array().cast("array<string>")).when(listed(c), texts(c)).otherwise(F.array(c))
    gained, lost = F.array_sort(F.array_except(code_set("new"), code_set("old"))), F.array_sort(F.array_except(code_set("old"), code_set("new")))
    codes = F.array_compact(
        F.array(
            F.when(F.size(gained) > 0, candidate("CAPABILITY_APPEARED_CANDIDATE", None, "EVIDENCE_AS_OF", codes=gained)),
            F.when(F.size(lost) > 0, candidate("CAPABILITY_DISAPPEARED_CANDIDATE", None, "EVIDENCE_AS_OF", codes=lost)),
        )
    )
    gone = F.when(F.col("removal_admissible"), F.array(candidate("ENTITY_RECORD_DISAPPEARED", None, "EVIDENCE_AS_OF"))).otherwise(F.array(candidate("ENTITY_RECORD_DISAPPEARED", "NO_REMOVAL_ADMISSIBLE", "UNKNOWN")))
    found = (
        F.when(~ours, unclassified("NO_PREREGISTERED_RULE"))
        .when(F.col("kind") == "added", F.array(candidate("ENTITY_RECORD_APPEARED", None, "EVIDENCE_AS_OF")))
        .when(F.col("kind") == "removed", gone)
        .when(F.col("path") == LOG_PATH, log)
        .when(F.col("path") == CODES_PATH, codes)
        .otherwise(unclassified("NO_PREREGISTERED_RULE"))
    )
    out = rows.select(key, on, "kind", "path", observed_at(F.col("left_observation_id")).alias("observed_after"), observed_at(F.col("right_observation_id")).alias("observed_by"), F.explode(found).alias("c"))
    return out.select(key, on, "kind", "path", "observed_after", "observed_by", "c.*")


def changes_of(changes: DataFrame, record_key: str, asked: DataFrame) -> DataFrame:
    """The changes of the asked records; a record without any has none."""
    return changes.join(asked.select(record_key).distinct(), record_key, "left_semi")
