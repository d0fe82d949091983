"""The integrity report of the campus datasets: 17 checks that yield (level, file, message, record_id).

Tables carry `ordinal`, the order of their rows.  Each table meets the ids that it refers to once, and all checks of a row come from that
one pass.  Empty ids count as missing and are not looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import casefold, collapse

ISSUE = "level string, file string, message string, record_id string"
# Levels, files and messages of the checks below, which readers of the report know.
#: Words of rooms that tell nothing, and types that aliases and links may refer to.
DULL = ("aula", "laboratorio", "lab", "")
ALIASED = {"BUILDING": ("buildings", "building_id"), "PLACE": ("places", "place_id"), "PERSON": ("people", "person_id"), "DEPARTMENT": ("departments", "department_id")}
LINKED = ("BUILDING", "PLACE")


def _full(c) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _say(text: str, *values) -> Column:
    """Text with each {} replaced by a value, None if it is null."""
    parts = text.split("{}")
    out = [F.lit(parts[0])]
    for v, rest in zip(values, parts[1:]):
        out += [F.coalesce(v.cast("string"), F.lit("None")), F.lit(rest)]
    return F.concat(*out)


def _issue(level: str, file: str, when: Column, message: Column, record: Column) -> Column:
    return F.when(when, F.struct(F.lit(level).alias("level"), F.lit(f"{file}.json").alias("file"), message.alias("message"), _full(record.cast("string")).alias("record_id")))


def _all(rows: DataFrame, issues: list[Column]) -> DataFrame:
    return rows.select(F.explode(F.filter(F.array(*issues), lambda x: x.isNotNull())).alias("x")).select("x.*")


def _meet(rows: DataFrame, fk: str, known: DataFrame, key: str, flag: str, *carry: str) -> DataFrame:
    """rows with a flag where fk is one of known's keys, and what the last row of that key carries."""
    side = known.where(_full(key).isNotNull()).groupBy(F.col(key).alias(flag)).agg(F.lit(1).alias("_"), *[F.max_by(c, "ordinal").alias(f"{flag}_{c}") for c in carry]).drop("_")
    return rows.join(side, F.col(fk) == F.col(flag), "left")


def _missing(fk: str, flag: str) -> Column:
    return _full(fk).isNotNull() & F.col(flag).isNull()


def _typed(tables: dict[str, DataFrame], kinds) -> DataFrame:
    out = None
    for kind in kinds:
        name, key = ALIASED[kind]
        one = tables[name].where(_full(key).isNotNull()).select(F.lit(kind).alias("kind"), F.col(key).alias("id")).distinct()
        out = one if out is None else out.unionByName(one)
    return out


def _polymorphic(rows: DataFrame, kind: str, ref: str, targets: DataFrame, kinds, file: str, message: Column, record: str) -> DataFrame:
    lost = rows.where(F.col(kind).isin(*kinds) & _full(ref).isNotNull()).join(targets, (F.col(kind) == F.col("kind")) & (F.col(ref) == F.col("id")), "left_anti")
    return _all(lost, [_issue("error", file, F.lit(True), message, F.col(record))])


def check(tables: dict[str, DataFrame]) -> DataFrame:
    """All issues, in no order; sort by level, file, record_id and message to show them.  A wrong place hides what else could be said of it."""
    people, aulas, links = tables["people"], tables["aulas"], tables["entity_links"]
    b, d, p = tables["buildings"], tables["departments"], tables["places"]
    out = []

    rows = _meet(d, "primary_building_id", b, "building_id", "_b")
    out.append(_all(rows, [_issue("error", "departments", _missing("primary_building_id", "_b"), _say("primary_building_id '{}' does not exist in buildings.json", F.col("primary_building_id")), F.col("department_id"))]))
    rows = _meet(p, "building_id", b, "building_id", "_b")
    out.append(_all(rows, [_issue("error", "places", _missing("building_id", "_b"), _say("building_id '{}' does not exist in buildings.json", F.col("building_id")), F.col("place_id"))]))

    rows = _meet(_meet(people, "department_id", d, "department_id", "_d"), "office_place_id", p, "place_id", "_p", "type")
    office, who = F.col("office_place_id"), F.col("person_id")
    out.append(_all(rows, [
        _issue("error", "people", _missing("department_id", "_d"), _say("department_id '{}' does not exist in departments.json", F.col("department_id")), who),
        _issue("error", "people", _missing("office_place_id", "_p"), _say("office_place_id '{}' does not exist in places.json", office), who),
        _issue("warning", "people", F.col("_p").isNotNull() & ~F.col("_p_type").eqNullSafe("OFFICE"), _say("office_place_id '{}' points to a non-OFFICE place", office), who),
    ]))

    rows = _meet(_meet(_meet(aulas, "place_id", p, "place_id", "_p", "type", "building_id"), "building_id", b, "building_id", "_b"), "department_id", d, "department_id", "_d")
    place, block, room = F.col("place_id"), F.col("building_id"), F.col("aula_id")
    there = ~_missing("place_id", "_p")
    out.append(_all(rows, [
        _issue("error", "aulas", ~there, _say("place_id '{}' does not exist in places.json", place), room),
        _issue("warning", "aulas", F.col("_p").isNotNull() & ~F.col("_p_type").eqNullSafe("AULA"), _say("place_id '{}' points to a non-AULA place", place), room),
        _issue("error", "aulas", there & _missing("building_id", "_b"), _say("building_id '{}' does not exist in buildings.json", block), room),
        _issue("warning", "aulas", there & _full("building_id").isNotNull() & (_full("_p_building_id") != block), _say("building_id '{}' differs from places.json building_id '{}' for place_id '{}'", block, F.col("_p_building_id"), place), room),
        _issue("error", "aulas", there & _missing("department_id", "_d"), _say("department_id '{}' does not exist in departments.json", F.col("department_id")), room),
    ]))

    said = F.coalesce(_full("normalized_name"), "name", F.lit(""))
    named = aulas.where("building_id is not null").withColumn("_k", casefold(collapse(said))).where("_k <> ''")
    # the first id of a key is found by an aggregation, so that a frequent key is no long window
    first = named.where(_full("aula_id").isNotNull()).groupBy("_k", "building_id").agg(F.min_by("aula_id", "ordinal").alias("_first"), F.min("ordinal").alias("_at"))
    again = named.join(first, ["_k", "building_id"]).where((F.col("ordinal") > F.col("_at")) & (F.coalesce("aula_id", F.lit("")) != F.col("_first")))
    out.append(_all(again, [_issue("error", "aulas", F.lit(True), _say("duplicate aula key for normalized_name '{}' and building_id '{}' (also in '{}')", F.col("_k"), block, F.col("_first")), room)]))

    at = _full(F.trim("building_id"))
    placed = aulas.select(at.alias("_b"), _full(casefold(collapse("room"))).alias("_r"), _full(collapse("floor")).alias("_f"), _full("aula_id").alias("aula_id")).where("_b is not null and _r is not null and _f is not null")
    mixed = placed.groupBy("_b", "_r").agg(F.array_join(F.array_sort(F.collect_set("_f")), ", ").alias("_fs"), F.min("_f").alias("_lo"), F.max("_f").alias("_hi"), F.min("aula_id").alias("aula_id")).where("_lo <> _hi")
    out.append(_all(mixed, [_issue("error", "aulas", F.lit(True), _say("conflicting floor for room '{}' in building_id '{}': {}", F.col("_r"), F.col("_b"), F.col("_fs")), room)]))

    words = F.array_sort(F.array_distinct(F.filter(F.split(casefold(said), "[^a-z0-9]+"), lambda x: ~x.isin(*DULL))))
    alike = aulas.select(at.alias("_b"), words.alias("_w"), F.coalesce("aula_id", F.lit("")).alias("aula_id")).where("_b is not null and size(_w) > 1").groupBy("_b", "_w").agg(F.array_sort(F.collect_set("aula_id")).alias("_ids")).where("size(_ids) > 1")
    ids = F.filter("_ids", lambda x: x != "")
    out.append(_all(alike, [_issue("warning", "aulas", F.lit(True), _say("suspicious near-duplicate aulas for building_id '{}' and token_set '{}': {}", F.col("_b"), F.array_join("_w", " "), F.array_join(ids, ", ")), F.get(ids, F.lit(0)))]))

    kind, ref = F.col("entity_type"), F.col("entity_id")
    out.append(_polymorphic(tables["aliases"], "entity_type", "entity_id", _typed(tables, ALIASED), ALIASED, "aliases", _say("entity_id '{}' does not exist for entity_type '{}'", ref, kind), "alias_id"))
    repeated = links.where(_full("link_id").isNotNull()).withColumn("_i", F.row_number().over(Window.partitionBy("link_id").orderBy("ordinal"))).where("_i > 1")
    out.append(_all(repeated, [_issue("error", "entity_links", F.lit(True), _say("duplicate link_id '{}'", F.col("link_id")), F.col("link_id"))]))
    for side in ("parent", "child"):
        kind, ref = f"{side}_entity_type", f"{side}_entity_id"
        out.append(_polymorphic(links, kind, ref, _typed(tables, LINKED), LINKED, "entity_links", _say(f"{ref} '{{}}' does not exist for {kind} '{{}}'", F.col(ref), F.col(kind)), "link_id"))

    every = out[0]
    for one in out[1:]:
        every = every.unionByName(one)
    return every
