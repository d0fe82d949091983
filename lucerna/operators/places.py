"""Places and rooms: links to buildings, forced buildings, enrichment and drops, aliases, the grouped contract."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rooms import alias_id, alias_labels, cascade, floor_from_codes, holds
from ..functions.text import casefold, made, once, slug
from .dedupe import first_wins

# Ids that are never linked, and (where to look, parts, building) in order; `=` looks at the id, `url` at the address.
NOT_LINKED = ("service-miai", "service-musnob", "service-orto-botanico", "service-rimuseum", "service-socialita-nel-campus", "service-quartieri", "service-servizio-mensa")
OFFICES, LANGUAGES, THEATRE = "uffici-centro-residenziale-e-area-didattica", "cla-centro-linguistico-d-ateneo", "auditorium-teatro-grande"
PLACE_RULES = (
    ("text", ("centro-sanitario", "assistenza sanitaria"), "centro-sanitario"),
    ("=", ("service-diritto-allo-studio", "service-info-isee"), OFFICES),
    ("url", ("/didattica/diritto-allo-studio/altri-benefici/", "/didattica/diritto-allo-studio/info-isee/"), OFFICES),
    ("text", ("front-office-on-line-cr", "serv-cr", "segnalazioni-e-richieste-cr", "centro residenziale"), OFFICES),
    ("text", ("centro-linguistico", "centro linguistico", " cla "), LANGUAGES),
    ("text", ("/sistema-museale/musnob/paleontologia/", "/sistema-museale/musnob/zoologia/", "/sistema-museale/musnob/mineralogia-e-petrografia/"), "cubo-14b"),
    ("text", ("centro-sportivo", "centro sportivo", "universitario sportivo", " cus "), "centro-universitario-sportivo"),
    ("text", ("career-service", "cubo 7/11"), "cubi-7-11*"),
    ("text", ("teatri-e-cinema", "edificio tau"), THEATRE),
    ("text", ("centro-congressi", "aula magna"), "aula-magna"),
    ("text", ("servizi-ict",), "cubo-22b"),
    ("text", ("borse-di-studio", "servizio-foresteria"), OFFICES),
    ("text", ("servizio-mensa",), OFFICES),
    ("text", ("biblioteche",), "cubo-libro"),
    ("text", ("polo-infanzia", "polo d'infanzia"), THEATRE),
)
CUBO = r"(?U)\bcubo\s*([0-9]{1,2})(?:\s*[/-]?\s*([a-z]))?\b"
CUBI = r"(?U)\bcubo\s*([0-9]{1,2})\s*[/-]\s*([0-9]{1,2}[a-z]?)\b"
CUBO_BARE = r"(?U)\b([0-9]{1,2}\s*[a-z])\b"
SHED = r"(?U)\bcapannone\s+([a-z])\b"

STRUCTURES, PLANNER = "/dipartimento/organizzazione/strutture/", "unical.prod.up.cineca.it/calendar/activities/"
#: Fixed values: (part of the address, condition on code and name, forced building).
FORCED = (
    (f"dispes.unical.it{STRUCTURES}", "_r.code in ('G1', 'G2', 'G3', 'G4')", "capannone-g"),
    (f"dispes.unical.it{STRUCTURES}", "_r.code in ('H1', 'H2', 'H3', 'H4')", "capannone-h"),
    (f"dispes.unical.it{STRUCTURES}", "_r.code in ('L1', 'L2')", "capannone-l"),
    (f"dispes.unical.it{STRUCTURES}", "_r.code in ('LS1', 'LS3', 'B', '44')", "polifunzionale"),
    (f"dfssn.unical.it{STRUCTURES}", "_r.code in ('13', '14', '15')", "capannone-c"),
    (f"dfssn.unical.it{STRUCTURES}", "_r.code in ('20', '21', '25')", "capannone-d"),
    (f"dfssn.unical.it{STRUCTURES}", "_r.code in ('45', '46', '52', '53')", "capannone-f"),
    (f"dfssn.unical.it{STRUCTURES}", "_r.name rlike 'aula circolare|aula gialla|aula informatica'", "polifunzionale-dfssn"),
    (f"dfssn.unical.it{STRUCTURES}", "_r.name rlike 'laboratorio chimico [bc]|microbiologia'", "capannone-e"),
    (f"dimeg.unical.it{STRUCTURES}", "contains(_r.name, 'consolidata b')", "cubo-43c"),
    (f"dimeg.unical.it{STRUCTURES}", "contains(_r.name, 'ds4')", "cubo-41b"),
    (f"dimeg.unical.it{STRUCTURES}", "_r.code rlike '\\\\bP1\\\\b' and contains(_r.name, 'piano ponte carrabile')", "cubo-40c"),
    (f"dimeg.unical.it{STRUCTURES}", "startswith(_r.name, 'aula m4 - aula seminari')", "cubo-44c"),
    (PLANNER, "startswith(_r.name, 'aula gialla -')", "polifunzionale-dfssn"),
    (PLANNER, "_r.name rlike 'medicina traslazionale|seminari medicina'", "polifunzionale-dfssn"),
    (PLANNER, "contains(_r.name, 'centro di simulazione') and contains(_r.name, 'med-td')", "polifunzionale-dfssn"),
    (PLANNER, "_r.name = 'aula orto botanico'", "orto-botanico"),
    (PLANNER, "contains(concat(' ', _r.name, ' '), ' lingue ') or endswith(_r.name, ' cla') or _r.name = 'aula cla'", LANGUAGES),
)
#: Fixed values: (part of the address, condition on name and building, what follows); `drop` takes the room and its place out.
ENRICHED = (
    (f"ctc.unical.it{STRUCTURES}", "_r.name = 'aula studio per i soli studenti di chimica'", {"building": "cubo-15c", "floor": "Secondo piano"}),
    (f"dimes.unical.it{STRUCTURES}", "_r.name = 'aula e'", {"drop": "1"}),
    (f"dimes.unical.it{STRUCTURES}", "_r.name in ('aula ds5', 'aula ds6', 'aula ds7', 'aula ds8')", {"floor": "Secondo piano"}),
    (f"dimes.unical.it{STRUCTURES}", "_r.name in ('aula p1', 'aula p5', 'aula p6')", {"floor": "Sesto piano"}),
    (f"dices.unical.it{STRUCTURES}", "_r.name = 'aula dolci'", {"building": "cubo-29b", "floor": "Secondo piano", "capacity": "280"}),
    (f"dimeg.unical.it{STRUCTURES}", "_r.name = 'aula lime laboratory of innovation and management engineering'", {"building": "cubo-41c"}),
    (f"dimeg.unical.it{STRUCTURES}", "_r.name in ('aula p1', 'aula p3', 'aula p4')", {"floor": "Sesto piano"}),
    (f"dimeg.unical.it{STRUCTURES}", "_r.name in ('aula consolidata 43b', 'aula b (consolidata)', 'aula consolidata b')", {"floor": "Quarto piano"}),
    (f"dinci.unical.it{STRUCTURES}", "contains(_r.name, 'giannattasio')", {"building": "cubo-45b", "floor": "Primo piano"}),
    (PLANNER, "_r.name in ('aula blu', 'aula verde', 'laboratorio a', 'laboratorio b', 'laboratorio c', 'spazio mostre')", {"drop": "1"}),
    (PLANNER, "contains(_r.name, 'multimediale') and contains(_r.name, '25')", {"building": LANGUAGES}),
    (PLANNER, "contains(_r.name, 'giannattasio') and _r.building = 'cubo-45b'", {"floor": "Primo piano"}),
    (PLANNER, "contains(_r.name, 'superiore')", {"floor": "Primo piano"}),
    (PLANNER, "contains(_r.name, 'inferiore')", {"floor": "Piano Terra"}),
    ("cla.unical.it/servizi-linguistici/studio-in-autonomia/", "contains(_r.name, 'multimediale cla')", {"building": LANGUAGES}),
    (f"diam.unical.it{STRUCTURES}", "contains(_r.name, 'giannattasio') and _r.building = 'cubo-45b'", {"floor": "Primo piano"}),
)


def _known(buildings: DataFrame) -> DataFrame:
    """(wanted, building): every id, and `prefix*` for the prefixes of `cubi-` ids that no other id shares."""
    ids = buildings.where("building_id is not null and building_id <> ''").select(F.col("building_id").alias("building")).distinct()
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.length("building")), lambda n: F.concat(F.substring("building", F.lit(1), n), F.lit("*"))))
    prefixes = ids.where(F.startswith("building", F.lit("cubi-"))).select(cut.alias("wanted"), "building").groupBy("wanted").agg(F.min("building").alias("building"), F.max("building").alias("_m")).where("building = _m").drop("_m")
    return ids.select(F.col("building").alias("wanted"), "building").unionByName(prefixes)


def _first_known(rows: DataFrame, wanted: Column, buildings: DataFrame, found: str) -> DataFrame:
    """The first of an array of wanted buildings that exists.

    Only distinct lists meet the buildings, so that one exchange of few rows serves any number of rules and no hot list is a hot task.
    """
    rows = rows.select("*", made(once(F.filter(wanted, lambda x: x.isNotNull()), lambda w: F.when(F.size(w) > 0, F.to_json(w)))).alias("_w"))
    lists = rows.where("_w is not null").select("_w").distinct()
    each = lists.select("_w", F.posexplode(F.from_json("_w", "array<string>")).alias("_i", "wanted")).join(_known(buildings), "wanted")
    return rows.join(each.groupBy("_w").agg(F.min_by("building", "_i").alias(found)), "_w", "left").drop("_w")


def link_places(places: DataFrame, buildings: DataFrame) -> DataFrame:
    """places with building_id: a known one stays, else that of the first rule whose building is known, else what was there."""
    text = casefold(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("name", "description", "source_url", "access_notes")]))
    said = F.struct(text.alias("text"), casefold(F.coalesce("source_url", F.lit(""))).alias("url"), casefold(F.col("place_id")).alias("key"))
    inferred = once(said, lambda x: _inferred(x.text, x.url, x.getField("key")))
    out = _first_known(places, F.concat(F.array("building_id"), inferred), buildings, "_found")
    return out.withColumn("building_id", F.coalesce("_found", "building_id")).drop("_found")


def _inferred(text: Column, url: Column, key: Column) -> Column:
    """The buildings that the rules want, in order; null where a rule doesn't hold."""
    where = {"text": lambda p: holds(text, p), "url": lambda p: holds(url, p), "=": lambda p: key.isin(*p)}
    numbered = F.contains(text, F.lit("cubo"))  # most texts have none, and are not searched
    by_number = F.when(numbered & F.rlike(text, F.lit(CUBO)), F.concat(F.lit("cubo-"), F.regexp_extract(text, CUBO, 1), F.regexp_extract(text, CUBO, 2)))
    by_numbers = F.when(numbered & F.rlike(text, F.lit(CUBI)), F.concat(F.lit("cubi-"), F.regexp_extract(text, CUBI, 1), F.lit("-"), F.regexp_extract(text, CUBI, 2), F.lit("*")))
    named = [F.when(where[k](parts), F.lit(target)) for k, parts, target in PLACE_RULES]
    return F.when(F.coalesce(~key.isin(*NOT_LINKED), F.lit(True)), F.array(by_number, by_numbers, *named)).otherwise(F.array().cast("array<string>"))


def buildings_in_text(rows: DataFrame, key: str, text: str, buildings: DataFrame) -> DataFrame:
    """(key, building) of every known building that the text names by number, shed or name."""
    ids = buildings.where("building_id is not null").select(F.col("building_id").alias("building")).distinct()
    only = ids.where(F.startswith("building", F.lit("polifunzionale"))).agg(F.min("building").alias("building"), F.max("building").alias("_m")).where("building = _m").select(F.lit("polifunzionale*").alias("wanted"), "building")
    wanted = rows.select(key, F.explode(F.array_distinct(once(casefold(F.col(text)), _wanted_by))).alias("wanted"))
    return wanted.join(ids.select(F.col("building").alias("wanted"), "building").unionByName(only), "wanted").select(key, "building").distinct()


def _wanted_by(t: Column) -> Column:
    tidy = lambda head, found: F.transform(found, lambda x: F.concat(F.lit(head), F.regexp_replace(x, r"(?U)[\s/-]+", "")))
    named = F.array(F.when(F.contains(t, F.lit("orto botanico")), F.lit("orto-botanico")), F.when(holds(t, (" cla ", "centro linguistico", "centro-linguistico")), F.lit(LANGUAGES)), F.when(F.contains(t, F.lit("polifunzionale")), F.lit("polifunzionale*")))
    numbers = F.transform(F.regexp_extract_all(t, F.lit(CUBO), F.lit(0)), lambda x: F.regexp_replace(x, "^cubo", ""))
    return F.concat(tidy("cubo-", numbers), tidy("cubo-", F.regexp_extract_all(t, F.lit(CUBO_BARE), F.lit(1))), tidy("capannone-", F.regexp_extract_all(t, F.lit(SHED), F.lit(1))), named)


def _in_family(rules, value) -> Column:
    """value(rule) of the first rule in the first family of addresses that fits; rules see `url`, `name`, `code`, `building`."""
    families = dict.fromkeys(f for f, _, _ in rules)
    return cascade([(F.contains(F.col("_r.url"), F.lit(f)), cascade([(F.expr(cond), value(then)) for g, cond, then in rules if g == f])) for f in families])


def _seen(rooms: DataFrame) -> DataFrame:
    clean = lambda c: F.nullif(F.upper(F.trim(c)), F.lit(""))
    return rooms.select("*", made(F.struct(casefold(F.coalesce("source_url", F.lit(""))).alias("url"), casefold(F.coalesce("name", F.lit(""))).alias("name"), F.coalesce(clean("short_code"), clean("room"), F.lit("")).alias("code"), F.trim("building_id").alias("building"))).alias("_r"))


def _move(rooms: DataFrame) -> DataFrame:
    tokens = F.when(F.col("_to").isNotNull(), F.array_sort(F.array_union(F.coalesce("search_tokens", F.array().cast("array<string>")), F.array("_to")))).otherwise(F.col("search_tokens"))
    return rooms.withColumn("search_tokens", tokens).withColumn("building_id", F.coalesce("_to", "building_id"))


def _follow(places: DataFrame, rooms: DataFrame) -> DataFrame:
    """places after their rooms: gone with them (_drop), moved with them (_to), and with their new floor (_floor) where they have none."""
    fates = rooms.where("place_id is not null and (_drop or _to is not null or _floor is not null)").groupBy("place_id").agg(F.max("_drop").alias("_drop"), F.min("_to").alias("_to"), F.min("_floor").alias("_floor"))
    out = places.join(fates, "place_id", "left").where("not coalesce(_drop, false)")
    return out.withColumn("floor", F.coalesce("floor", "_floor")).withColumn("building_id", F.coalesce("_to", "building_id")).select(*places.columns)


def force_buildings(rooms: DataFrame, places: DataFrame, buildings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms, places) with the building that the room's source is known to mean; an unknown one changes nothing.  Its id joins search_tokens."""
    moved = _move(_first_known(_seen(rooms), F.array(_in_family(FORCED, F.lit)), buildings, "_to"))
    return moved.select(*rooms.columns), _follow(places, moved.select("place_id", "_to", F.lit(False).alias("_drop"), F.lit(None).cast("string").alias("_floor")))


def enrich(rooms: DataFrame, places: DataFrame, buildings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms, places): sources' rules and codes fill floors and seats, move rooms and drop some, and places follow by place_id.

    A floor is filled only where it is missing, seats where they are missing or fewer.  Codes are read with the building before the move.
    """
    of = lambda k: _in_family(ENRICHED, lambda then: F.lit(then.get(k)))
    sheds = buildings.where(F.startswith("building_id", F.lit("capannone-"))).select(F.col("building_id").alias("_shed")).distinct()
    seen = _seen(rooms).join(sheds, F.col("building_id") == F.col("_shed"), "left")
    by_code = floor_from_codes(F.col("name"), F.col("room"), F.col("short_code"), F.col("_r.building"))
    floor = F.when(F.col("floor").isNull(), F.coalesce(of("floor"), F.when(F.col("_shed").isNotNull(), F.lit("Piano Terra")), by_code))
    seen = seen.select(*rooms.columns, floor.alias("_floor"), of("capacity").cast("int").alias("_seats"), of("building").alias("_want"), F.coalesce(of("drop") == "1", F.lit(False)).alias("_drop"))
    moved = _move(_first_known(seen, F.array("_want"), buildings, "_to"))
    kept = moved.where("not _drop").withColumn("floor", F.coalesce("floor", "_floor")).withColumn("capacity", F.greatest("capacity", "_seats"))
    return kept.select(*rooms.columns), _follow(places, moved.select("place_id", "_to", "_drop", "_floor"))


def aliases(rooms: DataFrame, places: DataFrame, buildings: DataFrame, landmarks: list[tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """Labels of rooms that are AULA places, then those of landmarks that exist; a label's first spelling stays."""
    aula = places.where("type = 'AULA'").select("place_id").distinct()
    labels = F.posexplode(alias_labels(F.col("name"), F.col("room"), F.col("short_code"))).alias("_i", "label")
    own = rooms.join(aula, "place_id", "left_semi").select(F.lit(0).alias("_p"), F.lit("PLACE").alias("entity_type"), F.col("place_id").alias("entity_id"), labels)
    listed = rooms.sparkSession.createDataFrame([(1, k, e, i, x) for k, e, ls in landmarks for i, x in enumerate(ls)], "_p int, entity_type string, entity_id string, _i int, label string")
    there = places.select(F.lit("PLACE").alias("entity_type"), F.col("place_id").alias("entity_id")).unionByName(buildings.select(F.lit("BUILDING").alias("entity_type"), F.col("building_id").alias("entity_id"))).distinct()
    rows = own.unionByName(listed.join(there, ["entity_type", "entity_id"], "left_semi")).select("*", made(slug("label")).alias("normalized")).where("normalized <> ''")
    kept = first_wins(rows, ["entity_type", "entity_id", "normalized"], ["_p", "_i", "label"])
    return kept.select(alias_id(F.col("entity_type"), F.col("entity_id"), F.col("normalized")).alias("alias_id"), "entity_type", "entity_id", "label", "normalized")


#: Fields that a contract's entries may set.
PLACE_FIELDS = ("source_id", "source_url", "building_id", "description", "email", "phone", "website_url", "opening_hours", "access_notes", "floor", "room")
BUILDING_FIELDS = ("category", "source_id", "source_url", "description")
LINK_FIELDS = ("parent_entity_type", "parent_entity_id", "relation_type", "child_entity_type", "child_entity_id")


def _text(entry: dict, field: str) -> str | None:
    v = entry.get(field)
    return (" ".join(v.split()) or None) if isinstance(v, str) else None


def _needed(entry: dict, field: str) -> str:
    v = _text(entry, field)
    if v is None:
        raise ValueError(f"missing required string field: {field}")
    return v


def _entries(contract: dict, name: str) -> list[dict]:
    v = contract.get(name)
    return [x for x in v if isinstance(x, dict)] if isinstance(v, list) else []


def _names(holder: dict, name: str) -> list[str]:
    v = holder.get(name)
    return [x for x in v if isinstance(x, str) and x] if isinstance(v, list) else []


def _patched(rows: DataFrame, key: str, patches: dict[str, dict], gone: list[str]) -> DataFrame:
    """rows with each id's patch (field to new value, None clears), new ids added and removed ones left out."""
    spark, rest = rows.sparkSession, [c for c in rows.columns if c != key]
    table = spark.createDataFrame([(k, json.dumps({f: v for f, v in p.items() if v is not None}), sorted(f for f, v in p.items() if v is None)) for k, p in patches.items()], f"{key} string, _set string, _cleared array<string>")
    value = lambda c: F.get_json_object("_set", f"$.{c}").cast(rows.schema[c].dataType)
    out = rows.join(table, key, "full_outer").where(F.coalesce(~F.col(key).isin(gone), F.lit(True)) if gone else F.lit(True))
    return out.select(key, *[F.when(F.coalesce(F.array_contains("_cleared", c), F.lit(False)), F.lit(None)).otherwise(F.coalesce(value(c), F.col(c))).alias(c) for c in rest]).select(*rows.columns)


def apply_contract(places: DataFrame, buildings: DataFrame, contract: dict, verified_at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(places, buildings, links) after the reviewed contract, a small document: clearings, quarters, places, canteens, buildings, removals, links.

    Each id's entries become one patch on the driver, later ones over earlier, so each table is joined once.
    """
    known = {r[0] for r in places.where(F.col("place_id").isin(_names(contract, "clear_overview_building_ids"))).select("place_id").distinct().collect()} if _names(contract, "clear_overview_building_ids") else set()
    at: dict[str, dict] = {k: {"building_id": None, "last_verified_at": verified_at} for k in known}
    for entry in [{"clear_building_id": True} | x for x in _entries(contract, "quartieri_places")] + _entries(contract, "place_overrides"):
        patch = at.setdefault(_needed(entry, "place_id"), {})
        if entry.get("clear_building_id") is True:
            patch["building_id"] = None
        patch |= {"type": _needed(entry, "type"), "name": _needed(entry, "name"), "last_verified_at": verified_at} | _set(entry, PLACE_FIELDS) | dict.fromkeys(_names(entry, "clear_fields"))
    of: dict[str, dict] = {}
    for entry in _entries(contract, "mensa_buildings") + _entries(contract, "building_overrides"):
        of.setdefault(_needed(entry, "building_id"), {}).update({"name": _needed(entry, "name"), "last_verified_at": verified_at} | _set(entry, BUILDING_FIELDS))
    links = [[_needed(x, f) for f in LINK_FIELDS] + [x["sort_order"] if isinstance(x.get("sort_order"), int) else None, _text(x, "source_id"), _text(x, "source_url")] for x in _entries(contract, "entity_links")]
    made = places.sparkSession.createDataFrame([(f"{x[1]}__{x[2].casefold()}__{x[4]}", *x) for x in links], "link_id string, " + "".join(f"{f} string, " for f in LINK_FIELDS) + "sort_order int, source_id string, source_url string")
    return _patched(places, "place_id", at, _names(contract, "remove_place_ids")), _patched(buildings, "building_id", of, _names(contract, "remove_building_ids")), made


def _set(entry: dict, fields) -> dict:
    out = {f: v for f in fields if (v := _text(entry, f))}
    lat, lng = entry.get("lat"), entry.get("lng")
    return out | ({"lat": round(float(lat), 7), "lng": round(float(lng), 7)} if isinstance(lat, (int, float)) and isinstance(lng, (int, float)) else {})
