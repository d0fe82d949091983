"""Rooms end to end: raw rows folded, made into rooms and their places, given buildings, enriched and merged.

Raw rooms have name, source_url, lat, lng, floor, room, short_code, building_hint, capacity and `ordinal`, the order they were found in.
Empty texts count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rooms import quality_score
from ..functions.text import casefold, collapse, none_if_empty, room_id, room_tokens, slug
from .dedupe import first_wins
from .lookup import nearest_within, unique_only
from .places import buildings_in_text, enrich, force_buildings

RAW = ("name", "source_url", "lat", "lng", "floor", "room", "short_code", "building_hint", "capacity")
#: The planner's part of addresses, and the distance in metres beyond which no building is near.
PLANNER_URL, NEAR_M = "calendar/activities", 250


def _given(c) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def folded_order() -> list[Column]:
    """The order of raw rooms: name, floor and hint without case."""
    return [casefold(F.col("name")), F.coalesce(casefold(_given("floor")), F.lit("")), F.coalesce(casefold(_given("building_hint")), F.lit(""))]


def raw_fold(raw: DataFrame) -> DataFrame:
    """One row for each name and hint (without case), folded in order: a row that tells more takes over, missing fields fill from the other, seats are the most.

    A row only matters if it has a set of fields that none before it had, as only then it can take over or fill anything; so the first
    row of each set (128 at most) is found by aggregation, and only these are folded.
    """
    rows = raw.withColumns({c: _given(c) for c in ("floor", "room", "short_code", "building_hint")})
    rows = rows.withColumns({"_k": casefold(collapse("name")), "_h": F.coalesce(casefold(F.col("building_hint")), F.lit(""))})
    has = F.concat(*[F.col(c).isNotNull().cast("int").cast("string") for c in RAW[2:]])
    first = rows.withColumn("_set", has).groupBy("_k", "_h", "_set").agg(F.min_by(F.struct(*RAW), "ordinal").alias("r"), F.min("ordinal").alias("ordinal"), F.max("capacity").alias("most"))
    one = first.groupBy("_k", "_h").agg(F.array_sort(F.collect_list(F.struct("ordinal", "r"))).alias("_l"), F.max("most").alias("most"))
    score = lambda r: quality_score(r.lat, r.lng, r.building_hint, r.floor, r.short_code, r.room, r.capacity)

    def step(a, x):
        r = x.r
        over = score(r) > score(a)
        lead = F.when(over, F.struct(r.getField("name").alias("name"), r.source_url.alias("source_url"))).otherwise(F.struct(a.getField("name").alias("name"), a.source_url.alias("source_url")))
        fill = lambda c: F.when(over, F.coalesce(r[c], a[c])).otherwise(F.coalesce(a[c], r[c])).alias(c)
        return F.struct(lead.getField("name").alias("name"), lead.source_url.alias("source_url"), *[fill(c) for c in RAW[2:]])

    start = F.get(F.col("_l"), F.lit(0)).r
    merged = F.aggregate(F.slice("_l", F.lit(2), F.greatest(F.size("_l") - 1, F.lit(0))), start, step)
    return one.select(merged.alias("m"), "most", F.get(F.col("_l"), F.lit(0)).ordinal.alias("ordinal")).select(*[F.col(f"m.{c}").alias(c) for c in RAW[:-1]], F.col("most").alias("capacity"), "ordinal")


def rooms_and_places(raw: DataFrame, buildings: DataFrame, source: str, at: str) -> tuple[DataFrame, DataFrame]:
    """(rooms, places) of the raw rows, the first of an id.

    The building is the one that the hint names if it is known, else the nearest within 250 m, of equally near ones the first in the
    buildings' order (`ordinal`, else their id).
    """
    rows = raw.withColumn("name", none_if_empty("name")).where("name is not null")
    rows = rows.withColumns({"normalized_name": casefold(F.col("name")), "short_code": _given(F.upper(F.regexp_replace(_given("short_code"), r"(?U)\s+", ""))), "room": none_if_empty("room"), "floor": none_if_empty("floor"), "capacity": F.when(F.col("capacity") > 0, F.col("capacity")), "_hint": slug(_given("building_hint"))})
    known = buildings.where("building_id is not null").select(F.col("building_id").alias("_hint"), F.col("building_id").alias("_named")).distinct()
    # rows without a hint stay out of the exchange by hint
    hinted = rows.where("_hint is not null").join(known, "_hint", "left").unionByName(rows.where("_hint is null").withColumn("_named", F.lit(None).cast("string")))
    spots = hinted.where("_named is null and lat is not null and lng is not null").select("lat", "lng").distinct().withColumn("pid", F.struct("lat", "lng"))
    order = "ordinal" if "ordinal" in buildings.columns else "building_id"
    sites = buildings.where("building_id is not null and lat is not null and lng is not null").select(F.struct(F.col(order).alias("o"), "building_id").alias("tid"), F.col("lat").alias("tlat"), F.col("lng").alias("tlng"))
    near = nearest_within(spots, sites, NEAR_M).select("pid.lat", "pid.lng", F.col("tid.building_id").alias("_near"))
    placed = hinted.where("lat is not null and lng is not null").join(near, ["lat", "lng"], "left").unionByName(hinted.where("lat is null or lng is null").withColumn("_near", F.lit(None).cast("string")))
    placed = placed.withColumn("building_id", F.coalesce("_named", F.when(F.col("_named").isNull(), F.col("_near"))))
    placed = placed.withColumn("aula_id", room_id(F.col("normalized_name"), F.col("short_code"), F.col("building_id")))
    kept = first_wins(placed, ["aula_id"], ["ordinal"])
    stamp = [F.lit(source).alias("source_id"), F.col("source_url"), F.lit(at).alias("last_verified_at")]
    tokens = room_tokens(F.col("name"), F.col("short_code"), F.col("room"), F.col("building_id")).alias("search_tokens")
    rooms = kept.select("aula_id", F.col("aula_id").alias("place_id"), "name", "normalized_name", "short_code", tokens, "building_id", "floor", "room", "capacity", *stamp)
    both = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    places = kept.select(F.col("aula_id").alias("place_id"), F.lit("AULA").alias("type"), "name", "building_id", "floor", "room", F.when(both, F.bround("lat", 7)).alias("lat"), F.when(both, F.bround("lng", 7)).alias("lng"), *stamp)
    return rooms, places


def backfill(rooms: DataFrame, places: DataFrame, buildings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms, places): a room without building takes the only one that its name, room and code (each if it stands for one) and its texts name.

    All maps are made before anything is filled.  Rows without a key stay out of its exchange.
    """
    look = {"_name": _given(casefold(collapse(F.coalesce(_given("normalized_name"), "name")))), "_room": _given(casefold(collapse("room"))), "_code": _given(casefold(collapse("short_code")))}
    rows = rooms.withColumns(look)
    known = buildings.where("building_id is not null").select("building_id").distinct()
    placed = rows.join(known, "building_id", "left_semi")
    empty = rows.where(F.col("building_id").isNull())
    votes = None
    for c in look:
        told = empty.where(F.col(c).isNotNull()).select("aula_id", c).join(unique_only(placed, c, "building_id").withColumnRenamed("building_id", "building"), c).select("aula_id", "building")
        votes = told if votes is None else votes.unionByName(told)
    said = empty.select("aula_id", F.concat_ws(" ", _given("name"), _given("room"), _given("short_code"), _given("source_url")).alias("_said"))
    votes = votes.unionByName(buildings_in_text(said, "aula_id", "_said", buildings))
    found = unique_only(votes, "aula_id", "building").withColumnRenamed("building", "_to")
    out = rooms.join(found, "aula_id", "left").withColumn("_to", F.when(F.col("building_id").isNull(), F.col("_to")))
    tokens = F.when(F.col("_to").isNotNull(), F.array_sort(F.array_union(F.coalesce("search_tokens", F.array().cast("array<string>")), F.array(F.lower("_to"))))).otherwise(F.col("search_tokens"))
    out = out.withColumn("search_tokens", tokens).withColumn("building_id", F.coalesce("building_id", "_to"))
    moved = out.where("_to is not null and place_id is not null").groupBy("place_id").agg(F.min("_to").alias("_to"))
    at = places.join(moved, "place_id", "left").withColumn("building_id", F.coalesce("building_id", "_to"))
    return out.select(*rooms.columns), at.select(*places.columns)


def _off_planner() -> Column:
    return (~F.contains(casefold(F.coalesce("source_url", F.lit(""))), F.lit(PLANNER_URL))).cast("int")


def room_rank() -> Column:
    """Which of duplicate rooms leads: floor, seats, code, room, another source than the planner, the building in its id, a small letter in its name."""
    held = _given("building_id").isNotNull() & F.contains(F.coalesce("aula_id", F.lit("")), F.col("building_id"))
    flags = [_given("floor").isNotNull(), F.col("capacity").isNotNull(), _given("short_code").isNotNull(), _given("room").isNotNull(), _off_planner() == 1, F.coalesce(held, F.lit(False)), F.rlike(F.coalesce("name", F.lit("")), F.lit(r"\p{Ll}"))]
    return sum((x.cast("int") * (1 << (6 - i)) for i, x in enumerate(flags)), F.lit(0))


def place_rank() -> Column:
    flags = [F.col("lat").isNotNull() & F.col("lng").isNotNull(), _given("floor").isNotNull(), _given("room").isNotNull(), _off_planner() == 1]
    return sum((x.cast("int") * (1 << (3 - i)) for i, x in enumerate(flags)), F.lit(0))


def _first(value: Column, name: str, when: Column | None = None) -> Column:
    """The value of the row with the least `_at`, of those that the condition keeps."""
    return F.min_by(F.when(when, value) if when is not None else value, F.when(when, F.col("_at")) if when is not None else F.col("_at")).alias(name)


def merge_rooms(rooms: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms, places) with one row for each name and building; rooms without a building stay alone.

    The leading row's fields stay; code, room and floor fill from the next by rank, seats are the most, tokens those of all.  Places of
    merged rooms become one: the leading one's fields, name and source of the room, coordinates as a pair from the first that has both;
    where there is none it is made from the room.  Ranks and firsts are aggregates, so a frequent name costs no more than a row a task.
    """
    named = _given(casefold(collapse(F.coalesce(_given("normalized_name"), "name"))))
    key = F.when(F.col("building_id").isNotNull() & named.isNotNull(), F.concat_ws("|", F.lit("k"), named, "building_id")).otherwise(F.concat_ws("|", F.lit("s"), "aula_id"))
    ranked = rooms.withColumn("_k", key).withColumn("_at", F.struct((-room_rank()).alias("r"), F.col("aula_id").alias("o")))
    filled = ("short_code", "room", "floor")
    lead = [c for c in rooms.columns if c not in (*filled, "capacity", "search_tokens")]
    fill = [_first(_given(c), c, _given(c).isNotNull()) for c in filled]
    seats = F.max(F.when(F.col("capacity") > 0, F.col("capacity"))).alias("capacity")
    one = ranked.groupBy("_k").agg(_first(F.struct(*lead), "_lead"), *fill, seats, F.array_sort(F.array_distinct(F.flatten(F.collect_set("search_tokens")))).alias("search_tokens"), F.count("*").alias("_n"))
    merged = one.select("_k", "_n", "_lead.*", *filled, "capacity", "search_tokens")

    side = places.withColumn("_at", F.struct((-place_rank()).alias("r")))
    members = ranked.where("place_id is not null").select("_k", "place_id", F.col("aula_id").alias("_o"))
    met = members.join(side, "place_id").withColumn("_at", F.struct(F.col("_at.r").alias("r"), F.col("_o").alias("o")))
    pair = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    rest = [c for c in places.columns if c not in ("lat", "lng")]
    best = met.groupBy("_k").agg(_first(F.struct(*rest, "lat", "lng"), "_p"), _first(_given("floor"), "_floor", _given("floor").isNotNull()), _first(_given("room"), "_room", _given("room").isNotNull()), _first(F.struct("lat", "lng"), "_pair", pair))
    own = merged.select("_k", "_n", *[F.col(c).alias(f"_r_{c}") for c in ("aula_id", "place_id", "name", "source_id", "source_url", "last_verified_at", "building_id", "floor", "room")])
    both = own.join(best, "_k", "left").where("_n > 1 or _p is not null")
    alone = F.col("_n") == 1
    over = {"place_id": F.coalesce("_r_place_id", "_r_aula_id"), "type": F.lit("AULA"), "floor": F.coalesce(_given("_r_floor"), "_floor"), "room": F.coalesce(_given("_r_room"), "_room"), "lat": F.coalesce("_pair.lat", "_p.lat"), "lng": F.coalesce("_pair.lng", "_p.lng")}
    over |= {c: F.coalesce(F.col(f"_r_{c}"), F.col(f"_p.{c}")) for c in ("name", "source_id", "source_url", "last_verified_at", "building_id")}
    out = both.select(*[(F.when(alone, F.col(f"_p.{c}")).otherwise(over[c]) if c in over else F.col(f"_p.{c}")).alias(c) for c in places.columns])
    return merged.select(*rooms.columns), out


def rooms(raw: DataFrame, buildings: DataFrame, source: str, at: str, cut=lambda rows: rows) -> tuple[DataFrame, DataFrame]:
    """(rooms, places) from raw rooms: projected, given buildings, moved and enriched by their sources, merged.

    cut: writes rows and reads them again; each step reads the one before several times, so plans grow without it.
    """
    found, at_ = map(cut, rooms_and_places(cut(raw), buildings, source, at))
    found, at_ = map(cut, backfill(found, at_, buildings))
    found, at_ = force_buildings(found, at_, buildings)
    found, at_ = map(cut, enrich(found, at_, buildings))
    return merge_rooms(found, at_)
