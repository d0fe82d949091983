"""Queries of rooms end to end, over raw rows made of the driver's parts and suppliers, each with the SQL that says the same.

The SQL that makes the raw rows is read by both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rooms as R
from ..operators import dedupe, room_merge
from ..operators.rules import cut
from ..sources.tables import spread, table
from .registry import query

# Every third part of a size has the same name, so that folds and merges have something to do.
RAW = """select cast(p_partkey as bigint) as ordinal, 'Aula ' || upper(substr(p_name, 1, 1)) || p_size as name, case when p_partkey % 4 = 0 then 'https://unical.prod.up.cineca.it/calendar/activities/' || p_partkey else 'https://d.it/' || p_partkey end as source_url,
case when p_partkey % 3 = 0 then 39.36 + (p_partkey * 37 % 1000) / 100000.0 end as lat, case when p_partkey % 3 <> 1 then 16.22 + (p_partkey * 91 % 1000) / 100000.0 end as lng,
case when p_partkey % 5 = 0 then p_type when p_partkey % 5 = 1 then '' end as floor, case when p_partkey % 7 < 2 then p_brand end as room, case when p_partkey % 2 = 0 then 'c' || p_size end as short_code,
case when p_partkey % 6 = 0 then 'Block ' || (p_size % 9) when p_partkey % 6 = 1 then 'BLOCK ' || (p_size % 9) when p_partkey % 6 = 2 then 'Gone' when p_partkey % 6 = 3 then '' end as building_hint, case when p_partkey % 3 = 0 then p_size * 10 end as capacity from {part}"""
BLOCKS = "select cast(s_suppkey as bigint) as ordinal, 'block-' || (s_suppkey % 9) || case when s_suppkey < 9 then '' else '-' || s_suppkey end as building_id, 39.36 + (s_suppkey * 53 % 1000) / 100000.0 as lat, 16.22 + (s_suppkey * 17 % 1000) / 100000.0 as lng from {supplier}"


def made(spark, d: str, sql: str, *names: str) -> DataFrame:
    """The rows of a SQL text whose tables stand in braces."""
    for n in names:
        spread(table(spark, d, n)).createOrReplaceTempView(f"_lucerna_{n}")
        sql = sql.replace(f"{{{n}}}", f"_lucerna_{n}")
    return spark.sql(sql)


def plain(sql: str, *names: str) -> str:
    for n in names:
        sql = sql.replace(f"{{{n}}}", n)
    return sql


def _raw(spark, d) -> DataFrame:
    return made(spark, d, RAW, "part").withColumns({"lat": F.col("lat").cast("double"), "lng": F.col("lng").cast("double"), "capacity": F.col("capacity").cast("int")})


def _blocks(spark, d) -> DataFrame:
    return made(spark, d, BLOCKS, "supplier").withColumns({"lat": F.col("lat").cast("double"), "lng": F.col("lng").cast("double")})


SCORE = "(case when lat is not null and lng is not null then 3 else 0 end + case when nullif(building_hint, '') is not null then 2 else 0 end + case when nullif(floor, '') is not null then 2 else 0 end + case when nullif(short_code, '') is not null then 1 else 0 end + case when nullif(room, '') is not null then 1 else 0 end + case when capacity is not null then 1 else 0 end)"


@query(f"select ordinal, {SCORE} as score from ({plain(RAW, 'part')})")
def raw_room_scores(spark, d):
    return _raw(spark, d).select("ordinal", R.quality_score(*[F.col(c) for c in ("lat", "lng", "building_hint", "floor", "short_code", "room", "capacity")]).alias("score"))


# The fold as it is defined, a row at a time: SQL follows each key's rows one after another.
FOLD = f"""with recursive raw as ({plain(RAW, 'part')}),
t as (select lower(name) as k, coalesce(lower(nullif(building_hint, '')), '') as h, row_number() over (partition by lower(name), coalesce(lower(nullif(building_hint, '')), '') order by ordinal) as n,
  name, source_url, cast(lat as double) as lat, cast(lng as double) as lng, nullif(floor, '') as floor, nullif(room, '') as room, nullif(short_code, '') as short_code, nullif(building_hint, '') as building_hint, cast(capacity as integer) as capacity from raw),
f as (select * from t where n = 1
  union all
  select k, h, n, case when o then r.name else f.name end, case when o then r.source_url else f.source_url end, case when o then coalesce(r.lat, f.lat) else coalesce(f.lat, r.lat) end, case when o then coalesce(r.lng, f.lng) else coalesce(f.lng, r.lng) end,
    case when o then coalesce(r.floor, f.floor) else coalesce(f.floor, r.floor) end, case when o then coalesce(r.room, f.room) else coalesce(f.room, r.room) end, case when o then coalesce(r.short_code, f.short_code) else coalesce(f.short_code, r.short_code) end,
    case when o then coalesce(r.building_hint, f.building_hint) else coalesce(f.building_hint, r.building_hint) end, greatest(r.capacity, f.capacity)
  from (select f.k, f.h, r.n, {SCORE.replace('lat', 'r.lat').replace('lng', 'r.lng').replace('building_hint', 'r.building_hint').replace('floor', 'r.floor').replace('short_code', 'r.short_code').replace(' room', ' r.room').replace('(room', '(r.room').replace('capacity', 'r.capacity')}
    > {SCORE.replace('lat', 'f.lat').replace('lng', 'f.lng').replace('building_hint', 'f.building_hint').replace('floor', 'f.floor').replace('short_code', 'f.short_code').replace(' room', ' f.room').replace('(room', '(f.room').replace('capacity', 'f.capacity')} as o,
    r as r, f as f from f join t r on r.k = f.k and r.h = f.h and r.n = f.n + 1))
select name, source_url, lat, lng, floor, room, short_code, building_hint, capacity from f qualify row_number() over (partition by k, h order by n desc) = 1"""


@query(FOLD)
def raw_room_fold(spark, d):
    return room_merge.raw_fold(_raw(spark, d)).drop("ordinal")


@query(f"select building_hint, name, floor, ordinal, row_number() over (partition by building_hint order by lower(name), coalesce(lower(floor), ''), coalesce(lower(building_hint), ''), ordinal) as place from ({plain(RAW, 'part')})")
def raw_room_order(spark, d):
    return dedupe.placed(_raw(spark, d), ["building_hint"], [*room_merge.folded_order(), "ordinal"], "place").select("building_hint", "name", "floor", "ordinal", F.col("place").cast("long").alias("place"))


HAV = "2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))"
PROJECTED = f"""raw as ({plain(RAW, 'part')}), b as ({plain(BLOCKS, 'supplier')}),
m as (select ordinal, building_id, {HAV} as metres, bo from (select raw.ordinal, b.building_id, b.ordinal as bo, pow(sin(radians(b.lat - raw.lat) / 2), 2) + cos(radians(raw.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - raw.lng) / 2), 2) as h from raw join b on raw.lat is not null and raw.lng is not null)),
near as (select ordinal, arg_min(building_id, (metres, bo)) as n from m where metres <= 250 group by 1),
p as (select raw.*, coalesce(named.building_id, n) as building_id, upper(short_code) as code from raw left join near using (ordinal) left join b named on named.building_id = replace(lower(nullif(building_hint, '')), ' ', '-')),
ided as (select *, coalesce(lower(code), replace(lower(name), 'aula ', '')) as base from p),
k as (select *, case when building_id is null then base else base || '-' || building_id end as aula_id from ided qualify row_number() over (partition by case when building_id is null then base else base || '-' || building_id end order by ordinal) = 1),
r as (select aula_id, name, lower(name) as normalized_name, code as short_code, building_id, nullif(floor, '') as floor, room, nullif(capacity, 0) as capacity, source_url, cast(lat as double) as lat, cast(lng as double) as lng,
  list_distinct(list_filter([replace(lower(name), ' ', '-'), replace(lower(name), ' ', ''), replace(lower(name), 'aula ', ''), replace(lower(room), '#', '-'), replace(lower(room), '#', ''), lower(code), building_id], lambda x: x is not null)) as tokens from k)"""


@query(f"with {PROJECTED} select aula_id, name, normalized_name, short_code, array_to_string(list_sort(tokens), ' ') as tokens, building_id, floor, room, cast(capacity as integer) as capacity, source_url, case when lat is not null and lng is not null then round_even(lat, 7) end as lat, case when lat is not null and lng is not null then round_even(lng, 7) end as lng from r")
def rooms_and_places(spark, d):
    rooms, places = room_merge.rooms_and_places(_raw(spark, d), _blocks(spark, d), "s", "now")
    out = rooms.join(places.select("place_id", "lat", "lng"), "place_id")
    return out.select("aula_id", "name", "normalized_name", "short_code", F.array_join("search_tokens", " ").alias("tokens"), "building_id", "floor", "room", "capacity", "source_url", "lat", "lng")


def _projected(spark, d):
    """(rooms, places, buildings), written and read again: each later step reads them several times, and plans would grow with each."""
    b = cut(_blocks(spark, d))
    return *map(cut, room_merge.rooms_and_places(cut(_raw(spark, d)), b, "s", "now")), b


def _filled(spark, d):
    rooms, places, b = _projected(spark, d)
    return map(cut, room_merge.backfill(rooms, places, b))


VOTES = f"""{PROJECTED}, placed as (select * from r where building_id in (select building_id from b)),
votes as (select r.aula_id, v.v from r join (select normalized_name as x, min(building_id) as v from placed group by 1 having count(distinct building_id) = 1) v on v.x = r.normalized_name where r.building_id is null
union all select r.aula_id, v.v from r join (select lower(room) as x, min(building_id) as v from placed where room is not null group by 1 having count(distinct building_id) = 1) v on v.x = lower(r.room) where r.building_id is null
union all select r.aula_id, v.v from r join (select lower(short_code) as x, min(building_id) as v from placed where short_code is not null group by 1 having count(distinct building_id) = 1) v on v.x = lower(r.short_code) where r.building_id is null),
filled as (select r.* exclude (building_id, tokens), coalesce(building_id, v) as building_id, list_distinct(case when building_id is null and v is not null then list_append(tokens, v) else tokens end) as tokens from r left join (select aula_id, min(v) as v from votes group by 1 having count(distinct v) = 1) using (aula_id))"""


@query(f"with {VOTES} select aula_id, building_id, array_to_string(list_sort(tokens), ' ') as tokens from filled")
def room_backfill(spark, d):
    rooms, _ = room_merge.backfill(*_projected(spark, d))
    return rooms.select("aula_id", "building_id", F.array_join("search_tokens", " ").alias("tokens"))


RANK = "(case when floor is not null then 64 else 0 end + case when capacity is not null then 32 else 0 end + case when short_code is not null then 16 else 0 end + case when room is not null then 8 else 0 end + case when source_url not like '%calendar/activities%' then 4 else 0 end + case when contains(aula_id, building_id) then 2 else 0 end + 1)"
MERGED = f"""{VOTES}, g as (select *, case when building_id is null then 's|' || aula_id else 'k|' || normalized_name || '|' || building_id end as key, (-{RANK}, aula_id) as rk, (-(case when lat is not null and lng is not null then 8 else 0 end + case when floor is not null then 4 else 0 end + case when room is not null then 2 else 0 end + case when source_url not like '%calendar/activities%' then 1 else 0 end), aula_id) as pat from filled),
one as (select key, count(*) as n, arg_min(aula_id, rk) as aula_id, arg_min(name, rk) as name, arg_min(source_url, rk) as source_url, arg_min(building_id, rk) as building_id, arg_min(short_code, rk) filter (where short_code is not null) as short_code, arg_min(room, rk) filter (where room is not null) as room,
  arg_min(floor, rk) filter (where floor is not null) as floor, max(capacity) as capacity, list_distinct(flatten(list(tokens))) as tokens, arg_min(floor, pat) filter (where floor is not null) as pfloor, arg_min(room, pat) filter (where room is not null) as proom,
  arg_min(lat, pat) filter (where lat is not null and lng is not null) as lat, arg_min(lng, pat) filter (where lat is not null and lng is not null) as lng from g group by key)"""


@query(f"with {MERGED} select aula_id, name, source_url, building_id, short_code, room, floor, cast(capacity as integer) as capacity, array_to_string(list_sort(tokens), ' ') as tokens from one")
def room_merge_ranked(spark, d):
    rooms, _ = room_merge.merge_rooms(*_filled(spark, d))
    return rooms.select("aula_id", "name", "source_url", "building_id", "short_code", "room", "floor", "capacity", F.array_join("search_tokens", " ").alias("tokens"))


@query(f"with {MERGED} select aula_id as place_id, 'AULA' as type, name, source_url, building_id, coalesce(floor, pfloor) as floor, coalesce(room, proom) as room, round_even(lat, 7) as lat, round_even(lng, 7) as lng from one")
def place_merge_ranked(spark, d):
    _, out = room_merge.merge_rooms(*_filled(spark, d))
    return out.select("place_id", "type", "name", "source_url", "building_id", "floor", "room", "lat", "lng")


@query(f"""with {MERGED} select 'AULA' as type, aula_id as place_id, name, building_id, floor, room from one where n > 1""")
def place_synthesis(spark, d):
    rooms, places = _filled(spark, d)
    _, out = room_merge.merge_rooms(rooms, places.where(F.lit(False)))
    return out.select("type", "place_id", "name", "building_id", "floor", "room")
