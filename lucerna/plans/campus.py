"""Queries that make rooms, places and requests out of the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rooms
from ..operators import documents, places
from ..sources import markup, requests
from ..sources.tables import spread, table
from .registry import query

# A text about a building for every part: a numbered block with a letter, a shed, or a bare code.
SAID = "case p_partkey % 3 when 0 then 'ECONOMY, cubo ' || p_size || '/' || substr(p_name, 1, 1) when 1 then 'capannone  ' || substr(p_name, 2, 1) || ' piano' else 'ubicazione ' || p_size || substr(p_name, 1, 1) || ' ' end"
HINT = r"case p_partkey % 3 when 1 then 'Capannone ' || upper(substr(p_name, 2, 1)) else 'Cubo ' || p_size || upper(substr(p_name, 1, 1)) end"


def _part(spark, d) -> DataFrame:
    return spread(table(spark, d, "part")).withColumn("said", F.expr(SAID))


@query(f"select p_partkey, {HINT} as hint from part")
def building_hints(spark, d):
    return _part(spark, d).select("p_partkey", rooms.building_hint("said").alias("hint"))


FLOOR_LIST = "['Piano Terra', 'Primo piano', 'Secondo piano', 'Terzo piano', 'Quarto piano', 'Quinto piano', 'Sesto piano', 'Settimo piano']"


@query(f"select p_partkey, case when p_name like 'large%' then 'Sesto piano' else {FLOOR_LIST}[p_size % 10 + 1] end as floor from part")
def floor_labels(spark, d):
    said = F.expr("case when p_name like 'large%' then 'sul ponte  carrabile' when p_partkey % 2 = 0 then p_name || ' piano ' || (p_size % 10) else (p_size % 10) || '° Piano' end")
    return spread(table(spark, d, "part")).select("p_partkey", rooms.floor_label(said).alias("floor"))


@query("select p_partkey, case when p_partkey % 4 = 3 then null when p_size * 150 between 1 and 5000 then cast(p_size * 150 as integer) end as seats from part")
def seat_counts(spark, d):
    said = F.expr("case p_partkey % 4 when 0 then 'capienza: ' || (p_size * 150) when 1 then p_name || ' ' || (p_size * 150) || ' persone' when 2 then '' || (p_size * 150) else p_name end")
    return spread(table(spark, d, "part")).select("p_partkey", rooms.capacity(said).alias("seats"))


@query("""select p_partkey, p_name || '|' || c || '|Aula ' || c || '|' || s || '|Aula ' || s as labels
from (select p_partkey, p_name, upper(replace(p_brand, '#', '')) as c, upper(replace(p_brand, '#', ' ')) as s from part)""")
def room_aliases(spark, d):
    labels = rooms.alias_labels(F.col("p_name"), F.lit(None).cast("string"), F.replace("p_brand", F.lit("#"), F.lit("")))
    return spread(table(spark, d, "part")).select("p_partkey", F.array_join(labels, "|").alias("labels"))


BLOCKS = "select distinct 'cubo-' || (s_suppkey % 40) || case when s_acctbal > 4000 then 's' else 'l' end as building_id from supplier union select 'capannone-a' union select 'capannone-m' union select 'aula-magna' union select 'polifunzionale'"
WANTED = "case p_partkey % 3 when 1 then 'capannone-' || substr(p_name, 2, 1) else 'cubo-' || p_size || substr(p_name, 1, 1) end"


def _blocks(spark, d) -> DataFrame:
    own = table(spark, d, "supplier").selectExpr("'cubo-' || (s_suppkey % 40) || case when s_acctbal > 4000 then 's' else 'l' end as building_id").distinct()
    return own.unionByName(spark.createDataFrame([("capannone-a",), ("capannone-m",), ("aula-magna",), ("polifunzionale",)], "building_id string"))


@query(f"""with b as ({BLOCKS}) select p_partkey, coalesce(b.building_id, case when p_partkey % 3 = 0 and p_type = 'ECONOMY' then 'aula-magna' end, case when p_partkey % 3 <> 0 and p_type = 'PROMO' then 'gone' end) as building_id
from part left join b on p_partkey % 3 = 0 and b.building_id = {WANTED}""")
def place_rules(spark, d):
    rows = _part(spark, d).selectExpr("p_partkey", "'p-' || p_partkey as place_id", "said as name", "case when p_type = 'ECONOMY' and p_partkey % 3 = 0 then 'Aula Magna' end as description", "cast(null as string) as source_url", "cast(null as string) as access_notes", "case when p_partkey % 3 <> 0 and p_type = 'PROMO' then 'gone' end as building_id")
    return places.link_places(rows, _blocks(spark, d)).select("p_partkey", "building_id")


@query(f"with b as ({BLOCKS}) select p_partkey, building_id as building from part join b on building_id = {WANTED}")
def regex_links(spark, d):
    return places.buildings_in_text(_part(spark, d), "p_partkey", "said", _blocks(spark, d))


def _rooms(spark, d) -> DataFrame:
    url = "case p_partkey % 3 when 0 then 'https://dispes.unical.it/dipartimento/organizzazione/strutture/' when 1 then 'https://dinci.unical.it/dipartimento/organizzazione/strutture/' end as source_url"
    return spread(table(spark, d, "part")).selectExpr("'p-' || p_partkey as place_id", "'Aula ' || p_name || case when p_type = 'PROMO' then ' Giannattasio' else '' end as name", "cast(null as string) as room", "substr(p_name, 1, 1) || (p_size % 4) as short_code", url, "cast(null as string) as building_id", "cast(null as string) as floor", "p_size as capacity", "cast(array() as array<string>) as search_tokens")


def _no_places(spark) -> DataFrame:
    return spark.createDataFrame([], "place_id string, building_id string, floor string")


@query("select 'p-' || p_partkey as place_id, case when p_partkey % 3 = 0 and p_name like 'l%' and p_size % 4 in (1, 2) then 'capannone-l' when p_partkey % 3 = 0 and p_name like 'h%' and p_size % 4 > 0 then 'capannone-h' end as building_id from part")
def forced_buildings(spark, d):
    known = spark.createDataFrame([("capannone-l",), ("capannone-h",)], "building_id string")
    return places.force_buildings(_rooms(spark, d), _no_places(spark), known)[0].select("place_id", "building_id")


@query("select 'p-' || p_partkey as place_id, case when p_partkey % 3 = 1 and p_type = 'PROMO' then 'cubo-45b' end as building_id, case when p_partkey % 3 = 1 and p_type = 'PROMO' then 'Primo piano' end as floor from part")
def enriched_rooms(spark, d):
    known = spark.createDataFrame([("cubo-45b",)], "building_id string")
    return places.enrich(_rooms(spark, d), _no_places(spark), known)[0].select("place_id", "building_id", "floor")


CONTRACT = {
    "clear_overview_building_ids": ["c-1", "c-none"],
    "quartieri_places": [{"place_id": "c-2", "type": "Q", "name": "two", "floor": "1"}],
    "place_overrides": [{"place_id": "c-3", "type": "P", "name": "three", "building_id": "b-9", "clear_fields": ["floor"]}, {"place_id": "new", "type": "P", "name": "new"}],
    "remove_place_ids": ["c-4"],
}


@query("""select 'c-' || c_custkey as place_id, case c_custkey when 2 then 'Q' when 3 then 'P' else c_mktsegment end as type, case c_custkey when 2 then 'two' when 3 then 'three' else c_name end as name,
case when c_custkey in (1, 2) then null when c_custkey = 3 then 'b-9' else 'b-' || c_nationkey end as building_id, case c_custkey when 2 then '1' when 3 then null else 'f' end as floor, case when c_custkey in (1, 2, 3) then 'now' end as last_verified_at
from customer where c_custkey <> 4 union all select 'new', 'P', 'new', null, null, 'now'""")
def grouped_contract(spark, d):
    rows = table(spark, d, "customer").selectExpr("'c-' || c_custkey as place_id", "c_mktsegment as type", "c_name as name", "'b-' || c_nationkey as building_id", "'f' as floor", "cast(null as string) as last_verified_at")
    return places.apply_contract(rows, spark.createDataFrame([], "building_id string, name string, last_verified_at string"), CONTRACT, "now")[0]


def _rule(i, target, action, **more):
    return {"id": i, "entity_type": "building", "entity_id": target, "field": "name", "action": action, "priority": 0, "status": "applied"} | more


REGISTRY = [
    _rule("a", "1", "replace", value="low", priority=1), _rule("b", "1", "replace", value="One", priority=5), _rule("c", "2", "set_null"),
    _rule("d", "3", "drop_if_matches", patterns=["supplier#000000003"]), _rule("e", "4", "drop_if_prefix", patterns=["SUPP"]), _rule("f", "5", "override", value="x"), _rule("g", "6", "set_null", status="draft"),
]


@query("select cast(s_suppkey as varchar) as building_id, case when s_suppkey = 1 then 'One' when s_suppkey in (2, 3, 4) then null else s_name end as name, cast(case when s_suppkey in (1, 2, 3, 4) then 1 else 0 end as integer) as changed from supplier")
def registry_corrections(spark, d):
    return documents.correct(table(spark, d, "supplier").selectExpr("cast(s_suppkey as string) as building_id", "s_name as name"), "building", REGISTRY)


PART_SCHEMA = {"items": {"type": "object", "required": ["id", "kind"], "additionalProperties": False, "properties": {"id": {"type": "string", "minLength": 3}, "size": {"type": "integer", "minimum": 10}, "kind": {"enum": ["PROMO", "ECONOMY"]}, "price": {"type": "string"}}}}


@query("""with p as (select cast(p_partkey as integer) as row, * from part) select row, 'id' as field, 'minLength' as error from p where p_partkey < 100 union all select row, 'size', 'minimum' from p where p_size < 10
union all select row, 'kind', 'required' from p where p_type = 'SMALL' union all select row, 'kind', 'enum' from p where p_type not in ('PROMO', 'ECONOMY', 'SMALL')
union all select row, 'price', 'type' from p union all select row, '', 'additionalProperties' from p where p_size > 40""")
def schema_file_errors(spark, d):
    line = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_size").alias("size"), F.expr("nullif(p_type, 'SMALL') as kind"), F.col("p_retailprice").alias("price"), F.expr("case when p_size > 40 then 1 end as more")))
    return documents.schema_errors(spread(table(spark, d, "part")).select(F.col("p_partkey").cast("int").alias("row"), line.alias("v")), PART_SCHEMA)


ATTEMPTS = "select user_id as request, cast(row_number() over (partition by user_id order by ts, event_id) as integer) as attempt, case event_type when 'purchase' then 200 when 'view' then 503 when 'click' then 429 when 'error' then 404 end as status from events"
PLAN = f"""with a as ({ATTEMPTS}), s as (select *, coalesce(status = 200, false) as succeeded, coalesce(status = 200 or status = 404, false) or attempt > 2 as stop from a),
p as (select request, attempt, status, succeeded, not stop as will_retry, case when stop then 0.0 else 0.5 * pow(2.0, attempt - 1) end as delay, stop and not succeeded as final_failure from s qualify not coalesce(bool_or(stop) over (partition by request order by attempt rows between unbounded preceding and 1 preceding), false))"""


def _attempts(spark, d) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("_lucerna_events")
    return spark.sql(ATTEMPTS.replace("from events", "from _lucerna_events"))


@query(f"{PLAN} select request, attempt, status, succeeded, will_retry, cast(delay as double) as delay, final_failure from p")
def retry_schedule(spark, d):
    return requests.retry_plan(_attempts(spark, d)).select("request", "attempt", "status", "succeeded", "will_retry", "delay", "final_failure")


@query(f"{PLAN} select count_if(attempt = 1) as requests, count(*) as attempts, count_if(will_retry) as retries, count_if(final_failure) as final_failures from p")
def attempt_summary(spark, d):
    return requests.summary(requests.retry_plan(_attempts(spark, d)))


@query("""select page_id, sha256('{"method":"GET","payload":null,"url":"' || url || '"}') as key from pages""")
def cache_keys(spark, d):
    return table(spark, d, "pages").select("page_id", requests.cache_key(F.lit("get"), F.col("url")).alias("key"))


@query("""with n as (select page_id, 'a' as tag, cast(len(regexp_extract_all(html, '<a[ >]')) as bigint) as n from pages union all select page_id, 'h1', len(regexp_extract_all(html, '<h1[ >]')) from pages
union all select page_id, 'article', len(regexp_extract_all(html, '<article[ >]')) from pages) select * from n where n > 0""")
def html_nodes(spark, d):
    return markup.nodes(table(spark, d, "pages"), "page_id", "html", ("a", "h1", "article")).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


# Pages of a host point to each other's successors, so that there is something to follow.
HOPS = "select page_id as url, (page_id * 3 + 1) % (select count(*) from pages) as target from pages union all select page_id, (page_id * 7 + 2) % (select count(*) from pages) from pages"


def _hops(spark, d) -> DataFrame:
    table(spark, d, "pages").createOrReplaceTempView("_lucerna_pages")
    return spark.sql(HOPS.replace("from pages", "from _lucerna_pages"))


@query(f"with h as ({HOPS}), a as (select target as url from h where url = 1), b as (select target as url from h join a using (url)), c as (select target as url from h join b using (url)) select cast(url as bigint) as url from (select 1 as url union select * from a union select * from b union select * from c)")
def link_levels(spark, d):
    return requests.expand(spark.createDataFrame([(1,)], "url long"), _hops(spark, d), 3)


@query(f"with recursive h as ({HOPS}), r(url, step) as (select cast(1 as bigint), 0 union select h.target, step + 1 from r join h on h.url = r.url where step < 4) select url, cast(min(step) as integer) as step from r group by url")
def bounded_crawl(spark, d):
    return requests.crawl(spark.createDataFrame([(1,)], "url long"), _hops(spark, d), 1000, depth=4).select("url", "step")
