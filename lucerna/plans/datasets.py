"""Queries of sources, datasets, checks and releases, over rows made of the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import crawl
from ..functions import urls
from ..operators import blocks, campus_integrity, canonical, documents, merge, places, release
from ..sources import markup, raw, registry, requests, tables
from ..sources.tables import spread, table
from .cases import pick
from .registry import query
from .rooms import made, plain

# --- sources: recorded responses, arrays, markup ---

ASKED = "select page_id, 'GET' as method, case when page_id % 5 = 0 then url || '#gone' else url end as url from {pages}"


@query(f"select a.page_id, a.url, length(p.html) as n from ({plain(ASKED, 'pages')}) a join pages p on p.url = a.url and p.page_id = a.page_id")
def replayed_bodies(spark, d):
    said = table(spark, d, "pages").select("page_id", F.lit("GET").alias("method"), "url", F.col("html").alias("body"))
    out = tables.replayed(made(spark, d, ASKED, "pages").withColumn("url", F.concat_ws(" ", "page_id", "url")), said.withColumn("url", F.concat_ws(" ", "page_id", "url")))
    return out.select("page_id", F.regexp_replace("url", "^[0-9]+ ", "").alias("url"), F.length("body").cast("long").alias("n"))


@query("select page_id, length(html) as n from pages")
def replayed_strictly(spark, d):
    said = table(spark, d, "pages").select(F.lit("GET").alias("method"), F.concat_ws(" ", "page_id", "url").alias("url"), F.col("html").alias("body"))
    asked = table(spark, d, "pages").select("page_id", F.lit("GET").alias("method"), F.concat_ws(" ", "page_id", "url").alias("url"))
    return tables.replayed(asked, said, strict=True).select("page_id", F.length("body").cast("long").alias("n"))


@query("select page_id, page_id % 3 = 0 as hit, case when page_id % 3 = 0 then 'cached' when page_id % 3 = 1 then 'fetched' end as body from pages")
def request_cache(spark, d):
    keyed = table(spark, d, "pages").select("page_id", requests.cache_key(F.lit("get"), F.concat(F.lit("https://h/"), F.col("page_id").cast("string"))).alias("key"))
    body = lambda n, v: keyed.where(f"page_id % 3 = {n}").select("key", F.lit(v).alias("body"))
    return requests.through_cache(keyed, body(0, "cached"), body(1, "fetched")).select("page_id", "hit", "body")


@query(r"""select page_id, v, sha256('{"method":"POST","payload":{"a":{"y":[1,2],"z":"pi\u00f9 ' || v || '"},"b":' || page_id || '},"url":"https://h/api"}') as key, 'answer ' || v || ' of ' || length(html) as body
from pages, (select unnest([0, 1]) as v) where page_id % 7 <> 3""")
def post_requests(spark, d):
    """Two requests a page to one address, told apart by payloads that are written otherwise than those on record."""
    each = table(spark, d, "pages").select("page_id", F.length("html").alias("n"), F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
    text = lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    n, v = F.col("page_id").cast("string"), F.col("v").cast("string")
    to = lambda method, payload: each.withColumns({"method": F.lit(method), "url": F.lit("https://h/api"), "payload": payload})
    asked = to("post", text('{"b": ', n, ', "a": {"z": "pi\u00f9 ', v, '", "y": [1, 2]}}')).drop("n")
    said = to("POST", text('{"a":{"z":"pi\\u00F9 ', v, '","y":[1,2]}, "b":', n, "}")).where("page_id % 7 <> 3").withColumn("body", text("answer ", v, " of ", F.col("n").cast("string")))
    out = tables.replayed(asked, said.select("method", "url", "payload", "body"))
    return out.select("page_id", "v", requests.cache_key(F.col("method"), F.col("url"), F.col("payload")).alias("key"), "body")


ARRAYS = pick(["'[{\"id\": \"a' || p_size || '\", \"n\": ' || p_size || '}, 7, {\"n\": 1}]'", "'{\"id\": \"x\"}'", "'not json'", "'[]'", "null"])


@query("select p_partkey, 'a' || p_size as id, cast(p_size as bigint) as n from part where p_partkey % 5 = 0 union all select p_partkey, null, 1 from part where p_partkey % 5 = 0")
def array_texts(spark, d):
    rows = spread(table(spark, d, "part")).select("p_partkey", F.expr(ARRAYS).alias("body"))
    return tables.json_texts(rows, "p_partkey", "body", "id string, n long")


KML = """'<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder><name>F' || (p_size % 3) || '</name><Placemark><name>Cubo ' || p_size || 'A</name><description><![CDATA[Sede<br>di ' || p_name || ']]></description><Point><coordinates>16.' || p_size || ',39.3,0</coordinates></Point></Placemark><Folder><Placemark><name>No place</name></Placemark></Folder></Folder></Document></kml>'"""


@query("""select p_partkey, 'F' || (p_size % 3) as folder, 'Cubo ' || p_size || 'A' as name, 'Sede di ' || p_name as description, cast(39.3 as double) as lat, cast('16.' || p_size as double) as lng from part where p_partkey % 4 > 0
union all select p_partkey, null, 'No place', null, null, null from part where p_partkey % 4 > 0""")
def placemarks(spark, d):
    rows = spread(table(spark, d, "part")).select("p_partkey", F.expr(f"case when p_partkey % 4 = 0 then 'no xml' else {KML} end").alias("body"))
    return markup.placemarks(rows, "p_partkey", "body")


# A page for every part: a table of rooms, an accordion and the planner's list.
TABLE = """'<table><tr><th>Nome aula</th><th>Ubicazione</th><th>Posti</th></tr><tr><td>A' || p_size || '</td><td>Cubo ' || p_size || 'B, piano ' || (p_size % 8) || '</td><td>' || (p_size + 10) || '</td></tr><tr><td>Aula ' || p_name || '; C' || p_size || '</td><td>x</td><td>' || p_size || '</td></tr><tr><td>&nbsp;</td></tr></table>'"""
FLOORS = "['Piano Terra', 'Primo piano', 'Secondo piano', 'Terzo piano', 'Quarto piano', 'Quinto piano', 'Sesto piano', 'Settimo piano']"


@query("""select p_partkey, 1 as line, 'A' || p_size || '|Cubo ' || p_size || 'B, piano ' || (p_size % 8) || '|' || (p_size + 10) as cells from part union all select p_partkey, 0, 'Nome aula|Ubicazione|Posti' from part union all select p_partkey, 2, 'Aula ' || p_name || '; C' || p_size || '|x|' || p_size from part""")
def table_cells(spark, d):
    rows = spread(table(spark, d, "part")).select("p_partkey", F.expr(TABLE).alias("html"))
    return markup.table_rows(rows, "p_partkey", "html").select("p_partkey", "line", F.array_join("cells", "|").alias("cells"))


@query(f"""select 'u' || p_partkey as source_url, 'Aula A' || p_size as name, 'A' || p_size as room, 'A' || p_size as short_code, 'Cubo ' || p_size || 'B' as building_hint, {FLOORS}[p_size % 8 + 1] as floor, cast(p_size + 10 as integer) as capacity from part
union all select 'u' || p_partkey, 'Aula ' || p_name, p_name, null, null, null, cast(p_size as integer) from part union all select 'u' || p_partkey, 'Aula ' || p_name || '; C' || p_size, p_name || '; C' || p_size, null, null, null, cast(p_size as integer) from part""")
def rooms_of_tables(spark, d):
    rows = spread(table(spark, d, "part")).select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr(TABLE).alias("html"))
    out = raw.table_rooms(markup.table_rows(rows, "url", "html"))
    return out.select("source_url", "name", "room", "short_code", "building_hint", "floor", "capacity")


ENTRY = """'<div class="accordion-item"><button class="accordion-button">Aule del dipartimento</button><div class="accordion-body"><p>intro</p><p><strong>Aula M' || p_size || '</strong></p><p>Cubo ' || p_size || 'C, secondo piano</p><p>capienza ' || p_size || ' posti</p><p><strong>Aula Rossa</strong> al cubo 41C</p></div></div>'"""


@query("""select p_partkey, 0 as item, 'Aule del dipartimento' as title, n, case n when 0 then 'intro' when 1 then 'Aula M' || p_size when 2 then 'Cubo ' || p_size || 'C, secondo piano' when 3 then 'capienza ' || p_size || ' posti' else 'Aula Rossa al cubo 41C' end as text, case n when 1 then 'Aula M' || p_size when 4 then 'Aula Rossa' else '' end as strong
from part, (select unnest([0, 1, 2, 3, 4]) as n)""")
def accordion_parts(spark, d):
    rows = spread(table(spark, d, "part")).select("p_partkey", F.expr(ENTRY).alias("html"))
    return markup.accordion_blocks(rows, "p_partkey", "html").select("p_partkey", "item", "title", F.col("ord").alias("n"), "text", F.array_join("strong", "|").alias("strong"))


@query("""select 'u' || p_partkey as source_url, 'Aula M' || p_size as name, 'M' || p_size as short_code, 'Cubo ' || p_size || 'C' as building_hint, 'Secondo piano' as floor, cast(p_size as integer) as capacity from part
union all select 'u' || p_partkey, 'Aula Rossa', null, 'Cubo 41C', null, null from part""")
def rooms_of_accordions(spark, d):
    rows = spread(table(spark, d, "part")).select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr(ENTRY).alias("html"))
    return raw.accordion_rooms(markup.accordion_blocks(rows, "url", "html")).select("source_url", "name", "short_code", "building_hint", "floor", "capacity")


MARKS = """select 'u' || p_partkey as url, 'Strutture' as folder, case when p_partkey % 3 = 0 then 'Aula ' || p_name else 'Cubo ' || p_size || 'A' end as name, case when p_partkey % 3 = 1 then 'Primo piano: Aula B' || p_size || ', Secondo piano: Aula C' || p_size || '; x' end as description, 39.3 as lat, 16.2 as lng from {part}"""


@query("""select 'u' || p_partkey as source_url, 'Aula ' || p_name as name, null as floor, null as building_hint from part where p_partkey % 3 = 0 union all select 'u' || p_partkey, 'Aula B' || p_size, 'Primo piano', 'Cubo ' || p_size || 'A' from part where p_partkey % 3 = 1
union all select 'u' || p_partkey, 'Aula C' || p_size, 'Secondo piano', 'Cubo ' || p_size || 'A' from part where p_partkey % 3 = 1""")
def rooms_of_maps(spark, d):
    return raw.map_rooms(made(spark, d, MARKS, "part")).select("source_url", "name", "floor", "building_hint")


PLANNED = """'[{"descrizione": "Sala ' || p_name || ' piano terra", "codice": "x", "edificioId": "e' || (p_partkey % 3) || '"}, {"codice": "d ' || p_size || '", "edificio": {"descrizione": " Cubo  ' || p_size || 'A"}}, {"descrizione": "Campo padel"}, 3]'"""
SCHEDULED = """'[{"aule": [{"descrizione": "Aula ' || p_name || ' piano terra", "edificioId": "e0"}]}, {"aule": null}, {"aule": [{"codice": "q' || p_size || '"}]}]'"""


def _known_blocks(spark) -> DataFrame:
    return spark.createDataFrame([("e0", "Cubo 0A"), ("e1", "Cubo 1A")], "id string, descrizione string")


@query("""select 'u' || p_partkey as source_url, 'Sala ' || p_name || ' piano terra' as name, 'Piano Terra' as floor, case p_partkey % 3 when 0 then 'Cubo 0A' when 1 then 'Cubo 1A' end as building_hint, null as short_code from part
union all select 'u' || p_partkey, 'Aula D' || p_size, null, 'Cubo ' || p_size || 'A', 'D' || p_size from part""")
def rooms_of_planner(spark, d):
    bodies = spread(table(spark, d, "part")).select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr(PLANNED).alias("body"))
    return raw.planner_rooms(bodies, _known_blocks(spark)).select("source_url", "name", "floor", "building_hint", "short_code")


@query("select 'u' || p_partkey as source_url, 'Aula ' || p_name || ' piano terra' as name, null as floor, 'Cubo 0A' as building_hint from part union all select 'u' || p_partkey, 'Aula Q' || p_size, null, null from part")
def rooms_of_schedules(spark, d):
    bodies = spread(table(spark, d, "part")).select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr(SCHEDULED).alias("body"))
    return raw.schedule_rooms(bodies, _known_blocks(spark)).select("source_url", "name", "floor", "building_hint")


@query("""with l as (select 'Aula ' || p_name as name, min(p_partkey) as k from part where p_partkey % 3 = 0 group by 1), f as (select distinct 'Aula B' || p_size as name from part where p_partkey % 3 = 1 union all select distinct 'Aula C' || p_size from part where p_partkey % 3 = 1),
a as (select distinct 'Aula Q' || p_size as name from part), s as (select distinct 'Aula ' || p_name || ' piano terra' as name from part)
select name, cast(1 as bigint) as n, false as planned from l union all select name, 1, false from f union all select name, 1, true from a union all select name, 1, true from s""")
def rooms_of_all_sources(spark, d):
    bodies = spread(table(spark, d, "part")).select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr(SCHEDULED).alias("body"))
    out = raw.all_rooms(raw.map_rooms(made(spark, d, MARKS, "part")), raw.schedule_rooms(bodies, _known_blocks(spark)))
    return out.groupBy("name").agg(F.count("*").alias("n"), F.first(F.col("lat").isNull()).alias("planned"))


@query("select 'Aula Multimediale CLA ' || p_size || 'B' as name, 'Cubo ' || p_size || 'B' as building_hint from part where p_partkey % 2 = 0 union all select 'Aula Multimediale CLA 3C', 'Cubo 3C' from part where p_partkey % 2 = 0")
def self_study_rooms(spark, d):
    rows = spread(table(spark, d, "part")).selectExpr("case when p_partkey % 2 = 0 then 'https://cla.unical.it/servizi-linguistici/studio-in-autonomia/' else 'https://x.it/' end || p_partkey as url", "'Laboratori  Multimediali (Cubo ' || p_size || 'b; cubo 3C) altro cubo 9Z' as text")
    return raw.self_study_rooms(rows).select("name", "building_hint")


HARVEST = pick(["'a linkCalendarioId=' || repeat('Ab', 11) || (10 + p_size % 40) || '&'", "'structuretree=' || (170000 + p_size)", "'href=\"/storage/teachers/n.' || p_size || '/\"'", "p_name"])


@query("""select distinct 'calendar' as kind, repeat('ab', 11) || (10 + p_size % 40) as found from part where p_partkey % 4 = 0 union all select distinct 'structure', '' || (170000 + p_size) from part where p_partkey % 4 = 1 union all select distinct 'teacher', 'n.' || p_size from part where p_partkey % 4 = 2""")
def harvests(spark, d):
    rows = spread(table(spark, d, "part")).select(F.expr(HARVEST).alias("html"))
    kinds = {"calendar": (raw.CALENDAR_ID,), "structure": raw.STRUCTURE_CODES, "teacher": (raw.TEACHER_SLUG,)}
    out = [raw.harvested(rows, "html", *p).select(F.lit(k).alias("kind"), "found") for k, p in kinds.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


# Pages of an interface: chains of ten, the last without a next one.
PAYLOADS = """select 'https://s.it/api?p=' || page_id as url, page_id, '{"results": [{"TeacherName": " Ada  N' || page_id || '", "Email": ["", "a.n' || page_id || '@u.it"], "TeacherDepartmentName": "D", "StructureName": "S ' || (page_id % 7) || '", "StructureURL": "https://s.it/' || page_id || '"}, 4, {"TeacherName": ""}], "next": ' || case when page_id % 10 = 9 then 'null' else '"/api?p=' || (page_id + 1) || '"' end || '}' as body from {pages}"""
CHAIN = "select page_id, page_id % 10 as step from pages where page_id < 10"


@query(f"select 'https://s.it/api?p=' || c.page_id as url, cast(step as integer) as step, case when c.page_id % 10 < 9 then 'https://s.it/api?p=' || (c.page_id + 1) end as next from ({CHAIN}) c")
def payload_chain(spark, d):
    bodies = made(spark, d, PAYLOADS, "pages").select("url", "body")
    return crawl._payloads(spark, bodies, "https://s.it/api?p=0", 50).select("url", "step", "next")


@query(f"select 'Ada N' || page_id as full_name, 'a.n' || page_id || '@u.it' as email, 'D' as department_name, 'https://u.it/storage/teachers/a.n' || page_id || '/' as source_url from ({CHAIN})")
def teachers_of_payloads(spark, d):
    bodies = made(spark, d, PAYLOADS, "pages").select("url", "body")
    return raw.teachers(crawl._payloads(spark, bodies, "https://s.it/api?p=0", 50), "https://u.it/").select("full_name", "email", "department_name", "source_url")


@query(f"select 'S ' || (page_id % 7) as name, 'https://s.it/' || min(page_id) as website_url from ({CHAIN}) group by page_id % 7")
def departments_of_payloads(spark, d):
    bodies = made(spark, d, PAYLOADS, "pages").select("url", "body")
    return raw.departments(crawl._payloads(spark, bodies, "https://s.it/api?p=0", 50), "https://u.it/").select("name", "website_url")


BOOK = """select 'https://s.it/api/?structuretree=' || (100 + page_id % 2) as url, '{"results": [{"ID": "N.' || page_id || '", "Name": "Rossi N' || page_id || '", "Email": ["n' || page_id || '@u.it", 3]}, {"ID": "both"}]}' as body from {pages}"""


@query("select 'slug:n.' || page_id as key, 'd' || (100 + page_id % 2) as department_id from pages union all select 'name:rossi n' || page_id, 'd' || (100 + page_id % 2) from pages union all select 'name_key:n' || page_id || '-rossi', 'd' || (100 + page_id % 2) from pages union all select 'email_local:n' || page_id, 'd' || (100 + page_id % 2) from pages")
def teacher_map(spark, d):
    pages = raw.payload_pages(made(spark, d, BOOK, "pages"))
    return crawl.teacher_departments(pages, spark.createDataFrame([("100", "d100"), ("101", "d101")], "code string, department_id string"))


LISTED = """select 'https://s.it/api?p=' || s_suppkey as url, s_suppkey as step, '{"results": [{"TeacherName": "' || s_name || '", "TeacherID": "' || case when s_suppkey % 5 = 4 then '' else 't ' || s_suppkey end || '", "Email": ["t' || s_suppkey || '@u.it"], "TeacherDepartmentName": "D"}]}' as body from {supplier}"""
DETAILS = """select 'https://s.it/api/t%20' || s_suppkey || '/?format=json' as url, '{"results": ' || case when s_suppkey % 4 = 1 then '[]' when s_suppkey % 4 = 2 then '{"TeacherEmail": [3, " x' || s_suppkey || '@u.it "], "TeacherOffice": "Cubo  ' || s_nationkey || '", "ReceptionHours": "lun ' || s_nationkey || '"}'
else '{"TeacherTelOffice": ["", "0984 ' || s_suppkey || '"], "TeacherOffice": "Cubo ' || s_nationkey || '", "TeacherOfficeReference": "Stanza ' || s_suppkey || '", "ReceptionHours": ["none"], "TeacherDepartmentCod": "0' || s_nationkey || '"}' end || '}' as body from {supplier}"""


@query("""with s as (select *, case when s_suppkey % 5 = 4 then 1 else s_suppkey % 4 end as k from supplier)
select s_name as full_name, case when k = 2 then 'x' else 't' end || s_suppkey || '@u.it' as email, case when k in (0, 3) then '0984 ' || s_suppkey end as phone, case when k in (0, 3) then '0' || s_nationkey end as department_code, case when k = 2 then 'lun ' || s_nationkey end as office_hours,
case when k in (0, 3) then 'Stanza ' || s_suppkey end as office_reference, case when k = 2 then 'Cubo ' || s_nationkey when k in (0, 3) then 'Office: Cubo ' || s_nationkey || ' | Office references: Stanza ' || s_suppkey end as notes, 'https://u.it/storage/teachers/t' || s_suppkey || '/' as website_url from s""")
def teacher_details(spark, d):
    """The second wave: every listed teacher with an id is asked for, and what the answer says goes first."""
    listed = made(spark, d, LISTED, "supplier")
    pages = raw.payload_pages(listed.select("url", "body")).join(listed.select("url", "step"), "url")
    out = raw.teachers(pages, "https://u.it/", "https://s.it/api/", made(spark, d, DETAILS, "supplier"))
    return out.select("full_name", "email", "phone", "department_code", "office_hours", "office_reference", "notes", "website_url")


# Departments whose site names a structure, leads to a list of staff or is not on record.  A structure's people stand on two pages.
SITES = """select s_suppkey, 'https://d' || s_suppkey || '.unical.it' as site, '""" + urls.ADDRESS_BOOK + """' || (100000 + s_suppkey) as book from {supplier}"""
SAID = [
    ("s_suppkey % 3 = 0", "site || '/'", "'<script src=\"' || book || '\"></script><a href=\"mailto:not.read@u.it\">x</a>'"),
    ("s_suppkey % 3 = 0", "book", "'{\"results\": [{\"ID\": \"A.' || s_suppkey || '\", \"Name\": \"Rossi  P' || s_suppkey || '\", \"Email\": [\"p' || s_suppkey || '@u.it\"]}, {\"ID\": \"both\"}], \"next\": \"' || book || '&page=2\"}'"),
    ("s_suppkey % 3 = 0", "book || '&page=2'", "'{\"results\": [{\"ID\": \"B.' || s_suppkey || '\"}], \"next\": \"' || book || '\"}'"),
    ("s_suppkey % 3 = 1", "site || '/'", "'<a href=\"mailto:M' || s_suppkey || '@u.it\">m</a><a href=\"/docenti#top\">Elenco</a><a href=\"/news\">Notizie</a>'"),
    ("s_suppkey % 3 = 1", "site || '/docenti'", "'<a href=\"https://www.unical.it/storage/teachers/S.' || s_suppkey || '/\">Verdi S' || s_suppkey || '</a>'"),
    ("s_suppkey % 3 = 1", "site || '/news'", "'<a href=\"mailto:n' || s_suppkey || '@u.it\">not read</a>'"),
]
KEYS_OF = [(0, "'department_code:' || (100000 + n)"), (0, "'slug:a.' || n"), (0, "'name:rossi p' || n"), (0, "'name_key:p' || n || '-rossi'"), (0, "'email_local:p' || n"), (0, "'slug:b.' || n"), (1, "'email_local:m' || n"), (1, "'slug:s.' || n"), (1, "'name_key:s' || n || '-verdi'")]


@query(" union all ".join(f"select {k} as key, 'd' || n as department_id from (select s_suppkey as n from supplier) where n % 3 = {r}" for r, k in KEYS_OF))
def harvest_rounds(spark, d):
    """Sites are read, structures found in them asked for, and their pages followed, until nothing is new."""
    said = " union all ".join(f"select {url} as url, {body} as body from ({SITES}) where {which}" for which, url, body in SAID)
    departments = made(spark, d, SITES, "supplier").select(F.concat(F.lit("d"), "s_suppkey").alias("department_id"), F.col("site").alias("website_url"), F.lit("https://elsewhere.it/").alias("source_url"))
    return crawl.department_map(departments, made(spark, d, said, "supplier")).select("key", "department_id")


VALUES = pick(["'[\"\", 3, \" a  ' || p_size || '\", \"b\"]'", "' x ' || p_size", "'\"q' || p_size || '\"'", "'[]'", "'{\"a\": 1}'", "null"])


@query("select p_partkey, " + pick(["'a ' || p_size || '|b'", "'x ' || p_size", "'q' || p_size", "''", "''", "''"]) + " as found from part")
def json_strings(spark, d):
    return spread(table(spark, d, "part")).select("p_partkey", F.array_join(raw.texts(F.expr(VALUES)), "|").alias("found"))


SCRIPT = "'<script>var v = {item: {\"results\": {\"a\": \"}' || p_size || '\", \"b\": {\"c\": [1, 2]}}}};</script>'"


@query("select p_partkey, case when p_partkey % 3 > 0 then '}' || p_size end as a, case when p_partkey % 3 > 0 then '[1,2]' end as c from part")
def script_payloads(spark, d):
    rows = spread(table(spark, d, "part")).select("p_partkey", F.expr(f"case when p_partkey % 3 > 0 then {SCRIPT} else p_name end").alias("html"))
    found = rows.withColumn("v", markup.script_object("html", "item:"))
    return found.select("p_partkey", F.get_json_object("v", "$.results.a").alias("a"), F.get_json_object("v", "$.results.b.c").alias("c"))


SERVICE = """select 'https://www.unical.it/campus/servizi/s' || p_partkey || '/x/' as url, '<title>T</title><h1>' || case when p_partkey % 3 = 0 then 'Home' else 'Ufficio ' || p_name end || '</h1><p>' || case when p_partkey % 2 = 0 then 'Archivio notizie' else 'Info ' || p_brand end || '</p><a href=\"mailto:a' || p_size || '@u.it\">m</a><a href=\"tel:1\">t</a><a href=\"https://z.it/' || p_size || '\">z</a>' as html from {part}"""


@query("""select case when p_partkey % 3 = 0 then 'S' || p_partkey else 'Ufficio ' || p_name end as name, 'https://www.unical.it/campus/servizi/s' || p_partkey || '/' as source_url, case when p_partkey % 3 = 0 then 'SERVICE' else 'OFFICE' end as service_type, case when p_partkey % 2 = 1 then 'Info ' || p_brand end as description, 'a' || p_size || '@u.it' as email, '1' as phone, 'https://z.it/' || p_size as website_url from part""")
def services_of_pages(spark, d):
    nodes = markup.nodes(made(spark, d, SERVICE, "part"), "url", "html", ("h1", "h2", "title", "p", "a"))
    return raw.services_of(nodes).select("name", "source_url", "service_type", "description", "email", "phone", "website_url")


# --- rows that belong together ---

LINES = "select o_custkey as doc, o_orderkey as ord, case when o_orderkey % 4 = 0 then 'T' || o_orderkey else 't' || o_orderkey end as t from {orders}"


@query(f"with g as (select doc, ord, t, sum(case when t like 'T%' then 1 else 0 end) over (partition by doc order by ord) as n from ({plain(LINES, 'orders')})) select doc, min(ord) as ord, string_agg(t, ' ' order by ord) as t from g where n > 0 group by doc, n")
def title_blocks(spark, d):
    return blocks.carry_forward(made(spark, d, LINES, "orders"), ["doc"], "ord", F.startswith("t", F.lit("T")), "t", [])


@query("select o_custkey, o_orderkey, row_number() over w as current, count(*) over (partition by o_custkey) as total from orders window w as (partition by o_custkey order by o_orderkey) qualify row_number() over w % 5 = 0 or row_number() over w = count(*) over (partition by o_custkey)")
def progress_steps(spark, d):
    return blocks.reported(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 5)


@query("select p_partkey, case p_partkey % 3 when 0 then 'a=' || p_size || ',b=new,c=' || p_brand when 1 then 'b=new,c=' || p_brand else 'a=' || p_size || ',b=old' end as found from part")
def merged_maps(spark, d):
    old = F.when(F.col("p_partkey") % 3 != 1, F.create_map(F.lit("b"), F.lit("old"), F.lit("a"), F.col("p_size").cast("string")))
    new = F.when(F.col("p_partkey") % 3 != 2, F.create_map(F.lit("c"), F.col("p_brand"), F.lit("b"), F.lit("new")))
    said = F.transform(F.map_entries(blocks.merged_map(old, new)), lambda e: F.concat_ws("=", e.key, e.value))
    return spread(table(spark, d, "part")).select("p_partkey", F.array_join(said, ",").alias("found"))


# --- datasets from raw rows ---

BUILDINGS = """select p_partkey as ordinal, 'cubo ' || (p_partkey % 40) || 'b - ' || p_brand as name, 'u' as source_url, 39.123456789 + p_partkey as lat, 16.5 as lng, 'Descrizione: ' || p_name as description from {part} union all select -1, ' ', 'u', 1.0, 1.0, null from {part} where p_partkey = 0"""


@query(f"select 'cubo-' || (ordinal % 40) || 'b' as building_id, 'Cubo ' || (ordinal % 40) || 'B' as name, substr(description, 14) as description, cast(round_even(cast(lat as double), 7) as double) as lat, cast(lng as double) as lng from ({plain(BUILDINGS, 'part')}) where ordinal >= 0 qualify row_number() over (partition by ordinal % 40 order by ordinal) = 1")
def canonical_buildings(spark, d):
    rows = made(spark, d, BUILDINGS, "part").withColumns({"lat": F.col("lat").cast("double"), "lng": F.col("lng").cast("double")})
    return canonical.buildings(rows, "s", "now").select("building_id", "name", "description", "lat", "lng")


DEPARTMENTS = "select n_nationkey as ordinal, 'Dipartimento ' || n_name || ' - DX' || chr(65 + n_nationkey) || 'Y' as name, 'https://dx' || chr(97 + n_nationkey) || 'y.unical.it/' as source_url, case when n_nationkey % 2 = 0 then ' a@b.it ' end as email, '' as phone, 'https://w.it' as website_url from {nation}"
ID = "'dipartimento-nation-' || {n} || '-dx' || chr(cast(97 + {n} as integer)) || 'y'"


@query(f"select {ID.format(n='n_nationkey')} as department_id, 'Dipartimento ' || n_name || ' - DX' || chr(65 + n_nationkey) || 'Y' as name, case when n_nationkey % 2 = 0 then 'a@b.it' end as email, null as phone, 'https://w.it' as website_url from nation")
def canonical_departments(spark, d):
    return canonical.departments(made(spark, d, DEPARTMENTS, "nation"), "s", "now").select("department_id", "name", "email", "phone", "website_url")


@query("select 'service-' || lower(p_brand[:5]) || '-' || p_brand[7:] as place_id, 'SERVICE' as type, p_brand as name, min(p_partkey) as first from part where p_partkey % 2 = 0 group by p_brand union all select 'office-' || lower(p_brand[:5]) || '-' || p_brand[7:], 'OFFICE', p_brand, min(p_partkey) from part where p_partkey % 2 = 1 group by p_brand")
def canonical_services(spark, d):
    none = [F.lit(None).cast("string").alias(c) for c in ("email", "phone", "website_url", "opening_hours")]
    rows = spread(table(spark, d, "part")).select(F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("name"), F.expr("case when p_partkey % 2 = 1 then 'OFFICE' else '' end").alias("service_type"), F.col("p_partkey").cast("string").alias("source_url"), F.lit("").alias("description"), *none)
    return canonical.services(rows, "s", "now").select("place_id", "type", "name", F.col("source_url").cast("long").alias("first"))


N = "c_custkey % 25"
PEOPLE = f"""select c_custkey as ordinal, case when c_custkey % 11 = 10 then ' ' else 'Ada ' || c_mktsegment || ' N' || c_custkey end as full_name, 'u' as source_url, case c_custkey % 7 when 4 then 'x@dx' || chr(cast(97 + {N} as integer)) || 'y.unical.it' when 5 then 'L' || c_custkey || '@u.it' end as email, '' as phone,
case c_custkey % 7 when 0 then 'dipartimento nation ' || ({N}) || ' dx' || chr(cast(97 + {N} as integer)) || 'y' when 1 then 'dx' || chr(cast(97 + {N} as integer)) || 'y' when 2 then 'Uff. DX' || chr(cast(65 + {N} as integer)) || 'Y bis' else 'Unknown' end as department_name,
case when c_custkey % 7 = 6 then 'C' || c_custkey end as department_code, case when c_custkey % 7 = 3 then 'https://www.dx' || chr(cast(97 + {N} as integer)) || 'y.unical.it/p' end as website_url, '  Lun  9 ' as office_hours, case when c_custkey % 3 = 0 then 'Cubo ' || (c_custkey % 9) || 'B, piano 2, stanza ' || c_custkey end as office_reference, case when c_custkey % 3 = 1 then 'Office: o' || c_custkey || ' | Office references: somewhere' end as notes from {{customer}}"""
MAP = "select 'department_code:C' || c_custkey as key, 'by-code' as department_id from {customer} union all select 'email_local:l' || c_custkey, 'by-mail' from {customer}"


@query(f"""select 'n' || c_custkey || '-ada-' || lower(c_mktsegment) as person_id, case when c_custkey % 7 < 5 then {ID.format(n=f'({N})')} when c_custkey % 7 = 5 then 'by-mail' else 'by-code' end as department_id, lower(case c_custkey % 7 when 4 then 'x@dx' || chr(cast(97 + {N} as integer)) || 'y.unical.it' when 5 then 'L' || c_custkey || '@u.it' end) as email, 'Lun 9' as office_hours,
case when c_custkey % 3 = 0 then 'office-ufficio-cubo-' || (c_custkey % 9) || 'b-piano-2-stanza-' || c_custkey end as office_place_id, case when c_custkey % 3 = 1 then 'o' || c_custkey end as notes, case c_custkey % 3 when 0 then 'Cubo ' || (c_custkey % 9) || 'B, piano 2, stanza ' || c_custkey when 1 then 'somewhere' end as office_reference_text from customer where c_custkey % 11 <> 10""")
def canonical_people(spark, d):
    deps = canonical.departments(made(spark, d, DEPARTMENTS, "nation"), "s", "now")
    out = canonical.people(made(spark, d, PEOPLE, "customer"), deps, made(spark, d, MAP, "customer"), "s", "now")
    return out.select("person_id", "department_id", "email", "office_hours", "office_place_id", "notes", "office_reference_text")


@query("select 'office-ufficio-cubo-' || (c_custkey % 9) || 'b-piano-2-stanza-' || c_custkey as place_id, case when c_custkey % 9 < 5 then 'cubo-' || (c_custkey % 9) || 'b' end as building_id, 'Piano 2' as floor, 'Stanza ' || c_custkey as room, 'Lun 9' as opening_hours from customer where c_custkey % 3 = 0")
def canonical_offices(spark, d):
    known = spark.createDataFrame([(f"cubo-{i}b", f"Cubo {i}B") for i in range(5)], "building_id string, name string")
    return canonical.offices(made(spark, d, PEOPLE, "customer"), known, (), "s", "now").select("place_id", "building_id", "floor", "room", "opening_hours")


@query("select c_custkey as place_id, case when c_nationkey < 12 then 'other' else 'mine' end as source_id, case when c_nationkey < 12 then 'old' else 'new' end as name from customer where c_nationkey < 12 or c_custkey % 2 = 0")
def kept_sources(spark, d):
    c = table(spark, d, "customer")
    old = c.select(F.col("c_custkey").alias("place_id"), F.expr("case when c_nationkey < 12 then 'other' else 'mine' end").alias("source_id"), F.lit("old").alias("name"))
    return canonical.keep_others(old, c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("place_id"), F.lit("mine").alias("source_id"), F.lit("new").alias("name")), "mine", "place_id")


# --- links, forced buildings, enrichment: every rule ---

RULED = [
    ("'Centro-Sanitario ' || p_size", "''", "''", "'x'", "'centro-sanitario'"), ("p_name", "''", "''", "'service-info-isee'", f"'{places.OFFICES}'"), ("p_name", "''", "'https://u/didattica/diritto-allo-studio/info-isee/' || p_size", "'x'", f"'{places.OFFICES}'"),
    ("'Serv-CR ' || p_size", "''", "''", "'x'", f"'{places.OFFICES}'"), ("'il CLA di'", "''", "''", "'x'", f"'{places.LANGUAGES}'"), ("p_name", "''", "'https://u/Sistema-Museale/musnob/zoologia/'", "'x'", "'cubo-14b'"),
    ("p_name", "'al CUS oggi'", "''", "'x'", "'centro-universitario-sportivo'"), ("'Career-Service'", "''", "''", "'x'", "'cubi-7-11b'"), ("'Edificio TAU'", "''", "''", "'x'", f"'{places.THEATRE}'"), ("'Aula Magna ' || p_size", "''", "''", "'x'", "'aula-magna'"),
    ("p_name", "''", "'https://u/servizi-ict/'", "'x'", "'cubo-22b'"), ("p_name", "''", "'https://u/borse-di-studio/'", "'x'", f"'{places.OFFICES}'"), ("'Servizio-Mensa'", "''", "''", "'x'", f"'{places.OFFICES}'"), ("'Biblioteche'", "''", "''", "'x'", "'cubo-libro'"),
    ("'Polo d''infanzia'", "''", "''", "'x'", f"'{places.THEATRE}'"), ("'Cubo 14B'", "''", "''", "'x'", "'cubo-14b'"), ("'cubo 7/11'", "''", "''", "'x'", "'cubi-7-11b'"), ("'Servizio-Mensa'", "''", "''", "'service-servizio-mensa'", "null"), ("p_name", "''", "''", "'x'", "null"),
]
LINKABLE = ("centro-sanitario", places.OFFICES, places.LANGUAGES, "cubo-14b", "centro-universitario-sportivo", "cubi-7-11b", places.THEATRE, "aula-magna", "cubo-22b", "cubo-libro")


@query("select p_partkey, " + pick([r[4] for r in RULED]) + " as building_id from part")
def linked_places(spark, d):
    cols = [F.expr(pick([r[i] for r in RULED])).alias(c) for i, c in enumerate(("name", "description", "source_url", "place_id"))]
    rows = spread(table(spark, d, "part")).select("p_partkey", *cols, F.lit(None).cast("string").alias("access_notes"), F.lit(None).cast("string").alias("building_id"))
    return places.link_places(rows, spark.createDataFrame([(x,) for x in LINKABLE], "building_id string")).select("p_partkey", "building_id")


def _at(host: str) -> str:
    return f"'https://{host}.unical.it{places.STRUCTURES}'"


PLAN = f"'https://{places.PLANNER}'"
FORCED = [
    (_at("dispes"), "'g' || (p_size % 4 + 1)", "'Aula'", "'capannone-g'"), (_at("dispes"), "'H3'", "'Aula'", "'capannone-h'"), (_at("dispes"), "'L2'", "'Aula'", "'capannone-l'"), (_at("dispes"), "'44'", "'Aula'", "'polifunzionale'"), (_at("dispes"), "'G9'", "'Aula'", "null"),
    (_at("dfssn"), "'14'", "'Aula'", "'capannone-c'"), (_at("dfssn"), "'25'", "'Aula'", "'capannone-d'"), (_at("dfssn"), "'52'", "'Aula'", "'capannone-f'"), (_at("dfssn"), "''", "'Aula Gialla'", "'polifunzionale-dfssn'"), (_at("dfssn"), "''", "'Laboratorio Chimico C'", "'capannone-e'"),
    (_at("dimeg"), "''", "'Aula Consolidata B'", "'cubo-43c'"), (_at("dimeg"), "''", "'Aula DS4'", "'cubo-41b'"), (_at("dimeg"), "'P1'", "'Aula piano ponte carrabile'", "'cubo-40c'"), (_at("dimeg"), "''", "'Aula M4 - Aula seminari ' || p_size", "'cubo-44c'"),
    (PLAN, "''", "'Aula Gialla - ' || p_size", "'polifunzionale-dfssn'"), (PLAN, "''", "'Medicina traslazionale'", "'polifunzionale-dfssn'"), (PLAN, "''", "'Centro di simulazione MED-TD'", "'polifunzionale-dfssn'"), (PLAN, "''", "'Aula Orto Botanico'", "'orto-botanico'"), (PLAN, "''", "'Aula Lingue ' || p_size", f"'{places.LANGUAGES}'"),
    (PLAN, "''", "'Sala CLA'", f"'{places.LANGUAGES}'"), ("'https://other'", "'G1'", "'Aula Gialla'", "null"),
]


def _ruled_rooms(spark, d, rules, floor="cast(null as string)", building="cast(null as string)") -> DataFrame:
    cols = [F.expr(pick([r[i] for r in rules])).alias(c) for i, c in enumerate(("source_url", "short_code", "name"))]
    return spread(table(spark, d, "part")).select(F.concat(F.lit("p-"), "p_partkey").alias("place_id"), *cols, F.lit("").alias("room"), F.expr(building).alias("building_id"), F.expr(floor).alias("floor"), F.lit(20).alias("capacity"), F.array().cast("array<string>").alias("search_tokens"))


@query("select 'p-' || p_partkey as place_id, " + pick([r[3] for r in FORCED]) + " as building_id, coalesce(" + pick([r[3] for r in FORCED]) + ", '') as tokens from part")
def forced_by_source(spark, d):
    known = spark.createDataFrame([(b,) for b in sorted({then for _, _, then in places.FORCED})], "building_id string")
    rooms = _ruled_rooms(spark, d, FORCED)
    moved, at = places.force_buildings(rooms, rooms.select("place_id", F.lit(None).cast("string").alias("building_id"), "floor"), known)
    return moved.join(at.select("place_id", F.col("building_id").alias("_b")), "place_id").where("building_id <=> _b").select("place_id", "building_id", F.array_join("search_tokens", " ").alias("tokens"))


ENRICHED = [
    (_at("ctc"), "''", "'Aula studio per i soli studenti di Chimica'", "'cubo-15c'", "'Secondo piano'", "20"), (_at("dimes"), "''", "'Aula E'", "'drop'", "null", "20"), (_at("dimes"), "''", "'Aula DS7'", "null", "'Secondo piano'", "20"), (_at("dimes"), "''", "'Aula P5'", "null", "'Sesto piano'", "20"),
    (_at("dices"), "''", "'Aula Dolci'", "'cubo-29b'", "'Secondo piano'", "280"), (_at("dimeg"), "''", "'Aula Lime Laboratory of Innovation and Management Engineering'", "'cubo-41c'", "null", "20"), (_at("dimeg"), "''", "'Aula P4'", "null", "'Sesto piano'", "20"), (_at("dimeg"), "''", "'Aula B (Consolidata)'", "null", "'Quarto piano'", "20"),
    (_at("dinci"), "''", "'Aula Giannattasio ' || p_size", "'cubo-45b'", "'Primo piano'", "20"), (PLAN, "''", "'Aula Blu'", "'drop'", "null", "20"), (PLAN, "''", "'Multimediale 25'", f"'{places.LANGUAGES}'", "null", "20"), (PLAN, "''", "'Sala superiore ' || p_size", "null", "'Primo piano'", "20"), (PLAN, "''", "'Sala inferiore'", "null", "'Piano Terra'", "20"),
    ("'https://cla.unical.it/servizi-linguistici/studio-in-autonomia/'", "''", "'Aula Multimediale CLA 1A'", f"'{places.LANGUAGES}'", "null", "20"), ("'https://other'", "'29B 3A'", "'Aula'", "null", "'Terzo piano'", "20"), ("'https://other'", "''", "p_name", "null", "null", "20"),
]


@query("select * from (select 'p-' || p_partkey as place_id, " + pick([r[3] for r in ENRICHED]) + " as building_id, " + pick([r[4] for r in ENRICHED]) + " as floor, cast(" + pick([r[5] for r in ENRICHED]) + " as integer) as capacity from part) where building_id is distinct from 'drop'")
def enriched_by_source(spark, d):
    known = spark.createDataFrame([(b,) for b in ("cubo-15c", "cubo-29b", "cubo-41c", "cubo-45b", places.LANGUAGES)], "building_id string")
    rooms = _ruled_rooms(spark, d, ENRICHED)
    moved, at = places.enrich(rooms, rooms.select("place_id", "building_id", "floor"), known)
    return moved.join(at.select("place_id", F.col("building_id").alias("_b"), F.col("floor").alias("_f")), "place_id").where("building_id <=> _b and floor <=> _f").select("place_id", "building_id", "floor", "capacity")


@query("select 'p-' || p_partkey as place_id, case when p_partkey % 2 = 0 then 'Primo piano' else 'Piano Terra' end as floor from part")
def enriched_in_place(spark, d):
    rules = [(PLAN, "''", "'Sala Giannattasio'")]
    rooms = _ruled_rooms(spark, d, rules, building="case when p_partkey % 2 = 0 then 'cubo-45b' else 'capannone-a' end")
    known = spark.createDataFrame([("cubo-45b",), ("capannone-a",)], "building_id string")
    return places.enrich(rooms, rooms.select("place_id", "building_id", "floor").where("false"), known)[0].select("place_id", "floor")


HINTS = [("'al cubo ' || p_size || ' c'", "'Cubo ' || p_size || 'C'"), ("'Cubi 7-11b'", "'Cubi 7-11B'"), ("'capannone d'", "'Capannone D'"), ("'Ampliamento Polifunzionale'", "'Ampliamento Polifunzionale'"), ("'orto botanico'", "'Orto Botanico'"), ("'polifunzionale OVEST'", "'Polifunzionale Ovest'"), ("'il Polifunzionale'", "'Polifunzionale'"), ("' 3 b'", "'Cubo 3B'"), ("'piano 2, 3b'", "'Cubo 3B'"), ("'3b x'", "null"), ("p_name", "null")]


@query("select p_partkey, " + pick([h[1] for h in HINTS]) + " as hint from part")
def every_building_hint(spark, d):
    from ..functions.rooms import building_hint

    return spread(table(spark, d, "part")).select("p_partkey", building_hint(F.expr(pick([h[0] for h in HINTS]))).alias("hint"))


ROOMS = "select 'p-' || p_partkey as place_id, 'Aula B' || p_partkey as name, '' as room, 'b' || p_partkey as short_code from {part}"
MARKED = [("PLACE", "p-1", ("Uno", "UNO", "Aula B1")), ("BUILDING", "b-1", ("Torre",)), ("PLACE", "gone", ("x",))]


@query("""with l as (select 'p-' || p_partkey as entity_id, p_partkey as k, unnest(['Aula B' || p_partkey, 'B' || p_partkey, 'B ' || p_partkey, 'Aula B ' || p_partkey]) as label, unnest(['aula-b' || p_partkey, 'b' || p_partkey, 'b-' || p_partkey, 'aula-b-' || p_partkey]) as normalized from part where p_partkey % 2 = 1)
select 'PLACE' as entity_type, entity_id, label, normalized, 'alias-place-' || entity_id || '-' || normalized as alias_id from l union all select 'PLACE', 'p-1', 'Uno', 'uno', 'alias-place-p-1-uno' union all select 'BUILDING', 'b-1', 'Torre', 'torre', 'alias-building-b-1-torre'""")
def alias_rows(spark, d):
    rooms = made(spark, d, ROOMS, "part")
    at = rooms.select("place_id", F.expr("case when cast(substr(place_id, 3) as int) % 2 = 1 then 'AULA' else 'OTHER' end").alias("type"))
    return places.aliases(rooms, at, spark.createDataFrame([("b-1",)], "building_id string"), MARKED)


# --- checks ---

TABLES = {
    "buildings": "select p_partkey as ordinal, 'b' || p_partkey as building_id from {part} where p_partkey < 50",
    "departments": "select s_suppkey as ordinal, 'd' || s_suppkey as department_id, case when s_suppkey % 3 = 0 then 'b' || (s_suppkey + 45) when s_suppkey % 3 = 1 then '' end as primary_building_id from {supplier}",
    "places": "select p_partkey as ordinal, 'p' || p_partkey as place_id, case p_partkey % 3 when 0 then 'AULA' when 1 then 'OFFICE' end as type, case when p_partkey % 2 = 0 then 'b' || (p_partkey % 60) end as building_id from {part}",
    "people": "select c_custkey as ordinal, 'x' || c_custkey as person_id, case when c_custkey % 2 = 0 then 'd' || (c_custkey % 40) end as department_id, case when c_custkey % 3 = 0 then 'p' || (c_custkey * 3 + 1) when c_custkey % 3 = 1 then 'p' || c_custkey end as office_place_id from {customer}",
    "aulas": "select p_partkey as ordinal, 'a' || p_partkey as aula_id, case when p_partkey % 4 = 0 then 'p' || (p_partkey * 2) else 'p' || p_partkey end as place_id, 'Aula ' || p_name as name, case when p_partkey % 2 = 0 then 'room ' || (p_partkey % 30) || ' lab' end as normalized_name, 'b' || (p_partkey % 55) as building_id, case when p_size % 2 = 0 then '' || (p_size % 4) end as floor, 'R ' || (p_partkey % 7) as room, case when p_partkey % 5 = 0 then 'd' || (p_partkey % 50) end as department_id from {part}",
    "aliases": "select e.event_id as ordinal, 'l' || event_id as alias_id, case event_id % 5 when 0 then 'BUILDING' when 1 then 'PLACE' when 2 then 'PERSON' when 3 then 'DEPARTMENT' else 'OTHER' end as entity_type, case event_id % 5 when 0 then 'b' when 1 then 'p' when 2 then 'x' else 'd' end || user_id as entity_id from {events} e",
    "entity_links": "select event_id as ordinal, 'k' || (event_id % 400) as link_id, case when event_id % 2 = 0 then 'BUILDING' else 'PLACE' end as parent_entity_type, case when event_id % 2 = 0 then 'b' else 'p' end || user_id as parent_entity_id, case when event_id % 3 = 0 then 'OTHER' else 'PLACE' end as child_entity_type, 'p' || (user_id * 5) as child_entity_id from {events}",
}
CHECKS = "with " + ", ".join(f"_{k} as ({plain(v, 'part', 'supplier', 'customer', 'events')})" for k, v in TABLES.items()) + """,
ids as (select 'BUILDING' as k, building_id as i from _buildings union select 'PLACE', place_id from _places union select 'PERSON', person_id from _people union select 'DEPARTMENT', department_id from _departments),
room as (select a.*, p.place_id as pp, p.type as pt, p.building_id as pb, coalesce(nullif(a.normalized_name, ''), a.name, '') as said from _aulas a left join _places p on p.place_id = a.place_id),
named as (select *, lower(said) as k, arg_min(aula_id, ordinal) over (partition by lower(said), building_id) as f, min(ordinal) over (partition by lower(said), building_id) as first_at from room),
tok as (select building_id, aula_id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(said), '[^a-z0-9]+'), lambda x: x not in ('', 'aula', 'lab', 'laboratorio')))), ' ') as w from room)
select 'error' as level, 'departments.json' as file, 'primary_building_id ''' || primary_building_id || ''' does not exist in buildings.json' as message, department_id as record_id from _departments where nullif(primary_building_id, '') is not null and primary_building_id not in (select building_id from _buildings)
union all select 'error', 'places.json', 'building_id ''' || building_id || ''' does not exist in buildings.json', place_id from _places where building_id not in (select building_id from _buildings)
union all select 'error', 'people.json', 'department_id ''' || department_id || ''' does not exist in departments.json', person_id from _people where department_id not in (select department_id from _departments)
union all select 'error', 'people.json', 'office_place_id ''' || office_place_id || ''' does not exist in places.json', person_id from _people where office_place_id not in (select place_id from _places)
union all select 'warning', 'people.json', 'office_place_id ''' || office_place_id || ''' points to a non-OFFICE place', person_id from _people join _places on place_id = office_place_id where type is distinct from 'OFFICE'
union all select 'error', 'aulas.json', 'place_id ''' || place_id || ''' does not exist in places.json', aula_id from room where pp is null
union all select 'warning', 'aulas.json', 'place_id ''' || place_id || ''' points to a non-AULA place', aula_id from room where pp is not null and pt is distinct from 'AULA'
union all select 'error', 'aulas.json', 'building_id ''' || building_id || ''' does not exist in buildings.json', aula_id from room where pp is not null and building_id not in (select building_id from _buildings)
union all select 'warning', 'aulas.json', 'building_id ''' || building_id || ''' differs from places.json building_id ''' || pb || ''' for place_id ''' || place_id || '''', aula_id from room where pb <> building_id
union all select 'error', 'aulas.json', 'department_id ''' || department_id || ''' does not exist in departments.json', aula_id from room where pp is not null and department_id not in (select department_id from _departments)
union all select 'error', 'aulas.json', 'duplicate aula key for normalized_name ''' || k || ''' and building_id ''' || building_id || ''' (also in ''' || f || ''')', aula_id from named where ordinal > first_at
union all select 'error', 'aulas.json', 'conflicting floor for room ''' || lower(room) || ''' in building_id ''' || building_id || ''': ' || string_agg(distinct floor, ', ' order by floor), min(aula_id) from room where floor is not null group by lower(room), building_id having count(distinct floor) > 1
union all select 'warning', 'aulas.json', 'suspicious near-duplicate aulas for building_id ''' || building_id || ''' and token_set ''' || w || ''': ' || string_agg(aula_id, ', ' order by aula_id), min(aula_id) from tok where contains(w, ' ') group by building_id, w having count(*) > 1
union all select 'error', 'aliases.json', 'entity_id ''' || entity_id || ''' does not exist for entity_type ''' || entity_type || '''', alias_id from _aliases where entity_type <> 'OTHER' and not exists (select 1 from ids where k = entity_type and i = entity_id)
union all select 'error', 'entity_links.json', 'duplicate link_id ''' || link_id || '''', link_id from _entity_links qualify row_number() over (partition by link_id order by ordinal) > 1
union all select 'error', 'entity_links.json', 'parent_entity_id ''' || parent_entity_id || ''' does not exist for parent_entity_type ''' || parent_entity_type || '''', link_id from _entity_links where not exists (select 1 from ids where k = parent_entity_type and i = parent_entity_id)
union all select 'error', 'entity_links.json', 'child_entity_id ''' || child_entity_id || ''' does not exist for child_entity_type ''' || child_entity_type || '''', link_id from _entity_links where child_entity_type <> 'OTHER' and not exists (select 1 from ids where k = child_entity_type and i = child_entity_id)"""


@query(CHECKS)
def campus_checks(spark, d):
    return campus_integrity.check({k: made(spark, d, v, *[n for n in ("part", "supplier", "customer", "events") if f"{{{n}}}" in v]) for k, v in TABLES.items()})


RULES = {
    "corrections": [
        {"id": "r1", "action": "replace", "entity_type": "Buildings", "entity_id": "1", "field": "name", "reason": "x", "author": "a", "created_at": "2026-01-01T00:00:00Z", "status": "applied", "reviewer": "b", "priority": 3, "value": "v"},
        {"id": "r2", "action": "set_null", "entity_type": "place", "entity_id": "2", "field": "floor", "reason": "x", "author": "a", "created_at": "2026-01-01T00:00:00+01:00", "status": "approved", "reviewer": "b"},
        {"id": "r3", "action": "alias", "entity_type": "person", "entity_id": "3", "field": "name", "reason": "x", "author": "a", "created_at": "2026-01-01T00:00:00Z", "status": "draft"},
    ]
}


@query("select r_regionkey, id, entity_type, priority from region, (select 'r1' as id, 'building' as entity_type, 3 as priority union all select 'r2', 'place', 0 union all select 'r3', 'person', 0)")
def registry_rules(spark, d):
    loaded = documents.load_rules(json.dumps(RULES), {"r2"})
    rules = spark.createDataFrame([(r["id"], r["entity_type"], r["priority"]) for r in loaded], "id string, entity_type string, priority int")
    return table(spark, d, "region").select("r_regionkey").crossJoin(F.broadcast(rules))  # five rows


CORRECTED = [{"id": f"c{i}", "entity_type": "building", "entity_id": f"b{i}", "field": "name", "action": a, "value": "new", "priority": 0, "status": s} for i, (a, s) in enumerate((("replace", "applied"), ("set_null", "approved"), ("override", "applied"), ("replace", "draft")))]


@query("select 'datasets' as name, cast(1 as bigint) as n union all select 'rules_considered', 4 union all select 'rules_applied', 3 union all select 'rows_changed', 2 union all select 'fields_changed', 2")
def applied_rules(spark, d):
    rows = made(spark, d, TABLES["buildings"], "part").withColumn("name", F.col("building_id"))
    found = documents.applied({"buildings": documents.correct(rows, "building", CORRECTED)}, CORRECTED)
    return spark.createDataFrame(list(found.items()), "name string, n long")


@query(f"with a as ({plain(TABLES['aulas'], 'part')}) select count(*) as total, count(nullif(building_id, '')) as with_building_id, count(nullif(floor, '')) as with_floor, cast(0 as bigint) as with_capacity from a")
def contract_counts(spark, d):
    return documents.room_coverage(made(spark, d, TABLES["aulas"], "part").withColumn("capacity", F.col("ordinal").cast("string")))


REPORTED = """select aula_id, name, place_id, building_id, floor, case when ordinal % 3 = 0 then 'c' end as short_code, case when ordinal % 4 = 0 then cast(ordinal as integer) end as capacity, case when ordinal % 2 = 0 then 'u' || (ordinal % 3) end as source_url from ({aulas})"""


@query(f"""with a as (select *, case when ordinal % 6 > 0 then building_id end as b from ({plain(TABLES['aulas'], 'part')}))
select 'total' as name, cast(count(*) as double) as n from a union all select 'with_building_id', count(b) from a union all select 'with_building_id_ratio', round_even(count(b) / count(*), 4) from a union all select 'with_floor', count(floor) from a union all select 'with_short_code', count_if(ordinal % 3 = 0) from a
union all select 'missing ' || case when ordinal % 2 = 0 then 'u' || (ordinal % 3) else 'unknown' end, count(*) from a where b is null group by 1 union all select 'warnings', 1 union all select 'examples', least(20, count_if(b is null)) from a""")
def report_figures(spark, d):
    rows = {k: made(spark, d, v, *[n for n in ("part", "supplier", "customer", "events") if f"{{{n}}}" in v]) for k, v in TABLES.items() if k not in ("aliases", "entity_links")}
    rows["aulas"] = rows["aulas"].withColumns({"short_code": F.expr("case when ordinal % 3 = 0 then 'c' end"), "capacity": F.lit(None).cast("int"), "source_url": F.expr("case when ordinal % 2 = 0 then 'u' || (ordinal % 3) end"), "building_id": F.expr("case when ordinal % 6 > 0 then building_id end")})
    rows["buildings"] = rows["buildings"].withColumns({"lat": F.lit(1.0), "lng": F.lit(1.0)})
    found = documents.report(rows, {"aulas": []}, [], {"s": {"final_failures": 3, "failure_budget": 1}, "t": {"final_failures": 0}})
    a = found["coverage"]["aulas"]
    out = [(k, float(a[k])) for k in ("total", "with_building_id", "with_building_id_ratio", "with_floor", "with_short_code")] + [(f"missing {x['source_url']}", float(x["count"])) for x in a["missing_building_by_source"]]
    return spark.createDataFrame([*out, ("warnings", float(found["scrape_diagnostics"]["warning_count"])), ("examples", float(len(a["missing_building_examples"])))], "name string, n double")


@query("select user_id, count(*) as attempts, least(count_if(event_type = 'error'), 1000000) as final_failures from events group by user_id")
def budgeted(spark, d):
    sums = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "error").alias("final_failures"))
    return requests.within_budget(sums, 1_000_000)


# --- releases and the registry of sources ---

OLD = "select 'c' || c_custkey as person_id, c_name as name, case when c_custkey % 2 = 0 then 'p' || c_custkey end as office_place_id, 's' || (c_nationkey % 3) as source_id, 'e' as email, 'd' as department_id, 'then' as last_verified_at from {customer} where c_custkey % 5 > 0"
NEW = "select 'c' || c_custkey as person_id, case when c_custkey % 7 = 0 then c_name || '!' else c_name end as name, case when c_custkey % 4 = 0 then 'p' || c_custkey when c_custkey % 4 = 2 then '' end as office_place_id, 's' || (c_nationkey % 3) as source_id, case when c_custkey % 10 = 0 then 'e' else 'e' end as email, case when c_custkey % 3 = 0 then 'd' end as department_id, 'now' as last_verified_at from {customer} where c_custkey % 6 > 0"
BOTH = f"with o as ({plain(OLD, 'customer')}), n as ({plain(NEW, 'customer')}), j as (select o.person_id as op, n.person_id as np, coalesce(o.person_id, n.person_id) as id, o.name as oname, n.name as nname, nullif(o.office_place_id, '') as oo, nullif(n.office_place_id, '') as no, o.department_id as od, n.department_id as nd, n.email as ne, n.source_id as ns from o full join n on o.person_id = n.person_id)"


@query(f"""{BOTH} select id, 'removed' as kind, '' as fields from j where np is null union all select id, 'added', '' from j where op is null
union all select id, 'lost', array_to_string(list_filter([case when od is not null and nd is null then 'department_id' end, case when oo is not null and no is null then 'office_place_id' end], lambda x: x is not null), ',') from j where op is not null and np is not null and ((od is not null and nd is null) or (oo is not null and no is null))
union all select id, 'changed', 'name' from j where op is not null and np is not null and oname <> nname""")
def release_review(spark, d):
    out = release.review(made(spark, d, OLD, "customer"), made(spark, d, NEW, "customer"), "person_id")
    return out.select("id", "kind", F.array_join("fields", ",").alias("fields"))


@query(f"""{BOTH} select count(op) as baseline, count(np) as candidate, count_if(op is null) as added, count_if(np is null) as removed, count_if(op is not null and oo is not null) as baseline_with_office, count_if(np is not null and no is not null) as candidate_with_office, count_if(op is not null and np is not null and oo is not null) as shared_with_office_before,
count_if(op is not null and np is not null and no is not null) as shared_with_office_after, count_if(op is null and no is not null) as new_with_office, count_if(op is null and ne is not null) as new_with_email, count_if(op is null and nd is not null) as new_with_department from j""")
def release_people(spark, d):
    return release.people_counts(made(spark, d, OLD, "customer"), made(spark, d, NEW, "customer"))


@query(f"{BOTH} select ns as source_id, count(*) as n from j where op is null group by ns")
def release_sources(spark, d):
    return release.new_people_sources(made(spark, d, OLD, "customer"), made(spark, d, NEW, "customer"))


@query(f"""{BOTH}, k as (select id, 'removed' as kind from j where np is null union all select id, 'added' from j where op is null union all select id, 'lost' from j where op is not null and np is not null and ((od is not null and nd is null) or (oo is not null and no is null)) union all select id, 'changed' from j where op is not null and np is not null and oname <> nname)
select id, kind, count(*) over (partition by kind) as n from k qualify row_number() over (partition by kind order by id) <= 15""")
def release_samples(spark, d):
    return release.samples(release.review(made(spark, d, OLD, "customer"), made(spark, d, NEW, "customer"), "person_id")).drop("fields")


@query("select s_suppkey as source_id, case when s_suppkey % 3 = 0 then 'new' else s_name end as name, case when s_suppkey % 3 > 0 then s_nationkey end as notes from supplier union all select -s_suppkey - 1, 'new', null from supplier where s_suppkey % 3 = 0")
def source_registry(spark, d):
    old = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("notes"))
    new = old.where("source_id % 3 = 0").select("source_id", F.lit("new").alias("name"), F.lit(None).cast("int").alias("notes"))
    return registry.upsert_sources(old, new.unionByName(new.withColumn("source_id", -F.col("source_id") - 1)))


@query("select 'aulas' as name, 'x/aulas.jsonl' as path union all select 'people', 'x/people.jsonl'")
def dataset_paths(spark, d):
    return spark.createDataFrame(list(registry.dataset_paths("x/", ("aulas", "people")).items()), "name string, path string")


@query("select c_custkey, case when c_custkey % 6 > 0 and c_custkey % 7 = 0 then c_name || '!' else c_name end as name, case when c_custkey % 6 = 0 then case when c_custkey % 2 = 0 then 'p' || c_custkey end when c_custkey % 4 = 0 then 'p' || c_custkey end as office from customer where c_custkey % 5 > 0 or c_custkey % 6 > 0")
def baseline_with_nulls(spark, d):
    old = table(spark, d, "customer").where("c_custkey % 5 > 0").selectExpr("c_custkey", "c_name as name", "case when c_custkey % 2 = 0 then 'p' || c_custkey end as office")
    new = table(spark, d, "customer").where("c_custkey % 6 > 0").selectExpr("c_custkey", "case when c_custkey % 7 = 0 then c_name || '!' else c_name end as name", "case when c_custkey % 4 = 0 then 'p' || c_custkey end as office")
    return merge.baseline_merge(old, new, "c_custkey", overwrite_nulls=True)


@query(r"select page_id, lower(regexp_extract(url, '^([a-z]+):', 1)) as scheme, regexp_extract(url, '\?([^#]*)', 1) as query, regexp_replace(url, '[?#].*$', '') as bare from pages")
def url_pieces(spark, d):
    c = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.scheme(c).alias("scheme"), urls.query(c).alias("query"), urls.without_query(c).alias("bare"))
