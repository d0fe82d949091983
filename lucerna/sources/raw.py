"""Typed raw rows from recorded bodies: rooms of maps, tables, accordions and the planner, services, teachers, departments.

Every function gives its rows an `ordinal` by place in the source; `all_rooms` puts the sources before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rooms as R
from ..functions import services, urls
from ..functions.text import casefold, collapse, made, none_if_empty, once
from ..operators.blocks import carry_forward
from ..operators.room_merge import RAW, raw_fold

# Words of columns, of rows that list equipment, of folders and addresses; groups of laboratories of the language centre.
NAME_COLUMNS = ("aula", "nome", "denominazione", "laboratorio")
PLACE_COLUMNS = ("cubo", "ubicazione", "luogo", "posizione", "indirizzo", "piano", "liv")
SEAT_COLUMNS = ("capienza", "posti")
EQUIPMENT = ("wi-fi", "rete lan", "dotazione")
SELF_STUDY = "cla.unical.it/servizi-linguistici/studio-in-autonomia/"
LAB_GROUP, LAB_BLOCK = r"(?iU)Laboratori\s+Multimediali\s*\(([^)]*)\)", r"(?iU)\bCubo\s*([0-9]{1,2}[A-Za-z])\b"
CALENDAR_ID = r"(?i)linkCalendarioId=([0-9a-f]{24})"
STRUCTURE_CODES = (r"(?i)https://storage\.portale\.unical\.it/api/ricerca/addressbook/\?[^\"'\s>]*structuretree=([0-9]+)", r"(?i)structuretree(?:=|['\"\s:]+)['\"]?([0-9]{6})")
TEACHER_SLUG = r"(?i)/storage/teachers/([^/?#\"']+)/?"


def _room(name: Column, **more: Column) -> list[Column]:
    """Columns of a raw room whose room and code come from its name."""
    types = {"lat": "double", "lng": "double", "capacity": "int"}
    own = {"name": name, "room": R.room_label(name), "short_code": R.short_code(name)} | more
    return [own.get(c, F.lit(None)).cast(types.get(c, "string")).alias(c) for c in RAW]


def map_rooms(marks: DataFrame) -> DataFrame:
    """Rooms of placemarks (url, folder, name, description, lat, lng): the mark itself if its name says `Aula `, and those its description lists by floor."""
    hint = R.building_hint(F.concat_ws(" ", "name", F.coalesce("description", F.lit(""))))
    rows = marks.where("name is not null").select("*", made(casefold(F.col("name"))).alias("_low")).withColumn("_hint", hint)
    low = F.col("_low")
    own = rows.where(F.contains(low, F.lit("aula "))).select("*", made(R.map_room_name("name")).alias("_name")).where("_name is not null")
    one = own.select(F.struct(F.col("url").alias("a"), F.col("name").alias("b"), F.lit(0).alias("c"), F.lit(0).alias("d")).alias("ordinal"), *_room(F.col("_name"), source_url=F.col("url"), lat=F.col("lat"), lng=F.col("lng"), building_hint=F.col("_hint")))
    may = F.contains(low, F.lit("cubo ")) | F.contains(low, F.lit("aula ")) | F.coalesce(F.contains(casefold(F.col("folder")), F.lit("strutture")), F.lit(False))
    listed = rows.where(may & F.col("description").isNotNull()).select("*", F.posexplode(R.floor_segments("description")).alias("_i", "_s"))
    listed = listed.select("*", F.posexplode(R.segment_rooms(F.col("_s.text"))).alias("_j", "_name"))
    many = listed.select(F.struct(F.col("url").alias("a"), F.col("name").alias("b"), (F.col("_i") + 1).alias("c"), F.col("_j").alias("d")).alias("ordinal"), *_room(F.col("_name"), source_url=F.col("url"), lat=F.col("lat"), lng=F.col("lng"), floor=F.col("_s.floor"), building_hint=F.col("_hint")))
    return one.unionByName(many)


def table_rooms(rows: DataFrame) -> DataFrame:
    """Rooms of table rows (url, tab, line, cells, headers): the names a row lists, and its name cell where the page has no such room yet."""
    named = lambda words: R.columns_named(F.col("headers"), words)
    head = once(R.is_header_row(F.col("headers")), lambda h: F.array(*[F.when(h, named(w)).otherwise(F.array().cast("array<int>")) for w in (NAME_COLUMNS, PLACE_COLUMNS, SEAT_COLUMNS)]))
    equipment = lambda low: R.holds(low, EQUIPMENT) & ~F.contains(low, F.lit("aula"))
    data = rows.where(~R.is_header_row(F.col("cells"))).select("*", made(collapse(F.array_join("cells", " "))).alias("_text")).where((F.col("_text") != "") & ~once(casefold(F.col("_text")), equipment))
    picked = lambda i: R.cells_at(F.col("cells"), F.col("_at")[i])
    data = data.select("*", made(head).alias("_at")).select("*", made(F.struct(F.size(F.col("_at")[0]).alias("n"), picked(0).alias("names"), picked(1).alias("places"), picked(2).alias("seats"))).alias("_c"))
    data = data.withColumns({"_n": F.col("_c.n"), "_names": F.when(F.size("_c.names") > 0, F.col("_c.names")).otherwise(F.slice("cells", 1, 1))})
    place = F.coalesce(none_if_empty(F.array_join(F.when(F.size("_c.places") > 0, F.col("_c.places")).otherwise(F.slice("cells", 2, 2)), " ")), F.col("_text"))
    seats = F.coalesce(F.nullif(F.array_join("_c.seats", " "), F.lit("")), F.col("_text"))
    told = F.struct(once(place, R.building_hint).alias("hint"), R.floor_label(place).alias("floor"), R.capacity(seats).alias("cap"))
    data = data.select("url", "tab", "line", "_n", "_names", made(told).alias("_t")).withColumns({"_hint": F.col("_t.hint"), "_floor": F.col("_t.floor"), "_cap": F.col("_t.cap")})
    listed = F.filter(F.transform(R.room_candidates(F.array_join("_names", " ; ")), R.department_room_name), lambda x: x.isNotNull())
    rest = F.when((F.col("_n") > 0) | R.tells_room(F.col("_names")), R.department_room_name(F.get(F.col("_names"), F.lit(0))))
    each = F.filter(F.concat(F.transform(listed, lambda x: F.struct(x.alias("name"), F.lit(False).alias("more"))), F.array(F.struct(rest.alias("name"), F.lit(True).alias("more")))), lambda x: x["name"].isNotNull())
    found = data.select("*", F.posexplode(each).alias("_i", "_x"))
    key = Window.partitionBy("url", casefold(F.col("_x.name")), F.coalesce("_hint", F.lit("")))
    place = F.struct("tab", "line", F.col("_i").alias("i"))
    kept = found.withColumn("_at", place).withColumn("_first", F.min("_at").over(key)).where("not _x.more or _at = _first")
    return kept.select(F.struct(F.col("url").alias("a"), F.lpad(F.col("tab").cast("string"), 9, "0").alias("b"), F.col("line").alias("c"), F.col("_i").alias("d")).alias("ordinal"), *_room(F.col("_x.name"), source_url=F.col("url"), floor=F.col("_floor"), building_hint=F.col("_hint"), capacity=F.col("_cap")))


def block_titles(tag: Column, text: Column, strong: Column, laboratory: Column) -> Column:
    """Names of rooms that a block of an accordion starts: its heading, else what it says in bold, else names in a paragraph; each once."""
    return once(collapse(text), lambda t: once(casefold(t), lambda low: _block_titles(tag, t, low, strong, laboratory)))


def _block_titles(tag: Column, t: Column, low: Column, strong: Column, laboratory: Column) -> Column:
    clean = lambda x: F.trim(F.regexp_replace(collapse(x), "^['`\"]+", ""))
    named = lambda x: once(casefold(x), lambda y: F.startswith(y, F.lit("aula ")) | F.startswith(y, F.lit("laboratorio ")))
    di = F.concat(F.when(F.startswith(low, F.lit("di ")), F.lit("Laboratorio ")).otherwise(F.lit("Laboratorio di ")), t)
    heading = F.when(tag == "h4", F.when(F.startswith(low, F.lit("laboratorio ")), t).when(laboratory & R.is_laboratory_heading(t), di))
    bold = F.filter(F.transform(strong, clean), lambda x: R.is_entry_name(x) & (~R.tells_location(t) | named(x)))
    first = F.filter(F.concat(F.array(heading), bold), lambda x: x.isNotNull() & (x != ""))
    none = F.array().cast("array<string>")
    said = F.when((tag == "p") & (F.contains(low, F.lit("aula")) | F.contains(low, F.lit("laboratorio"))), F.filter(F.transform(R.room_candidates(t), clean), lambda x: named(x) & R.is_entry_name(x))).otherwise(none)
    every = F.when((t == "") | R.is_generic_heading(t), none).otherwise(once(first, lambda x: F.when(F.size(x) > 0, x).otherwise(said)))
    distinct = lambda xs, folded: F.filter(xs, lambda x, i: F.array_position(folded, F.get(folded, i)) == i + 1)
    return once(every, lambda xs: once(F.transform(xs, lambda x: casefold(collapse(x))), lambda folded: distinct(xs, folded)))


def accordion_rooms(blocks: DataFrame) -> DataFrame:
    """Rooms of accordion bodies (url, item, title, ord, tag, text, strong): a block that names rooms and those up to the next one tell of them."""
    lab = F.contains(casefold(F.coalesce("title", F.lit(""))), F.lit("laborator"))
    rows = blocks.withColumn("_lab", lab).select("*", made(block_titles(F.col("tag"), F.col("text"), F.col("strong"), F.col("_lab"))).alias("_titles"))
    told = carry_forward(rows, ["url", "item"], "ord", F.size("_titles") > 0, "text", ["_titles", "_lab"])
    each = told.select("*", F.posexplode("_titles").alias("_i", "_t")).select("*", made(R.department_room_name("_t")).alias("_name")).where("_name is not null")
    hint = R.coded_hint(F.col("_name"), F.coalesce(R.building_hint("text"), R.building_hint("_t")))
    out = each.select("*", made(F.struct(hint.alias("hint"), R.floor_label("text").alias("floor"), R.capacity("text").alias("cap"))).alias("_x"))
    out = out.withColumns({"_hint": F.col("_x.hint"), "_floor": F.col("_x.floor"), "_cap": F.col("_x.cap")})
    broad = F.col("_lab") & F.startswith(casefold(F.col("_name")), F.lit("laboratorio di ")) & F.col("_hint").isNull() & F.col("_floor").isNull() & F.col("_cap").isNull()
    return out.where(~broad).select(F.struct(F.col("url").alias("a"), F.lpad(F.col("item").cast("string"), 9, "0").alias("b"), F.col("ord").alias("c"), F.col("_i").alias("d")).alias("ordinal"), *_room(F.col("_name"), source_url=F.col("url"), floor=F.col("_floor"), building_hint=F.col("_hint"), capacity=F.col("_cap")))


def self_study_rooms(pages: DataFrame) -> DataFrame:
    """The language centre's multimedia rooms, one for each block that its page (url, text) lists."""
    groups = F.array_join(F.regexp_extract_all("text", F.lit(LAB_GROUP), F.lit(1)), " ; ")
    blocks = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(groups, F.lit(LAB_BLOCK), F.lit(1)), F.upper)))
    rows = pages.where(F.contains(casefold(F.col("url")), F.lit(SELF_STUDY))).select("url", F.posexplode(blocks).alias("_i", "_b"))
    return rows.select(F.struct(F.col("url").alias("a"), F.lit("").alias("b"), F.lit(0).alias("c"), F.col("_i").alias("d")).alias("ordinal"), *_room(F.concat(F.lit("Aula Multimediale CLA "), "_b"), source_url=F.col("url"), building_hint=F.concat(F.lit("Cubo "), "_b")))


ITEM = "struct<descrizione:string,codice:string,edificio:string,edificioId:string>"


def _planned(items: DataFrame, blocks: DataFrame, floors: bool) -> DataFrame:
    said = once(collapse("x.descrizione"), lambda t: F.when(t != "", t).otherwise(F.col("x.codice")))
    named = items.select("*", made(R.planner_room_name(said)).alias("_name")).where("_name is not null").withColumn("_b", none_if_empty(F.get_json_object("x.edificio", "$.descrizione")))
    # ids are few kinds and may be null: only rows that need one are looked up
    known = blocks.select(F.col("id").alias("_id"), F.col("descrizione").alias("_known")).distinct()
    # those that need none have their own name as key, which no id equals: they meet nothing and don't gather in one task
    out = named.withColumn("_id", F.when(F.col("_b").isNull() & F.col("x.edificioId").isNotNull(), F.concat(F.lit("i"), "x.edificioId")).otherwise(F.concat(F.lit("n"), F.coalesce("url", F.lit("")), "_name")))
    out = out.join(known.withColumn("_id", F.concat(F.lit("i"), "_id")), "_id", "left").select("*", made(R.room_label("_name")).alias("_label"))
    floor = R.floor_label("x.descrizione") if floors else F.lit(None)
    return out.select("ordinal", *_room(F.col("_name"), room=F.col("_label"), short_code=R.code_of(F.col("_label")), source_url=F.col("url"), floor=floor, building_hint=F.coalesce("_b", "_known")))


def _objects(c, schema: str) -> Column:
    """The objects of a JSON array, as structs; other elements go."""
    listed = F.filter(F.from_json(c, "array<string>"), lambda x: F.startswith(F.ltrim(x), F.lit("{")))
    return F.transform(listed, lambda x: F.from_json(x, schema))


def planner_rooms(bodies: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rooms of the planner's lists (url, body); blocks: (id, descrizione) of its buildings.  What is no array has no rows."""
    items = bodies.select("url", F.posexplode(_objects("body", ITEM)).alias("_i", "x"))
    return _planned(items.withColumn("ordinal", F.struct(F.col("url").alias("a"), F.lit("").alias("b"), F.col("_i").alias("c"), F.lit(0).alias("d"))), blocks, True)


def schedule_rooms(bodies: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rooms that the entries of schedules (url, body) name."""
    entries = bodies.select("url", F.posexplode(_objects("body", "struct<aule:string>")).alias("_i", "_e"))
    items = entries.select("url", "_i", F.posexplode(_objects("_e.aule", ITEM)).alias("_j", "x"))
    return _planned(items.withColumn("ordinal", F.struct(F.col("url").alias("a"), F.lit("").alias("b"), F.col("_i").alias("c"), F.col("_j").alias("d"))), blocks, False)


def all_rooms(*sources: DataFrame) -> DataFrame:
    """The folded rooms of all sources, earlier ones first; a source that is switched off is left out by the caller."""
    ranked = [x.withColumn("ordinal", F.struct(F.lit(i).alias("s"), F.col("ordinal").alias("o"))) for i, x in enumerate(sources)]
    return raw_fold(reduce(DataFrame.unionByName, ranked))


def harvested(pages: DataFrame, text: str, *patterns: str) -> DataFrame:
    """Distinct first groups of the patterns in the pages, in small letters."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns])
    return pages.select(F.explode(found).alias("found")).select(F.lower("found").alias("found")).distinct()


PERSON = "struct<ID:string,Name:string,Email:string,TeacherName:string,TeacherID:string,TeacherDepartmentName:string,TeacherDepartmentCod:string,StructureName:string,StructureURL:string>"


def payload_pages(bodies: DataFrame, base: Column | str = "url") -> DataFrame:
    """(url, next, results) of paginated payloads (url, body): next is absolute, results an array of objects as text; what is no payload has none."""
    nxt = F.nullif(F.get_json_object("body", "$.next"), F.lit(""))
    results = F.coalesce(F.from_json(F.get_json_object("body", "$.results"), "array<string>"), F.array().cast("array<string>"))
    return bodies.select("url", F.when(nxt.isNotNull(), urls.absolute(F.col("url"), nxt)).alias("next"), F.filter(results, lambda x: F.startswith(F.ltrim(x), F.lit("{"))).alias("results"))


def texts(c) -> Column:
    """The strings of a JSON value that is one or a list of values, tidy and not empty."""
    listed = F.from_json(c, "array<variant>")
    strings = F.transform(F.filter(listed, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.try_variant_get(v, "$", "string"))
    one = F.when(~F.startswith(F.ltrim(c), F.lit("[")) & ~F.startswith(F.ltrim(c), F.lit("{")), F.array(F.regexp_replace(c, '^"|"$', "")))
    return F.coalesce(F.filter(F.transform(F.coalesce(F.when(F.startswith(F.ltrim(c), F.lit("[")), strings), one), collapse), lambda x: x != ""), F.array().cast("array<string>"))


def _strings(v, field: str, listed: bool = True) -> Column:
    """The strings of an object's field (a variant), the field itself or, if listed, those in its list; tidy and not empty."""
    x = F.try_variant_get(v, f"$.{field}", "variant")
    said = lambda y: F.when(F.schema_of_variant(y) == "STRING", F.try_variant_get(y, "$", "string"))
    many = F.transform(F.try_variant_get(v, f"$.{field}", "array<variant>"), said)
    one = F.array(said(x))
    return F.filter(F.transform(F.coalesce(many, one) if listed else one, none_if_empty), lambda y: y.isNotNull())


#: What a teacher's details say, in the order of the columns.
DETAIL = "email string, phone string, department_name string, department_code string, website_url string, office_hours string, office_reference string, notes string"


def teacher_details(bodies: DataFrame) -> DataFrame:
    """(url, d) of payloads (url, body) whose `results` is an object: what they say of a teacher.  Others have no rows.

    Of several bodies of one address the least row counts; an object with a key twice is no payload.
    """
    said = bodies.select("url", F.try_variant_get(F.try_parse_json("body"), "$.results", "variant").alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    first = lambda c, listed=True: F.get(_strings(F.col("v"), c, listed), F.lit(0))
    office, reference = first("TeacherOffice", False), first("TeacherOfficeReference")
    notes = F.when(reference.isNull(), office).otherwise(F.concat_ws(" | ", F.concat(F.lit("Office: "), office), F.concat(F.lit("Office references: "), reference)))
    of = {"email": first("TeacherEmail"), "phone": first("TeacherTelOffice"), "department_name": first("TeacherDepartmentName"), "department_code": first("TeacherDepartmentCod"), "website_url": first("TeacherWebSite"), "office_hours": first("ReceptionHours", False), "office_reference": reference, "notes": notes}
    return said.select("url", F.struct(*[v.alias(k) for k, v in of.items()]).alias("d")).groupBy("url").agg(F.min("d").alias("d"))


def detailed(rows: DataFrame, details: DataFrame | None) -> DataFrame:
    """rows (detail_url, ...) with details (url, d): what a detail says goes before what the list says."""
    asked = rows.where("detail_url is not null")
    none = F.lit(None).cast(f"struct<{DETAIL.replace(' ', ':').replace(',:', ',')}>")
    if details is None:
        out = rows.withColumn("d", none)
    else:  # rows without an address of details don't meet in one task
        out = asked.join(details.withColumnRenamed("url", "detail_url"), "detail_url", "left").unionByName(rows.where("detail_url is null").withColumn("d", none))
    both = ("email", "department_name", "department_code", "website_url")
    return out.withColumns({c: F.coalesce(f"d.{c}", c) for c in both} | {c: F.col(f"d.{c}") for c in ("phone", "office_hours", "office_reference", "notes")})


def teachers(pages: DataFrame, base: str, api: str | None = None, bodies: DataFrame | None = None) -> DataFrame:
    """Raw teachers of the interface's pages (url, step, results), the first of a name and address.

    With the interface's own address and responses (url, body) the rows are asked for in a second wave: a teacher with an id has what the
    answer under `<api>/<id>/` says; one without an id or an answer stays as listed.
    """
    rows = pages.select("url", "step", F.posexplode("results").alias("_i", "v")).select("*", F.from_json("v", PERSON).alias("x")).withColumn("full_name", none_if_empty("x.TeacherName")).where("full_name is not null")
    first = lambda c: F.get(texts(F.col(f"x.{c}")), F.lit(0))
    out = rows.withColumns({"email": first("Email"), "department_name": first("TeacherDepartmentName"), "department_code": first("TeacherDepartmentCod")})
    out = out.withColumn("website_url", urls.teacher_url(F.lit(base), F.col("email"), none_if_empty("x.TeacherID"))).withColumn("source_url", F.coalesce("website_url", "url")).withColumn("ordinal", F.struct("step", "_i"))
    out = out.withColumn("detail_url", F.lit(None).cast("string") if api is None else urls.teacher_detail(F.lit(api), none_if_empty("x.TeacherID")))
    details = None
    if api is not None:
        asked = out.where("detail_url is not null").select(F.col("detail_url").alias("url")).distinct()
        details = teacher_details(bodies.select("url", "body").join(asked, "url", "left_semi"))
    out = detailed(out.select("ordinal", "full_name", "source_url", "email", "department_name", "department_code", "website_url", "detail_url"), details)
    told = ("ordinal", "full_name", "source_url", "department_name", "department_code", "website_url", "phone", "office_hours", "office_reference", "notes")
    one = out.groupBy(casefold(F.col("full_name")).alias("_k"), "email").agg(F.min_by(F.struct(*told), "ordinal").alias("r"))
    return one.select("r.ordinal", "r.full_name", "r.source_url", "email", *[f"r.{c}" for c in told[3:]])


def departments(pages: DataFrame, base: str) -> DataFrame:
    """Raw departments of the interface's pages, the first of a name."""
    rows = pages.select("step", F.posexplode("results").alias("_i", "v")).select("*", F.from_json("v", PERSON).alias("x")).withColumn("name", none_if_empty("x.StructureName")).where("name is not null")
    out = rows.withColumn("website_url", none_if_empty("x.StructureURL")).withColumn("ordinal", F.struct("step", "_i"))
    one = out.groupBy(casefold(F.col("name")).alias("_k")).agg(F.min_by(F.struct("ordinal", "name", "website_url"), "ordinal").alias("r"))
    return one.select("r.ordinal", "r.name", F.coalesce("r.website_url", F.lit(base)).alias("source_url"), F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("phone"), "r.website_url")


def services_of(nodes: DataFrame) -> DataFrame:
    """Raw services of pages' nodes (url, node, tag, attrs, text): heading, first paragraph, addresses, numbers and hours; pages of no service go."""
    href = F.col("_href")
    at = lambda cond, value: F.min_by(F.when(cond, value), F.when(cond, F.col("node")))
    tag, said = F.col("tag"), F.col("_said")
    outer = F.rlike(href, F.lit("^https?://"))
    # what is read from attributes and texts goes into the aggregation's sort, not they themselves; a page's address is read once, not for each node
    told = F.when(tag.isin("h1", "h2", "title", "p"), none_if_empty("text"))
    rows = nodes.select("url", "node", "tag", F.col("attrs")["href"].alias("_href"), told.alias("_said"), F.contains(F.lower("text"), F.lit("orario")).alias("_orario"))
    one = rows.groupBy("url").agg(
        F.coalesce(at(tag == "h1", said), at(tag == "h2", said), at(tag == "title", said)).alias("_name"), at(tag == "p", said).alias("_about"),
        at((tag == "a") & F.startswith(href, F.lit("mailto:")), F.trim(F.replace(href, F.lit("mailto:"), F.lit("")))).alias("email"),
        at((tag == "a") & F.startswith(href, F.lit("tel:")), F.trim(F.replace(href, F.lit("tel:"), F.lit("")))).alias("phone"),
        at((tag == "a") & outer, F.trim(href)).alias("website_url"), F.max("_orario").alias("_hours"),
    ).select("*", made(urls.service_url(F.col("url"))).alias("_page")).where("_page is not null")
    one = one.where("_name is not null").select("*", made(urls.service_name(F.col("_page"))).alias("_by"))
    by_url = F.col("_by")
    deep = (F.size(urls.segments(F.col("_page"))) > 4) & by_url.isNotNull()
    name = F.when(deep, by_url).otherwise(F.col("_name"))
    name = once(name, lambda n: F.when(services.is_noise_name(n), F.when(~services.is_noise_name(by_url), by_url)).otherwise(n))
    about = F.when(~services.is_noise_description("_about"), F.col("_about"))
    rows = one.select("*", made(name).alias("name")).where("name is not null").withColumn("description", about)
    hours = F.when(F.col("_hours"), F.lit("Orari disponibili sulla pagina sorgente"))
    return rows.select(F.col("url").alias("ordinal"), "name", F.col("_page").alias("source_url"), services.service_type(F.col("name"), F.coalesce("description", F.lit(""))).alias("service_type"), "description", F.nullif("email", F.lit("")).alias("email"), F.nullif("phone", F.lit("")).alias("phone"), "website_url", hours.alias("opening_hours"))
