"""The whole crawl over recorded responses: every dataset from its sources, links, aliases, checks and report, stage by stage.

A stage takes the tables made so far and returns new ones; nothing is kept between them but tables.  Responses are (method, url, body).
A profile says which sources are read, as a live crawl would; here all that is left out is simply not among the responses.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import urls
from .functions.people import is_building
from .functions.services import service_link
from .functions.text import casefold, collapse, name_key
from .operators import canonical, merge, places, room_merge
from .operators.campus_integrity import check
from .operators.lookup import unique_only
from .operators.rules import cut, pages_in_order
from .sources import markup, raw, requests

# Ids of datasets and, in the stages, ids of sources and the type of rooms' places.
KEYS = {"buildings": "building_id", "departments": "department_id", "places": "place_id", "aulas": "aula_id", "people": "person_id", "aliases": "alias_id", "entity_links": "link_id", "sources": "source_id"}

#: The first `main` of a page.
MAIN = r"(?is)<main\b[^>]*>(.*?)</main\s*>"


@dataclass(frozen=True)
class Profile:
    """What a crawl reads: addresses of the maps, interfaces and lists, and which sources of rooms.

    pages: pages of one interface that may be read; more of them fail the crawl (None: all are read).  budget: responses without a body that
    it may have; more fail it before any stage (None: any number).  details: teachers are asked for one by one after their list.
    department_pages: pages read from each address of a department, to learn whose teachers are whose; 0 for none of them, None for all.
    """

    at: str
    maps: tuple[str, ...] = ()
    departments_api: str = ""
    teachers_api: str = ""
    services: tuple[str, ...] = ()
    base: str = "https://www.unical.it/"
    planner: tuple[str, ...] = ()
    planner_blocks: str = ""
    schedules: tuple[str, ...] = ()
    tables: bool = True
    accordions: bool = True
    pages: int | None = None
    budget: int | None = None
    meetings: tuple[str, ...] = ()
    details: bool = True
    department_pages: int | None = 10


def fast(profile: Profile) -> Profile:
    """Without schedules, details of teachers and sites of departments."""
    return replace(profile, schedules=(), details=False, department_pages=0)


def _bodies(responses: DataFrame, wanted) -> DataFrame:
    return responses.where(F.col("url").isin(*wanted) & F.col("body").isNotNull()).select("url", "body")


def _payloads(spark: SparkSession, responses: DataFrame, first: str, most: int | None) -> DataFrame:
    """Pages of a paginated interface with their step; a page whose `next` was seen ends it.  Raises OverflowError beyond `most` pages."""
    pages = raw.payload_pages(responses.where("body is not null"))
    reached = pages_in_order(spark.createDataFrame([(first,)], "url string"), pages, most)
    if most is not None and not reached.where(F.col("step") >= most).isEmpty():
        raise OverflowError(f"{first} has more than {most} pages")
    return pages.join(reached, "url")


def empty(spark: SparkSession, schemas: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema).withColumn("ordinal", F.lit("")) for name, schema in schemas.items()}


def departments(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    rows = raw.departments(_payloads(spark, responses, p.departments_api, p.pages), p.base) if p.departments_api else None
    return {} if rows is None else {"departments": canonical.departments(rows, "unical-departments", p.at)}


def _marks(responses: DataFrame, p: Profile) -> DataFrame:
    return markup.placemarks(_bodies(responses, p.maps), "url", "body")


def buildings(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    if not p.maps:
        return {}
    marks = _marks(responses, p).where(is_building(F.col("name")) & F.col("lat").isNotNull() & F.col("folder").isNotNull())
    return {"buildings": canonical.buildings(marks.select(F.col("name").alias("ordinal"), "name", F.col("url").alias("source_url"), "lat", "lng", "description"), "campus-map", p.at)}


def services(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    """Services of the pages that one to three links lead to from the lists; links stand in a page's `main`, if it has one."""
    if not p.services:
        return {}
    pages = responses.where("body is not null").select("url", "body")
    scoped = pages.select("url", F.coalesce(F.nullif(F.regexp_extract("body", MAIN, 1), F.lit("")), F.col("body")).alias("body"))
    links = markup.nodes(scoped, "url", "body", ("a",)).where("attrs['href'] is not null")
    to = links.select("url", service_link(F.col("url"), F.col("attrs")["href"], F.col("text")).alias("target")).where("target is not null").distinct()
    to = cut(to)
    reached = requests.levels(spark.createDataFrame([(u,) for u in p.services], "url string"), to, 3)
    found = cut(raw.services_of(markup.nodes(pages.join(reached.select("url"), "url"), "url", "body", ("h1", "h2", "title", "p", "a"))))
    return {"places": canonical.keep_others(t["places"].drop("ordinal"), canonical.services(found, "unical-services", p.at), "unical-services", "place_id")}


def teachers(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    if not p.teachers_api:
        return {}
    bodies = responses.where("body is not null").select("url", "body")
    listed = _payloads(spark, responses, p.teachers_api, p.pages)
    rows = cut(raw.teachers(listed, p.base, p.teachers_api if p.details else None, bodies))
    known = cut(department_map(t["departments"], bodies, p.department_pages)) if p.department_pages != 0 else None
    people = canonical.people(rows, t["departments"], known, "unical-teachers", p.at)
    offices = canonical.offices(rows, t["buildings"], p.meetings, "unical-teachers", p.at)
    return {"people": people, "places": canonical.keep_others(t["places"].drop("ordinal"), offices, "unical-teachers", "place_id")}


def aulas(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    sources = [raw.map_rooms(_marks(responses, p))] if p.maps else []
    lists = {*p.planner, *p.schedules, *p.maps, p.planner_blocks, p.departments_api, p.teachers_api}
    pages = responses.where(~F.col("url").isin(*lists) & F.col("body").isNotNull()).select("url", "body")
    if p.tables:
        sources.append(raw.table_rooms(markup.table_rows(pages, "url", "body")))
    if p.accordions:
        sources.append(raw.accordion_rooms(markup.accordion_blocks(pages, "url", "body")))
        sources.append(raw.self_study_rooms(pages.select("url", collapse(F.regexp_replace("body", "<[^>]*>", " ")).alias("text"))))
    blocks = _bodies(responses, [p.planner_blocks]).select(F.inline(F.from_json("body", "array<struct<id:string,descrizione:string>>")))
    if p.planner:
        sources.append(raw.planner_rooms(_bodies(responses, p.planner), blocks))
    if p.schedules:
        sources.append(raw.schedule_rooms(_bodies(responses, p.schedules), blocks))
    if not sources:
        return {}
    rooms, at = room_merge.rooms(raw.all_rooms(*map(cut, sources)), t["buildings"], "unical-aulas", p.at, cut)
    old = t["places"].drop("ordinal")
    mine = (F.col("type") == "AULA") & (F.col("source_id") == "unical-aulas")
    wide = at.select(*[F.col(c) if c in at.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns])
    return {"aulas": rooms, "places": merge.partition_replace(old, wide, mine, "place_id")}


def link(spark, responses: DataFrame, p: Profile, t: dict, cut=cut) -> dict:
    return {"places": places.link_places(t["places"].drop("ordinal"), t["buildings"]).select(*[c for c in t["places"].columns if c != "ordinal"])}


STAGES = (("departments", departments), ("buildings", buildings), ("services", services), ("teachers", teachers), ("aulas", aulas), ("places-buildings", link))


def shaped(rows: DataFrame, like: DataFrame) -> DataFrame:
    """rows with the columns of a table, null where they have none."""
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(like.schema[c].dataType).alias(c) for c in like.columns if c != "ordinal"])


def affordable(responses: DataFrame, profile: Profile) -> None:
    """Raises RuntimeError if more responses have no body than the profile's budget allows."""
    if profile.budget is not None and (failed := responses.where("body is null").count()) > profile.budget:
        raise RuntimeError(f"final failures: {failed}, budget {profile.budget}")


def run(spark: SparkSession, responses: DataFrame, profile: Profile, baseline: dict[str, DataFrame], contract: dict | None = None, landmarks=(), cut=cut) -> dict[str, DataFrame]:
    """All datasets: each stage's tables over the baseline's rows, which stay where a stage says nothing of them.

    cut: writes a table and reads it again, so that a stage's plan does not hold those before it (a checkpoint if none is given).
    """
    affordable(responses, profile)
    t = dict(baseline)
    for _, stage in STAGES:
        for name, rows in stage(spark, responses, profile, t, cut).items():
            old = t[name].drop("ordinal")
            whole = rows if name == "places" else merge.baseline_merge(old, shaped(rows, old), KEYS[name])
            t[name] = cut(shaped(whole, old)).withColumn("ordinal", F.col(KEYS[name]))
    if contract is not None:
        at, of, links = places.apply_contract(t["places"].drop("ordinal"), t["buildings"].drop("ordinal"), contract, profile.at)
        for name, rows in (("places", at), ("buildings", of), ("entity_links", links)):
            t[name] = cut(shaped(rows, t[name])).withColumn("ordinal", F.col(KEYS[name]))
    found = places.aliases(t["aulas"], t["places"], t["buildings"], list(landmarks))
    t["aliases"] = cut(shaped(found, t["aliases"])).withColumn("ordinal", F.col("alias_id"))
    return t


def issues(t: dict[str, DataFrame]) -> DataFrame:
    return check(t)


def _said(kind: str, c) -> Column:
    return F.when(F.nullif(c, F.lit("")).isNotNull(), F.concat(F.lit(f"{kind}:"), c))


def _book_keys(rows: DataFrame) -> DataFrame:
    """(department_id, key) of an address book's results (department_id, results)."""
    each = rows.select("department_id", F.explode("results").alias("v")).select("department_id", F.from_json("v", raw.PERSON).alias("x"))
    local = F.transform(F.filter(raw.texts(F.col("x.Email")), lambda e: F.contains(e, F.lit("@"))), lambda e: F.concat(F.lit("email_local:"), F.lower(F.substring_index(e, "@", 1))))
    keys = F.concat(F.array(_said("slug", casefold(F.trim("x.ID"))), _said("name", casefold(collapse("x.Name"))), _said("name_key", name_key("x.Name"))), local)
    return each.select("department_id", F.explode(F.array_distinct(F.filter(keys, lambda k: k.isNotNull()))).alias("key"))


def teacher_departments(pages: DataFrame, codes: DataFrame) -> DataFrame:
    """(key, department_id) of the address book's pages (url, results) of structures (code, department_id), only keys of one department."""
    code = F.regexp_extract(urls.query(F.col("url")), "structuretree=([0-9]+)", 1)
    return unique_only(_book_keys(pages.withColumn("code", code).join(codes, "code")), "key", "department_id")


def department_map(departments: DataFrame, bodies: DataFrame, most: int | None = 10) -> DataFrame:
    """(key, department_id): what tells a department's teachers, learned from its own site, only keys of one department.

    Two worklists, each of which asks, reads and asks again until nothing is new.  The first reads at most `most` pages from each of a
    department's addresses: a page that names structures ends there, others lead on by their links to staff.  The second reads the address
    book of each structure to its end.  A page's own keys count if it names no structure.  Departments without an address have no keys.
    """
    at = departments.where("department_id is not null and department_id <> ''").select("department_id", F.explode(F.array("website_url", "source_url")).alias("u"))
    seeds = at.select("department_id", F.explode(urls.people_seeds(F.col("u"))).alias("url")).distinct()
    mine = seeds.select(urls.site(F.col("url")).alias("_site")).distinct()
    pages = bodies.withColumn("_site", urls.site(F.col("url"))).join(mine, "_site", "left_semi")
    codes = F.array_distinct(F.concat(*[F.regexp_extract_all("body", F.lit(p), F.lit(1)) for p in raw.STRUCTURE_CODES]))
    pages = cut(pages.select("url", "body", codes.alias("codes")))
    href = F.trim(F.col("attrs")["href"])
    links = markup.nodes(pages.where("size(codes) = 0").select("url", "body"), "url", "body", ("a",)).select("url", href.alias("href"), "text").where("href <> ''")
    mail = F.startswith("href", F.lit("mailto:"))
    links = cut(links.withColumn("to", F.when(~mail, urls.absolute(F.col("url"), F.col("href")))).where(mail | urls.scheme(F.col("to")).isin("http", "https")))
    said = lambda c: F.exists(F.array(*map(F.lit, urls.STAFF)), lambda x: F.contains(c, x))
    low, onward = casefold(F.col("text")), urls.without_fragment(F.col("to"))
    staff = said(low) | said(casefold(F.col("to"))) | urls.leads_to_people(F.col("url"), F.col("to"), low)
    leads = links.where(F.col("to").isNotNull() & (urls.site(F.col("to")) == urls.site(F.col("url"))) & staff).select("url", onward.alias("target")).distinct()
    read = requests.worklist(seeds.select(F.struct("department_id", F.col("url").alias("first")).alias("seed"), "url"), lambda x: x.join(leads, "url").select("seed", "place", "target"), most)
    read = read.select("seed.department_id", "url").distinct()
    slug = F.lower(F.trim(F.regexp_extract("to", r"(?i)/storage/teachers/([^/?#]+)/?", 1)))
    address = F.replace("href", F.lit("mailto:"), F.lit(""))
    local = F.when(F.contains(address, F.lit("@")), casefold(F.trim(F.substring_index(address, "@", 1))))
    own = F.when(mail, F.array(_said("email_local", local))).otherwise(F.array(_said("name_key", name_key("text")), _said("slug", slug)))
    found = links.select("url", F.explode(F.filter(own, lambda k: k.isNotNull())).alias("key")).distinct().join(read, "url").select("department_id", "key")
    named = read.join(pages.select("url", F.explode("codes").alias("code")), "url").select("department_id", "code").distinct()
    books = raw.payload_pages(bodies.where(F.contains("url", F.lit(urls.ADDRESS_BOOK.split("?")[0].split("//")[1]))))
    answered = requests.worklist(
        named.select(F.col("code").alias("seed")).distinct().select("seed", F.concat(F.lit(urls.ADDRESS_BOOK), "seed").alias("url")),
        lambda x: x.join(books.select("url", F.col("next").alias("target")), "url").select("seed", "place", "target"),
    )
    results = answered.join(books.select("url", "results"), "url").select(F.col("seed").alias("code"), "results").join(named, "code")
    keys = found.unionByName(_book_keys(results)).unionByName(named.select("department_id", F.concat(F.lit("department_code:"), "code").alias("key")))
    return unique_only(keys.distinct(), "key", "department_id")
