"""From raw rows to datasets.  Raw tables carry `ordinal`, the order in which their rows were found; the first of a key stays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions.text import casefold, collapse, made, name_key, none_if_empty, person_id, place_id, slug
from ..functions.urls import host, local_part
from .dedupe import first_wins
from .lookup import priority_lookup, unique_only
from .places import buildings_in_text

#: Fixed value: the shortest building slug that is looked for inside references.
LEAST_SLUG = 8


def _given(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _with(rows: DataFrame, column: str, value: Column) -> DataFrame:
    """rows with a generated column.  A filter on a plain one is evaluated before rows are dealt over the cores: a whole file in one task."""
    return rows.select(*[c for c in rows.columns if c != column], made(value).alias(column))


def _stamp(source: str, at: str) -> list[Column]:
    return [F.lit(source).alias("source_id"), F.col("source_url"), F.lit(at).alias("last_verified_at")]


def buildings(raw: DataFrame, source: str, at: str) -> DataFrame:
    """building_id, name, category, description, coordinates to seven places."""
    rows = _with(raw, "_called", P.building_name("name")).where("_called is not null")
    rows = _with(rows, "building_id", slug("_called")).where("building_id <> ''")
    rows = first_wins(rows, ["building_id"], ["ordinal"])
    return rows.select("building_id", F.col("_called").alias("name"), P.building_category("_called").alias("category"), P.building_description("description").alias("description"), F.bround("lat", 7).alias("lat"), F.bround("lng", 7).alias("lng"), *_stamp(source, at))


def departments(raw: DataFrame, source: str, at: str) -> DataFrame:
    rows = _with(raw, "_called", none_if_empty("name")).where("_called is not null")
    rows = _with(rows, "department_id", slug("_called")).where("department_id <> ''")
    return first_wins(rows, ["department_id"], ["ordinal"]).select("department_id", F.col("_called").alias("name"), _given("email").alias("email"), _given("phone").alias("phone"), _given("website_url").alias("website_url"), *_stamp(source, at))


def services(raw: DataFrame, source: str, at: str) -> DataFrame:
    """Places of the service's type, SERVICE by default."""
    rows = _with(raw, "_called", none_if_empty("name")).where("_called is not null").withColumn("_t", F.coalesce(_given("service_type"), F.lit("SERVICE"))).withColumn("place_id", place_id(F.col("_t"), F.col("_called")))
    kept = first_wins(rows, ["place_id"], ["ordinal"])
    return kept.select("place_id", F.col("_t").alias("type"), F.col("_called").alias("name"), *[_given(c).alias(c) for c in ("description", "email", "phone", "website_url", "opening_hours")], *_stamp(source, at))


def department_keys(departments: DataFrame) -> DataFrame:
    """(kind, key, value) that departments are found by: id, name, acronym, domain.  The smallest id takes a key that several have."""
    d = departments.where("department_id is not null")
    named = d.where("name is not null")
    words = F.array_distinct(F.filter(F.concat(P.acronyms(F.col("name")), F.array(P.url_acronym("source_url"))), lambda x: x.isNotNull()))
    short = named.select(F.explode(words).alias("key"), F.col("department_id").alias("value"))
    physics = named.where(F.contains(casefold(F.col("name")), F.lit("fisica"))).select(F.lit("fis").alias("key"), F.col("department_id").alias("value"))
    kinds = {
        "id": d.select(F.col("department_id").alias("key"), F.col("department_id").alias("value")),
        "name": named.select(P.department_key("name").alias("key"), F.col("department_id").alias("value")),
        "acronym": short,
        "domain": short.select(F.lower("key").alias("key"), "value").unionByName(physics),
    }
    out = None
    for kind, rows in kinds.items():
        one = rows.where("key is not null").groupBy("key").agg(F.min("value").alias("value")).select(F.lit(kind).alias("kind"), "key", "value")
        out = one if out is None else out.unionByName(one)
    return out


def resolve_department(rows: DataFrame, keys: DataFrame, name: str, email: str, url: str, found: str) -> DataFrame:
    """The department that a raw name, else an address or a site means: id, name, acronym, an acronym within by place, domains."""
    n = F.col("_n")
    looked = {"id": slug(n), "name": P.department_key(n), "acronym": F.upper(n), "mail": P.domain_alias(F.get(F.split(email, "@", 2), F.lit(1))), "site": P.domain_alias(host(url))}
    sites = keys.where("kind = 'domain'")
    side = keys.where("kind <> 'domain'").unionByName(sites.withColumn("kind", F.lit("_mail"))).unionByName(sites.withColumn("kind", F.lit("_site"))).withColumn("kind", F.regexp_replace("kind", "^(?!_)", "_"))
    out = _with(rows, "_n", none_if_empty(name)).withColumns({f"_{k}": v for k, v in looked.items()})
    out = _with(out, "_within", P.acronyms(n)).drop("_n")
    # the acronyms of distinct names only are looked up, so a frequent name costs no more than a rare one
    each = out.where("size(_within) > 0").select("_within").distinct().select("_within", F.posexplode("_within").alias("_i", "key"))
    first = each.join(keys.where("kind = 'acronym'").select("key", "value"), "key").groupBy("_within").agg(F.min_by("value", "_i").alias("_by_word"))
    out = priority_lookup(out.join(first, "_within", "left"), ["_id", "_name", "_acronym"], side, "_a")
    out = priority_lookup(out, ["_mail", "_site"], side, "_b")
    return out.withColumn(found, F.coalesce("_a", "_by_word", "_b")).drop("_id", "_name", "_acronym", "_mail", "_site", "_within", "_by_word", "_a", "_b")


def teacher_keys(rows: DataFrame) -> DataFrame:
    """rows with the keys that a map of teachers may hold: department_code, slug and its encoded form, email_local, name, name_key."""
    of = F.lower(F.trim(F.url_decode(F.regexp_replace(F.regexp_extract(F.coalesce(_given("website_url"), "source_url"), r"(?i)/storage/teachers/([^/?#]+)", 1), r"\+", "%2B"))))
    coded = F.lower(F.regexp_replace(F.replace(F.url_encode(of), F.lit("+"), F.lit("%20")), r"\*", "%2A"))
    return rows.withColumns({"_code": _given("department_code"), "_slug": F.nullif(of, F.lit("")), "_coded": F.nullif(coded, F.lit("")), "_local": F.when(F.contains("email", F.lit("@")), F.nullif(local_part("email"), F.lit(""))), "_full": F.nullif(casefold(collapse("full_name")), F.lit("")), "_key": name_key("full_name")})


def people(raw: DataFrame, departments: DataFrame | None, teachers: DataFrame | None, source: str, at: str) -> DataFrame:
    """Professors with id, department, office and notes.  Without departments the id is made from the raw name; teachers is (key, department_id)."""
    rows = _with(raw, "full_name", none_if_empty("full_name")).where("full_name is not null")
    rows = resolve_department(rows, department_keys(departments), "department_name", "email", "website_url", "_d") if departments is not None else rows.withColumn("_d", F.nullif(slug("department_name"), F.lit("")))
    if teachers is not None:
        # each kind is told by a plain prefix and has its own branch, so a lookup reads the map once and matches no pattern
        names = {"_code": "department_code", "_slug": "slug", "_coded": "slug", "_local": "email_local", "_full": "name", "_key": "name_key"}
        typed = [teachers.where(F.startswith("key", F.lit(f"{x}:"))).select(F.lit(k).alias("kind"), F.substring("key", len(x) + 2, 1 << 30).alias("key"), F.col("department_id").alias("value")) for k, x in names.items()]
        typed = reduce(DataFrame.unionByName, typed)
        rows = priority_lookup(teacher_keys(rows), ["_code", "_slug", "_coded", "_local", "_full", "_key"], typed, "_t").withColumn("_d", F.coalesce("_d", "_t"))
    notes, reference = P.note(F.col("notes"), F.col("office_reference"))
    office = P.office_reference(F.col("office_reference"), F.col("notes"))
    rows = _with(rows, "person_id", person_id(F.col("full_name"), F.col("email"))).where("person_id is not null")
    kept = first_wins(rows, ["person_id"], ["ordinal"])
    return kept.select("person_id", "full_name", F.lit("PROFESSOR").alias("role"), F.lower(_given("email")).alias("email"), _given("phone").alias("phone"), F.col("_d").alias("department_id"), _given("website_url").alias("website_url"), none_if_empty("office_hours").alias("office_hours"), F.when(P.is_office(office), P.office_id(office)).alias("office_place_id"), notes.alias("notes"), reference.alias("office_reference_text"), *_stamp(source, at))


def offices(raw: DataFrame, buildings: DataFrame, meetings: tuple[str, ...], source: str, at: str) -> DataFrame:
    """OFFICE places of the references that name one, the first of an id.  The building is the only one that the reference names by number or name."""
    ref = P.office_reference(F.col("office_reference"), F.col("notes"))
    rows = _with(raw, "_ref", ref).where(P.is_office(F.col("_ref"))).withColumn("place_id", P.office_id(F.col("_ref")))
    rows = first_wins(rows, ["place_id"], ["ordinal"]).withColumn("_s", slug("_ref"))
    refs = rows.select("place_id", "_ref", "_s")
    named = buildings_in_text(refs, "place_id", "_ref", buildings)
    # names are found by an equi join on runs of whole and partial slugs of their lengths, not by testing every pair
    b = buildings.select(F.col("building_id").alias("building"), slug("name").alias("_w")).where(F.length("_w") >= LEAST_SLUG)
    lengths = b.agg(F.collect_set(F.length("_w")).alias("_ls"))
    runs = refs.join(F.broadcast(lengths)).select("place_id", F.explode(F.flatten(F.transform("_ls", lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("_s") - n + 1, F.lit(1))), lambda i: F.substring("_s", i, n))))).alias("_w")).distinct()
    told = named.unionByName(runs.join(b, "_w").select("place_id", "building"))
    health = buildings.where("building_id = 'centro-sanitario'").select(F.col("building_id").alias("building"), F.lit(True).alias("_h")).distinct()
    told = told.unionByName(refs.where(F.contains(casefold(F.col("_ref")), F.lit("centro sanitario"))).withColumn("_h", F.lit(True)).join(health, "_h").select("place_id", "building"))
    out = rows.join(unique_only(told, "place_id", "building").withColumnRenamed("building", "building_id"), "place_id", "left")
    meets, hours = F.col("place_id").isin(*meetings), P.unescape(F.col("office_hours"))
    about, reference = P.note(F.col("notes"), F.col("_ref"))
    return out.select("place_id", F.lit("OFFICE").alias("type"), F.concat(F.lit("Ufficio "), "_ref").alias("name"), "building_id", P.office_part(F.col("_ref"), "piano", "Piano").alias("floor"), P.office_part(F.col("_ref"), "stanza", "Stanza").alias("room"), F.when(meets, P.meeting_hours(hours)).otherwise(F.nullif(P.opening_hours(F.col("office_hours")), F.lit(""))).alias("opening_hours"), F.when(meets, P.meeting_url(hours)).alias("meeting_url"), F.when(meets, P.meeting_code(hours)).alias("meeting_code"), about.alias("description"), reference.alias("office_reference_text"), *_stamp(source, at))


def keep_others(existing: DataFrame, new: DataFrame, source: str, key: str) -> DataFrame:
    """Rows of other sources stay and win over new ones of their id."""
    others = existing.where(~F.col("source_id").eqNullSafe(F.lit(source)))
    return others.unionByName(new.join(others.select(key), key, "left_anti"), allowMissingColumns=True)
