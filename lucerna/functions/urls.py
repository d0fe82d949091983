"""URL parts and canonical forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(c) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#:]+)", 1))


def path(c) -> Column:
    return F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)


def canonical(c, depth: int) -> Column:
    """Host and at most `depth` segments of the path; null without a host."""
    parts = F.slice(F.filter(F.split(path(c), "/"), lambda x: x != ""), 1, depth)
    return F.when(host(c) != "", F.concat_ws("/", host(c), F.array_join(parts, "/")))


def local_part(email) -> Column:
    return F.lower(F.substring_index(F.trim(email), "@", 1))


# Prefixes of paths with the segments that their pages keep, parts that no page of a service has, words of other pages.
MUSEUM = ("campus", "vivere-il-campus", "sistema-museale")
FAMILIES = (("campus", "vivere-il-campus"), ("campus", "servizi"), ("didattica", "diritto-allo-studio"), ("ateneo", "servizi"))
BLOCKED = ("contents", "news", "calendars", "events", "eventi", "archivio", "documentazione", "unicalfesta", "festival", "seminari", "step", "modulistica", "viewer", "accesso-ai-musei")
SERVICE_PARTS = ("segreter", "servizi", "service", "ufficio")
TEACHERS_API = r"(?i)((?:(?:https?:)?//[^\"'\s>]*?)?/api/ricerca/teachers/?(?:\?[^\"'\s>]*)?)"
STRUCTURES_API = "/api/ricerca/structures/"
PEOPLE_PATH = "/dipartimento/presentazione/persone"
DEPARTMENT_SITES = ".unical.it"
STAFF = ("docent", "ricerc", "person", "people", "staff", "professor", "fascia", "assegn", "dottor")
ADDRESS_BOOK = "https://storage.portale.unical.it/api/ricerca/addressbook/?structuretree="


def _any(c, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def scheme(c) -> Column:
    return F.lower(F.regexp_extract(c, "^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))


def site(c) -> Column:
    """Host with its port, as written."""
    return F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def query(c) -> Column:
    return F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)


def segments(c) -> Column:
    return F.filter(F.split(path(c), "/"), lambda x: x != "")


def without_query(c) -> Column:
    return F.regexp_replace(c, r"[?#].*$", "")


def without_fragment(c) -> Column:
    return F.regexp_replace(c, "#.*$", "")


def _resolved(parts: Column) -> Column:
    """A path's segments without `.`, and without `..` and what it takes back."""
    start = F.array().cast("array<string>")
    return F.aggregate(parts, start, lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))))


def absolute(base, href) -> Column:
    """href as seen from the page base: addresses stay, `//host`, `/path`, `?query`, `#part` and relative paths take what they lack from base."""
    own, root = scheme(base), F.concat(scheme(base), F.lit("://"), site(base))
    folder, page = F.regexp_replace(path(base), "[^/]*$", ""), F.nullif(path(base), F.lit(""))
    whole = F.concat(F.when(folder == "", "/").otherwise(folder), F.regexp_replace(href, r"[?#].*$", ""))
    raw = F.when(F.startswith(href, F.lit("/")), F.regexp_replace(href, r"[?#].*$", "")).otherwise(whole)
    parts = F.slice(F.split(raw, "/"), 2, 1 << 30)
    tidy = F.concat(F.lit("/"), F.array_join(_resolved(parts), "/"), F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit("")))
    rest = F.regexp_extract(href, r"([?#].*)$", 1)
    return (
        F.when(href == "", base)
        .when(F.rlike(href, F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(own, F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(without_fragment(base), href))
        .when(F.startswith(href, F.lit("?")), F.concat(root, F.coalesce(page, F.lit("")), href))
        .otherwise(F.concat(root, F.regexp_replace(tidy, "^//", "/"), rest))
    )


def with_param(c, name: str, value: str) -> Column:
    """The address with one query parameter set: in its place, last if it is new; of repeated ones the last stays."""
    pairs = F.filter(F.split(query(c), "&"), lambda x: F.contains(x, F.lit("=")))
    keys = F.transform(pairs, lambda x: F.substring_index(x, "=", 1))
    last = F.transform(F.array_distinct(keys), lambda k: F.element_at(F.filter(pairs, lambda x: F.substring_index(x, "=", 1) == k), -1))
    put = F.transform(last, lambda x: F.when(F.substring_index(x, "=", 1) == name, F.lit(f"{name}={value}")).otherwise(x))
    new = F.when(F.array_contains(keys, name), put).otherwise(F.concat(put, F.array(F.lit(f"{name}={value}"))))
    return F.concat(without_query(c), F.lit("?"), F.array_join(new, "&"), F.regexp_extract(c, "(#.*)$", 1))


def service_url(c) -> Column:
    """The page of a service that an address belongs to: its path cut to the segments of its family; null for pages that are no service's."""
    parts = F.transform(segments(c), lambda x: F.lower(x))
    whole, n = F.array_join(parts, "/"), F.size(parts)
    starts = lambda *p: F.array_join(F.slice(parts, 1, len(p)), "/") == "/".join(p)
    museum = F.when(n == 3, 3).when((F.get(parts, F.lit(3)) == "musnob") & (n >= 5), 5).otherwise(4)
    family = F.lit(False)
    for p in FAMILIES:
        family = family | starts(*p)
    keep = F.when(starts(*MUSEUM), museum).when(family, F.when(n >= 3, 3)).when(F.get(parts, F.lit(0)) == "servizi-ict", F.least(n, F.lit(2))).when(_any(whole, SERVICE_PARTS), 3)
    fine = scheme(c).isin("http", "https") & (n > 0) & ~starts("media", "medias") & ~_any(whole, BLOCKED)
    return F.when(fine & keep.isNotNull(), F.concat(scheme(c), F.lit("://"), site(c), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), keep), "/"), F.lit("/")))


def title_case(c) -> Column:
    """Every letter after none in capitals, the others small: after apostrophes and digits too."""
    parts = F.regexp_extract_all(c, F.lit(r"(?U)(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda x: F.initcap(F.lower(x))), "")


def service_name(c) -> Column:
    """The last segment of an address as a title."""
    leaf = F.trim(F.translate(F.element_at(F.concat(F.array(F.lit("")), segments(c)), -1), "-_", "  "))
    return F.when(leaf != "", title_case(leaf))


def teachers_api(html, base) -> Column:
    """The first address of the teachers' interface in a page, absolute, as JSON; null without one."""
    found = F.regexp_replace(F.regexp_extract(html, TEACHERS_API, 1), "[),;]+$", "")
    return F.when(found != "", with_param(absolute(base, found), "format", "json"))


def departments_api(text, base) -> Column:
    """The address of the departments' interface that a text holds, up to the next quote; null without one."""
    at = F.when(F.instr(text, "http") > 0, F.instr(text, "http")).otherwise(F.instr(text, STRUCTURES_API))
    said = F.regexp_replace(F.trim(F.substring_index(F.substring(text, at, F.lit(1 << 30)), '"', 1)), "^'+|'+$", "")
    return F.when(F.contains(text, F.lit(STRUCTURES_API)) & F.contains(said, F.lit(STRUCTURES_API)), absolute(base, said))


def teacher_url(base, email, ident) -> Column:
    """A teacher's page by the local part of the address, else by id."""
    local = F.when(F.contains(email, F.lit("@")), F.nullif(F.trim(F.substring_index(email, "@", 1)), F.lit("")))
    named = F.coalesce(local, F.nullif(ident, F.lit("")))
    return F.when(named.isNotNull(), absolute(base, F.concat(F.lit("/storage/teachers/"), F.replace(F.url_encode(named), F.lit("+"), F.lit("%20")), F.lit("/"))))


def teacher_detail(api, ident) -> Column:
    """The address that the teachers' interface gives a teacher's details at; null without an id."""
    quoted = F.replace(F.regexp_replace(F.replace(F.url_encode(ident), F.lit("+"), F.lit("%20")), r"\*", "%2A"), F.lit("%7E"), F.lit("~"))
    return F.concat(scheme(api), F.lit("://"), site(api), F.regexp_replace(path(api), "/+$", ""), F.lit("/"), F.nullif(quoted, F.lit("")), F.lit("/?format=json"))


def people_seeds(c) -> Column:
    """Where a department's own site is read from: its address up to the path, and its lists of people; none for other sites."""
    root = F.concat(scheme(c), F.lit("://"), site(c))
    lists = [F.concat(root, F.lit(f"{PEOPLE_PATH}/{x}")) for x in ("", "?lang=it")]
    own = F.concat(root, F.regexp_replace(path(c), "/?$", "/"))
    return F.when(scheme(c).isin("http", "https") & F.endswith(site(c), F.lit(DEPARTMENT_SITES)), F.array_distinct(F.array(own, *lists))).otherwise(F.array().cast("array<string>"))


def leads_to_people(page, link, text) -> Column:
    """Whether a link is one of a list of people: to it, or from it to a further page."""
    here, there = F.contains(F.lower(path(page)), F.lit(PEOPLE_PATH)), F.contains(F.lower(path(link)), F.lit(PEOPLE_PATH))
    return there | (here & (F.contains(F.lower(query(link)), F.lit("page=")) | F.contains(text, F.lit("next")) | F.contains(text, F.lit("precedent"))))
