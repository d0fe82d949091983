"""What texts about people, offices, departments and buildings say."""

from __future__ import annotations

from html import unescape as _unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .rooms import cascade, holds
from .text import casefold, collapse, none_if_empty, place_id, slug

# Patterns and words of the source texts.
LINE_ENDS = r"(?i)</p>|</div>|</li>"
LINES = r"[\n\r\x0b\f\x1c-\x1e\x85\x{2028}\x{2029}]+"
MEETING_URL = r"(?iU)https://teams\.microsoft\.com/[^\s<\">]+"
MEETING_CODE = r"(?iU)\bcodice(?:\s+canale)?(?:\s*:\s*|\s+)([a-z0-9]{5,10})\b"
LONE_CODE = r"(?i)^(?=.*[a-z])(?=.*[0-9])[a-z0-9]{5,10}$"
LINK_ONLY = r"(?i)^(link(?::.*| al team.*:)?|link per team.*:|codice e link.*:|oppure|si può accedere tramite link|o tramite il codice)$"
AT_ADDRESS = r"(?iU),?\s+all'indirizzo\s*$"
OFFICE_NOTE = r"(?iU)^\s*Office:\s*([^|]+?)\s*\|\s*Office references:\s*(.+?)\s*$"
REFERENCE_NOTE = r"(?iU)^\s*Office references:\s*(.+?)\s*$"
REFERENCE_IN_NOTES = r"(?iU)Office references:\s*([^|]+)"
OFFICE_WORDS = ("cubo", "piano", "stanza", "edificio", "capannone", "polifunzionale", "orto botanico", "centro sanitario", "centro linguistico")
DEPARTMENT_CUTS = ("-dip", "-dipartimento", "-di", "-desf", "-dices", "-diam", "-dimes")
WIFI = r"(?iU)\baule/zone coperte da wifi\s*:"
MAP_NOTE = r"(?iU)^(landmark|building)\s+on\s+official\s+unical\s+campus\s+map\b"
STOPS = (
    r"(?iU)\b(link informativo|link portale|uffici strutture presenti|piano terra|primo piano|secondo piano|terzo piano|quarto piano|quinto piano|sesto piano|settimo piano|altra collocazione|evento|zona copertura outdoor)\s*:.*$"
)
LOW_SIGNAL = ("area di pertinenza", "link: descrizione", "uffici", "blocco x", "blocco 11", "palazzo a")
BUILDING_NAME = r"(?iU)^(Cubo\s+[0-9A-Z]+|Cubi\s+[0-9A-Z-]+[A-Z]?)(?:\s|-|$)"
ACRONYM = r"(?U)\b([A-Z][A-Za-z]{2,8})\b"
DOMAIN = ".unical.it"


def unescape(c) -> Column:
    """Character references replaced; Spark has no function for it."""

    @F.pandas_udf("string")
    def replaced(pages: pd.Series) -> pd.Series:
        return pages.map(lambda x: _unescape(x) if isinstance(x, str) else None)

    return replaced(c)


def segments(c) -> Column:
    """Lines of HTML without tags.  Only ends of p, div and li part lines; a br is a blank."""
    plain = F.regexp_replace(F.regexp_replace(c, LINE_ENDS, "\n"), "<[^>]+>", " ")
    return F.filter(F.transform(F.split(plain, LINES), collapse), lambda x: x != "")


def html_lines(c) -> Column:
    """Text of HTML in one line, with a dot between what were lines."""
    plain = unescape(F.regexp_replace(F.regexp_replace(c, LINE_ENDS, "\n"), "<[^>]+>", " "))
    return F.array_join(F.filter(F.transform(F.split(plain, LINES), collapse), lambda x: x != ""), " • ")


def meeting_url(c) -> Column:
    return none_if_empty(F.regexp_extract(c, MEETING_URL, 0))


def meeting_code(c) -> Column:
    """The code after `codice`, else a line that is nothing but a code."""
    lone = F.get(F.filter(segments(c), lambda x: F.rlike(x, F.lit(LONE_CODE))), F.lit(0))
    return F.coalesce(F.nullif(F.regexp_extract(c, MEETING_CODE, 1), F.lit("")), lone)


def meeting_hours(c) -> Column:
    """The lines that are left without addresses, codes and what introduces them."""
    odd = lambda x: F.rlike(x, F.lit(LINK_ONLY)) | F.rlike(x, F.lit(LONE_CODE)) | (F.contains(casefold(x), F.lit("microsoft teams")) & F.contains(x, F.lit("|")))
    bare = lambda x: collapse(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, MEETING_URL, ""), MEETING_CODE, ""), AT_ADDRESS, ""))
    return F.nullif(F.array_join(F.filter(F.transform(F.filter(segments(c), lambda x: ~odd(x)), bare), lambda x: x != ""), " • "), F.lit(""))


def opening_hours(c) -> Column:
    """Hours as they are where they name a meeting or hold bars, else without tags."""
    return F.when(F.contains(casefold(c), F.lit("teams")) | F.contains(c, F.lit("|")), collapse(c)).otherwise(html_lines(c))


def note(notes, reference) -> tuple[Column, Column]:
    """(notes, office reference): `Office: x | Office references: y` is parted, a bare reference leaves no notes."""
    n, r = none_if_empty(notes), none_if_empty(reference)
    both, only = F.rlike(n, F.lit(OFFICE_NOTE)), F.rlike(n, F.lit(REFERENCE_NOTE))
    left = cascade([(n.isNull(), F.lit(None)), (both, none_if_empty(F.regexp_extract(n, OFFICE_NOTE, 1))), (only, F.lit(None))], n)
    ref = cascade([(both, none_if_empty(F.regexp_extract(n, OFFICE_NOTE, 2))), (only, none_if_empty(F.regexp_extract(n, REFERENCE_NOTE, 1)))], r)
    return left, F.coalesce(ref, r)


def office_reference(reference, notes) -> Column:
    return F.coalesce(none_if_empty(reference), none_if_empty(F.regexp_extract(notes, REFERENCE_IN_NOTES, 1)))


def is_office(reference) -> Column:
    """Whether a reference names a place and not just any words."""
    return F.coalesce(holds(casefold(collapse(reference)), OFFICE_WORDS), F.lit(False))


def office_id(reference) -> Column:
    return place_id(F.lit("OFFICE"), F.concat(F.lit("Ufficio "), reference))


def office_part(reference, word: str, label: str) -> Column:
    """`Piano x` or `Stanza x` of a reference."""
    found = F.regexp_extract(reference, rf"(?iU)\b{word}\s*([0-9a-z]+)\b", 1)
    return F.when(found != "", F.concat(F.lit(f"{label} "), found))


def department_key(name) -> Column:
    """Slug without the listed parts, cut in order wherever they stand, within words too."""
    out = slug(name)
    for cut in DEPARTMENT_CUTS:
        out = F.replace(out, F.lit(cut), F.lit(""))
    return F.nullif(F.regexp_replace(F.regexp_replace(out, "-+", "-"), "^-|-$", ""), F.lit(""))


def acronyms(name) -> Column:
    """Words of three to nine letters that start with D, four letters at least, in capitals, by place; then what follows the last hyphen."""
    words = F.transform(F.regexp_extract_all(name, F.lit(ACRONYM), F.lit(1)), F.upper)
    tail = F.when(F.contains(name, F.lit("-")), F.regexp_replace(F.upper(F.trim(F.element_at(F.split(name, "-"), -1))), "[^A-Z]", ""))
    return F.array_distinct(F.filter(F.concat(words, F.array(tail)), lambda x: x.isNotNull() & F.startswith(x, F.lit("D")) & (F.length(x) >= 4)))


def url_acronym(url) -> Column:
    tail = F.regexp_replace(F.upper(F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)), "[^A-Z]", "")
    return F.when(F.startswith(tail, F.lit("D")) & (F.length(tail) >= 4), tail)


def domain_alias(domain) -> Column:
    """The part before the campus's domain.  All leading w's and dots go, not just `www.`: web becomes eb."""
    clean = F.regexp_replace(F.trim(F.lower(domain)), r"^[w.]+", "")
    prefix = F.when(F.endswith(clean, F.lit(DOMAIN)), F.regexp_replace(clean, r"\.unical\.it$", ""))
    return F.when((prefix != "") & ~F.contains(prefix, F.lit(".")), prefix)


def building_name(name) -> Column:
    """`Cubo` or `Cubi` and its number in capitals without what follows, else the name as it is."""
    n = none_if_empty(name)
    head = F.regexp_extract(n, BUILDING_NAME, 1)
    return F.when(head != "", F.concat(F.initcap(F.lower(F.substring(head, 1, 4))), F.lit(" "), F.upper(F.regexp_replace(head, r"(?U)^\S+\s+", "")))).otherwise(n)


def building_description(text) -> Column:
    """A description up to the first stop label, null if it only says what maps and coverage lists say."""
    t = none_if_empty(text)
    cut = F.regexp_replace(F.regexp_replace(t, r"(?iU)^\s*descrizione\s*:\s*", ""), STOPS, "")
    clean = F.regexp_replace(F.nullif(F.regexp_replace(cut, r"^[ \-:;,.]+|[ \-:;,.]+$", ""), F.lit("")), r"(?U)\s*-\s*-\s*", " - ")
    return F.when(~F.rlike(t, F.lit(WIFI)) & ~F.rlike(t, F.lit(MAP_NOTE)) & ~casefold(clean).isin(*LOW_SIGNAL), clean)


def building_category(name) -> Column:
    return F.when(F.contains(casefold(name), F.lit("mensa")), F.lit("MENSA"))


# Parts of names of what maps show besides buildings, and of buildings.
NO_BUILDING = ("fontanella", "parcheggio", "pensiline", "terminal bus", "wifi", "copertura", "strada", "casetta dell'acqua", "bar ", "banca ", "campo ")
A_BUILDING = ("aula magna", "teatro", "anfiteatro", "biblioteca", "mensa", "residenza", "quartiere", "maisonnettes", "palestra", "rettorato", "centro", "museo", "cla", "capannone", "polifunzionale", "orto botanico", "ampliamento polifunzionale", "stabilario")


def is_building(name) -> Column:
    """Whether a map's name is a building's: no parking area or other mark, and a numbered block or one of the kinds."""
    t = casefold(name)
    return F.coalesce(~F.rlike(t, F.lit(r"(?U)^p[0-9]+\b")) & ~holds(t, NO_BUILDING) & (F.rlike(t, F.lit("^cub[oi] ")) | holds(t, A_BUILDING)), F.lit(False))
