"""Queries over texts made for every row: each row takes one of a list of texts by its key, and the SQL says what must come out.

The expected values are those of the contract, not of another program; parts of the row (its name, size, brand) stand within them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people, rooms, services, text, urls
from ..sources.tables import spread, table
from .registry import QUERIES, SQL


def pick(values: list[str], key: str = "p_partkey") -> str:
    """SQL that takes the value for the row's key; both engines read it."""
    return f"case {key} % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


def cases(name: str, found, *rows: tuple) -> None:
    """A query of part: rows are inputs and what comes out, as SQL; found makes the output from the inputs' columns, x0, x1 and so on."""
    inputs = [[r[i] for r in rows] for i in range(len(rows[0]) - 1)]
    expected = [r[-1] for r in rows]

    def run(spark, d) -> DataFrame:
        part = spread(table(spark, d, "part")).select("p_partkey", *[F.expr(pick(v)).alias(f"x{i}") for i, v in enumerate(inputs)])
        return part.select("p_partkey", found(*[F.col(f"x{i}") for i in range(len(inputs))]).alias("found"))

    run.__name__ = run.__qualname__ = name
    QUERIES[name] = run
    SQL[name] = f"select p_partkey, {pick(expected)} as found from part"


def _bar(c: Column) -> Column:
    """An array as one text."""
    return F.array_join(c, "|")


NOTHING = "null"

cases(
    "building_names", people.building_name,
    ("'cubo ' || p_size || 'b - Dipartimento'", "'Cubo ' || p_size || 'B'"),
    ("'CUBI 7-11b'", "'Cubi 7-11B'"),
    ("'  Aula   ' || p_name", "'Aula ' || p_name"),
    ("'Cubo ' || p_size || '-x'", "'Cubo ' || p_size"),
    ("'   '", NOTHING),
    ("p_name", "p_name"),
)

cases(
    "building_descriptions", people.building_description,
    ("'Aule/zone coperte da wifi: ' || p_name", NOTHING),
    ("'Landmark on official Unical campus map'", NOTHING),
    ("'Descrizione: Sede di ' || p_name || '. Piano terra: aule'", "'Sede di ' || p_name"),
    ("'Uffici'", NOTHING),
    ("p_name || ' - - ' || p_brand", "p_name || ' - ' || p_brand"),
    ("'descrizione : ' || p_name || ' ;'", "p_name"),
    ("'Link informativo: ' || p_name", NOTHING),
    (NOTHING, NOTHING),
)

cases(
    "building_kinds", lambda x: F.concat_ws("|", F.coalesce(people.building_category(x), F.lit("-")), people.is_building(x).cast("string")),
    ("'Mensa ' || p_name", "'MENSA|true'"), ("'P' || p_size || ' mensa'", "'MENSA|false'"), ("'Cubo ' || p_size || 'A'", "'-|true'"),
    ("'Fontanella Cubo ' || p_size", "'-|false'"), ("'CUBI 7-11b'", "'-|true'"), ("'Aula ' || p_size", "'-|false'"), ("'Aula  magna'", "'-|false'"), ("'Aula Magna ' || p_name", "'-|true'"),
)

cases(
    "header_rows", lambda a, b: rooms.is_header_row(F.array(a, b)).cast("string"),
    ("'Nome aula'", "'Posti'", "'true'"), ("'Nome aula'", "'Posti ' || p_size", "'false'"), ("'Nome:'", "'Posti'", "'false'"), ("p_name", "p_brand", "'false'"), ("'Capienza'", "repeat('x', 41)", "'false'"), ("'Ubicazione'", "p_type", "'true'"),
)

cases(
    "cells_by_header", lambda a, b: _bar(rooms.cells_at(F.array(a, b, F.lit("c")), rooms.columns_named(F.array(F.lit("Numero posti"), F.lit("Aula"), F.lit("POSTI")), ("posti",)))),
    ("p_name", "'b'", "p_name || '|c'"), ("''", "p_brand", "'c'"), ("'' || p_size", "p_brand", "p_size || '|c'"),
)

cases(
    "room_codes", lambda x: F.concat_ws("|", rooms.is_room_code(x).cast("string"), rooms.is_alias_code(x).cast("string")),
    ("'A' || p_size", "'true|true'"), ("'ab 12 c'", "'true|true'"), ("'' || (10000 + p_size)", "'false|false'"), ("'3B' || p_size", "'true|true'"), ("'AULA'", "'false|false'"),
    ("'AB-12'", "'false|true'"), ("'123ABC4'", "'false|true'"), ("'ABCDE1234X'", "'false|true'"), ("p_name", "'false|false'"), ("''", "'false|false'"),
)

cases(
    "office_references", lambda r, n: F.concat_ws("|", people.is_office(people.office_reference(r, n)).cast("string"), people.office_reference(r, n), people.office_part(people.office_reference(r, n), "piano", "Piano"), people.office_part(people.office_reference(r, n), "stanza", "Stanza")),
    ("' Cubo 3b,  piano ' || p_size", "p_name", "'true|Cubo 3b, piano ' || p_size || '|Piano ' || p_size"),
    ("''", "'Office references: stanza ' || p_size || ' | x'", "'true|stanza ' || p_size || '|Stanza ' || p_size"),
    ("p_name", "''", "'false|' || p_name"), ("''", "p_name", "'false'"),
)

cases(
    "office_notes", lambda n, r: F.concat_ws("|", *[F.coalesce(x, F.lit("-")) for x in people.note(n, r)]),
    ("'Office: ' || p_name || ' | Office references: cubo ' || p_size", "'old'", "p_name || '|cubo ' || p_size"),
    ("'office references:  ' || p_name", "''", "'-|' || p_name"), ("'see ' || p_brand", "p_name", "'see ' || p_brand || '|' || p_name"), ("'  '", "p_name", "'-|' || p_name"), ("p_name", "''", "p_name || '|-'"),
)

cases(
    "room_labels", lambda x: F.concat_ws("|", F.coalesce(rooms.room_label(x), F.lit("-")), F.coalesce(rooms.short_code(x), F.lit("-"))),
    ("'Aula A' || p_size", "'A' || p_size || '|A' || p_size"), ("'aula b c'", "'b c|BC'"), ("'Aula ' || p_name", "p_name || '|-'"), ("p_name", "'-|-'"), ("'AULA  DS ' || p_size", "'DS ' || p_size || '|DS' || p_size"),
)

FLOORS = "['Piano Terra', 'Primo piano', 'Secondo piano', 'Terzo piano', 'Quarto piano', 'Quinto piano', 'Sesto piano', 'Settimo piano']"
cases(
    "floors_of_codes", rooms.floor_from_codes,
    ("'Aula X ponte carrabile'", "''", "''", "''", "'Sesto piano'"), ("'Ponte Pedonale ' || p_name", "''", "''", "''", "'Quarto piano'"),
    ("'CH-30-' || (p_size % 8) || 'B'", "''", "''", "''", f"{FLOORS}[p_size % 8 + 1]"),
    ("'LAB 30A_' || (p_size % 8) || 'P'", "''", "''", "''", f"{FLOORS}[p_size % 8 + 1]"),
    ("''", "'45B0' || (p_size % 10)", "''", "'cubo-45b'", "'Piano Terra'"),
    ("''", "'29B ' || (p_size % 8) || 'A'", "''", "''", f"{FLOORS}[p_size % 8 + 1]"),
    ("'29B 1A e 29B 2A'", "''", "''", "''", NOTHING),
    ("'Aula 31' || 'c' || (p_size % 8)", "''", "''", "'cubo-31c'", f"{FLOORS}[p_size % 8 + 1]"),
    ("p_name", "''", "''", "'cubo-31c'", NOTHING),
)

cases(
    "rooms_in_cells", lambda x: _bar(rooms.room_candidates(x)),
    ("'Aula A' || p_size", "'Aula A' || p_size"), ("'A1; 3B2 , ' || p_name || '/' || 'C' || p_size", "'A1|3B2|C' || p_size"), ("'nel cubo 30B al primo'", "'30B'"), ("p_name", "''"), ("'C' || p_size", "'C' || p_size"),
)

cases(
    "map_room_names", lambda x: F.coalesce(rooms.map_room_name(x), F.lit("-")),
    ("'Aula ' || p_name || ' - Convegno del 3'", "'Aula ' || p_name"), ("'Aula ' || p_name || ' - ' || p_brand", "'Aula ' || p_name || ' - ' || p_brand"), ("p_name", "'-'"), ("'  aula   ' || p_size", "'aula ' || p_size"),
)

cases(
    "outside_room_names", lambda x: F.coalesce(rooms.outside_room_name(x), F.lit("-")),
    ("'Campo da Tennis Aula ' || p_size", "'-'"), ("'Aula ' || p_name", "'Aula ' || p_name"), ("'la  Aula B' || p_size || '!'", "'Aula B' || p_size"), ("'ds ' || p_size", "'Aula DS' || p_size"), ("p_name", "'-'"), ("''", "'-'"),
)

cases(
    "department_room_names", lambda x: F.coalesce(rooms.department_room_name(x), F.lit("-")),
    ("'DIMES 4' || 'A ' || p_size", "'Aula 4A' || p_size"), ("'Laboratorio di ' || p_name", "'Laboratorio di ' || p_name"), ("'Help Desk ' || p_size", "'-'"), ("p_name", "'Aula ' || p_name"), ("repeat('x', 81)", "'-'"), ("'a*' || p_name", "'-'"),
)

cases(
    "planner_room_names", lambda x: F.coalesce(rooms.planner_room_name(x), F.lit("-")),
    ("p_name", "p_name"), ("'Padel ' || p_size", "'-'"), ("'A' || p_size", "'Aula A' || p_size"), ("repeat('x', 101)", "'-'"), ("'a*' || p_name", "'-'"), ("'Aula ' || p_size || ' - giorni pari'", "'Aula ' || p_size"),
)

cases(
    "heading_kinds", lambda x: F.concat_ws("|", rooms.is_entry_name(x).cast("string"), rooms.is_laboratory_heading(x).cast("string"), rooms.tells_location(x).cast("string"), rooms.tells_room(F.array(x, F.lit(""))).cast("string")),
    ("'Aula ' || p_name", "'true|true|false|true'"), ("'Aule per ' || p_name", "'false|false|false|false'"), ("'Laboratorio ' || p_name", "'true|true|false|false'"), ("'B' || p_size", "'true|true|false|true'"),
    ("'Ubicazione: cubo 30B'", "'false|false|true|true'"), ("'Posti ' || p_size", "'false|true|true|false'"), ("repeat('x', 81)", "'false|false|false|false'"), ("''", "'false|false|false|false'"),
)

cases(
    "floor_segments", lambda x: _bar(F.transform(rooms.floor_segments(x), lambda s: F.concat(s.floor, F.lit("="), _bar(rooms.segment_rooms(s.text))))),
    ("'intro PIANO terra: Aula A' || p_size || ', Primo piano (nord): ' || p_name || ' secondo piano:  '", "'Piano Terra=Aula A' || p_size || '|Primo piano='"),
    ("p_name", "''"), ("'Altra collocazione : Aula ' || p_size || ' Evento x; Aula B'", "'Altra collocazione=Aula ' || p_size || '|Aula B'"),
)

cases(
    "meetings", lambda x: F.concat_ws("|", F.coalesce(people.meeting_url(x), F.lit("-")), F.coalesce(people.meeting_code(x), F.lit("-")), F.coalesce(people.meeting_hours(x), F.lit("-")), people.opening_hours(x)),
    ("'<p>Mon ' || p_size || '</p><p>codice: ab12' || (100 + p_size) || '</p>'", "'-|ab12' || (100 + p_size) || '|Mon ' || p_size || '|Mon ' || p_size || ' • codice: ab12' || (100 + p_size)"),
    ("p_name || ' https://teams.microsoft.com/l/' || p_size || ' x'", "'https://teams.microsoft.com/l/' || p_size || '|-|' || p_name || ' x|' || p_name || ' https://teams.microsoft.com/l/' || p_size || ' x'"),
    ("'<div>' || p_name || '<br>' || p_brand || '</div>oppure'", "'-|-|' || p_name || ' ' || p_brand || '|' || p_name || ' ' || p_brand || ' • oppure'"),
    ("'a &amp; ' || p_size", "'-|-|a &amp; ' || p_size || '|a & ' || p_size"),
)

cases(
    "department_names", lambda x: F.concat_ws("|", F.coalesce(people.department_key(x), F.lit("-")), _bar(people.acronyms(x))),
    ("'Dipartimento di Fisica - DIFIS'", "'dipartimento-fisicafis|DIFIS'"), ("p_name", "replace(p_name, ' ', '-') || '|'"), ("'Scienze - DES'", "'scienze-des|'"), ("'Dimes x'", "'dimes-x|DIMES'"),
)

cases(
    "domain_names", lambda x: F.coalesce(people.domain_alias(x), F.lit("-")),
    ("'www.DIMES.unical.it'", "'dimes'"), ("'web.unical.it'", "'eb'"), ("'a.b.unical.it'", "'-'"), ("'unical.it'", "'-'"), ("'d' || p_size || '.unical.it'", "'d' || p_size"),
)

cases(
    "romans", lambda x: text.roman(x).cast("long"),
    ("'XIV'", "cast(14 as bigint)"), ("'mcmxciv'", "cast(1994 as bigint)"), ("'VII'", "cast(7 as bigint)"), ("repeat('I', p_size % 4 + 1)", "cast(p_size % 4 + 1 as bigint)"), ("'IX'", "cast(9 as bigint)"),
)

cases(
    "folded_texts", lambda x: F.concat_ws("|", text.slug(x), text.casefold(x), F.coalesce(text.none_if_empty(x), F.lit("-"))),
    ("'Ștefan Nguyễn ' || p_size", "'stefan-nguyen-' || p_size || '|ștefan nguyễn ' || p_size || '|Ștefan Nguyễn ' || p_size"),
    ("'oﬃce Straße'", "'office-strae|office strasse|oﬃce Straße'"), ("'x² ½ ĳ ΣΟΦΟΣ'", "'x2-12-ij|x² ½ ĳ σοφοσ|x² ½ ĳ ΣΟΦΟΣ'"), ("' ' || p_name || '  '", "replace(p_name, ' ', '-') || '| ' || p_name || '  |' || p_name"), ("'Łódź ' || p_brand", "'odz-' || replace(lower(p_brand), '#', '-') || '|łódź ' || lower(p_brand) || '|Łódź ' || p_brand"),
)

cases(
    "room_tokens", lambda n, c, r: F.array_join(text.room_tokens(n, c, r, F.lit("Cubo-1")), " "),
    ("'Aula ' || p_name", "'A1'", "'Room ' || p_size", "array_to_string(list_sort(list_distinct(['aula-' || replace(p_name, ' ', '-'), 'aula' || replace(p_name, ' ', ''), replace(p_name, ' ', '-'), replace(p_name, ' ', ''), 'a1', 'room-' || p_size, 'room' || p_size, 'cubo-1'])), ' ')"),
    ("'X'", "''", "''", "'cubo-1 x'"),
)

B = "'https://www.unical.it/campus/servizi/x?y=1'"
cases(
    "absolute_urls", urls.absolute,
    (B, "'/a/' || p_size", "'https://www.unical.it/a/' || p_size"), (B, "'b/' || p_size || '?q=1'", "'https://www.unical.it/campus/servizi/b/' || p_size || '?q=1'"), (B, "'//h.it/' || p_size", "'https://h.it/' || p_size"),
    (B, "'http://h.it/' || p_size", "'http://h.it/' || p_size"), (B, "'../' || p_size || '/'", "'https://www.unical.it/campus/' || p_size || '/'"), (B, "'?z=' || p_size", "'https://www.unical.it/campus/servizi/x?z=' || p_size"),
    (B, "'#' || p_size", "'https://www.unical.it/campus/servizi/x?y=1#' || p_size"), (B, "''", "'https://www.unical.it/campus/servizi/x?y=1'"), ("'https://h.it'", "'a'", "'https://h.it/a'"), (B, "'mailto:' || p_size", "'mailto:' || p_size"), (B, "'./../../' || p_size", "'https://www.unical.it/' || p_size"),
)

cases(
    "url_queries", lambda x: urls.with_param(x, "format", "json"),
    ("'https://h.it/a?x=' || p_size", "'https://h.it/a?x=' || p_size || '&format=json'"), ("'https://h.it/a?format=xml&x=' || p_size || '#f'", "'https://h.it/a?format=json&x=' || p_size || '#f'"), ("'https://h.it/' || p_size", "'https://h.it/' || p_size || '?format=json'"),
)

H = "'https://www.unical.it/"
cases(
    "service_urls", lambda x: F.concat_ws("|", F.coalesce(urls.service_url(x), F.lit("-")), F.coalesce(urls.service_name(urls.service_url(x)), F.lit("-"))),
    (f"{H}campus/vivere-il-campus/sistema-museale/musnob/zoologia/' || p_size", f"{H}campus/vivere-il-campus/sistema-museale/musnob/zoologia/|Zoologia'"),
    (f"{H}campus/vivere-il-campus/sistema-museale/orto/' || p_size", f"{H}campus/vivere-il-campus/sistema-museale/orto/|Orto'"),
    (f"{H}campus/vivere-il-campus/sistema-museale/'", f"{H}campus/vivere-il-campus/sistema-museale/|Sistema Museale'"),
    (f"{H}Campus/Servizi/s-' || p_size || '/x'", f"{H}campus/servizi/s-' || p_size || '/|S ' || p_size"),
    (f"{H}campus/servizi/'", "'-|-'"), (f"{H}media/medias/ufficio'", "'-|-'"), (f"{H}campus/servizi/news/' || p_size", "'-|-'"),
    (f"{H}servizi-ict/posta/' || p_size", f"{H}servizi-ict/posta/|Posta'"), (f"{H}didattica/diritto-allo-studio/borse/' || p_size", f"{H}didattica/diritto-allo-studio/borse/|Borse'"),
    (f"{H}a/b/segreteria/d'", f"{H}a/b/segreteria/|Segreteria'"), (f"{H}' || p_size", "'-|-'"), (f"{H}ateneo/servizi/l_o'", f"{H}ateneo/servizi/l_o/|L O'"),
)

cases(
    "service_links", lambda h, t: F.coalesce(services.service_link(F.lit("https://www.unical.it/campus/servizi/"), h, t), F.lit("-")),
    ("'/campus/servizi/s' || p_size || '/x/'", "'Sportello ' || p_name", f"{H}campus/servizi/s' || p_size || '/'"), ("'s' || p_size", "p_name", f"{H}campus/servizi/s' || p_size || '/'"),
    ("'mailto:a@b.it'", "p_name", "'-'"), ("'https://other.it/campus/servizi/a'", "p_name", "'-'"), ("'s?lang=en'", "p_name", "'-'"), ("'s'", "''", "'-'"), ("'s'", "'a b c d e f g h i'", "'-'"), ("'s'", "'Home'", "'-'"), ("'s'", "'RSS ' || p_size", "'-'"), ("'news'", "p_name", "'-'"),
)

cases(
    "service_kinds", lambda n, d: F.concat_ws("|", services.service_type(n, d), services.is_noise_name(n).cast("string"), services.is_noise_description(d).cast("string")),
    ("'Segreteria ' || p_name", "'ufficio'", "'SECRETARY|false|false'"), ("p_name", "'Office ' || p_size", "'OFFICE|false|false'"), ("'Home'", "'Vai a tutte le notizie'", "'SERVICE|true|true'"), ("'Evento ' || p_size", "''", "'SERVICE|true|false'"), ("p_name", "p_brand", "'SERVICE|false|false'"),
)

cases(
    "title_cases", urls.title_case,
    ("'d''ateneo ' || p_size", "'D''Ateneo ' || p_size"), ("upper(p_name)", "upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2)"), ("'a1b'", "'A1B'"),
)

cases(
    "api_urls", lambda x: F.concat_ws("|", F.coalesce(urls.teachers_api(x, F.lit("https://www.unical.it/p/")), F.lit("-")), F.coalesce(urls.departments_api(x, F.lit("https://www.unical.it/p/")), F.lit("-"))),
    ("'<a href=\"/api/ricerca/teachers/?x=' || p_size || '\">'", "'https://www.unical.it/api/ricerca/teachers/?x=' || p_size || '&format=json|-'"),
    ("'u = \"//s.it/api/ricerca/teachers/\";'", "'https://s.it/api/ricerca/teachers/?format=json|-'"),
    ("'g(\"https://s.it/api/ricerca/structures/?p=' || p_size || '\")'", "'-|https://s.it/api/ricerca/structures/?p=' || p_size"), ("p_name", "'-|-'"),
)

cases(
    "teacher_urls", lambda e, i: F.coalesce(urls.teacher_url(F.lit("https://s.it/x"), e, i), F.lit("-")),
    ("'a.b' || p_size || '@u.it'", "'id'", "'https://s.it/storage/teachers/a.b' || p_size || '/'"), ("p_name", "'T ' || p_size", "'https://s.it/storage/teachers/T%20' || p_size || '/'"), ("''", "''", "'-'"),
)

cases(
    "people_links", lambda p, u, t: urls.leads_to_people(p, u, t).cast("string"),
    ("'https://d.it/dipartimento/presentazione/persone/'", "'https://d.it/x?page=' || p_size", "'2'", "'true'"), ("'https://d.it/'", "'https://d.it/Dipartimento/presentazione/persone/' || p_size", "p_name", "'true'"),
    ("'https://d.it/'", "'https://d.it/x?page=2'", "'next'", "'false'"), ("'https://d.it/dipartimento/presentazione/persone/'", "'https://d.it/y'", "'precedente'", "'true'"), ("'https://d.it/dipartimento/presentazione/persone/'", "'https://d.it/y'", "p_name", "'false'"),
)
