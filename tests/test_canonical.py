"""From raw rows to datasets, on small tables of our own."""

import pytest
from pyspark.sql import functions as F

from lucerna.functions import people as P
from lucerna.operators import canonical as C

TEACHER = "ordinal int, full_name string, source_url string, email string, phone string, department_name string, department_code string, website_url string, office_hours string, office_reference string, notes string"


def texts(spark, column, values):
    return [r[0] for r in spark.createDataFrame(list(enumerate(values)), "i int, t string").orderBy("i").select(column).collect()]


def test_texts(spark):
    assert texts(spark, P.building_name("t"), ["cubo 3b - x", "CUBI 7-11b", "Aula  Magna", " ", None]) == ["Cubo 3B", "Cubi 7-11B", "Aula Magna", None, None]
    assert texts(spark, P.building_description("t"), ["Descrizione: A - - b, Evento: x", "uffici", "aule/zone coperte da wifi : x", "Landmark on official Unical campus map", " ;", None]) == ["A - b", None, None, None, None, None]
    assert texts(spark, P.department_key("t"), ["Dipartimento di Fisica", "Scienze-Dip", "x diritto", None]) == ["dipartimento-fisica", "scienze", "xritto", None]
    assert texts(spark, P.acronyms(F.col("t")), ["Dip. Dimes e DICES", "Ingegneria - D.E.S.F", "x"]) == [["DIMES", "DICES"], ["DESF"], []]
    assert texts(spark, P.domain_alias("t"), ["www.dimes.unical.it", "web.unical.it", "a.b.unical.it", "x.org", None]) == ["dimes", "eb", None, None, None]
    assert texts(spark, P.html_lines("t"), ["<p>a</p><p>b &amp; c</p>", "x<br>y", ""]) == ["a • b & c", "x y", ""]


def test_meetings(spark):
    said = "<p>Lun 9</p><p>Link:</p><p>https://teams.microsoft.com/l/x?y</p><p>Codice: abc123</p><p>q1w2e3</p>"
    got = spark.createDataFrame([(said,)], "t string").select(P.meeting_hours("t"), P.meeting_url("t"), P.meeting_code("t")).first()
    assert tuple(got) == ("Lun 9", "https://teams.microsoft.com/l/x?y", "abc123")
    assert texts(spark, P.meeting_code("t"), ["<p>x</p><p>q1w2e3</p>", "nothing here", None]) == ["q1w2e3", None, None]


@pytest.fixture(scope="module")
def departments(spark):
    raw = spark.createDataFrame([(1, "Dipartimento di Fisica", "https://x/fisica", None, None, None), (2, "Ingegneria - DIMES", "https://x/dimes", " a@b ", None, None), (3, "dipartimento di  fisica", "u", "late", None, None), (4, " ", None, None, None, None)], "ordinal int, name string, source_url string, email string, phone string, website_url string")
    return C.departments(raw, "s", "now")


def test_departments(departments):
    assert sorted((r.department_id, r.email) for r in departments.collect()) == [("dipartimento-di-fisica", None), ("ingegneria-dimes", "a@b")]


def test_people(spark, departments):
    rows = [
        (1, " Rossi  Mario ", "u", "M@fis.unical.it ", "1", None, None, None, "h", None, "Office: x | Office references: Cubo 3b Piano 2 Stanza 1"),
        (2, "Bianchi Ada", "u", None, None, "Dip. Dimes", None, None, None, "Cubo 3B", "n"),
        (3, "Verdi Ugo", "https://x/storage/teachers/ugo%20v/", None, None, "unknown", None, None, None, None, None),
        (4, "Rossi Mario", "u", "later", None, None, None, None, None, None, None),
        (5, None, "u", None, None, None, None, None, None, None, None),
        (6, "Neri Ivo", "u", "n@www.dimes.unical.it", None, "DIMES", "c9", None, None, "somewhere", None),
    ]
    raw = spark.createDataFrame(rows, TEACHER)
    teachers = spark.createDataFrame([("slug:ugo%20v", "d-map"), ("department_code:c9", "never")], "key string, department_id string")
    got = {r.full_name: r for r in C.people(raw, departments, teachers, "s", "now").collect()}
    assert {k: r.department_id for k, r in got.items()} == {"Rossi Mario": "dipartimento-di-fisica", "Bianchi Ada": "ingegneria-dimes", "Verdi Ugo": "d-map", "Neri Ivo": "ingegneria-dimes"}
    r = got["Rossi Mario"]
    assert (r.person_id, r.email, r.notes, r.office_reference_text, r.office_place_id) == ("mario-rossi", "m@fis.unical.it", "x", "Cubo 3b Piano 2 Stanza 1", "office-ufficio-cubo-3b-piano-2-stanza-1")
    assert got["Neri Ivo"].office_place_id is None
    assert {r.department_id for r in C.people(raw, None, None, "s", "now").collect()} == {None, "dip-dimes", "unknown", "dimes"}


def test_offices(spark):
    b = spark.createDataFrame([("cubo-3b", "Cubo 3B"), ("palazzo-specchi", "Palazzo Specchi"), ("x", None)], "building_id string, name string")
    rows = [(1, "A", "u", None, None, None, None, None, "<p>a</p><p>b</p>", "Cubo 3b Piano 2 Stanza 1", None), (2, "B", "u", None, None, None, None, None, None, None, "Office references: edificio Palazzo Specchi | z"), (3, "C", "u", None, None, None, None, None, None, "cubo 3b palazzo specchi", None), (4, "D", "u", None, None, None, None, None, None, "nowhere", None)]
    got = {r.name: (r.building_id, r.floor, r.room, r.opening_hours) for r in C.offices(spark.createDataFrame(rows, TEACHER), b, (), "s", "now").collect()}
    assert got == {"Ufficio Cubo 3b Piano 2 Stanza 1": ("cubo-3b", "Piano 2", "Stanza 1", "a • b"), "Ufficio edificio Palazzo Specchi": ("palazzo-specchi", None, None, None), "Ufficio cubo 3b palazzo specchi": (None, None, None, None)}
    old = spark.createDataFrame([("a", "s", "old"), ("b", "t", "kept")], "place_id string, source_id string, name string")
    new = spark.createDataFrame([("b", "s", "new"), ("c", "s", "new")], "place_id string, source_id string, name string")
    assert sorted((r.place_id, r.name) for r in C.keep_others(old, new, "s", "place_id").collect()) == [("b", "kept"), ("c", "new")]


def test_buildings_and_services(spark):
    raw = spark.createDataFrame([(1, "cubo 3b - x", "u", 39.123456789, 16.0, "d"), (2, "Cubo 3B", "u", 1.0, 1.0, None), (3, "Mensa", "u", None, None, None)], "ordinal int, name string, source_url string, lat double, lng double, description string")
    assert sorted((r.building_id, r.name, r.category, r.lat) for r in C.buildings(raw, "s", "now").collect()) == [("cubo-3b", "Cubo 3B", None, 39.1234568), ("mensa", "Mensa", "MENSA", None)]
    raw = spark.createDataFrame([(1, "Aiuto", "u", "", None, None, None, None, None), (2, "aiuto", "v", None, None, None, None, None, None)], "ordinal int, name string, source_url string, service_type string, description string, email string, phone string, website_url string, opening_hours string")
    assert [(r.place_id, r.source_url) for r in C.services(raw, "s", "now").collect()] == [("service-aiuto", "u")]
