"""Rules about places and rooms, on small tables of our own."""

import pytest
from pyspark.sql import functions as F

from lucerna.functions import rooms
from lucerna.operators import places

PLACE = "place_id string, type string, name string, description string, source_url string, access_notes string, building_id string, floor string, last_verified_at string, lat double"
ROOM = "place_id string, name string, room string, short_code string, source_url string, building_id string, floor string, capacity int, search_tokens array<string>"


@pytest.fixture(scope="module")
def buildings(spark):
    ids = ["cubo-3b", "cubo-45b", "cubi-7-11b", "cubi-8-1a", "cubi-8-1b", "capannone-g", "capannone-c", "aula-magna", "cubo-libro", "polifunzionale-x", "cubo-41b", "orto-botanico"]
    return spark.createDataFrame([(x,) for x in ids], "building_id string")


def texts(spark, column, values):
    return [r[0] for r in spark.createDataFrame(list(enumerate(values)), "i int, t string").orderBy("i").select(column).collect()]


def test_buildings_floors_and_seats(spark):
    assert texts(spark, rooms.building_hint("t"), ["Cubo 3 b", "cubo 31/c", "Cubi 7-11b", "capannone g", "polifunzionale EST", "polifunzionale", "18B", "piano 3, 18b", "18b", None]) == ["Cubo 3B", "Cubo 31C", "Cubi 7-11B", "Capannone G", "Polifunzionale Est", "Polifunzionale", "Cubo 18B", "Cubo 18B", "Cubo 18B", None]
    assert texts(spark, rooms.floor_label("t"), ["II piano", "0 piano", "piano terra", "piano 7", "piano 8", "9 piano terzo piano", "ponte coperto", "sottovia", "", None]) == ["Secondo piano", "Piano Terra", "Piano Terra", "Settimo piano", None, "Terzo piano", "Quarto piano", "Altra collocazione", None, None]
    assert texts(spark, rooms.capacity("t"), ["capienza: 90 posti", "120 persone", "dotata di 12 postazioni", "44", "posti 6000, 20 persone", "none", None]) == [90, 120, 12, 44, None, None, None]


def test_codes(spark):
    assert texts(spark, rooms.short_code(F.col("t")), ["Aula DS 4", "aula a b", "Aula Magna", "Sala 4", None]) == ["DS4", "AB", None, None, None]
    assert texts(spark, rooms.room_candidates("t"), ["Aula P1; Aula DS 4", "P1 / 18A, foo", "a 18A 2 x", ""]) == [["Aula P1", "Aula DS 4"], ["P1", "18A"], ["18A 2"], []]
    rows = spark.createDataFrame([("Aula 45B03", "cubo-45b"), ("CH-12-3C", None), ("Aula 18B 3", "cubo-18b"), ("18B 3X 18B 4X", None), ("LAB 41C-2P", None)], "n string, b string")
    found = rows.select("n", rooms.floor_from_codes(F.col("n"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("b")).alias("f"))
    assert {r.n: r.f for r in found.collect()} == {"Aula 45B03": "Piano Terra", "CH-12-3C": "Terzo piano", "Aula 18B 3": "Terzo piano", "18B 3X 18B 4X": None, "LAB 41C-2P": "Secondo piano"}


def test_table_rows(spark):
    rows = spark.createDataFrame([(["Aula", "Capienza posti", "Note"], ["A1", "", "30"])], "h array<string>, c array<string>")
    got = rows.select(rooms.is_header_row(F.col("h")), rooms.is_header_row(F.col("c")), rooms.cells_at(F.col("c"), rooms.columns_named(F.col("h"), ("aula", "posti")))).first()
    assert list(got) == [True, False, ["A1"]]


def test_links_fall_through_missing_buildings(spark, buildings):
    rows = [("a", "Cubo 3 B"), ("b", "cubo 7/11b career-service"), ("c", "cubo 9c aula magna"), ("d", "biblioteche"), ("service-miai", "cubo 3b"), ("e", None), ("f", "cubo 8/1")]
    table = spark.createDataFrame([(k, "SERVICE", n, None, None, None, "gone" if k == "e" else None, None, None, None) for k, n in rows], PLACE)
    assert {r.place_id: r.building_id for r in places.link_places(table, buildings).collect()} == {"a": "cubo-3b", "b": "cubi-7-11b", "c": "aula-magna", "d": "cubo-libro", "service-miai": None, "e": "gone", "f": None}
    assert places.link_places(table.limit(0), buildings).count() == 0


def test_buildings_named_in_text(spark, buildings):
    rows = spark.createDataFrame([(1, "Cubo 3b e capannone G, polifunzionale"), (2, "45 B o 99z"), (3, None)], "k int, t string")
    got = sorted((r.k, r.building) for r in places.buildings_in_text(rows, "k", "t", buildings).collect())
    assert got == [(1, "capannone-g"), (1, "cubo-3b"), (1, "polifunzionale-x"), (2, "cubo-45b")]


def test_sources_force_buildings_and_places_follow(spark, buildings):
    url = "https://dispes.unical.it/dipartimento/organizzazione/strutture/"
    rows = spark.createDataFrame([("p1", "Aula G1", None, " g1 ", url, None, None, None, ["x"]), ("p2", "Aula H1", "H1", None, url, "cubo-3b", None, None, None), ("p3", "Aula DS4", "Z", None, url.replace("dispes", "dimeg"), None, None, None, None), ("p4", None, None, None, None, None, None, None, None)], ROOM)
    table = spark.createDataFrame([(k, "AULA", None, None, None, None, None, None, None, None) for k in ("p1", "p2", "p3", "p5")], PLACE)
    got, at = places.force_buildings(rows, table, buildings)
    assert {r.place_id: (r.building_id, r.search_tokens) for r in got.collect()} == {"p1": ("capannone-g", ["capannone-g", "x"]), "p2": ("cubo-3b", None), "p3": ("cubo-41b", ["cubo-41b"]), "p4": (None, None)}
    assert {r.place_id: r.building_id for r in at.collect()} == {"p1": "capannone-g", "p2": None, "p3": "cubo-41b", "p5": None}


def test_enrichment_fills_and_drops(spark, buildings):
    of = "https://{}.unical.it/dipartimento/organizzazione/strutture/".format
    rows = [
        ("p1", "Aula E", None, None, of("dimes"), None, None, 5, None),
        ("p2", "Aula Giannattasio", None, None, of("dinci"), "cubo-3b", None, None, None),
        ("p3", "Aula Dolci", None, None, of("dices"), None, "Terzo piano", 300, None),
        ("p4", "Aula X", None, None, "", "capannone-g", None, None, None),
        ("p5", "Aula 18B 2X", None, None, None, None, None, None, None),
    ]
    table = spark.createDataFrame([(r[0], "AULA", None, None, None, None, None, None, None, None) for r in rows], PLACE)
    got, at = places.enrich(spark.createDataFrame(rows, ROOM), table, buildings)
    assert {r.place_id: (r.building_id, r.floor, r.capacity) for r in got.collect()} == {"p2": ("cubo-45b", "Primo piano", None), "p3": (None, "Terzo piano", 300), "p4": ("capannone-g", "Piano Terra", None), "p5": (None, "Secondo piano", None)}
    assert {r.place_id: (r.building_id, r.floor) for r in at.collect()} == {"p2": ("cubo-45b", "Primo piano"), "p3": (None, None), "p4": (None, "Piano Terra"), "p5": (None, "Secondo piano")}


def test_aliases_keep_the_first_spelling(spark, buildings):
    rows = spark.createDataFrame([("p1", "Aula P1", "P1", "p-1", None, None, None, None, None), ("p9", "Aula Z", None, None, None, None, None, None, None)], ROOM)
    table = spark.createDataFrame([("p1", "AULA") + (None,) * 8, ("p9", "SERVICE") + (None,) * 8], PLACE)
    got = places.aliases(rows, table, buildings, [("BUILDING", "aula-magna", ("Aula Magna", "AULA  MAGNA")), ("PLACE", "none", ("x",))])
    assert sorted((r.entity_id, r.label, r.alias_id) for r in got.collect()) == [("aula-magna", "Aula Magna", "alias-building-aula-magna-aula-magna"), ("p1", "Aula P 1", "alias-place-p1-aula-p-1"), ("p1", "Aula P1", "alias-place-p1-aula-p1"), ("p1", "P 1", "alias-place-p1-p-1"), ("p1", "P1", "alias-place-p1-p1")]


def test_contract(spark, buildings):
    table = spark.createDataFrame([("a", "X", "A", None, None, None, "b1", None, None, None), ("b", "X", "B", None, None, None, "b1", "f", None, None), ("c", "X", "C", None, None, None, None, None, None, None)], PLACE)
    b = spark.createDataFrame([("b1", "one", None), ("b2", "two", None)], "building_id string, name string, category string")
    contract = {
        "clear_overview_building_ids": ["a", "zz"],
        "quartieri_places": [{"place_id": "q", "type": "Q", "name": " New  one ", "lat": 39.123456789, "lng": 1}],
        "place_overrides": [{"place_id": "b", "type": "Y", "name": "B2", "clear_fields": ["floor"], "building_id": "b2"}],
        "building_overrides": [{"building_id": "b2", "name": "deux", "category": "c"}],
        "remove_place_ids": ["c"], "remove_building_ids": ["b1"],
        "entity_links": [{"parent_entity_type": "PLACE", "parent_entity_id": "a", "relation_type": "HAS", "child_entity_type": "PLACE", "child_entity_id": "b", "sort_order": 2}],
    }
    at, of, links = places.apply_contract(table, b, contract, "now")
    assert {r.place_id: (r.type, r.name, r.building_id, r.floor, r.last_verified_at, r.lat) for r in at.collect()} == {"a": ("X", "A", None, None, "now", None), "b": ("Y", "B2", "b2", None, "now", None), "q": ("Q", "New one", None, None, "now", 39.1234568)}
    assert [tuple(r) for r in of.select("building_id", "name", "category").collect()] == [("b2", "deux", "c")]
    assert [(r.link_id, r.sort_order) for r in links.collect()] == [("a__has__b", 2)]
    with pytest.raises(ValueError):
        places.apply_contract(table, b, {"place_overrides": [{"place_id": "b"}]}, "now")
