"""Each check fires on the row made for it and on no other."""

from lucerna.operators.campus_integrity import check

SCHEMAS = {
    "buildings": "ordinal int, building_id string",
    "departments": "ordinal int, department_id string, primary_building_id string",
    "places": "ordinal int, place_id string, type string, building_id string",
    "people": "ordinal int, person_id string, department_id string, office_place_id string",
    "aulas": "ordinal int, aula_id string, place_id string, name string, normalized_name string, building_id string, floor string, room string, department_id string",
    "aliases": "ordinal int, alias_id string, entity_type string, entity_id string",
    "entity_links": "ordinal int, link_id string, parent_entity_type string, parent_entity_id string, child_entity_type string, child_entity_id string",
}
ROWS = {
    "buildings": [("b1",), ("b2",)],
    "departments": [("d1", "b1"), ("d2", "no"), ("d3", "")],
    "places": [("p1", "AULA", "b1"), ("p2", "OFFICE", "no"), ("p3", None, None)],
    "people": [("x1", "d1", "p2"), ("x2", "no", "no"), ("x3", None, "p3"), ("x4", "", "")],
    "aulas": [
        ("a1", "p1", "Aula Uno", None, "b1", "1", "R", "d1"), ("a2", "no", "Q", None, "no", None, None, "no"), ("a3", "p2", "W", None, "gone", None, None, "no"),
        ("a4", "p1", "aula  UNO", None, "b1", "2", " r ", None), ("a5", "p1", "x", None, "b2", None, None, None), ("a6", None, "due tre", None, "b1", None, None, None), ("a7", None, "Tre-due lab", None, "b1", None, None, None),
    ],
    "aliases": [("l1", "BUILDING", "b1"), ("l2", "PLACE", "b1"), ("l3", "OTHER", "z"), ("l4", "PERSON", "")],
    "entity_links": [("k1", "PLACE", "p1", "BUILDING", "b1"), ("k1", "PLACE", "no", "BUILDING", "no"), ("k2", "OTHER", "no", None, None)],
}


def tables(spark, rows):
    return {k: spark.createDataFrame([(i, *r) for i, r in enumerate(rows.get(k, []))], s) for k, s in SCHEMAS.items()}


def test_checks(spark):
    got = sorted((r.level, r.file, r.record_id, r.message) for r in check(tables(spark, ROWS)).collect())
    e, w, at = "error", "warning", " does not exist in "
    assert got == sorted([
        (e, "departments.json", "d2", f"primary_building_id 'no'{at}buildings.json"),
        (e, "places.json", "p2", f"building_id 'no'{at}buildings.json"),
        (e, "people.json", "x2", f"department_id 'no'{at}departments.json"),
        (e, "people.json", "x2", f"office_place_id 'no'{at}places.json"),
        (w, "people.json", "x3", "office_place_id 'p3' points to a non-OFFICE place"),
        (e, "aulas.json", "a2", f"place_id 'no'{at}places.json"),
        (w, "aulas.json", "a3", "place_id 'p2' points to a non-AULA place"),
        (e, "aulas.json", "a3", f"building_id 'gone'{at}buildings.json"),
        (w, "aulas.json", "a3", "building_id 'gone' differs from places.json building_id 'no' for place_id 'p2'"),
        (e, "aulas.json", "a3", f"department_id 'no'{at}departments.json"),
        (w, "aulas.json", "a5", "building_id 'b2' differs from places.json building_id 'b1' for place_id 'p1'"),
        (e, "aulas.json", "a4", "duplicate aula key for normalized_name 'aula uno' and building_id 'b1' (also in 'a1')"),
        (e, "aulas.json", "a1", "conflicting floor for room 'r' in building_id 'b1': 1, 2"),
        (w, "aulas.json", "a6", "suspicious near-duplicate aulas for building_id 'b1' and token_set 'due tre': a6, a7"),
        (e, "aliases.json", "l2", "entity_id 'b1' does not exist for entity_type 'PLACE'"),
        (e, "entity_links.json", "k1", "duplicate link_id 'k1'"),
        (e, "entity_links.json", "k1", "parent_entity_id 'no' does not exist for parent_entity_type 'PLACE'"),
        (e, "entity_links.json", "k1", "child_entity_id 'no' does not exist for child_entity_type 'BUILDING'"),
    ])


def test_nothing_to_check(spark):
    assert check(tables(spark, {})).collect() == []
