"""Registries, schema files, reports, contracts."""

import hashlib
import json

import pytest

from lucerna.operators import documents as D

RULE = {"id": "a", "action": "set_null", "entity_type": "buildings", "entity_id": "b1", "field": "name", "reason": "r", "author": "x", "created_at": "2026-01-01T00:00:00Z", "status": "approved", "reviewer": "y"}


def load(*rules, allowed=("a",)):
    return D.load_rules(json.dumps({"corrections": list(rules)}), set(allowed))


def test_registry():
    assert load(RULE)[0]["entity_type"] == "building"
    for bad in (RULE | {"reviewer": " "}, RULE | {"action": "x"}, RULE | {"created_at": "2026-01-01T00:00:00"}, RULE | {"id": "b"}, RULE | {"priority": "1"}, {k: v for k, v in RULE.items() if k != "reason"}):
        with pytest.raises(ValueError):
            load(bad)
    with pytest.raises(ValueError, match="one priority"):
        load(RULE, RULE | {"id": "b"}, allowed=("a", "b"))
    assert len(load(RULE, RULE | {"id": "b", "status": "archived"})) == 2
    load(RULE | {"status": "draft", "reviewer": None}, allowed=())


def test_corrections(spark):
    rows = spark.createDataFrame([("b1", "One", "x", 1), ("b2", " Two ", "", 2), ("b3", "Three", None, 3), ("b4", "Four", "keep", None)], "building_id string, name string, category string, n int")
    make = lambda i, target, field, action, p=0, **more: RULE | {"id": i, "entity_id": target, "field": field, "action": action, "priority": p} | more
    rules = [make("a", "b1", "name", "set_null"), make("b", "b1", "name", "replace", 5, value="Uno"), make("c", "b2", "name", "drop_if_matches", patterns=["TWO"]), make("d", "b2", "category", "override", value="c"), make("e", "b3", "name", "drop_if_prefix", patterns=["th"]), make("f", "b4", "category", "override", value="c"), make("g", "b3", "n", "replace", value=7), make("h", "zz", "name", "merge")]
    got = {r.building_id: tuple(r)[1:] for r in D.correct(rows, "building", load(*rules, allowed="ace")).collect()}
    assert got == {"b1": ("Uno", "x", 1, 1), "b2": (None, "c", 2, 2), "b3": (None, None, 7, 2), "b4": ("Four", "keep", None, 0)}
    with pytest.raises(Exception, match="no meaning"):
        D.correct(rows, "building", load(make("h", "b1", "name", "merge"))).collect()


def test_schema_files(spark, tmp_path):
    schema = {"type": "array", "items": {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {"id": {"type": "string", "minLength": 1, "pattern": "^[a-z]*$"}, "n": {"type": "integer", "minimum": 1}, "x": {"type": "number"}, "t": {"type": "array", "items": {"type": "string", "minLength": 1}}, "k": {"enum": ["a", "b"]}}}}
    rows = [{"id": "a", "n": 1, "x": 1, "t": ["q"], "k": "a"}, {"n": 0}, {"id": "", "x": "1"}, {"id": "A", "n": 1.5}, {"id": "a", "t": ["", 1]}, {"id": None, "other": 1}, {"id": "a", "k": "c"}, 5, {"id": "a", "n": 2.0, "x": 2.5}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    got = sorted((r.row, r.field, r.error) for r in D.schema_errors(D.json_rows(spark, f"file://{tmp_path}/a.json"), schema).collect())
    assert got == [(1, "id", "required"), (1, "n", "minimum"), (2, "id", "minLength"), (2, "x", "type"), (3, "id", "pattern"), (3, "n", "type"), (4, "t", "items"), (5, "", "additionalProperties"), (5, "id", "type"), (6, "k", "enum"), (7, "", "type")]


def test_report_and_contract(spark, tmp_path):
    empty = spark.createDataFrame([], "x string")
    aulas = spark.createDataFrame([("a", "A", "u", "b1", "f", 3), ("b", "B", "", "", None, None), ("c", "C", "u", None, "", None)], "aula_id string, name string, source_url string, building_id string, floor string, capacity int")
    tables = {k: empty for k in D.METRICS} | {"aulas": aulas}
    got = D.report(tables, {"aulas": ["e"], "places": []}, [], {"s": {"final_failures": 2, "failure_budget": 1}, "t": {}})
    assert got["summary"] == {"total_datasets": 2, "invalid_datasets": 1, "integrity_issues": 0}
    a = got["coverage"]["aulas"]
    assert (a["total"], a["with_building_id"], a["with_floor_ratio"], a["with_capacity"], a["missing_building_id_ratio"]) == (3, 1, 0.3333, 1, 0.6667)
    assert a["missing_building_by_source"] == [{"source_url": "u", "count": 1}, {"source_url": "unknown", "count": 1}]
    assert got["coverage"]["people"]["with_email_ratio"] == 0.0
    assert got["scrape_diagnostics"]["warnings"][0]["message"] == "s: 2 final failures (budget 1) [EXCEEDED]"
    (tmp_path / "a.json").write_text("[1, 2]")
    c = D.contract(spark, f"file://{tmp_path}", ["a.json"], 1, "v", "id")
    assert c["datasets"] == [{"name": "a.json", "records": 2, "sha256": hashlib.sha256(b"[1, 2]").hexdigest()}]
    with pytest.raises(ValueError):
        D.contract(spark, f"file://{tmp_path}", ["a.json"], 0, "v", "id")
