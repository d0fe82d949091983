"""Commands from a folder to a folder."""

import json

import pytest

from lucerna.cli import main

KML = '<kml xmlns="http://www.opengis.net/kml/2.2"><Folder><name>F</name>' + "".join(f"<Placemark><name>{n}</name><Point><coordinates>16,39</coordinates></Point></Placemark>" for n in ("cubo 3b - x", "P2 centro", "Bar Mensa", "Teatro")) + "</Folder></kml>"


@pytest.fixture
def data(tmp_path):
    files = {
        "buildings.json": [{"building_id": "cubo-3b", "name": "Cubo 3B"}],
        "places.json": [{"place_id": "a", "type": "AULA", "name": "Aula P1", "description": "cubo 3b"}, {"place_id": "b", "type": "SERVICE", "name": "x"}, 7],
        "aulas.json": [{"aula_id": "a", "place_id": "a", "name": "Aula P1", "short_code": "P1", "capacity": 3}],
        "registry.json": {"corrections": [{"id": "r", "action": "replace", "entity_type": "place", "entity_id": "b", "field": "name", "value": "new", "reason": "r", "author": "a", "created_at": "2026-01-01T00:00:00Z", "status": "applied", "reviewer": "z"}]},
        "contract.json": {"place_overrides": [{"place_id": "n", "type": "T", "name": "N"}]},
        "landmarks.json": {"landmarks": [{"entity_type": "BUILDING", "entity_id": "cubo-3b", "labels": ["Block"]}]},
        "aulas.schema.json": {"items": {"type": "object", "properties": {"capacity": {"type": "integer", "minimum": 1}}}},
    }
    for name, rows in files.items():
        (tmp_path / name).write_text(json.dumps(rows))
    (tmp_path / "responses.jsonl").write_text(json.dumps({"url": "u", "body": KML}))
    return tmp_path


def test_commands(spark, data, capsys):
    at, out = f"file://{data}", lambda name: f"file://{data}/{name}"
    rows = lambda name, table: [json.loads(x) for f in sorted((data / name / f"{table}.jsonl").glob("part-*")) for x in f.read_text().splitlines()]
    run = lambda *args: main(list(args), spark)

    assert run("link", "places-buildings", "--data", at, "--out", out("o1")) == 0
    assert [(r["place_id"], r.get("building_id")) for r in rows("o1", "places")] == [("a", "cubo-3b"), ("b", None)]
    assert run("link", "aliases", "--data", at, "--out", out("o2"), "--landmarks", "landmarks.json") == 0
    assert sorted(r["label"] for r in rows("o2", "aliases")) == ["Aula P 1", "Aula P1", "Block", "P 1", "P1"]
    assert run("link", "service-locations", "--data", at, "--out", out("o3"), "--contract", "contract.json", "--verified-at", "now") == 0
    assert [r["place_id"] for r in rows("o3", "places")] == ["a", "b", "n"]
    assert run("corrections", "apply", "--data", at, "--out", out("o4"), "--registry", "registry.json") == 0
    assert [r["name"] for r in rows("o4", "places")] == ["Aula P1", "new"]
    assert run("crawl", "buildings", "--responses", out("responses.jsonl"), "--out", out("o5"), "--verified-at", "now") == 0
    assert [r["building_id"] for r in rows("o5", "buildings")] == ["cubo-3b", "teatro"]
    assert run("validate", "--data", at, "--schemas", at) == 0
    capsys.readouterr()
    assert run("report", "--data", at, "--schemas", at) == 0
    got = json.loads(capsys.readouterr().out)
    assert got["summary"] == {"total_datasets": 1, "invalid_datasets": 0, "integrity_issues": 0} and got["coverage"]["places"]["total"] == 2
    assert run("contract", "--data", at) == 0
    assert [x["name"] for x in json.loads(capsys.readouterr().out)["datasets"]] == ["aulas.json", "buildings.json", "places.json"]
    (data / "aulas.json").write_text('[{"aula_id": "a", "place_id": "none", "name": "x", "capacity": 0}]')
    assert run("validate", "--data", at, "--schemas", at) == 1
    said = capsys.readouterr().out
    assert "aulas: [0].capacity: minimum" in said and "error aulas.json a: place_id 'none' does not exist" in said


def test_report_counts_all_issues(spark, data, capsys):
    (data / "aulas.json").write_text(json.dumps([{"aula_id": x, "place_id": "none", "name": "x"} for x in "abc"]))
    report = lambda *more: main(["report", "--data", f"file://{data}", "--schemas", f"file://{data}", *more], spark)
    capsys.readouterr()
    assert report() == 0
    whole = json.loads(capsys.readouterr().out)
    assert report("--most-issues", "1") == 0
    cut = json.loads(capsys.readouterr().out)
    total = whole["summary"]["integrity_issues"]
    assert total == len(whole["integrity"]["issues"]) >= 3 and set(whole["integrity"]) == {"issues"}
    assert cut["summary"]["integrity_issues"] == total and cut["integrity"] == {"issues": whole["integrity"]["issues"][:1], "listed": 1, "total": total}
