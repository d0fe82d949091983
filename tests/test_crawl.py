"""The whole crawl over recorded responses, the source registry, seeds and the release review, on small tables of our own."""

import json

import pytest

from lucerna import crawl
from lucerna.cli import DATASETS, main
from lucerna.operators import release
from lucerna.sources import registry

U = "https://www.unical.it"
MAP = '<kml xmlns="http://www.opengis.net/kml/2.2"><Folder><name>Strutture</name><Placemark><name>Cubo 3B</name><description>Primo piano: Aula B1, Aula B2</description><Point><coordinates>16.2,39.3</coordinates></Point></Placemark></Folder></kml>'
TABLE = "<table><tr><th>Nome aula</th><th>Ubicazione</th><th>Posti</th></tr><tr><td>Aula B1</td><td>Cubo 3B, primo piano</td><td>30</td></tr></table>"
RESPONSES = [
    ("GET", f"{U}/kml", MAP),
    ("GET", f"{U}/api/d", json.dumps({"results": [{"StructureName": "Ingegneria - DIMES", "StructureURL": "https://dimes.unical.it"}], "next": None})),
    ("GET", f"{U}/api/t?p=1", json.dumps({"results": [{"TeacherName": "Ada Rossi", "Email": ["a.rossi@dimes.unical.it"], "TeacherDepartmentName": "DIMES"}], "next": "/api/t?p=2"})),
    ("GET", f"{U}/api/t?p=2", json.dumps({"results": [{"TeacherName": "Ugo Neri"}, {"TeacherName": "ada  rossi", "Email": "a.rossi@dimes.unical.it"}], "next": "/api/t?p=1"})),
    ("GET", f"{U}/campus/servizi/", '<main><a href="/campus/servizi/mensa/">Servizio mensa</a><a href="/news/">x</a></main>'),
    ("GET", f"{U}/campus/servizi/mensa/", "<h1>Servizio mensa</h1><p>Nel cubo 3B</p>"),
    ("GET", "https://dimes.unical.it/aule", TABLE),
    ("GET", f"{U}/gone", None),
]
PROFILE = dict(maps=(f"{U}/kml",), departments_api=f"{U}/api/d", teachers_api=f"{U}/api/t?p=1", services=(f"{U}/campus/servizi/",))


def test_crawl(spark, tmp_path):
    assert crawl.fast(crawl.Profile("now", schedules=("x",))).schedules == ()
    at = lambda x: f"file://{tmp_path}/{x}"
    (tmp_path / "old").mkdir()
    (tmp_path / "old/buildings.json").write_text(json.dumps([{"building_id": "kept", "name": "Kept"}]))
    (tmp_path / "responses.jsonl").write_text("\n".join(json.dumps({"method": m, "url": u, "body": b}) for m, u, b in RESPONSES))
    (tmp_path / "profile.json").write_text(json.dumps({k: list(v) if isinstance(v, tuple) else v for k, v in PROFILE.items()}))
    args = ["--data", at("old"), "--responses", at("responses.jsonl"), "--profile", at("profile.json"), "--verified-at", "now", "--out"]
    assert main(["crawl", "full", *args, at("new")], spark) == 0
    rows = lambda name: {next(iter(r.values())) if name != "places" else r["place_id"]: r for r in (x.asDict() for x in spark.read.schema(DATASETS[name]).json(at(f"new/{name}.jsonl")).collect())}
    assert sorted(rows("buildings")) == ["cubo-3b", "kept"] and sorted(rows("departments")) == ["ingegneria-dimes"] and len(rows("sources")) == 4
    assert {k: r["department_id"] for k, r in rows("people").items()} == {"rossi-ada": "ingegneria-dimes", "neri-ugo": None}
    assert sorted(rows("aulas")) == ["b1-cubo-3b", "b2-cubo-3b"] and {"service-servizio-mensa", "b1-cubo-3b"} <= set(rows("places"))
    room = rows("aulas")["b1-cubo-3b"]
    assert (room["floor"], room["capacity"], room["building_id"]) == ("Primo piano", 30, "cubo-3b")
    assert "Aula B1" in {r["label"] for r in rows("aliases").values()}
    assert main(["review", "--data", at("old"), "--candidate", at("new"), "--locked", "buildings:kept"], spark) == 0
    assert main(["contract", "--data", at("new")], spark) == 0
    assert main(["seed", "--data", at("old"), "--out", at("copy")], spark) == 0
    assert (tmp_path / "copy/buildings.json").exists() and (tmp_path / "copy/people.jsonl").exists()
    with pytest.raises(PermissionError):
        main(["crawl", "full", *args, at("main"), "--canonical", at("main")], spark)
    with pytest.raises(ValueError):
        main(["crawl", "full", *args, at("old")], spark)
    with pytest.raises(ValueError):
        registry.seed(spark, at("old"), at("old/"), DATASETS)


def test_details_and_departments(spark):
    """Offices come from details, departments of teachers without one from the sites of departments; a fast crawl asks for neither."""
    book = "https://storage.portale.unical.it/api/ricerca/addressbook/?structuretree=77"
    more = [
        ("GET", f"{U}/api/t?p=1", json.dumps({"results": [{"TeacherName": "Ugo Neri", "TeacherID": "u/n *~"}, {"TeacherName": "Ada Rossi", "Email": "a@u.it"}, {"TeacherName": "Eva Blu", "TeacherID": "gone"}], "next": None})),
        ("GET", f"{U}/api/t/u%2Fn%20%2A~/?format=json", json.dumps({"results": {"TeacherEmail": ["u@u.it"], "TeacherOffice": "Cubo 3B", "TeacherOfficeReference": ["", "Cubo 3B, piano 2, stanza 5"], "ReceptionHours": "lunedì 10-12"}})),
        ("GET", f"{U}/api/t/gone/?format=json", "no json"),
        ("GET", "https://dimes.unical.it/", f"<a href='{book}'>x</a>"),
        ("GET", book, json.dumps({"results": [{"Name": "Ugo Neri"}, 5], "next": "?structuretree=77&page=2"})),
        ("GET", book + "&page=2", json.dumps({"results": [{"Name": "x", "Email": ["a@u.it"]}], "next": book})),
    ]
    responses = spark.createDataFrame(more, "method string, url string, body string")
    t = {k: spark.createDataFrame([], DATASETS[k]).withColumn("ordinal", crawl.F.lit("")) for k in ("departments", "buildings", "places")}
    t["departments"] = spark.createDataFrame([("dimes", "DIMES", "https://dimes.unical.it")], "department_id string, name string, website_url string")
    t["departments"] = t["departments"].select(*[crawl.F.col(c) if c in t["departments"].columns else crawl.F.lit(None).cast("string").alias(c) for c in spark.createDataFrame([], DATASETS["departments"]).columns])
    p = crawl.Profile("now", teachers_api=f"{U}/api/t?p=1")
    got = crawl.teachers(spark, responses, p, t)
    people = {r.full_name: r for r in got["people"].collect()}
    assert {k: (r.department_id, r.email) for k, r in people.items()} == {"Ugo Neri": ("dimes", "u@u.it"), "Ada Rossi": ("dimes", "a@u.it"), "Eva Blu": (None, None)}
    assert people["Ugo Neri"].office_hours == "lunedì 10-12" and [r.place_id for r in got["places"].collect()] == [people["Ugo Neri"].office_place_id]
    quick = crawl.teachers(spark, responses, crawl.fast(p), t)
    assert {r.department_id for r in quick["people"].collect()} == {None} and quick["places"].isEmpty()


def test_department_pages(spark):
    """Pages are taken breadth first, by the page that names them and by address, up to the bound of each address; keys of two departments are none."""
    at = "https://d.unical.it"
    staff = lambda *to, key="": "".join(f"<a href='{x}'>Docenti</a>" for x in to) + f"<a href='mailto:{key}@u.it'>m</a><a>no address</a><a href='javascript:x()'>staff</a>"
    site = {f"{at}/": staff("/b", "/a", "https://e.unical.it/other", key="home"), f"{at}/a": staff("/c", "/", key="a"), f"{at}/b": staff("/d", key="both"), f"{at}/c": staff(key="c"), f"{at}/d": staff("/", key="d"), "https://e.unical.it/": staff(key="both"), "https://e.unical.it/other": staff(key="other")}
    bodies = spark.createDataFrame(list(site.items()), "url string, body string")
    departments = spark.createDataFrame([("d", at, None), ("e", None, "https://e.unical.it"), ("f", "https://elsewhere.it/", "no address"), (None, at, at)], "department_id string, website_url string, source_url string")
    found = lambda most: {r.key: r.department_id for r in crawl.department_map(departments, bodies, most).collect()}
    of = lambda *names: {f"email_local:{x}": "d" for x in names}
    assert found(None) == of("home", "a", "c", "d")
    assert found(4) == of("home", "a", "c") and found(3) == of("home", "a")
    assert found(2) == of("home", "a") | {"email_local:both": "e"}
    assert crawl.department_map(departments, bodies.limit(0)).isEmpty() and crawl.department_map(departments.limit(0), bodies).isEmpty()


def page(*to):
    return "<nav><a href='/campus/servizi/nav/'>Servizio nav</a></nav><main class='x'><h1>Servizio</h1>" + "".join(f"<a href='/campus/servizi/{x}/'>Servizio {x}</a>" for x in to) + "</main>"


def services_of(spark, site, **more):
    at = f"{U}/campus/servizi/"
    responses = spark.createDataFrame([("GET", at + (f"{k}/" if k else ""), v) for k, v in site.items()], "method string, url string, body string")
    seen = []
    places = spark.createDataFrame([], DATASETS["places"]).withColumn("ordinal", crawl.F.lit(""))

    def cut(rows):
        out = spark.createDataFrame(rows.collect(), rows.schema)
        seen.append(out)
        return out

    crawl.services(spark, responses, crawl.Profile("now", services=(at,), **more), {"places": places}, cut)
    return sorted({r.source_url.removeprefix(at).strip("/") for r in seen[-1].select("source_url").collect()})


def test_services_to_three_levels(spark):
    """Three links away is read, four isn't; links outside `main` are none."""
    pages = {"": page("a", "b"), "a": page("c", "a"), "b": page(), "c": page("d"), "d": page("e"), "e": page(), "nav": page()}
    found = services_of(spark, pages)
    assert found == ["a", "b", "c", "d"]
    assert services_of(spark, pages, pages=1) == found  # a bound of interfaces never cuts services


def test_pages_are_never_cut_silently(spark):
    body = lambda i, n: json.dumps({"results": [{"TeacherName": f"T {i}"}], "next": f"/api/t?p={i + 1}" if i < n else None})
    responses = spark.createDataFrame([("GET", f"{U}/api/t?p={i}", body(i, 4)) for i in range(5)], "method string, url string, body string")
    assert crawl._payloads(spark, responses, f"{U}/api/t?p=0", None).count() == crawl._payloads(spark, responses, f"{U}/api/t?p=0", 5).count() == 5
    with pytest.raises(OverflowError):
        crawl._payloads(spark, responses, f"{U}/api/t?p=0", 4)


def test_budget(spark):
    responses = spark.createDataFrame([("GET", "x", None), ("GET", "y", None)], "method string, url string, body string")
    with pytest.raises(RuntimeError, match="final failures: 2, budget 1"):
        crawl.run(spark, responses, crawl.Profile("now", budget=1), {})


def test_budget_of_one_stage(spark, tmp_path):
    at = lambda x: f"file://{tmp_path}/{x}"
    (tmp_path / "old").mkdir()
    (tmp_path / "responses.jsonl").write_text("\n".join(json.dumps({"method": "GET", "url": u, "body": None}) for u in "xy"))
    (tmp_path / "profile.json").write_text(json.dumps({"budget": 1}))
    with pytest.raises(RuntimeError, match="final failures: 2, budget 1"):
        main(["crawl", "teachers", "--data", at("old"), "--responses", at("responses.jsonl"), "--profile", at("profile.json"), "--verified-at", "now", "--out", at("new")], spark)
    assert not (tmp_path / "new").exists()


def test_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("[1]")
    at = lambda x: f"file://{tmp_path}/{x}"
    assert registry.json_object(spark, at("a.json")) == {"x": 1} and registry.json_object(spark, at("b.json")) == registry.json_object(spark, at("c.json")) == {}
    for name in ("b.json", "c.json"):
        with pytest.raises(ValueError):
            registry.json_object(spark, at(name), strict=True)


def test_review(spark):
    schema = "person_id string, name string, email string, office_place_id string, department_id string, source_id string, last_verified_at string"
    old = spark.createDataFrame([("a", "A", "e", "p", None, "s", "1"), ("b", "B", None, None, None, "s", "1")], schema)
    new = spark.createDataFrame([("a", "AA", "", "p", None, "s", "2"), ("c", "C", "e", None, "d", "t", "2")], schema)
    assert sorted((r.id, r.kind, tuple(r.fields)) for r in release.review(old, new, "person_id").collect()) == [("a", "changed", ("name",)), ("a", "lost", ("email",)), ("b", "removed", ()), ("c", "added", ())]
    said = release.text({"people": (old, new, "person_id")}, [("people", "a"), ("people", "b")])
    assert "- people a: there" in said and "- people b: missing" in said and "- new of t: 1" in said and "- lost: a -> email" in said
