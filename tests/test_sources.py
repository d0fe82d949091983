"""Pages, placemarks, scripts, requests and crawls."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lucerna.sources import markup, raw, requests, tables

PAGE = """<html><body><h1>T &amp; x</h1><p>one<p>two<br><a href="u?a=1&amp;b">go <b>on</b></a></i>
<table><tr><th>Aula<th>Posti</tr><tr><td>A1</td><td> 30 </td></tr><tr><td></td></tr></table>
<div class="accordion-item x"><button class="accordion-button">First</button><div class="accordion-body"><p>a</p>b
<div class="accordion-item"><button class="accordion-button">In</button></div></div></div><script>var a = "<p>";</script></body>"""
KML = """
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder><name>Out</name><Placemark><name> A  b</name><description><![CDATA[x<br>y &amp; z]]></description>
<Point><coordinates> 16.2,39.3,0 1,1 </coordinates></Point></Placemark><Folder><name>In</name><Placemark><name>C</name></Placemark></Folder></Folder><Placemark><name>loose</name></Placemark></Document></kml>"""


def test_pages(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<a")], "k long, html string")
    got = markup.nodes(rows, "k", "html", ("h1", "a", "b")).orderBy("node").collect()
    assert [(r.k, r.tag, r.text, r.attrs) for r in got] == [(1, "h1", "T & x", {}), (1, "a", "go on", {"href": "u?a=1&b"}), (1, "b", "on", {})]
    assert got[2].parent == got[1].node
    lines = markup.table_rows(rows, "k", "html").collect()
    assert [r.line for r in lines] == list(range(len(lines))) and lines[-1].cells == ["A1", "30"] and lines[0].cells == lines[0].headers
    items = markup.accordions(rows, "k", "html").orderBy("item").collect()
    assert [(r.depth, r.title) for r in items] == [(0, "First"), (1, "In")] and items[0].body[:2] == ["a", "b"]


def test_placemarks(spark):
    rows = spark.createDataFrame([(1, KML), (2, "no xml"), (3, None)], "k long, kml string")
    got = [tuple(r) for r in markup.placemarks(rows, "k", "kml").collect()]
    assert got == [(1, "Out", "A b", "x y & z", 39.3, 16.2), (1, "In", "C", None, None, None)]
    with pytest.raises(Exception, match="ParseError"):
        markup.placemarks(rows, "k", "kml", strict=True).collect()


def test_script_objects(spark):
    rows = spark.createDataFrame([('x item: {"results": {"a": "}{", "e": ["", " q "]}} rest',), ("item: {bad",), (None,), ("none",)], "s string")
    got = [r[0] for r in rows.select(markup.script_object(F.col("s"), "item:")).collect()]
    assert json.loads(got[0]) == {"results": {"a": "}{", "e": ["", " q "]}} and got[1:] == [None, None, None]
    texts = spark.createDataFrame([('["", " q "]',), ('"s"',), ('{"a": 1}',), (None,)], "j string")
    assert [r[0] for r in texts.select(markup.first_text(F.col("j"))).collect()] == ["q", "s", None, None]


def test_cache(spark):
    want = [hashlib.sha256(json.dumps(x, sort_keys=True, separators=(",", ":")).encode()).hexdigest() for x in ({"method": "GET", "url": 'https://a/b?c="1"', "payload": None}, {"method": "POST", "url": "u", "payload": {"a": 1}})]
    rows = spark.createDataFrame([(0, "get", 'https://a/b?c="1"', None), (1, "post", "u", '{"a":1}')], "i int, m string, u string, p string").withColumn("key", requests.cache_key(F.col("m"), F.col("u"), F.col("p")))
    assert [r.key for r in rows.orderBy("i").collect()] == want
    side = lambda *x: spark.createDataFrame(list(x), "key string, body string")
    got = requests.through_cache(rows, side((want[0], "c")), side((want[0], "f"), (want[1], "g")))
    assert sorted((r.i, r.hit, r.body) for r in got.collect()) == [(0, True, "c"), (1, False, "g")]


def test_retries(spark):
    rows = spark.createDataFrame([("a", 1, 503), ("a", 2, None), ("a", 3, 200), ("b", 1, 404), ("b", 2, 200), ("c", 1, 500), ("c", 2, 500), ("c", 3, 500), ("c", 4, 200)], "request string, attempt int, status int")
    plan = requests.retry_plan(rows)
    got = {(r.request, r.attempt): (r.succeeded, r.will_retry, r.delay, r.final_failure) for r in plan.collect()}
    assert got == {("a", 1): (False, True, 0.5, False), ("a", 2): (False, True, 1.0, False), ("a", 3): (True, False, 0.0, False), ("b", 1): (False, False, 0.0, True), ("c", 1): (False, True, 0.5, False), ("c", 2): (False, True, 1.0, False), ("c", 3): (False, False, 0.0, True)}
    assert requests.within_budget(requests.summary(plan), 2).first().asDict() == {"requests": 3, "attempts": 7, "retries": 4, "final_failures": 2}
    with pytest.raises(Exception, match="budget 1"):
        requests.within_budget(requests.summary(plan), 1).collect()


def test_crawls(spark):
    links = spark.createDataFrame([("s", "b"), ("s", "a"), ("a", "z"), ("b", "c"), ("b", "s"), ("z", "q")], "url string, target string")
    seed = spark.createDataFrame([("s",)], "url string")
    got = requests.crawl(seed, links, 5).orderBy("place").collect()
    assert [(r.url, r.step) for r in got] == [("s", 0), ("a", 1), ("b", 1), ("z", 2), ("c", 2)]
    assert requests.crawl(seed, links, 99).count() == 6
    assert requests.crawl(seed.limit(0), links, 5).count() == 0
    assert sorted(r.url for r in requests.expand(seed, links, 1).collect()) == ["a", "b", "s"]


def test_payload_keys(spark):
    """Every way to write a payload has one key, which is that of the sorted, compact, escaped object."""
    given = [{"b": [1, {"z": None, "a": True}], "a": {"è": "x\n\u0001\x7f\\u001F", "A": "\U0001f600 \"q\" /"}}, {"": {"b": 1, "a": -2}, "f": 1.5}, {}, [], "s", None]
    rows = [(i, json.dumps(v, ensure_ascii=bool(w), indent=w), json.dumps(v, sort_keys=True, separators=(",", ":"))) for i, v in enumerate(given) for w in (None, 2)]
    out = spark.createDataFrame(rows, "i int, p string, want string").withColumns({"got": requests.canonical_json("p"), "key": requests.cache_key(F.lit("post"), F.lit("https://h/è"), F.col("p"))}).collect()
    assert [r.got for r in out] == [r.want for r in out]
    digest = lambda want: hashlib.sha256(('{"method":"POST","payload":' + want + ',"url":"https://h/\\u00e8"}').encode()).hexdigest()
    assert [r.key for r in out] == [digest(r.want) for r in out]
    with pytest.raises(Exception, match="(?i)malformed"):
        spark.createDataFrame([("no json",)], "p string").select(requests.canonical_json("p")).collect()


def test_replayed_by_payload(spark):
    said = spark.createDataFrame([("POST", "u", '{"a": 1, "b": 2}', "first"), ("POST", "u", '{"a":2}', "second"), ("GET", "u", None, "page")], "method string, url string, payload string, body string")
    asked = spark.createDataFrame([(1, "post", "u", '{"b":2,"a":1}'), (2, "POST", "u", '{"a":2}'), (3, "get", "u", None), (4, "POST", "u", '{"a":3}')], "i int, method string, url string, payload string")
    assert {r.i: r.body for r in tables.replayed(asked, said).collect()} == {1: "first", 2: "second", 3: "page"}
    with pytest.raises(Exception, match="missing u"):
        tables.replayed(asked, said, strict=True).collect()


def test_teacher_details(spark):
    """Only answers whose results are an object say something; repeated answers count once, nulls and other kinds of values are nothing."""
    body = lambda x: json.dumps({"results": x})
    rows = [("a", body({"TeacherOffice": ["x"], "TeacherOfficeReference": [None, 4, " R  1 "], "TeacherTelOffice": 5})), ("b", body([])), ("c", None), ("d", "no json"), ("e", body({})), ("e", body({})), (None, body({"TeacherOffice": "O"})), ("f", body({"TeacherOffice": "O"}))]
    got = {r.url: r.d for r in raw.teacher_details(spark.createDataFrame(rows, "url string, body string").withColumn("d", F.lit(1))).collect()}
    assert set(got) == {"a", "e", None, "f"} and set(got["e"].asDict().values()) == {None}
    assert (got["a"].office_reference, got["a"].notes, got["a"].phone, got["f"].notes) == ("R 1", "Office references: R 1", None, "O")


def test_worklist(spark, monkeypatch):
    """Breadth first by seed; nulls are no requests; a bound limits groups before the exchange."""
    plans = []
    monkeypatch.setattr(requests, "cut", lambda x: plans.append(x._jdf.queryExecution().toString()) or spark.createDataFrame(x.collect(), x.schema))
    links = spark.createDataFrame([("a", "c"), ("a", "b"), ("b", "a"), ("b", "d"), ("c", "e"), ("e", None)], "url string, target string")
    seeds = spark.createDataFrame([("s", "a"), ("s", "a"), ("t", "c"), (None, "a"), ("u", None)], "seed string, url string")
    follow = lambda x: x.join(links, "url").select("seed", "place", "target")
    run = lambda most: sorted((r.seed, r.place, r.url) for r in requests.worklist(seeds, follow, most).collect())
    whole = [("s", 1, "a"), ("s", 2, "b"), ("s", 3, "c"), ("s", 4, "d"), ("s", 5, "e"), ("t", 1, "c"), ("t", 2, "e")]
    assert run(None) == whole and run(3) == [x for x in whole if x[1] <= 3]
    assert "WindowGroupLimit" in plans[-1].split("Physical Plan")[1] and requests.worklist(seeds.limit(0), follow).isEmpty()
