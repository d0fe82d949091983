"""Work that must not grow faster than the rows."""

from pyspark.sql import functions as F

from lucerna.functions import rooms, text
from lucerna.operators import lookup, places
from lucerna.sources import raw, tables


def uses(rows, of: str) -> int:
    """How often a function stands in the plan."""
    return rows._jdf.queryExecution().optimizedPlan().toString().count(f"{of}(")


def test_crowded_places_are_compared_once(spark):
    """100,000 points on 100,000 targets would be 10 billion pairs."""
    points = spark.range(100_000).selectExpr("id as pid", "39.36 + id % 2 * 0.001 as lat", "16.22D as lng")
    targets = spark.range(100_000).selectExpr("id as tid", "39.36D as tlat", "16.22D as tlng")
    found = lookup.nearest_within(points, targets, 250, 0.004)
    assert found.groupBy("tid", F.round("metres").alias("m")).count().orderBy("m").collect() == [(0, 0.0, 50_000), (0, 111.0, 50_000)]
    again = points.limit(1).unionByName(points.limit(1).withColumn("lat", F.lit(39.3605)))
    assert [tuple(r) for r in lookup.nearest_within(again, targets, 250).collect()] == [(0, 0, 0.0)]


def test_uses_of_a_text_do_not_multiply(spark):
    """What names and floors are read from stands in the plan a few times and not once for each use of each use."""
    rows = spark.createDataFrame([("Sala x piano terra",)], "x string")
    assert uses(rows.select(rooms.planner_room_name("x")), "regexp_replace") < 30
    assert uses(rows.select(rooms.floor_label("x")), "lower") < 5
    assert uses(rows.select(text.search_tokens("x", F.lit("c"), F.lit("b"))), "lower") < 8
    assert uses(rows.select(rooms.alias_labels("x", F.lit(None).cast("string"), F.lit("a"))), "lower") < 5


def test_links_are_inferred_once(spark):
    rows = spark.createDataFrame([("p", "Aula Magna", None, None, None, None)], "place_id string, name string, description string, source_url string, access_notes string, building_id string")
    out = places.link_places(rows, spark.createDataFrame([("aula-magna",)], "building_id string"))
    assert out.first().building_id == "aula-magna" and uses(out, "lower") < 30


def test_names_are_folded_once(spark):
    """A planner's or department's name is made tidy once, folded once and searched for words of no room once, though other sources' rules follow (F6, F8)."""
    rows = spark.createDataFrame([("Sala x piano terra",)], "x string")
    for of in (rooms.planner_room_name, rooms.department_room_name):
        plan = rows.select(of("x").alias("y"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("padel") == 1, of.__name__


def test_a_label_is_read_once_for_room_and_code(spark):
    """Of the names of a planner's rooms, room and code come from one label (F6, F8)."""
    bodies = spark.createDataFrame([("u", '[{"descrizione": "Aula  B12"}, {"descrizione": " ", "codice": "q7"}, {"descrizione": "Aula A b"}]')], "url string, body string")
    out = raw.planner_rooms(bodies, spark.createDataFrame([("e", "Cubo 1A")], "id string, descrizione string"))
    assert sorted((r["name"], r.room, r.short_code) for r in out.collect()) == [("Aula A b", "A b", "AB"), ("Aula B12", "B12", "B12"), ("Aula Q7", "Q7", "Q7")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count(", 6, ") == 1


def test_texts_without_a_number_are_not_searched(spark):
    """Rules for numbered blocks look for the word before any pattern (F4)."""
    rows = spark.createDataFrame([("p", "Cubo 3 b", None, None, None, None), ("q", "ubicazione 3b", None, None, None, None)], "place_id string, name string, description string, source_url string, access_notes string, building_id string")
    out = places.link_places(rows, spark.createDataFrame([("cubo-3b",)], "building_id string"))
    assert {r.place_id: r.building_id for r in out.collect()} == {"p": "cubo-3b", "q": None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") + plan.count("contains(") > 2 * sum(len(w) for k, w, _ in places.PLACE_RULES if k != "=")


def test_labels_are_made_slugs_once(spark):
    """A label's slug is its key, is filtered and goes into its id (F10)."""
    rooms_of = spark.createDataFrame([("p-1", "Aula B1", "", "b1")], "place_id string, name string, room string, short_code string")
    out = places.aliases(rooms_of, spark.createDataFrame([("p-1", "AULA")], "place_id string, type string"), spark.createDataFrame([("b-1",)], "building_id string"), [])
    assert {r.normalized: r.alias_id for r in out.collect()}["b-1"] == "alias-place-p-1-b-1"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("[^a-z0-9]+") == 2


def test_letters_are_ruled_out_by_ascii_first(spark):
    """A long text with one letter that is several is folded letter by letter, and no ASCII letter is compared with all of the class."""
    rows = spark.range(1).select(F.concat(F.repeat(F.lit("abc "), 200_000), F.lit("ﬃ Șß")).alias("x"))
    assert rows.select(F.substring(text.slug("x"), -6, 6), F.substring(text.casefold("x"), -7, 7)).first() == ("-ffi-s", "ffi șss")


def test_rows_of_one_file_are_dealt_over_the_cores(spark, tmp_path):
    spark.range(10_000).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    dealt = tables.spread(tables.table(spark, str(tmp_path), "part")).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) >= spark.sparkContext.defaultParallelism and sum(r[1] for r in dealt) == 10_000


def test_plans_of_rooms_are_cut(spark):
    """Each step reads the rooms before several times; read from the tables each time they grow to hundreds of scans."""
    from lucerna.plans.queries import QUERIES

    for name in ("place_merge_ranked", "room_merge_ranked", "room_backfill"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 0, name


def test_plain_pages_make_the_same_tree():
    """Pages of plain tokens are cut by one expression, several times as fast (F5, F22); the tree is the parser's, and other pages go to it."""
    from random import Random

    from lucerna.sources.markup import _Node, _plain, _Tree

    def shape(x):
        return x if isinstance(x, str) else (x.tag, list(x.attrs.items()), x.at, [shape(k) for k in x.kids])

    parts = ["<p>", "</p>", "<P Class=\"a  b\" id=\"x\" id=\"y\">", "<br>", "<br/>", "<div/>", "<h2 >", "</H2>", "<img src=\"/a?b=1\" />", "a  b\n", "è ", "</gone>", "<title>t </TITLE>", "<a\thref=\"\">", "</a>", "<TABLE>", "<tr><td>1", "}", "x&nbsp;y", "&lt;b", "&amp", "&", "&#1;"]
    r = Random(7)
    for _ in range(3000):
        page = "".join(r.choices(parts, k=r.randrange(12)))
        found = _plain(page)
        assert isinstance(found, _Node) and shape(found) == shape(_Tree(page).root), page
    for page in ("<a href=\"?x&amp;y\">", "<title>a &amp; b</title>", "<!-- x --><p>", "<p class=a>", "<script>a<b></script>", "a < b", "<title>a<b>c</title>", "<p", "<textarea><p></textarea>", "<p a='b'>", "</p >"):
        assert _plain(page) is None


def test_costly_filters_stay_above_the_deal_over_the_cores(spark):
    """A filter on a plain column goes below it, so one task would evaluate it for a whole file (F12, F7)."""
    from lucerna.plans.queries import QUERIES

    for name in ("canonical_people", "canonical_offices", "canonical_services", "rooms_of_maps", "rooms_of_all_sources"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("\n")
        below = [b for a, b in zip(plan, plan[1:]) if "RoundRobin" in a]
        assert below and not any("Filter" in x and ("transform(" in x or "regexp" in x) for x in below), name


def test_a_page_of_a_service_is_told_once(spark):
    """Its address is read for each page and not for each of its nodes, and neither attributes nor other texts are sorted (F15)."""
    from lucerna.sources import raw

    rows = [("https://x.it/campus/servizi/a/b/", i, t, {"href": h} if h else {}, s) for i, (t, h, s) in enumerate([("h1", None, "Ufficio A"), ("p", None, "orario"), ("a", "mailto:a@b.it", "m")])]
    out = raw.services_of(spark.createDataFrame([*rows, ("https://x.it/y", 0, "h1", {}, "Y")], "url string, node int, tag string, attrs map<string,string>, text string"))
    assert [tuple(r) for r in out.select("name", "source_url", "email", "opening_hours").collect()] == [("Ufficio A", "https://x.it/campus/servizi/a/", "a@b.it", "Orari disponibili sulla pagina sorgente")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "campus/servizi" not in plan[plan.index("Aggregate"):]


def test_rooms_of_all_sources_reads_all_marks(spark):
    """Marks that are no rooms themselves count too: their descriptions list rooms by floor (F1)."""
    from lucerna.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    mapped = {r.name for r in QUERIES["rooms_of_maps"](spark, sf).select("name").distinct().collect()}
    found = {r.name: r.n for r in QUERIES["rooms_of_all_sources"](spark, sf).where("not planned").collect()}
    assert any(x.startswith("Aula B") for x in mapped) and found == dict.fromkeys(mapped, 1)
