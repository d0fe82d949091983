from pyspark.sql import functions as F

from lucerna.functions import rooms, text
from lucerna.operators import dedupe, merge
from lucerna.sources.tables import json_array


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


def test_text(spark):
    assert one(spark, text.collapse("x"), x=" a  b\x1c\n") == "a b"
    assert one(spark, text.collapse("x"), x=None) == ""
    assert one(spark, text.slug("x"), x="  Società ÀÉ--x!") == "societa-ae-x"
    assert one(spark, text.name_key("x"), x="Prof. Rossi Mario Rossi") == "mario-rossi"
    assert one(spark, text.name_key("x"), x="Dott. Rossi") is None
    assert one(spark, text.person_id(F.col("x")), x="Mario De Rossi") == "rossi-mario-de"
    assert one(spark, text.roman("x"), x="XIV") == 14
    assert one(spark, text.casefold("x"), x="Straße") == "strasse"
    assert one(spark, rooms.capacity("x"), x="capienza 9000, posti 30") is None
    assert one(spark, rooms.capacity("x"), x="posti: 30") == 30


def test_first_wins_groups_nulls(spark):
    rows = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), (1, 3, "c")], "k int, o int, v string")
    assert sorted(r.v for r in dedupe.first_wins(rows, ["k"], ["o"]).collect()) == ["a", "c"]


def test_fold_keeps_the_row_at_hand_on_ties(spark):
    rows = spark.createDataFrame([(1, 1, 5, None), (1, 2, 5, "x"), (1, 3, 6, None)], "k int, o int, s int, f string")
    assert dedupe.fold_merge(rows, ["k"], "o", "s", "f").first().asDict() == {"k": 1, "o": 3, "s": 6, "f": "x"}


def test_baseline_merge(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert {r.id: r.v for r in merge.baseline_merge(old, new, "id").collect()} == {1: "a", 2: "b", 3: "c"}
    assert {r.id: r.v for r in merge.baseline_merge(old, new, "id", overwrite_nulls=True).collect()} == {1: "a", 2: None, 3: "c"}


def test_json_arrays(spark, tmp_path):
    p = tmp_path / "x.json"
    p.write_text('[{"a": 1}, 3, {"a": 2}]')
    assert sorted(r.a for r in json_array(spark, f"file://{p}", "a int").collect()) == [1, 2]
    assert json_array(spark, f"file://{p}.none", "a int").count() == 0
    try:
        json_array(spark, f"file://{p}", "a int", strict=True)
    except ValueError:
        return
    raise AssertionError


def test_first_rows_are_limited_before_the_exchange(spark):
    from lucerna.operators import dedupe

    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 2, "w"), ("b", None, "v")], "k string, n int, v string")
    plan = dedupe.first_wins(rows, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial") and "WindowGroupLimit" in plan
    assert sorted(r.v for r in dedupe.first_wins(rows, ["k"], ["n"]).collect()) == ["v", "w", "x"]
    assert sorted(r.v for r in dedupe.last_wins(rows, ["k"], ["n"]).collect()) == ["v", "y", "z"]
    assert sorted(r.v for r in dedupe.best(rows, ["k"], "n", "v").collect()) == ["v", "y", "z"]
