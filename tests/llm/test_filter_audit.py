"""The audit against SQL and against a brute force that applies every order row by row."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from lucerna.llm import op11_filter_audit as op
from lucerna.llm.common import Scratch

SF = "/root/testdata/sf0.001"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "doc_id long, text string, lang string, sha string, mask int, part string, low long, n long"


def rows(it):
    return sorted(tuple(r[c] for c in COLUMNS) for r in it)


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    docs = [(i, t or "", p or "") for i, t, p in docs]
    good, toxic = ({i for i, *v in labels if i is not None and v[j] == 1} for j in (0, 1))

    def fails(i, t):
        words = t.replace("\x0b", " ").encode().split()
        yield "A", len(words) < 100
        yield "B", 100 * len(set(words)) < 80 * len(words)
        yield "C", 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)
        yield "D", any(c in "#$%&*|" for c in t)
        yield "E", i is not None and any(t == u and j is not None and j < i for j, u, _ in docs)

    failed = [({x for x, y in fails(i, t) if y}, i, p) for i, t, p in docs]
    out = []
    for part in {p for *_, p in failed}:
        own = [(f, i) for f, i, p in failed if p == part]
        shapley = Counter()
        made = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(f, i) for f, i in left if x in f]
                stay = [(f, i) for f, i in left if x not in f]
                shapley[x] += len(gone)
                made.append([part, "".join(order), step, len(stay), len(gone), sum(x in f for f, _ in own) - len(gone), sum(f == {x} for f, _ in own), sum(i in good for _, i in gone), sum(i in toxic for _, i in gone), x])
                left = stay
        out += [tuple(r[:-1] + [shapley[r[-1]]]) for r in made]
    return sorted(out)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(op.ORACLE)
    got = rows(op.query(spark, SF).collect())
    assert len(got) == 600 * 4
    assert got == sorted(want.select(", ".join(COLUMNS)).fetchall())


def made(seed):
    rng = random.Random(seed)
    texts = ["", None, "a b", "A B", "x #", " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i % 50}" for i in range(120)), "É" * 9 + "A", "AAAA " * 130 + "|", "a\x0bb\x1cc", "l " * 5000]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("partitions", [4, 32])
def test_equals_brute_force(spark, seed, partitions):
    docs, labels = made(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that groups of copies cross ranges
    try:
        d = spark.createDataFrame([(i, t, p, "s", 3, "p", 4, 5) for i, t, p in docs], SCHEMA)
        got = op.audit(d, spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string"))
        assert rows(got.collect()) == brute(docs, labels)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_copies_over_many_ranges(spark):
    """One text in all ranges, every doc_id twice: all but the two rows of the smallest id are copies."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        d = spark.range(300).selectExpr("id div 2 + 7 as doc_id", "'same text' as text", "'en' as lang").repartition(16)
        found = op.masks(d, Scratch(spark)).collect()
        assert Counter(r.mask >> 4 for r in found) == {0: 2, 1: 298}
        assert {r.doc_id for r in found if not r.mask >> 4} == {7}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op.audit(d, none).count() == 0
    assert op.audit(spark.createDataFrame([(1, "a", None)], d.schema), none).count() == 600


def test_no_text_is_sorted(spark):
    """Texts are judged where they are read: the step that sorts rows has fingerprints only."""
    plans = {}

    class Seen(Scratch):
        def table(self, df, name):
            plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
            return super().table(df, name)

    rows = spark.createDataFrame([(2, "a b", "it"), (1, "a b", "it"), (3, None, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: bool(r.mask & 16) for r in op.masks(rows, Seen(spark)).collect()}
    assert found == {1: False, 2: True, 3: False} and "Sort" in plans["compared"] and "text" not in plans["compared"]
