"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A sketch has SIZE coordinates.  In round i < SIZE each shingle falls in the bin that its round hash names, with value i + fraction; in
round i >= SIZE every shingle falls in bin i - SIZE.  A coordinate keeps the least value that fell in it; rounds end once every
coordinate is filled, at the latest after 2 * SIZE rounds (Dahlgaard, Knudsen and Thorup, 2017).  Agreeing coordinates estimate the
Jaccard similarity with concentration bounds.  BANDS bands of SIZE / BANDS coordinates make candidates: at similarity 0.75 a pair is
missed with probability (1 - 0.75^4)^32, about 5e-6.

Documents with equal shingle sets are one class, represented by the smallest doc_id.  In a bucket all members are held against one pivot, the
member that shares the most buckets, so tests grow with the members.  That leaves pairs of members x, y of one pivot p in different
components.  Let x lack a and add b of p's shingles.  At most |p| - max(a_x, a_y) + o are common to x and y, where o added ones are common,
so either the counts allow a link with o = 0 (few do: classes of equal counts are compared, not members) or x and y share added shingles.
Added shingles with the same members are taken together, common ones are summed by pair, and pairs whose sum suffices are verified.  No
pair that shares a bucket is lost.

Nulls and edges: null, empty or wordless texts have no shingles and are linked with nothing; a null doc_id is never linked and has a null
component_id and kept true; rows that share a doc_id are one node; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, as_long, documents, hashed, having, ids, mix, raw, shingles, slices, split_all, texts
from .components import components

SIZE, BANDS, WORDS = 128, 32, 5
SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def sketch(s: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of a set of 64-bit hashes: (round << 56) + fraction in each coordinate."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 2048 // len(s))
    for first in range(0, size, step):
        rounds = np.arange(first, min(size, first + step), dtype=np.uint64)
        h = mix(s[None, :] + mix(rounds + np.uint64(1))[:, None])
        np.minimum.at(out, (h & np.uint64(size - 1)).astype(np.int64).ravel(), ((h >> np.uint64(8)) | (rounds << np.uint64(56))[:, None]).ravel())
        if (out >> np.uint64(56)).max() < size:
            return out
    for i in np.flatnonzero((out >> np.uint64(56)) >= size):  # the rounds of one bin each
        h = mix(s + mix(np.array([size + i + 1], np.uint64)))
        out[i] = (h >> np.uint64(8)).min() | np.uint64(min(255, size + i) << 56)
    return out


def _shingled(b, column="text"):
    words, starts = split_all([t.lower() for t in raw(b, column)])
    h = hashed(words)
    return [shingles(h[a:e], WORDS) for a, e in zip(starts[:-1], starts[1:])]


def _sketches(batches):
    for b in slices(batches):
        n, key, bands = [], [], []
        for s in _shingled(b):
            n.append(len(s))
            key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            if len(s):
                x = sketch(s).reshape(BANDS, -1)
                acc = np.arange(BANDS, dtype=np.uint64)
                for j in range(x.shape[1]):
                    acc = mix(acc * np.uint64(31) + x[:, j])
                bands.append(acc.view(np.int64))
            else:
                bands.append(None)
        yield pa.RecordBatch.from_arrays([ids(b), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])


def _sets(batches):
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays([ids(b), pa.array([s.tobytes() for s in _shingled(b)], pa.binary())], names=["doc_id", "shingles"])


def _tested(percent: int):
    """Each pair with whether it is linked, and for what it may share with others: |p|, lacking and added."""

    def run(batches):
        last = (None, None)
        for b in batches:
            size, lacks, adds, link = [], [], [], []
            for p, ps, xs in zip(ids(b, "p").to_pylist(), ids(b, "ps"), ids(b, "xs")):
                if last[0] != p:
                    last = (p, np.frombuffer(ps.as_buffer(), np.uint64))
                x = np.frombuffer(xs.as_buffer(), np.uint64)
                both = len(np.intersect1d(last[1], x, assume_unique=True))
                size.append(len(last[1]))
                lacks.append(len(last[1]) - both)
                adds.append(len(x) - both)
                link.append(both > 0 and 100 * both >= percent * (len(last[1]) + len(x) - both))
            yield pa.RecordBatch.from_arrays([ids(b, "p"), ids(b, "x"), pa.array(size, pa.int64()), pa.array(lacks, pa.int64()), pa.array(adds, pa.int64()), pa.array(link, pa.bool_())], names=["p", "x", "size", "lacks", "adds", "link"])

    return run


def _added(batches):
    for b in batches:
        more = [np.setdiff1d(np.frombuffer(xs.as_buffer(), np.uint64), np.frombuffer(ps.as_buffer(), np.uint64), assume_unique=True).view(np.int64) for ps, xs in zip(ids(b, "ps"), ids(b, "xs"))]
        n = [len(m) for m in more]
        take = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays([*(ids(b, c).take(take) for c in ("p", "x", "component")), pa.array(np.concatenate(more) if more else np.zeros(0, np.int64))], names=["p", "x", "component", "shingle"])


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id (the smallest doc_id with the same shingles)."""
    scratch = Scratch(docs.sparkSession)
    known = docs.where("doc_id is not null")
    sketches = scratch.table(texts(docs).mapInArrow(_sketches, SKETCH), "sketches")
    # keys of several documents only, as a table of its own: a join of two tables can split the rows of a key that many have
    classes = scratch.table(sketches.where("doc_id is not null and n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "classes")
    alone = F.when(F.col("n_shingles") > 0, F.col("doc_id"))
    member = sketches.join(classes, "set_key", "left").withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", alone)))
    member = scratch.table(member.select("doc_id", "n_shingles", "class_id", F.when(F.col("doc_id") == F.col("class_id"), F.col("bands")).alias("bands")), "members")
    scratch.drop(sketches, classes)
    rows = member.where("bands is not null").select(F.explode(F.array_distinct("bands")).alias("bucket"), "doc_id").distinct()
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = scratch.table(rows.join(full, "bucket"), "shared")
    degree = shared.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    wanted = degree.select("doc_id")
    ranked = shared.join(degree, "doc_id").select("bucket", "doc_id", F.struct("degree", -F.col("doc_id")).alias("rank"))
    pivots = ranked.groupBy("bucket").agg((-F.max("rank")["col2"]).alias("p"))
    first = shared.join(pivots, "bucket").where("p <> doc_id").select("p", F.col("doc_id").alias("x")).distinct()
    sets = scratch.table(having(texts(known), wanted, scratch).mapInArrow(_sets, "doc_id long, shingles binary"), "sets")

    def with_sets(pairs: DataFrame) -> DataFrame:
        return pairs.join(sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("xs")), "x").join(sets.select(F.col("doc_id").alias("p"), F.col("shingles").alias("ps")), "p")

    def tested(pairs: DataFrame, name: str) -> DataFrame:
        return scratch.table(with_sets(pairs).select("p", "x", "ps", "xs").mapInArrow(_tested(percent), "p long, x long, size long, lacks long, adds long, link boolean"), name)

    tests = tested(first, "tests")
    links = tests.where("link").select(F.col("p").alias("a"), F.col("x").alias("b"))
    found = components(links, scratch)
    rest = tests.drop("link").join(found.select(F.col("node").alias("x"), "component"), "x", "left").withColumn("component", F.coalesce("component", "x"))
    mixed = rest.groupBy("p").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("p")
    rest = scratch.table(rest.join(mixed, "p"), "rest")
    pairs = _by_counts(rest, percent).unionByName(_by_added(rest, with_sets(rest.select("p", "x", "component")).mapInArrow(_added, "p long, x long, component long, shingle long"), percent)).distinct()
    more = tested(pairs, "more").where("link").select(F.col("p").alias("a"), F.col("x").alias("b"))
    found = components(links.unionByName(more), scratch)
    out = member.join(found.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    component = F.coalesce("component", "class_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.coalesce("class_id", "doc_id").alias("class_id"))


def _enough(percent: int, common: str) -> str:
    """Whether pairs (l, r) of one pivot can be linked with so many added shingles in common."""
    both = f"(l.size - greatest(l.lacks, r.lacks) + {common})"
    return f"{100 + percent} * {both} >= {percent} * (2 * l.size - l.lacks - r.lacks + l.adds + r.adds)"


def _by_counts(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that need no added shingle in common."""
    key = ["p", "size", "lacks", "adds"]
    kinds = rest.select(*key).distinct()
    l, r = kinds.alias("l"), kinds.alias("r")
    fit = l.join(r, F.expr(f"l.p = r.p and {_enough(percent, '0')}")).select(F.col("l.p").alias("p"), F.col("l.lacks").alias("l1"), F.col("l.adds").alias("a1"), F.col("r.lacks").alias("l2"), F.col("r.adds").alias("a2"))
    x = rest.select("p", F.col("lacks").alias("l1"), F.col("adds").alias("a1"), F.col("x").alias("v"), F.col("component").alias("c1"))
    y = rest.select("p", F.col("lacks").alias("l2"), F.col("adds").alias("a2"), F.col("x").alias("w"), F.col("component").alias("c2"))
    return fit.join(x, ["p", "l1", "a1"]).join(y, ["p", "l2", "a2"]).where("v < w and c1 <> c2").select(F.col("v").alias("p"), F.col("w").alias("x"))


def _by_added(rest: DataFrame, added: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components with enough added shingles in common."""
    lists = added.groupBy("p", "shingle").agg(F.count("*").alias("n"), F.sum(F.xxhash64("x").cast("decimal(38,0)")).alias("sign"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    lists = lists.groupBy("p", "n", "sign").agg(F.min("shingle").alias("shingle"), F.count("*").alias("weight"))
    posted = added.join(lists.select("p", "shingle", "weight"), ["p", "shingle"]).select("p", "x", "shingle", "weight")
    shareable = posted.groupBy("p", "x").agg(F.sum("weight").alias("shareable"))  # no pair has more in common
    posted = posted.join(rest.join(shareable, ["p", "x"]), ["p", "x"])
    l, r = posted.alias("l"), posted.alias("r")
    met = l.join(r, F.expr(f"l.p = r.p and l.shingle = r.shingle and l.x < r.x and l.component <> r.component and {_enough(percent, 'least(l.shareable, r.shareable)')}"))
    met = met.groupBy("l.p", F.col("l.x").alias("v"), F.col("r.x").alias("w"), "l.size", F.col("l.lacks").alias("l1"), F.col("l.adds").alias("a1"), F.col("r.lacks").alias("l2"), F.col("r.adds").alias("a2")).agg(F.sum("l.weight").alias("common"))
    enough = f"{100 + percent} * (size - greatest(l1, l2) + common) >= {percent} * (2 * size - l1 - l2 + a1 + a2)"
    return met.where(enough).select(F.col("v").alias("p"), F.col("w").alias("x"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


ORACLE = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as materialized (
  select distinct doc_id, array_to_string(w[p : p + least(5, len(w)) - 1], ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as p from words where len(w) > 0)),
n as materialized (select doc_id, count(*) as n from sh group by doc_id),
links as materialized (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as k from sh x join sh y on x.s = y.s and x.doc_id <> y.doc_id group by all) t
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 75 * (na.n + nb.n - k)),
reach(node, low) as (
  select doc_id, doc_id from words
  union
  select links.b, reach.low from reach join links on links.a = reach.node where reach.low < links.b),
comp as (select node, min(low) as component_id from reach group by node)
select words.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, words.doc_id = component_id as kept, cl.class_id
from words join comp on comp.node = words.doc_id left join n on n.doc_id = words.doc_id
join (select doc_id, case when l is null then doc_id else min(doc_id) over (partition by l) end as class_id from (select words.doc_id, g.l from words left join (select doc_id, md5(string_agg(s, chr(10) order by s)) as l from sh group by doc_id) g on g.doc_id = words.doc_id)) cl on cl.doc_id = words.doc_id
"""
