"""The queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text, urls
from ..operators import coverage, dedupe, integrity, links, lookup, merge, rules
from ..sources.tables import spread, table
from .registry import QUERIES, SQL, query

SLUG = r"trim(regexp_replace(lower(regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"select doc_id, {SLUG.format('text')} as slug from documents")
def slug_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", text.slug("text").alias("slug"))


@query(f"select p_partkey, case when len(t) >= 2 then array_to_string(t, '-') end as name_key from (select p_partkey, list_sort(list_distinct(list_filter(string_split({SLUG.format('p_name')}, '-'), lambda x: length(x) > 1))) as t from part)")
def name_keys(spark, d):
    return spread(table(spark, d, "part")).select("p_partkey", text.name_key("p_name").alias("name_key"))


@query(r"""select c_custkey, array_to_string(list_prepend(t[-1], t[1:-2]), '-') as person_id, 'office-' || array_to_string(t, '-') as place_id
from (select c_custkey, string_split(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-'), '-') as t from customer)""")
def entity_ids(spark, d):
    return spread(table(spark, d, "customer")).select("c_custkey", text.person_id("c_name").alias("person_id"), text.place_id(F.lit("OFFICE"), F.col("c_name")).alias("place_id"))


@query(r"""select p_partkey, case when base = b or ends_with(base, '-' || b) then base else base || '-' || b end as room_id
from (select p_partkey, regexp_replace(trim(regexp_replace(lower('Aula ' || p_name), '[^a-z0-9]+', '-', 'g'), '-'), '^aula-', '') as base, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-') as b from part)""")
def room_ids(spark, d):
    return spread(table(spark, d, "part")).select("p_partkey", text.room_id(F.concat(F.lit("Aula "), "p_name"), F.lit(None).cast("string"), F.col("p_brand")).alias("room_id"))


@query(r"select doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as collapsed from documents")
def collapse_ws(spark, d):
    return table(spark, d, "documents").select("doc_id", text.collapse("text").alias("collapsed"))


@query("select p_partkey, regexp_replace(regexp_replace(upper(regexp_replace(p_brand, '[\\s\\-_./]+', '', 'g')), '([0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Z])([0-9])', '\\1 \\2', 'g') as code from part")
def code_labels(spark, d):
    return spread(table(spark, d, "part")).select("p_partkey", text.split_alnum(text.compact_code("p_brand")).alias("code"))


ORDER_ALL = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(ORDER_ALL)}) = 1")
def first_wins_dedupe(spark, d):
    return dedupe.first_wins(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ORDER_ALL)


@query("select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def last_wins_dedupe(spark, d):
    return dedupe.last_wins(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])


@query("select * from orders qualify row_number() over (partition by o_custkey order by o_orderpriority desc, o_orderkey) = 1")
def priority_pick(spark, d):
    return dedupe.best(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


RANK = "(case when o_orderstatus = 'F' then 4 else 0 end + case when o_orderpriority like '1%' then 2 else 0 end + case when o_totalprice > 100000 then 1 else 0 end)"


@query(f"select o_custkey, arg_min(p, (-{RANK}, o_orderkey)) filter (where p is not null) as p, arg_min(o_orderstatus, (-{RANK}, o_orderkey)) as o_orderstatus, max(o_totalprice) as o_totalprice from (select *, nullif(o_orderpriority, '5-LOW') as p from orders) group by o_custkey")
def ranked_merge(spark, d):
    rows = table(spark, d, "orders").withColumn("p", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return dedupe.ranked_merge(rows, ["o_custkey"], F.expr(RANK), "o_orderkey", ["p", "o_orderstatus"], ["o_totalprice"])


FOLD = f"""with recursive t as (select o_custkey, o_orderkey, {RANK} as score, nullif(o_orderpriority, '5-LOW') as p, row_number() over (partition by o_custkey order by o_orderkey) as n from orders),
f as (select * from t where n = 1 union all select t.o_custkey, case when t.score > f.score then t.o_orderkey else f.o_orderkey end, greatest(t.score, f.score), case when t.score > f.score then coalesce(t.p, f.p) else coalesce(f.p, t.p) end, t.n from f join t on t.o_custkey = f.o_custkey and t.n = f.n + 1)
select o_custkey, o_orderkey, score, p from f qualify row_number() over (partition by o_custkey order by n desc) = 1"""


@query(FOLD)
def fold_merge(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.expr(RANK).alias("score"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("p"))
    return dedupe.fold_merge(rows, ["o_custkey"], "o_orderkey", "score", "p")


@query("select l_orderkey, min(l_suppkey) as l_suppkey from lineitem group by l_orderkey having count(distinct l_suppkey) = 1")
def unique_only_map(spark, d):
    return lookup.unique_only(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("""select c_custkey, coalesce(a.v, b.v, c.v) as found from (select *, c_name as by_name, cast(c_custkey % 50 as varchar) as by_code, c_mktsegment as by_segment from customer) x
left join (select s_name as k, s_suppkey as v from supplier) a on a.k = by_name left join (select cast(s_suppkey as varchar) as k, s_suppkey + 1000 as v from supplier where s_acctbal > 0) b on b.k = by_code
left join (select c_mktsegment as k, min(c_custkey) as v from customer group by 1) c on c.k = by_segment""")
def priority_lookup(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    rows = c.select("c_custkey", F.col("c_name").alias("by_name"), (F.col("c_custkey") % 50).cast("string").alias("by_code"), F.col("c_mktsegment").alias("by_segment"))
    kinds = s.select(F.lit("by_name").alias("kind"), F.col("s_name").alias("key"), F.col("s_suppkey").alias("value"))
    kinds = kinds.unionByName(s.where("s_acctbal > 0").select(F.lit("by_code").alias("kind"), F.col("s_suppkey").cast("string").alias("key"), (F.col("s_suppkey") + 1000).alias("value")))
    kinds = kinds.unionByName(c.groupBy("c_mktsegment").agg(F.min("c_custkey").alias("value")).select(F.lit("by_segment").alias("kind"), F.col("c_mktsegment").alias("key"), "value"))
    return lookup.priority_lookup(rows, ["by_name", "by_code", "by_segment"], kinds, "found").select("c_custkey", "found")


@query("""with r as (select o_orderkey, o_custkey, cast(o_orderdate as date) as day, case when o_orderkey % 3 <> 0 then o_orderpriority end as p from orders),
a as (select o_custkey, min(p) as v from r where p is not null group by 1 having count(distinct p) = 1), b as (select day, min(p) as v from r where p is not null group by 1 having count(distinct p) = 1)
select o_orderkey, coalesce(p, case when a.v is null or b.v is null or a.v = b.v then coalesce(a.v, b.v) end) as p from r left join a using (o_custkey) left join b using (day)""")
def consensus_backfill(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.expr("case when o_orderkey % 3 <> 0 then o_orderpriority end").alias("p"))
    return lookup.consensus_backfill(rows, "p", ["o_custkey", "day"]).select("o_orderkey", "p")


HAV = "2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))"


@query(f"""with p as (select c_custkey as pid, 39.36 + (c_custkey * 37 % 1000) / 100000.0 as lat, 16.22 + (c_custkey * 91 % 1000) / 100000.0 as lng from customer),
t as (select s_suppkey as tid, 39.36 + (s_suppkey * 53 % 1000) / 100000.0 as tlat, 16.22 + (s_suppkey * 17 % 1000) / 100000.0 as tlng from supplier),
m as (select pid, tid, {HAV} as metres from (select pid, tid, pow(sin(radians(tlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(tlat)) * pow(sin(radians(tlng - lng) / 2), 2) as h from p cross join t))
select pid, tid, round(metres, 3) as metres from m where metres <= 250 qualify row_number() over (partition by pid order by metres, tid) = 1""")
def nearest_within_radius(spark, d):
    at = lambda k, a, b: [(39.36 + (F.col(k) * a % 1000) / 100000.0), (16.22 + (F.col(k) * b % 1000) / 100000.0)]
    p, t = at("c_custkey", 37, 91), at("s_suppkey", 53, 17)
    points = table(spark, d, "customer").select(F.col("c_custkey").alias("pid"), p[0].alias("lat"), p[1].alias("lng"))
    targets = table(spark, d, "supplier").select(F.col("s_suppkey").alias("tid"), t[0].alias("tlat"), t[1].alias("tlng"))
    return lookup.nearest_within(points, targets, 250, 0.004).withColumn("metres", F.round("metres", 3))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def fk_anti(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return integrity.dangling(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey", o, "o_orderkey")


POLY = "(select case when event_id % 3 = 0 then 'customer' when event_id % 3 = 1 then 'supplier' else 'other' end as entity_type, user_id as entity_id, event_id from events)"


@query(f"select event_id, entity_type, entity_id from {POLY} e where entity_type <> 'other' and not exists (select 1 from (select 'customer' as t, c_custkey as k from customer where c_custkey % 2 = 0 union all select 'supplier', s_suppkey from supplier) r where r.t = entity_type and r.k = entity_id)")
def fk_polymorphic(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr("case when event_id % 3 = 0 then 'customer' when event_id % 3 = 1 then 'supplier' else 'other' end").alias("entity_type"), F.col("user_id").alias("entity_id"))
    c = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.lit("customer").alias("entity_type"), F.col("c_custkey").alias("entity_id"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("entity_type"), F.col("s_suppkey").alias("entity_id"))
    return e.where("entity_type <> 'other'").join(c.unionByName(s), ["entity_type", "entity_id"], "left_anti").select("event_id", "entity_type", "entity_id")


@query("select l_orderkey, l_linenumber, l_shipdate, o_orderstatus from lineitem join orders on o_orderkey = l_orderkey where o_orderstatus is distinct from l_linestatus")
def attr_conflict(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey").where(~F.col("o_orderstatus").eqNullSafe(F.col("l_linestatus"))).select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderstatus")


@query("select p_name, p_brand, p_partkey, first_id from (select *, row_number() over w as n, first(p_partkey) over w as first_id from part window w as (partition by p_name, p_brand order by p_partkey)) where n > 1")
def dup_keys(spark, d):
    return integrity.repeats(table(spark, d, "part"), ["p_name", "p_brand"], "p_partkey", ["p_partkey"]).select("p_name", "p_brand", "p_partkey", "first_id")


@query("select p_name, p_type, string_agg(distinct p_brand, ',' order by p_brand) as found from part group by 1, 2 having count(distinct p_brand) > 1")
def conflict_groups(spark, d):
    return integrity.conflicts(table(spark, d, "part"), ["p_name", "p_type"], "p_brand")


@query("select p_brand, key, count(*) as n, min(p_partkey) as first_id from (select p_brand, p_partkey, array_to_string(list_sort(list_distinct(string_split(lower(p_name || ' ' || p_type), ' '))), ' ') as key from part) group by 1, 2 having count(*) > 1")
def near_dups(spark, d):
    key = F.array_join(F.array_sort(F.array_distinct(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " "))), " ")
    return table(spark, d, "part").select("p_brand", "p_partkey", key.alias("key")).groupBy("p_brand", "key").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_id")).where("n > 1")


@query("""select 'error' as level, 'lineitem' as file, 'missing order ' || l_orderkey as message, cast(l_partkey as varchar) as record_id from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')
union all select 'error', 'part', 'repeats ' || first_id, cast(p_partkey as varchar) from (select *, row_number() over w as n, first(p_partkey) over w as first_id from part window w as (partition by p_name, p_brand order by p_partkey)) where n > 1
union all select 'warning', 'part', 'brands ' || string_agg(distinct p_brand, ',' order by p_brand), p_name from part group by p_name having count(distinct p_brand) > 1""")
def integrity_report(spark, d):
    part, items = table(spark, d, "part"), table(spark, d, "lineitem")
    missing = integrity.dangling(items, "l_orderkey", table(spark, d, "orders").where("o_orderstatus = 'F'"), "o_orderkey")
    again, brands = integrity.repeats(part, ["p_name", "p_brand"], "p_partkey", ["p_partkey"]), integrity.conflicts(part, ["p_name"], "p_brand")
    return integrity.report(
        integrity.issue(missing, "error", "lineitem", F.concat(F.lit("missing order "), "l_orderkey"), F.col("l_partkey")),
        integrity.issue(again, "error", "part", F.concat(F.lit("repeats "), "first_id"), F.col("p_partkey")),
        integrity.issue(brands, "warning", "part", F.concat(F.lit("brands "), "found"), F.col("p_name")),
    )


@query("select p_brand, count(*) as total, count_if(p_size > 25) as sized, count_if(nullif(p_type, 'SMALL') is not null) as typed, count_if(p_size > 25) / count(*) as sized_ratio, count_if(nullif(p_type, 'SMALL') is not null) / count(*) as typed_ratio from part group by 1")
def coverage_report(spark, d):
    return coverage.coverage(table(spark, d, "part"), {"sized": F.col("p_size") > 25, "typed": F.expr("nullif(p_type, 'SMALL') is not null")}, ["p_brand"])


@query("select coalesce(nullif(source, 'src0'), 'unknown') as source, count(*) as n from documents where n_chars < 500 group by 1")
def missing_by_source(spark, d):
    return table(spark, d, "documents").where("n_chars < 500").groupBy(F.coalesce(F.expr("nullif(source, 'src0')"), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


@query("""with b as (select count_if(o_totalprice > 100000) as x from orders where o_orderkey % 2 = 0), a as (select count(*) as total, count_if(o_totalprice > 100000) as x, count_if(o_custkey is not null) as y from orders)
select a.x >= b.x as not_fallen, a.y = a.total as is_complete from a, b""")
def coverage_gate(spark, d):
    o, m = table(spark, d, "orders"), {"x": F.col("o_totalprice") > 100000, "y": F.col("o_custkey").isNotNull()}
    return coverage.gate(coverage.coverage(o.where("o_orderkey % 2 = 0"), m), coverage.coverage(o, m), "x", "y")


@query("""select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, coalesce(n.p, o.p) as p, coalesce(n.s, o.s) as s from (select o_orderkey, o_orderpriority as p, o_orderstatus as s from orders where o_orderkey % 3 <> 0) o
full join (select o_orderkey, nullif(o_orderpriority, '1-URGENT') as p, 'N' as s from orders where o_orderkey % 2 = 0) n on n.o_orderkey = o.o_orderkey""")
def baseline_merge(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"))
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.expr("nullif(o_orderpriority, '1-URGENT')").alias("p"), F.lit("N").alias("s"))
    return merge.baseline_merge(old, new, "o_orderkey")


@query("with n as (select o_orderkey, 'new' as s from orders where o_orderkey % 5 = 0) select o_orderkey, o_orderstatus as s from orders where o_orderstatus <> 'F' and o_orderkey not in (select o_orderkey from n) union all select * from n")
def partition_replace(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"))
    return merge.partition_replace(o, o.where("o_orderkey % 5 = 0").withColumn("s", F.lit("new")), F.col("s") == "F", "o_orderkey")


RULES = [(1, "set_null", None, 5, "a"), (2, "replace", "X", 5, "b"), (2, "set_null", None, 9, "c"), (3, "override", "Y", 1, "d"), (4, "drop_if_prefix", "BUILD", 1, "e"), (5, "drop_if_prefix", "auto", 1, "f"), (6, "replace", "Z", 2, "g"), (6, "replace", "W", 2, "h")]


@query(f"""with r as (select * from (values {', '.join(str((a, b, c or '', p, i)) for a, b, c, p, i in RULES)}) t(target, action, v, priority, id) qualify row_number() over (partition by target order by priority desc, id) = 1),
j as (select c_custkey, c_mktsegment as old, case action when 'set_null' then null when 'replace' then v when 'override' then coalesce(nullif(c_mktsegment, ''), v) when 'drop_if_prefix' then case when starts_with(lower(c_mktsegment), lower(v)) then null else c_mktsegment end else c_mktsegment end as c_mktsegment from customer left join r on target = c_custkey)
select c_custkey, c_mktsegment, old is distinct from c_mktsegment as changed from j""")
def corrections_apply(spark, d):
    rules = spark.createDataFrame(RULES, "target long, action string, value string, priority int, id string")
    return merge.apply_corrections(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment", rules)


@query("select p_partkey, case when p_name like '%red%' then 'r' when p_name like '%blue%' then 'b' when p_name like '%e%' then 'e' end as found from part")
def override_rules(spark, d):
    return merge.first_rule(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", [("red", "r"), ("blue", "b"), ("e", "e")], "found").drop("p_name")


@query(r"""select p_partkey, key, label from (select p_partkey, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') as key, label, prio from (select p_partkey, unnest([p_name, p_brand, p_name || ' ' || p_brand, upper(p_name)]) as label, unnest([1, 2, 3, 4]) as prio from part)) qualify row_number() over (partition by p_partkey, key order by prio) = 1""")
def alias_build(spark, d):
    labels = F.posexplode(F.array(F.col("p_name"), F.col("p_brand"), F.concat_ws(" ", "p_name", "p_brand"), F.upper("p_name"))).alias("prio", "label")
    rows = spread(table(spark, d, "part")).select("p_partkey", labels).withColumn("key", text.slug("label"))
    return dedupe.first_wins(rows, ["p_partkey", "key"], ["prio"]).select("p_partkey", "key", "label")


@query("""with o as (select o_orderkey as k, o_orderpriority as p, o_orderstatus as s from orders where o_orderkey % 7 <> 0), n as (select o_orderkey as k, case when o_orderkey % 4 = 0 then null else o_orderpriority end as p, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end as s from orders where o_orderkey % 6 <> 0),
j as (select o.k as ok, n.k as nk, o.p as op, n.p as np, o.s as os, n.s as ns from o full join n on o.k = n.k)
select '*' as field, 'removed' as kind, count_if(nk is null) as n from j union all select '*', 'added', count_if(ok is null) from j
union all select 'p', 'lost', count_if(ok is not null and nk is not null and op is not null and np is null) from j union all select 'p', 'changed', count_if(ok is not null and nk is not null and op is distinct from np) from j
union all select 's', 'lost', count_if(ok is not null and nk is not null and os is not null and ns is null) from j union all select 's', 'changed', count_if(ok is not null and nk is not null and os is distinct from ns) from j""")
def release_diff(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"))
    new = o.where("k % 6 <> 0").select("k", F.expr("case when k % 4 = 0 then null else p end").alias("p"), F.expr("case when k % 5 = 0 then 'X' else s end").alias("s"))
    return merge.release_diff(o.where("k % 7 <> 0"), new, "k", ["p", "s"])


def _manifest_sql(name, line):
    return f"select '{name}' as name, cast(sum(n) as bigint) as records, sha256(string_agg(d, chr(10) order by p)) as digest from (select d[1:3] as p, count(*) as n, sha256(string_agg(d, chr(10) order by d)) as d from (select sha256({line}) as d from {name}) group by 1)"


@query(" union all ".join(_manifest_sql(*x) for x in (("customer", "c_custkey || '|' || c_name"), ("orders", "o_orderkey || '|' || o_orderstatus"))))
def manifest(spark, d):
    return coverage.manifest({n: table(spark, d, n) for n in ("customer", "orders")}, {"customer": F.concat_ws("|", "c_custkey", "c_name"), "orders": F.concat_ws("|", "o_orderkey", "o_orderstatus")})


@query("select user_id, count(*) as attempts, count_if(event_type = 'error') as failures, count(distinct event_type) as kinds from events group by user_id")
def diagnostics(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "error").alias("failures"), F.count_distinct("event_type").alias("kinds"))


@query("""select page_id, href, count(*) as n from (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages) group by 1, 2""")
def html_links(spark, d):
    hrefs = F.explode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), 1)).alias("href")
    return table(spark, d, "pages").select("page_id", hrefs).groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query(r"""select page_id, coalesce(nullif(trim(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '\s+', ' ', 'g')), ''), nullif(trim(regexp_replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '')) as heading from pages""")
def html_headings(spark, d):
    pick = lambda tag: text.none_if_empty(F.regexp_extract("html", f"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1))
    return table(spark, d, "pages").select("page_id", F.coalesce(pick("h1"), pick("title")).alias("heading"))


@query(r"select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as words from pages")
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_html("html").alias("words"))


@query(r"""select page_id, host, case when host <> '' then array_to_string(list_prepend(host, list_filter(string_split(path, '/'), lambda x: x <> '')[1:2]), '/') end as canonical from (select page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) as host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) as path from pages)""")
def url_parts(spark, d):
    c = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.host(c).alias("host"), F.when(urls.host(c) != "", F.rtrim(urls.canonical(c, 2), F.lit("/"))).alias("canonical"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.expr("try_cast(get_json_object(props, '$.k') as bigint)").alias("k"))


@query("""select 'union' as op, count(*) as n from (select c_custkey from customer union select user_id from events) union all
select 'minus', count(*) from (select c_custkey from customer except select user_id from events) union all select 'both', count(*) from (select c_custkey from customer intersect select user_id from events) union all
select 'bag', count(*) from (select c_custkey from customer union all select user_id from events)""")
def set_ops(spark, d):
    a, b = table(spark, d, "customer").select("c_custkey"), table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    ops = {"union": a.union(b).distinct(), "minus": a.subtract(b), "both": a.intersect(b), "bag": a.union(b)}
    return reduce(DataFrame.unionByName, [x.agg(F.count("*").alias("n")).select(F.lit(k).alias("op"), "n") for k, x in ops.items()])


@query("select l_suppkey, l_orderkey, l_linenumber, l_extendedprice from lineitem qualify row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey) <= 3")
def topk_cap(spark, d):
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    return table(spark, d, "lineitem").withColumn("n", F.row_number().over(w)).where("n <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("""select doc_id, min(t) as target from (select doc_id, t from (select distinct doc_id, w from (select doc_id, unnest(string_split(lower(text), ' ')) as w from documents)) join (select 'lang-' || lang as t, lower(lang) as w from documents where lang is not null union select 'article', 'the' union select 'article', 'les') using (w)) group by doc_id having count(distinct t) = 1""")
def word_links(spark, d):
    docs = table(spark, d, "documents")
    named = docs.where("lang is not null").select(F.concat(F.lit("lang-"), "lang").alias("target"), F.lower("lang").alias("word")).union(spark.createDataFrame([("article", "the"), ("article", "les")], "target string, word string")).distinct()
    return links.word_links(docs, "doc_id", F.split(F.lower("text"), " "), named)


@query("""select c_custkey, coalesce(a.s_suppkey, b.s_suppkey, c.s_suppkey) as target from customer left join supplier a on a.s_suppkey = case when c_acctbal < 0 then c_custkey + 5 end
left join supplier b on b.s_suppkey = case when c_mktsegment like 'B%' then c_custkey * 2 end left join supplier c on c.s_suppkey = c_nationkey""")
def rule_chain_link(spark, d):
    c = table(spark, d, "customer")
    chain = [(F.col("c_acctbal") < 0, F.col("c_custkey") + 5), (F.col("c_mktsegment").like("B%"), F.col("c_custkey") * 2), (F.lit(True), F.col("c_nationkey").cast("long"))]
    return links.existing_rule(c, chain, table(spark, d, "supplier"), "s_suppkey", "target").select("c_custkey", "target")


@query("select o_orderkey, concat_ws('__', 'customer-' || o_custkey, lower(o_orderpriority), 'order-' || o_orderkey) as link_id from orders")
def entity_links(spark, d):
    c = F.concat(F.lit("customer-"), "o_custkey"), F.concat(F.lit("order-"), "o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", links.link_id(c[0], F.col("o_orderpriority"), c[1]).alias("link_id"))


@query("""select p_partkey, 'p_size' as field, 'minimum' as error from part where p_size < 10 union all select p_partkey, 'p_type', 'enum' from part where p_type not in ('SMALL', 'ECONOMY')
union all select p_partkey, 'p_brand', 'pattern' from part where not regexp_matches(p_brand, '^Brand#[1-4]') union all select p_partkey, 'p_name', 'required' from part where p_name is null""")
def schema_errors(spark, d):
    return rules.schema_errors(table(spark, d, "part"), "p_partkey", ["p_name"], {"p_type": ["SMALL", "ECONOMY"]}, {"p_size": 10}, {"p_brand": "^Brand#[1-4]"})


@query("""with recursive p as (select page_id as url, case when page_id % 10 <> 9 then page_id + 1 else page_id - 9 end as next from pages), r(url, step) as (select url, 0 from p where url % 10 = 3 union all select p.next, step + 1 from r join p using (url) where step < 9 and p.next in (select url from p))
select url, min(step) as step from r group by url""")
def paginate(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("url"), F.expr("case when page_id % 10 <> 9 then page_id + 1 else page_id - 9 end").alias("next"))
    return rules.pages_in_order(pages.where("url % 10 = 3").select("url"), pages, 9)


@query(f"select p_partkey, array_to_string(list_sort(list_distinct([s, replace(s, '-', ''), regexp_replace(s, '^aula-', ''), lower(p_brand), {SLUG.format('p_type')}])), ' ') as tokens from (select *, {SLUG.format("'Aula ' || p_name")} as s from part)")
def search_tokens(spark, d):
    return spread(table(spark, d, "part")).select("p_partkey", F.array_join(text.search_tokens(F.concat(F.lit("Aula "), "p_name"), F.col("p_brand"), F.col("p_type")), " ").alias("tokens"))


def flagship(spark, d):
    """How complete each brand's parts are, once repeated names are gone."""
    part = spread(table(spark, d, "part")).withColumn("slug", text.slug("p_name"))
    kept = dedupe.first_wins(part, ["slug", "p_brand"], ["p_partkey"])
    return coverage.coverage(kept, {"sized": F.col("p_size") > 25}, ["p_brand"]).orderBy("p_brand")


QUERIES["flagship"] = flagship
SQL["flagship"] = f"select p_brand, count(*) as total, count_if(p_size > 25) as sized, count_if(p_size > 25) / count(*) as sized_ratio from (select *, {SLUG.format('p_name')} as slug from part qualify row_number() over (partition by slug, p_brand order by p_partkey) = 1) group by 1"

from . import campus, cases, datasets, rooms  # noqa: E402, F401  register their queries
