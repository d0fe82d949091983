"""Requests against recorded responses: cache keys, cached bodies, retries, diagnostics, budgets, crawls.  Nothing here opens a connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.rules import cut

#: Statuses worth another attempt; an attempt without a status failed in transport.
RETRIED = (408, 425, 429, 500, 502, 503, 504)


def ascii_json(c) -> Column:
    """A JSON text with every character outside printable ASCII as `\\uXXXX` in small letters, those beyond U+FFFF as two of them."""
    parts = F.regexp_extract_all(c, F.lit(r"(\\u[0-9A-Fa-f]{4}|\\.|[ -\[\]-~]+|[^ -~])"), F.lit(1))
    units = lambda x: F.lower(F.regexp_replace(F.hex(F.encode(x, "UTF-16BE")), "(.{4})", r"\\u$1"))
    return F.array_join(F.transform(parts, lambda x: F.when(F.rlike(x, F.lit(r"^\\u")), F.lower(x)).when(F.rlike(x, F.lit("^[ -~]")), x).otherwise(units(x))), "")


def canonical_json(c) -> Column:
    """One text for all ways to write a JSON value: keys sorted at every depth, no white space, ASCII; null stays null.

    Numbers lose zeros at the end of fractions.  What is no JSON, or has a key twice in one object, fails the query.
    """
    return ascii_json(F.to_json(F.parse_json(c)))


def cache_key(method, url, payload=None) -> Column:
    """SHA-256 of the canonical JSON object of method, payload (JSON in any form, null without one) and url."""
    quoted = lambda c: ascii_json(F.regexp_replace(F.to_json(F.struct(c.alias("x"))), r'^\{"x":|\}$', ""))
    body = F.lit("null") if payload is None else F.coalesce(canonical_json(payload), F.lit("null"))
    return F.sha2(F.concat(F.lit('{"method":'), quoted(F.upper(method)), F.lit(',"payload":'), body, F.lit(',"url":'), quoted(url), F.lit("}")), 256)


def through_cache(requests: DataFrame, cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """requests (key, ...) with the body that the cache (key, body) has, else the one fetched (key, body); `hit` tells which."""
    out = requests.join(cache.select("key", F.col("body").alias("_c"), F.lit(True).alias("_h")), "key", "left").join(fetched.select("key", F.col("body").alias("_f")), "key", "left")
    return out.withColumn("hit", F.col("_h").isNotNull()).withColumn("body", F.when(F.col("hit"), F.col("_c")).otherwise(F.col("_f"))).drop("_c", "_h", "_f")


def retry_plan(attempts: DataFrame, retries: int = 2, backoff: float = 0.5, multiplier: float = 2.0) -> DataFrame:
    """attempts (request, attempt from 1, status) with succeeded, will_retry, delay in seconds, final_failure.  Attempts beyond the plan go."""
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    worth = F.col("status").isNull() | F.col("status").isin(*RETRIED)
    stop = F.col("ok") | ~F.col("worth") | (F.col("attempt") > retries)
    w = Window.partitionBy("request").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    out = attempts.withColumn("ok", ok).withColumn("worth", worth).withColumn("stop", stop).withColumn("_over", F.coalesce(F.max("stop").over(w), F.lit(False))).where("not _over")
    delay = F.when(F.col("stop"), 0.0).otherwise(backoff * F.pow(F.lit(multiplier), F.col("attempt") - 1))
    return out.withColumn("will_retry", ~F.col("stop")).withColumn("delay", delay).withColumn("final_failure", F.col("stop") & ~F.col("ok")).withColumnRenamed("ok", "succeeded").drop("worth", "stop", "_over")


def summary(plan: DataFrame, by: list[str] = ()) -> DataFrame:
    return plan.groupBy(*by).agg(F.count_if(F.col("attempt") == 1).alias("requests"), F.count("*").alias("attempts"), F.count_if("will_retry").alias("retries"), F.count_if("final_failure").alias("final_failures"))


def within_budget(summaries: DataFrame, budget: int) -> DataFrame:
    """The summaries; raises when the plan runs if one has more final failures than the budget (0 if negative)."""
    most = max(budget, 0)
    over = F.raise_error(F.concat(F.lit("final failures: "), F.col("final_failures").cast("string"), F.lit(f", budget {most}"))).cast("bigint")
    return summaries.withColumn("final_failures", F.when(F.col("final_failures") > most, over).otherwise(F.col("final_failures")))


def crawl(seeds: DataFrame, links: DataFrame, max_pages: int, depth: int = 100) -> DataFrame:
    """(url, step, place) of at most max_pages pages, breadth first from seeds (url) over links (url, target).

    Pages are taken by step, then by the place of the page that first names them, then by url; each once.  Step by step a frontier is
    joined with the links, so what a task holds does not grow with what was seen.
    """
    left, n = max_pages, 0
    front = seeds.select("url", F.lit(0).cast("long").alias("by")).distinct()
    seen = None
    for step in range(depth + 1):
        # the limit is the crawl's budget
        ranked = front.orderBy("by", "url").limit(left)
        placed = ranked.withColumn("place", F.row_number().over(Window.orderBy("by", "url")) + n)
        page = cut(placed.select("url", F.lit(step).alias("step"), F.col("place").cast("long").alias("place")))
        took = page.count()
        if seen is not None and not took:
            break
        seen, left, n = page if seen is None else seen.unionByName(page), left - took, n + took
        if not left or not took:
            break
        front = page.join(links, "url").groupBy(F.col("target").alias("url")).agg(F.min("place").alias("by")).join(seen.select("url"), "url", "left_anti")
    return seen


def worklist(seeds: DataFrame, follow, most: int | None = None) -> DataFrame:
    """(seed, url, place) of the requests that each seed leads to, breadth first, until nothing is new or a seed has `most` of them.

    seeds is (seed, url).  follow takes what was just requested (seed, url, place) and gives what its answers name, (seed, place, target);
    an answer may be a page, a payload or an error, so what is requested next can depend on it in any way.  A seed's requests are taken by
    the place of the one that first names them, then by url; each once a seed.  With several urls of one seed the first step takes them
    in their order.  Only the last step's requests are followed.
    """
    front = seeds.where("seed is not null and url is not null").select("seed", "url", F.lit(0).cast("long").alias("by")).distinct()
    seen = None
    w = Window.partitionBy("seed").orderBy("by", "url")
    while True:
        took = front
        if seen is not None:
            had = seen.groupBy("seed").agg(F.max("place").alias("_had"))
            took = front.join(had, "seed", "left")
        else:
            took = took.withColumn("_had", F.lit(0).cast("long"))
        took = took.withColumn("_n", F.row_number().over(w))
        if most is not None:  # the first bound limits groups before the exchange, the second is the seed's own
            took = took.where(F.col("_n") <= most).where(F.col("_n") + F.col("_had") <= most)
        took = took.withColumn("place", F.col("_n") + F.col("_had"))
        took = cut(took.select("seed", "url", F.col("place").cast("long").alias("place")))
        if took.isEmpty():
            return took if seen is None else seen
        seen = took if seen is None else seen.unionByName(took)
        named = follow(took).where("target is not null").groupBy("seed", F.col("target").alias("url")).agg(F.min("place").alias("by"))
        front = named.join(seen.select("seed", "url"), ["seed", "url"], "left_anti")


def levels(seeds: DataFrame, links: DataFrame, n: int) -> DataFrame:
    """Distinct urls that 1 to n links lead to from the seeds (a seed too, if a page names it); all of them, however many they are."""
    out = front = None
    for _ in range(n):
        front = (seeds if front is None else front).join(links.where("url <> target"), "url").select(F.col("target").alias("url")).distinct()
        out = front if out is None else out.unionByName(front)
    return out.distinct()


def expand(seeds: DataFrame, links: DataFrame, levels: int) -> DataFrame:
    """Distinct urls from the seeds to a fixed number of levels of links."""
    out = front = seeds.select("url").distinct()
    for _ in range(levels):
        front = front.join(links, "url").select(F.col("target").alias("url")).distinct()
        out = out.unionByName(front)
    return out.distinct()
