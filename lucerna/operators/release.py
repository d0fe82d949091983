"""Review of a release: what a candidate loses and changes against its baseline, entities that must stay, people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fields that differ in every release, and how many examples are shown.
IGNORED, SAMPLES, NEW_PEOPLE = ("last_verified_at",), 15, 25


def _said(c: Column) -> Column:
    """A value as text; null for what counts as empty: null, '', [] and {}."""
    text = F.to_json(F.struct(c.alias("v")))
    bare = F.regexp_replace(text, r'^\{"v":|\}$', "")
    return F.when(~bare.isin("{", "", '""', "[]", "{}"), bare)


def review(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(id, kind, fields): removed and added ids, ids that lost fields and ids whose fields changed, with the fields in order.

    Rows without an id are left out; of several rows of an id any one counts, as datasets have one.
    """
    fields = [c for c in old.columns if c != key and c not in (*IGNORED, "ordinal")]
    side = lambda rows, p, cols: rows.where(F.nullif(F.col(key).cast("string"), F.lit("")).isNotNull()).select(key, F.lit(True).alias(f"_{p}"), *[_said(F.col(c)).alias(f"_{p}_{c}") for c in cols])
    kept = [c for c in fields if c in new.columns]
    j = side(old, "o", fields).join(side(new, "n", kept), key, "full_outer")
    lost = F.array(*[F.when(F.col(f"_o_{c}").isNotNull() & (F.col(f"_n_{c}").isNull() if c in kept else F.lit(True)), F.lit(c)) for c in sorted(fields)])
    changed = F.array(*[F.when(F.col(f"_n_{c}").isNotNull() & ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")), F.lit(c)) for c in sorted(kept)])
    none, some = F.array().cast("array<string>"), lambda a: F.filter(a, lambda x: x.isNotNull())
    kinds = F.array(
        F.struct(F.lit("removed").alias("kind"), none.alias("fields"), F.col("_n").isNull().alias("is")), F.struct(F.lit("added").alias("kind"), none.alias("fields"), F.col("_o").isNull().alias("is")),
        F.struct(F.lit("lost").alias("kind"), some(lost).alias("fields"), (F.col("_o").isNotNull() & F.col("_n").isNotNull() & (F.size(some(lost)) > 0)).alias("is")),
        F.struct(F.lit("changed").alias("kind"), some(changed).alias("fields"), (F.col("_o").isNotNull() & F.col("_n").isNotNull() & (F.size(some(changed)) > 0)).alias("is")),
    )
    return j.select(F.col(key).alias("id"), F.explode(F.filter(kinds, lambda x: x["is"])).alias("x")).select("id", "x.kind", "x.fields")


def samples(found: DataFrame, most: int = SAMPLES) -> DataFrame:
    """The first ids of each kind, for reading, with the number of all."""
    w = Window.partitionBy("kind")
    return found.withColumn("n", F.count("*").over(w)).withColumn("_i", F.row_number().over(w.orderBy("id"))).where(F.col("_i") <= most).drop("_i")


def people_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: people of both sides, added and removed, with an office before and after, new ones with office, address and department."""
    given = lambda c: F.nullif(F.col(c), F.lit("")).isNotNull()
    o = old.where(given("person_id")).select("person_id", F.lit(True).alias("_o"), given("office_place_id").alias("_oo"))
    n = new.where(given("person_id")).select("person_id", F.lit(True).alias("_n"), given("office_place_id").alias("_no"), given("email").alias("_e"), given("department_id").alias("_d"))
    j = o.join(n, "person_id", "full_outer")
    before, after = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    fresh = after & ~before
    counts = {"baseline": before, "candidate": after, "added": fresh, "removed": before & ~after, "baseline_with_office": F.col("_oo"), "candidate_with_office": F.col("_no"), "shared_with_office_before": before & after & F.col("_oo"), "shared_with_office_after": before & after & F.col("_no"), "new_with_office": fresh & F.col("_no"), "new_with_email": fresh & F.col("_e"), "new_with_department": fresh & F.col("_d")}
    return j.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counts.items()])


def new_people_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """How many new people each source has."""
    fresh = new.where(F.nullif("person_id", F.lit("")).isNotNull()).join(old.select("person_id").where("person_id is not null").distinct(), "person_id", "left_anti")
    return fresh.groupBy(F.coalesce("source_id", F.lit("None")).alias("source_id")).agg(F.count("*").alias("n"))


def text(pairs: dict[str, tuple[DataFrame, DataFrame, str]], locked: list[tuple[str, str]] = ()) -> str:
    """The review as text: for each dataset its counts and the first ids of each kind, then the locked entities (dataset, id) and people."""
    lines = ["# Release review", ""]
    for name, (old, new, key) in pairs.items():
        rows = samples(review(old, new, key)).orderBy("kind", "id").collect()
        total = {r.kind: r.n for r in rows}
        lines += [f"### {name}", f"- baseline: {old.count()}, candidate: {new.count()}, removed: {total.get('removed', 0)}, added: {total.get('added', 0)}", f"- lost fields: {total.get('lost', 0)}, changed values: {total.get('changed', 0)}"]
        for kind in ("removed", "added", "lost", "changed"):
            shown = [r.id + (f" -> {', '.join(r.fields)}" if r.fields else "") for r in rows if r.kind == kind]
            lines += [f"- {kind}: {'; '.join(shown)}"] if shown else []
        lines.append("")
    if locked:
        lines.append("## Locked entities")
        for name, ident in locked:
            _, new, key = pairs[name]
            lines.append(f"- {name} {ident}: {'missing' if new.where(F.col(key) == ident).isEmpty() else 'there'}")
        lines.append("")
    if "people" in pairs:
        old, new, _ = pairs["people"]
        lines += ["## People", *[f"- {k}: {v}" for k, v in people_counts(old, new).first().asDict().items()]]
        lines += [f"- new of {r.source_id}: {r.n}" for r in new_people_sources(old, new).orderBy(F.desc("n"), "source_id").limit(NEW_PEOPLE).collect()]
    return "\n".join(lines) + "\n"
