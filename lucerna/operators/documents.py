"""Checks and documents about a folder of datasets: schema files, the registry of corrections, the report and the contract."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .coverage import coverage

# What registries may say, the datasets of entities, and those that a contract lists.
ACTIONS = ("set_null", "replace", "override", "drop_if_matches", "drop_if_prefix", "alias", "merge", "extract")
STATUSES = ("draft", "review", "approved", "applied", "archived")
APPLYABLE = ("approved", "applied")
REVIEWED = ("approved", "applied", "archived")
DESTRUCTIVE = ("set_null", "drop_if_matches", "drop_if_prefix")
DATASETS = {"alias": ("aliases", "alias_id"), "aula": ("aulas", "aula_id"), "building": ("buildings", "building_id"), "department": ("departments", "department_id"), "person": ("people", "person_id"), "place": ("places", "place_id"), "source": ("sources", "source_id")}
PLURALS = {"aliases": "alias", "aulas": "aula", "buildings": "building", "departments": "department", "people": "person", "places": "place", "sources": "source"}
NEEDED = ("id", "action", "entity_type", "entity_id", "field", "reason", "author", "created_at", "status")


def load_rules(text: str, allowed: set[str]) -> list[dict]:
    """The rules of a registry, a reviewed document of JSON; ValueError says all that is wrong with it."""
    root = json.loads(text)
    if not isinstance(root, dict) or not isinstance(root.get("corrections"), list):
        raise ValueError("a registry is an object with a list of corrections")
    wrong, ids, slots, out = [], set(), {}, []
    for i, r in enumerate(root["corrections"]):
        if not isinstance(r, dict):
            wrong.append(f"corrections[{i}] is no object")
            continue
        missing = [f for f in NEEDED if not isinstance(r.get(f), str) or not r[f].strip()]
        wrong += [f"corrections[{i}].{f} is missing" for f in missing]
        if missing:
            continue
        r = r | {f: r[f].strip() for f in NEEDED} | {"entity_type": PLURALS.get(r["entity_type"].strip().lower(), r["entity_type"].strip().lower()), "priority": r.get("priority", 0)}
        wrong += [f"corrections[{i}].{f} is unknown" for f, known in (("action", ACTIONS), ("status", STATUSES), ("entity_type", DATASETS)) if r[f] not in known]
        try:
            if datetime.fromisoformat(r["created_at"].replace("Z", "+00:00")).tzinfo is None:
                wrong.append(f"corrections[{i}].created_at has no time zone")
        except ValueError:
            wrong.append(f"corrections[{i}].created_at is no time")
        if type(r["priority"]) is not int:
            wrong.append(f"corrections[{i}].priority is no integer")
        if r["status"] in REVIEWED and not str(r.get("reviewer") or "").strip():
            wrong.append(f"corrections[{i}] has no reviewer")
        if r["id"] in ids:
            wrong.append(f"corrections[{i}] repeats id {r['id']}")
        ids.add(r["id"])
        slot = (r["entity_type"], r["entity_id"], r["field"], r["priority"])
        if r["status"] != "archived" and slots.setdefault(slot, r["id"]) != r["id"]:
            wrong.append(f"{r['id']} and {slots[slot]} have one priority for {'.'.join(slot[:3])}")
        out.append(r)
    banned = sorted(r["id"] for r in out if r["status"] in APPLYABLE and r["action"] in DESTRUCTIVE and r["id"] not in allowed)
    if banned:
        wrong.append(f"not allowed: {', '.join(banned)}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return out


def _starts(text: Column):
    return lambda p: F.startswith(text, p)


def _no_string(least: int):
    return lambda v: ~F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False)) | (F.length(F.try_variant_get(v, "$", "string")) < least)


def correct(rows: DataFrame, entity: str, rules: list[dict]) -> DataFrame:
    """rows with every field's winning rule applied, and `changed`, the number of fields that differ.  Actions without a meaning for rows raise if their row exists.

    One join brings a row all its rules, as a map from field to the winner.
    """
    key = DATASETS[entity][1]
    mine = sorted((r for r in rules if r["entity_type"] == entity and r["status"] in APPLYABLE), key=lambda r: (-r["priority"], r["id"]))
    win: dict[tuple, dict] = {}
    for r in mine:
        win.setdefault((r["entity_id"], r["field"]), r)
    patterns = lambda r: [x.strip().casefold() for x in r.get("patterns") or []]
    per: dict[str, dict] = {}
    for (target, field), r in win.items():
        value = r.get("value")
        per.setdefault(target, {})[field] = (r["action"], value if value is None or isinstance(value, str) else json.dumps(value), patterns(r))
    table = rows.sparkSession.createDataFrame(list(per.items()), f"{key} string, _r map<string,struct<action:string,value:string,patterns:array<string>>>")
    fields = [c for c in sorted({f for _, f in win}) if c in rows.columns and c != key]
    out, changed = rows.join(table, key, "left"), F.lit(0)
    for c in fields:
        old, rule = F.col(c), F.col("_r")[c]
        text, kind = F.lower(F.trim(old.cast("string"))), rows.schema[c].dataType
        new = (
            F.when(rule.isNull(), old)
            .when(rule.action == "set_null", F.lit(None))
            .when(rule.action == "replace", rule.value.cast(kind))
            .when(rule.action == "override", F.when(old.isNull() | (old.cast("string") == ""), rule.value.cast(kind)).otherwise(old))
            .when(rule.action == "drop_if_matches", F.when(~F.coalesce(F.array_contains(rule.patterns, text), F.lit(False)), old))
            .when(rule.action == "drop_if_prefix", F.when(~F.coalesce(F.exists(rule.patterns, _starts(text)), F.lit(False)), old))
            .otherwise(F.raise_error(F.concat(F.lit("no meaning for rows: "), rule.action)).cast(kind))
        )
        out = out.withColumn(f"_n_{c}", new)
        changed = changed + (~F.col(f"_n_{c}").eqNullSafe(old)).cast("int")
    kept = [F.col(f"_n_{c}").alias(c) if c in fields else F.col(c) for c in rows.columns]
    return out.select(*kept, changed.alias("changed"))


def json_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row, v): the elements of JSON arrays, one a file, or the lines of a folder of JSON lines, as text.  row is the place in an array, else null."""
    text = spark.read.text(path, wholetext=True)
    if path.endswith(".json"):
        return text.select(F.posexplode(F.from_json("value", "array<string>")).alias("row", "v"))
    return spark.read.text(path).select(F.lit(None).cast("int").alias("row"), F.col("value").alias("v"))


def _type(x: Column) -> Column:
    """JSON type of a variant: string, integer, number, boolean, array, object, null."""
    t = F.schema_of_variant(x)
    whole = t.isin("BIGINT", "TINYINT", "SMALLINT", "INT") | (F.try_variant_get(x, "$", "double") % 1 == 0)
    return F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(F.startswith(t, F.lit("ARRAY")), "array").when(F.startswith(t, F.lit("OBJECT")), "object").when(t == "VOID", "null").when(whole, "integer").otherwise("number")


def schema_tests(items: dict) -> list[tuple[str, str, Column]]:
    """(field, keyword, condition) of a schema of objects, over the variant `o` and its keys `k`; conditions tell what is broken."""
    tests: list[tuple[str, str, Column]] = []
    if items.get("additionalProperties") is False:
        tests.append(("", "additionalProperties", F.size(F.array_except("k", F.array(*[F.lit(x) for x in items.get("properties", {})]))) > 0))
    tests += [(f, "required", ~F.array_contains("k", f)) for f in items.get("required", [])]
    for f, spec in items.get("properties", {}).items():
        x = F.try_variant_get("o", f"$['{f}']", "variant")
        text, number, kind = F.try_variant_get("o", f"$['{f}']", "string"), F.try_variant_get("o", f"$['{f}']", "double"), _type(x)
        there = F.array_contains("k", f)
        if "type" in spec:
            kinds = [spec["type"]] if isinstance(spec["type"], str) else list(spec["type"])
            tests.append((f, "type", there & ~kind.isin(kinds + (["integer"] if "number" in kinds else []))))
        if "minLength" in spec:
            tests.append((f, "minLength", (kind == "string") & (F.length(text) < spec["minLength"])))
        if "pattern" in spec:
            tests.append((f, "pattern", (kind == "string") & ~F.rlike(text, F.lit(spec["pattern"]))))
        if "enum" in spec:
            tests.append((f, "enum", there & ~F.coalesce(text.isin([x if isinstance(x, str) else json.dumps(x) for x in spec["enum"]]), F.lit(False))))
        for word, broken in (("minimum", lambda n, m: n < m), ("maximum", lambda n, m: n > m)):
            if word in spec:
                tests.append((f, word, kind.isin("integer", "number") & broken(number, spec[word])))
        inner = spec.get("items", {})
        if inner.get("type") == "string":
            parts = F.try_variant_get("o", f"$['{f}']", "array<variant>")
            tests.append((f, "items", (kind == "array") & F.exists(parts, _no_string(inner.get("minLength", 0)))))
    return tests


def schema_errors(rows: DataFrame, schema: dict) -> DataFrame:
    """(row, field, error) of the rows (row, v) that break the schema of an array of objects; all keywords in one pass."""
    read = rows.withColumn("o", F.try_parse_json("v")).withColumn("k", F.coalesce(F.json_object_keys("v"), F.array().cast("array<string>")))
    is_object = F.coalesce(_type(F.col("o")) == "object", F.lit(False))
    tests = [F.when(~is_object, F.struct(F.lit("").alias("field"), F.lit("type").alias("error")))]
    tests += [F.when(is_object & bad, F.struct(F.lit(f).alias("field"), F.lit(e).alias("error"))) for f, e, bad in schema_tests(schema.get("items", {}))]
    return read.select("row", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("x")).select("row", "x.*")


#: The metrics of the report; `given` counts values that are neither null nor empty, `set` those that aren't null.
METRICS = {
    "buildings": {"with_coordinates": ("set", ("lat", "lng"))},
    "departments": {"with_email": ("given", ("email",)), "with_website_url": ("given", ("website_url",)), "with_primary_building_id": ("given", ("primary_building_id",))},
    "places": {"with_building_id": ("given", ("building_id",)), "type_aula": ("AULA", ("type",))},
    "aulas": {"with_place_id": ("given", ("place_id",)), "with_building_id": ("given", ("building_id",)), "with_floor": ("given", ("floor",)), "with_short_code": ("given", ("short_code",)), "with_capacity": ("set", ("capacity",))},
    "people": {"with_email": ("given", ("email",)), "with_department_id": ("given", ("department_id",)), "with_office_place_id": ("given", ("office_place_id",)), "with_office_hours": ("given", ("office_hours",))},
}
EXAMPLES = 20


def _metric(rows: DataFrame, how: str, fields: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for f in fields:
        c = F.col(f) if f in rows.columns else F.lit(None).cast("string")
        out = out & (c.isNotNull() if how == "set" else F.nullif(c.cast("string"), F.lit("")).isNotNull() if how == "given" else F.coalesce(c == how, F.lit(False)))
    return F.coalesce(out, F.lit(False))


def report(tables: dict[str, DataFrame], errors: dict[str, list[str]], issues: list[dict], sources: dict[str, dict], n_issues: int | None = None) -> dict:
    """The coverage report.  Only one-row aggregates, counts by source and at most 20 examples come to the driver.

    n_issues: how many issues there are where those listed are the first of more.
    """
    n_issues = len(issues) if n_issues is None else n_issues
    found = {}
    for name, metrics in METRICS.items():
        rows = tables[name]
        got = coverage(rows, {k: _metric(rows, how, fs) for k, (how, fs) in metrics.items()}).first().asDict()
        found[name] = {k: round(v, 4) if k.endswith("_ratio") else v for k, v in got.items()}
    aulas, total = tables["aulas"], found["aulas"]["total"]
    without = aulas.where(~_metric(aulas, "given", ("building_id",)))
    missing = total - found["aulas"]["with_building_id"]
    by_source = without.groupBy(F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.lit("unknown")).alias("source_url")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "source_url")
    named = F.coalesce(F.nullif(F.col("aula_id"), F.lit("")), "name", F.lit(""))
    examples = without.orderBy(named).limit(EXAMPLES).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("aula_id", "name", "source_url")])
    found["aulas"] |= {
        "missing_building_id": missing,
        "missing_building_id_ratio": round(missing / total, 4) if total else 0.0,
        "missing_building_by_source": [r.asDict() for r in by_source.collect()],
        "missing_building_examples": [r.asDict() for r in examples.collect()],
    }
    warnings = []
    for k in sorted(sources):
        failed, budget = (int(sources[k].get(x) or 0) for x in ("final_failures", "failure_budget"))
        if failed > 0:
            warnings.append({"source_id": k, "final_failures": failed, "failure_budget": budget, "message": f"{k}: {failed} final failures (budget {budget})" + (" [EXCEEDED]" if failed > budget else "")})
    return {
        "summary": {"total_datasets": len(errors), "invalid_datasets": sum(map(bool, errors.values())), "integrity_issues": n_issues},
        "schema_validation": {"datasets": errors},
        "integrity": {"issues": issues} | ({"listed": len(issues), "total": n_issues} if n_issues > len(issues) else {}),
        "scrape_diagnostics": {"sources": dict(sorted(sources.items())), "warnings": warnings, "warning_count": len(warnings)},
        "coverage": found,
    }


def applied(corrected: dict[str, DataFrame], rules: list[dict]) -> dict:
    """What applying the rules did: datasets, rules considered and applied, rows and fields changed (one row for each dataset comes here)."""
    rows = {name: df.agg(F.count_if(F.col("changed") > 0).alias("rows"), F.coalesce(F.sum("changed"), F.lit(0)).alias("fields")).first() for name, df in corrected.items()}
    return {"datasets": len(rows), "rules_considered": len(rules), "rules_applied": sum(r["status"] in APPLYABLE for r in rules), "rows_changed": sum(r["rows"] for r in rows.values()), "fields_changed": sum(r["fields"] for r in rows.values())}


def room_coverage(aulas: DataFrame) -> DataFrame:
    """One row: rooms, and those with a building, a floor and seats; only texts that say something and whole numbers count."""
    kind = dict(aulas.dtypes)
    said = lambda c: F.nullif(F.col(c), F.lit("")).isNotNull() if kind.get(c) == "string" else F.lit(False)
    seats = F.col("capacity").isNotNull() if kind.get("capacity") in ("int", "bigint") else F.lit(False)
    return aulas.agg(F.count("*").alias("total"), F.count_if(said("building_id")).alias("with_building_id"), F.count_if(said("floor")).alias("with_floor"), F.count_if(seats).alias("with_capacity"))


def _digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file; of a folder's parts that of their names' order of digests, each file hashed where it is read."""
    files = spark.read.format("binaryFile").load(path).where("length > 0 or path like '%.json'").select("path", F.sha2("content", 256).alias("d"))
    found = [r.d for r in files.orderBy("path").collect()]
    return found[0] if path.endswith(".json") else hashlib.sha256("\n".join(found).encode()).hexdigest()


def contract(spark: SparkSession, folder: str, names: list[str], compatibility: int, version: str, contract_id: str, aulas: DataFrame | None = None) -> dict:
    """Records and SHA-256 of each dataset and a revision over them; a dataset is a file or a folder of JSON lines.  aulas: the rooms to count."""
    if compatibility < 1:
        raise ValueError("compatibility must be 1 or more")
    listed = [{"name": name, "records": json_rows(spark, f"{folder}/{name}").count(), "sha256": _digest(spark, f"{folder}/{name}")} for name in sorted(names)]
    revision = hashlib.sha256("\n".join(f"{x['name']}:{x['sha256']}:{x['records']}" for x in listed).encode()).hexdigest()
    out = {"contract_id": contract_id, "contract_version": version, "compatibility_version": compatibility, "revision": revision, "datasets": listed}
    return out if aulas is None else out | {"coverage": {"aulas": room_coverage(aulas).first().asDict()}}
