"""Commands over a folder of datasets: crawl recorded responses, link, correct, validate, report, contract, review, seed.

A dataset is `name.json`, an array, or `name.jsonl`, a folder of JSON lines.  Commands that write take another folder (--out) and write
JSON lines with sorted fields and without nulls; the folder that was read is left as it is.

    python -m lucerna.cli validate --data DIR --schemas DIR
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crawl as crawls
from .functions.people import is_building
from .operators import canonical, documents, places, release
from .operators.campus_integrity import check
from .sources import markup, registry
from .sources.tables import write_json

# Fields of the datasets.
FROM = "source_id string, source_url string, last_verified_at string"
DATASETS = {
    "buildings": f"building_id string, name string, category string, description string, lat double, lng double, {FROM}",
    "departments": f"department_id string, name string, description string, email string, phone string, website_url string, primary_building_id string, {FROM}",
    "places": f"place_id string, type string, name string, building_id string, floor string, room string, description string, office_reference_text string, email string, phone string, website_url string, meeting_url string, meeting_code string, opening_hours string, access_notes string, lat double, lng double, department_id string, {FROM}",
    "aulas": f"aula_id string, place_id string, name string, normalized_name string, short_code string, search_tokens array<string>, building_id string, floor string, room string, capacity int, department_id string, {FROM}",
    "people": f"person_id string, full_name string, role string, email string, phone string, department_id string, website_url string, office_place_id string, office_hours string, notes string, office_reference_text string, {FROM}",
    "aliases": "alias_id string, entity_type string, entity_id string, label string, normalized string",
    "entity_links": "link_id string, parent_entity_type string, parent_entity_id string, relation_type string, child_entity_type string, child_entity_id string, sort_order int, source_id string, source_url string",
    "sources": "source_id string, name string, base_url string, notes string, last_crawled_at string",
}


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def find(self, name: str) -> str | None:
        for end in ("jsonl", "json"):
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}.{end}")
            if at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
                return f"{self.path}/{name}.{end}"
        return None

    def rows(self, name: str) -> DataFrame:
        """(row, v) as text; none where the dataset is missing."""
        at = self.find(name)
        return documents.json_rows(self.spark, at) if at else self.spark.createDataFrame([], "row int, v string")

    def read(self, name: str) -> DataFrame:
        """The dataset with `ordinal`; elements that are no objects are left out.  Lines of a folder are ordered by their first field."""
        rows = self.rows(name).where(F.startswith(F.ltrim("v"), F.lit("{"))).select("row", F.from_json("v", DATASETS[name]).alias("r")).select("row", "r.*")
        return rows.withColumn("ordinal", F.coalesce(F.lpad(F.col("row").cast("string"), 10, "0"), F.col(rows.columns[1]))).drop("row")

    def all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in DATASETS}

    def document(self, name: str) -> dict:
        text = self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()
        return json.loads(text[0]) if text else {}


def _write(out: str, **tables: DataFrame) -> None:
    for name, rows in tables.items():
        write_json(rows.drop("ordinal"), f"{out.rstrip('/')}/{name}.jsonl", rows.columns[0])


def link_buildings(spark, a) -> int:
    data = Folder(spark, a.data)
    _write(a.out, places=places.link_places(data.read("places"), data.read("buildings")).select(*data.read("places").columns))
    return 0


def link_aliases(spark, a) -> int:
    data = Folder(spark, a.data)
    marks = [(x["entity_type"], x["entity_id"], tuple(x["labels"])) for x in data.document(a.landmarks)["landmarks"]] if a.landmarks else []
    _write(a.out, aliases=places.aliases(data.read("aulas"), data.read("places"), data.read("buildings"), marks))
    return 0


def link_services(spark, a) -> int:
    data = Folder(spark, a.data)
    at, of, links = places.apply_contract(data.read("places").drop("ordinal"), data.read("buildings").drop("ordinal"), data.document(a.contract), a.verified_at)
    _write(a.out, places=at, buildings=of, entity_links=links)
    return 0


def apply_corrections(spark, a) -> int:
    data = Folder(spark, a.data)
    allowed = set(data.document(a.allowed)["allowed_rule_ids"]) if a.allowed else set()
    rules = documents.load_rules(json.dumps(data.document(a.registry)), allowed)
    for entity in sorted({r["entity_type"] for r in rules}):
        name = documents.DATASETS[entity][0]
        if data.find(name) is None:
            raise FileNotFoundError(f"{a.data}/{name}")
        _write(a.out, **{name: documents.correct(data.read(name), entity, rules).drop("changed")})
    return 0


def _errors(spark, data: Folder, schemas: str) -> dict[str, list[str]]:
    """Messages by dataset, those of the first thousand broken rows and a count of all; a dataset that is missing is an error."""
    found = {}
    for path, text in spark.read.text(f"{schemas.rstrip('/')}/*.schema.json", wholetext=True).select(F.input_file_name(), "value").collect():
        name = path.rsplit("/", 1)[-1].removesuffix(".schema.json")
        if data.find(name) is None:
            found[name] = ["missing dataset"]
            continue
        errors = documents.schema_errors(data.rows(name), json.loads(text))
        n = errors.count()
        shown = errors.orderBy("row", "field", "error").limit(1000).collect() if n else []
        found[name] = [f"[{r.row}].{r.field}: {r.error}" for r in shown] + ([f"{n} errors"] if n > len(shown) else [])
    return dict(sorted(found.items()))


def _issues(data: Folder) -> DataFrame:
    return check(data.all()).orderBy("level", "file", F.coalesce("record_id", F.lit("")), "message")


def validate(spark, a) -> int:
    """Schema errors and integrity issues; fails on any error, not on warnings."""
    data = Folder(spark, a.data)
    errors, issues = _errors(spark, data, a.schemas), _issues(data)
    for name, lines in errors.items():
        for line in lines:
            print(f"{name}: {line}")
    for r in issues.toLocalIterator():
        print(f"{r.level} {r.file} {r.record_id or '-'}: {r.message}")
    return int(any(errors.values()) or not issues.where("level = 'error'").isEmpty())


def report(spark, a) -> int:
    data = Folder(spark, a.data)
    sources = data.document(a.diagnostics).get("sources", {}) if a.diagnostics else {}
    found = _issues(data)
    issues = [{k: v for k, v in r.asDict().items() if v is not None} for r in found.limit(a.most_issues).collect()]
    print(json.dumps(documents.report(data.all(), _errors(spark, data, a.schemas), issues, sources, found.count()), indent=2, sort_keys=True, ensure_ascii=False))
    return 0


def contract(spark, a) -> int:
    data = Folder(spark, a.data)
    names = [at.rsplit("/", 1)[-1] for at in map(data.find, DATASETS) if at]
    print(json.dumps(documents.contract(spark, data.path, names, a.compatibility, a.version, a.id, data.read("aulas")), indent=2, sort_keys=True))
    return 0


def crawl_buildings(spark, a) -> int:
    """Buildings of the maps among recorded responses (url, body)."""
    marks = markup.placemarks(spark.read.schema("url string, body string").json(a.responses), "url", "body").where(is_building(F.col("name")) & F.col("lat").isNotNull() & F.col("folder").isNotNull())
    raw = marks.select(F.col("name").alias("ordinal"), "name", F.col("url").alias("source_url"), "lat", "lng", "description")
    _write(a.out, buildings=canonical.buildings(raw, a.source, a.verified_at))
    return 0


def _crawled(spark, a, only: str | None) -> int:
    """Crawls over recorded responses (method, url, body): one stage, or all of them, links, aliases, and the integrity checks.

    The profile is a JSON object of crawl.Profile's fields.  The folder --data is the baseline whose rows stay; --out is another one.
    """
    registry.guard(spark, a.out, a.canonical or f"{a.out}.none", a.allow_canonical == "yes", a.data)
    data = Folder(spark, a.data)
    given = registry.json_object(spark, a.profile, strict=True)
    profile = crawls.Profile(**{"at": a.verified_at} | {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
    profile = crawls.fast(profile) if a.speed == "fast" else profile
    responses = spark.read.schema("method string, url string, body string").json(a.responses)
    written: list[str] = []

    def cut(rows: DataFrame) -> DataFrame:
        written.append(f"{a.out.rstrip('/')}/_stages/{len(written)}")
        rows.write.parquet(written[-1])
        return spark.read.schema(rows.schema).parquet(written[-1])

    if only:
        crawls.affordable(responses, profile)
        stage, t = dict(crawls.STAGES)[only], data.all()
        _write(a.out, **{name: crawls.shaped(rows, t[name]) for name, rows in stage(spark, responses, profile, t, cut).items()})
        return 0
    contract = data.document(a.contract) if a.contract else None
    t = crawls.run(spark, responses, profile, data.all(), contract, cut=cut)
    new = spark.createDataFrame([(f"unical-{x}", x, profile.base, None, a.verified_at) for x in ("departments", "services", "teachers", "aulas")], "source_id string, name string, base_url string, notes string, last_crawled_at string")
    t["sources"] = registry.upsert_sources(t["sources"].drop("ordinal"), new).withColumn("ordinal", F.col("source_id"))
    _write(a.out, **t)
    found = check(t).where("level = 'error'")
    errors = found.orderBy("file", "record_id", "message").limit(20).collect()
    for r in errors:
        print(f"{r.level} {r.file} {r.record_id or '-'}: {r.message}")
    if len(errors) == 20:
        print(f"first 20 of {found.count()} errors")
    return int(bool(errors))


def review(spark, a) -> int:
    """The text of a release review; --locked lists entities as dataset:id."""
    old, new = Folder(spark, a.data), Folder(spark, a.candidate)
    pairs = {name: (old.read(name), new.read(name), crawls.KEYS[name]) for name in DATASETS if old.find(name) and new.find(name)}
    print(release.text(pairs, [tuple(x.split(":", 1)) for x in (a.locked or "").split(",") if x]), end="")
    return 0


def seed(spark, a) -> int:
    """Copies a folder's datasets and adds the empty ones that it lacks."""
    print("copied", *registry.seed(spark, a.data, a.out, DATASETS))
    print("made", *registry.placeholders(spark, a.out, DATASETS))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lucerna")
    groups = top.add_subparsers(required=True)

    def add(to, name: str, run: Callable, *needed: str, **optional):
        p = to.add_parser(name)
        for x in needed:
            p.add_argument(f"--{x}", required=True)
        for x, default in optional.items():
            p.add_argument(f"--{x.replace('_', '-')}", default=default, type=type(default) if default is not None else str)
        p.set_defaults(run=run)

    link = groups.add_parser("link").add_subparsers(required=True)
    add(link, "places-buildings", link_buildings, "data", "out")
    add(link, "aliases", link_aliases, "data", "out", landmarks=None)
    add(link, "service-locations", link_services, "data", "out", "contract", "verified-at")
    add(groups.add_parser("corrections").add_subparsers(required=True), "apply", apply_corrections, "data", "out", "registry", allowed=None)
    crawl = groups.add_parser("crawl").add_subparsers(required=True)
    add(crawl, "buildings", crawl_buildings, "responses", "out", "verified-at", source="campus-map")
    for name in ("departments", "services", "teachers", "aulas"):
        add(crawl, name, lambda spark, a, name=name: _crawled(spark, a, name), "data", "responses", "profile", "out", "verified-at", speed="full", canonical=None, allow_canonical="no")
    add(crawl, "full", lambda spark, a: _crawled(spark, a, None), "data", "responses", "profile", "out", "verified-at", speed="full", canonical=None, allow_canonical="no", contract=None)
    add(groups, "review", review, "data", "candidate", locked=None)
    add(groups, "seed", seed, "data", "out")
    add(groups, "validate", validate, "data", "schemas")
    add(groups, "report", report, "data", "schemas", diagnostics=None, most_issues=10000)
    add(groups, "contract", contract, "data", version="1", compatibility=1, id="datasets")
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(spark or SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
