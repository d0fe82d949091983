"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from lucerna.plans.queries import QUERIES

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
NAMES = ["flagship", "first_wins_dedupe", "ranked_merge", "consensus_backfill", "nearest_within_radius", "integrity_report", "coverage_report", "baseline_merge", "release_diff", "alias_build", "html_links", "manifest"]


def main() -> None:
    spark = SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["flagship"](spark, SF).write.format("noop").mode("overwrite").save()
    took = {}
    for name in NAMES:
        t = time.time()
        QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF}))


if __name__ == "__main__":
    main()
