"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from emberline.plans import catalog

HEADLINE = [
    "nearest_industrial", "polygon_tag", "nearest_facility_flare", "nearest_facility_heat", "recurrence", "anomaly_baselines",
    "neighbourhood_active_days", "build_labels", "stats_cube",  # labels are written by the first of these two, the second reads them
]


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
