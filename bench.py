"""Time the headline queries and print one JSON line.

Each query starts from the Parquet files; nothing is kept from one to the next.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from testbed.queries import QUERIES  # noqa: E402

HEADLINE = (
    "prepare_buildings", "contiguity", "building_distances", "walls_near_roads", "passive_volume",
    "blocks", "block_courtyard", "block_main_dir", "usr_floor_density", "usr_iris", "typo_usr",
    "building_indicators", "block_indicators", "usr_indicators",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("townform-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             # the test city is small in bytes but not in work: keep all cores busy
             .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
             .config("spark.driver.memory", "8g")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in wanted:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "urban_morphology_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
