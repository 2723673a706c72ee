"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the number of local cores. Each query
is run whole (into a sink that drops the rows) and its best of two runs counts,
the first of which also compiles. `refresh` writes both cubes from the facts;
the report queries read what it stored.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from verification import registry  # noqa: E402
from verification.scratch import cube_store  # noqa: E402

HEADLINE = [
    "rate_clean", "car_profile", "driver_profile", "rate_car_driver", "monthly_cube", "state_cube", "state_index",
    "slice_filter", "discount_what_if", "company_ranks", "company_report", "company_report_filtered",
    "company_report_what_if", "top_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("quotelens-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.sql.files.minPartitionNum", cpus).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    started = time.perf_counter()
    cube_store(spark, sf_dir)
    seconds["refresh"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
