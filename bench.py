"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The measurements are written once as a Parquet table (reported as
``load_measurements``), then every query runs over its whole tables: one warm-up,
then the median of three.  ``value`` is the sum of the medians without the load.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures import derive, registry  # noqa: E402

HEADLINE = (
    "energy_flow_per_day",
    "energy_flow_per_month",
    "accumulated_yearly_co2_savings",
    "accumulated_yearly_energy_costs",
    "amortization",
    "average_consumption_per_month_and_hour",
    "average_internal_consumption_share_per_hour",
    "yearly_internal_consumption_share",
    "average_production_per_hour",
    "average_production_per_month",
    "weekly_quartiles",
    "yearly_production",
    "peaks",
    "best_performing_days",
    "battery_soc",
    "yearly_consumption",
    "temperature_extremes",
    "import_power_series",
    "import_logger",
    "stream_quarters",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sunledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # no Python call sites per column expression: plans are built twice as fast
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf: str, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    start = time.perf_counter()
    derive.stored_measurements(spark, sf)
    load = time.perf_counter() - start
    times = {}
    for name in HEADLINE:
        seconds(spark, sf, name)
        times[name] = round(statistics.median(seconds(spark, sf, name) for _ in range(3)), 3)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "load_measurements": round(load, 3),
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
