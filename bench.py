"""Times the headline queries and the pipeline stages; prints one JSON line.

BENCH_SF_DIR is the folder of input tables, BENCH_CPUS the number of local cores.
Each query runs once to warm the JVM and is then timed, to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from meterline.operators.stamps import stamp_bronze
from meterline.plans.pipeline import Pipeline
from meterline.plans.queries import RUN_DATE, Layers, all_queries
from meterline.session import build_session, shared_folder
from meterline.sources.lake import Lake

HEADLINE = (
    "silver_filter_audit",
    "silver_enriched",
    "gold_daily",
    "gold_hourly",
    "gold_borough",
    "gold_routes",
    "kpi_global",
    "kpi_monthly",
    "daily_trends",
    "performance_ranking",
    "weekday_comparison",
    "hourly_heatmap",
    "peak_hours",
    "top_routes_volume",
    "top_routes_profit",
    "route_efficiency",
    "borough_flow",
    "borough_summary",
    "dq_checks",
    "dq_stats",
    "dq_null_profile",
    "mart_daily_hourly",
    "mart_revenue_trend",
    "mart_forecast_30d",
    "mart_sliced_hourly",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)

    layers = Layers(spark, folder)
    lake = Lake(tempfile.mkdtemp(prefix="bench-", dir=_local(shared_folder(spark))))
    trips = layers.bronze().withColumn("_source_file", F.lit(folder))
    job = Pipeline(spark, lake, trips, stamp_bronze(layers.raw_zones(), RUN_DATE), f"{lake.root}/exports")
    ledger = {row.job_name: row for row in job.run().collect()}
    rows_in = {"bronze": "bronze", "silver": "bronze", "quality": "silver", "gold": "silver"}
    stages = {name: {"sec": round(row.duration_sec, 3)} for name, row in ledger.items()}
    for name, source in rows_in.items():
        stages[name]["rows_per_sec"] = round(ledger[source].records_processed / ledger[name].duration_sec)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stages": stages,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


def _local(folder: str) -> str:
    folder = folder.removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    return folder


if __name__ == "__main__":
    main()
