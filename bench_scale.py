"""Runs the pipeline on monthly files of published size, derived from the test tables.

Usage: python bench_scale.py [copies]      (64 copies of sf0.1 are about 38 million trips)

The copies are spread over the days of 2023 and written as twelve monthly folders;
only the pipeline itself is timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from meterline.plans.pipeline import Pipeline
from meterline.plans.queries import RUN_DATE, Layers
from meterline.operators.stamps import stamp_bronze
from meterline.session import build_session, shared_folder
from meterline.sources.lake import Lake
from meterline.sources.trips import find_monthly_files, ingest_trips


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 64
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-scale",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=64,
        spark__driver__memory="20g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    layers = Layers(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    root = tempfile.mkdtemp(prefix="scale-", dir=shared_folder(spark).removeprefix("file://"))

    pickup = "timestamp_micros(unix_micros(TIMESTAMP '2023-01-01') + {0} * 86400000000 + pmod(unix_micros({1}), 86400000000))"
    day = "pmod(hash(trip_key, trip_line, copy), 365)"
    trips = (
        layers.raw_trips()
        .repartition(4 * int(cpus))
        .selectExpr("*", f"explode(sequence(1, {copies})) AS copy")
        .selectExpr(
            f"{pickup.format(day, 'tpep_pickup_datetime')} AS start",
            "unix_micros(tpep_dropoff_datetime) - unix_micros(tpep_pickup_datetime) AS length",
            "passenger_count",
            "trip_distance",
            "round(fare_amount, 2) AS fare_amount",
            "round(total_amount, 2) AS total_amount",
            "round(tip_amount, 2) AS tip_amount",
            "PULocationID",
            "DOLocationID",
        )
        .selectExpr(
            "start AS tpep_pickup_datetime",
            "timestamp_micros(unix_micros(start) + length) AS tpep_dropoff_datetime",
            "* EXCEPT (start, length)",
            "date_format(start, 'MM') AS month",
        )
    )
    trips.write.partitionBy("month").parquet(f"{root}/raw")
    print("input written", file=sys.stderr)

    paths = find_monthly_files(spark, f"{root}/raw", "month=*")
    started = time.perf_counter()
    job = Pipeline(
        spark,
        Lake(f"{root}/lake"),
        ingest_trips(spark, paths, RUN_DATE),
        stamp_bronze(layers.raw_zones(), RUN_DATE),
        f"{root}/exports",
    )
    ledger = {row.job_name: row for row in job.run().collect()}
    total = time.perf_counter() - started
    bronze, silver = (ledger[name].records_processed for name in ("bronze", "silver"))
    fed = {"bronze": bronze, "silver": bronze, "quality": silver, "gold": silver}
    stages = {name: {"sec": round(row.duration_sec, 1), "status": row.status} for name, row in ledger.items()}
    for name, rows in fed.items():
        stages[name]["rows_per_sec"] = round(rows / ledger[name].duration_sec)
    print(json.dumps({"rows_bronze": bronze, "rows_silver": silver, "total_sec": round(total, 1), "stages": stages}))
    spark.stop()


if __name__ == "__main__":
    main()
