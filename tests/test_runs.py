"""Stages that are skipped when nothing changed, and the audit taken from the write itself."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.operators.cleaning import TRIP_RULES, audit_of, filter_audit, rejection_mask, typed_trips
from meterline.plans import pipeline
from meterline.plans.pipeline import Pipeline
from meterline.sources.lake import Lake

STAGES = ["bronze", "silver", "quality", "gold", "analytics", "maintenance"]
BAD = [
    {},
    {"fare_amount": -1.0},
    {"trip_distance": 0.0, "total_amount": 0.0},
    {"passenger_count": None},
    {"PULocationID": None, "passenger_count": 9.0},
    {"tpep_pickup_datetime": None},
    {"trip_distance": 200.0},
]


def statuses(ledger):
    return {r.job_name: r.status for r in ledger.collect()}


def test_audit_from_masks_equals_the_audit_of_a_pass(trips):
    typed = typed_trips(trips(*BAD, *BAD, {}))
    masks = typed.groupBy(rejection_mask().alias("rejected")).agg(F.count("*").alias("n"))
    assert audit_of(masks).collect() == filter_audit(typed).collect()
    assert audit_of(masks.limit(0)).collect() == filter_audit(typed.limit(0)).collect()


def test_silver_reads_bronze_once_and_keeps_what_it_rejects(spark, trips, zones, tmp_path, monkeypatch):
    lake, reads = Lake(str(tmp_path)), []
    job = Pipeline(spark, lake, trips(*BAD), zones)
    job.bronze()
    usual = Lake.read

    def watched(self, session, key):
        df = usual(self, session, key)
        reads.append(key)
        return df

    monkeypatch.setattr(Lake, "read", watched)
    assert [r.rows for r in job.silver()] == [1]
    assert reads.count("bronze.trips") == 1
    audit = spark.read.parquet(lake.side_table("filter_audit")).collect()
    assert audit == filter_audit(typed_trips(lake.read(spark, "bronze.trips"))).collect()
    silver = lake.read(spark, "silver.trips_cleaned")
    assert silver.count() == 1 and "_rejected" not in silver.columns
    rejected = job.rejected_trips()
    first = list(TRIP_RULES).index
    assert rejected.filter(F.col("_rejected").bitwiseAND(1 << first("passengers_1_to_6")) != 0).count() == 2
    assert rejected.count() == 6 and not list(Path(lake.root).rglob("*__new_*"))


def test_trips_are_shuffled_before_they_get_wide(spark, trips, zones, tmp_path, monkeypatch):
    plans, write = [], pipeline.write_table

    def seen(df, *args, **options):
        plans.append((df._jdf.queryExecution().optimizedPlan().toString(), options))
        return write(df, *args, **options)

    monkeypatch.setattr(pipeline, "write_table", seen)
    job = Pipeline(spark, Lake(str(tmp_path / "lake")), trips(*BAD), zones)
    job.bronze()
    job.silver()
    (plan, options), *_ = plans
    wide, narrow = plan.split("RebalancePartitions")
    assert options["together"] and "fare_per_mile" in wide and "fare_per_mile" not in narrow


def test_silver_without_accepted_or_rejected_trips(spark, trips, zones, tmp_path):
    for name, rows in (("none", BAD[1:]), ("all", [{}])):
        lake = Lake(f"{tmp_path}/{name}")
        job = Pipeline(spark, lake, trips(*rows), zones)
        job.bronze()
        assert job.silver()[0].rows == (0 if name == "none" else 1)
        assert lake.read(spark, "silver.trips_cleaned").count() == (0 if name == "none" else 1)
        audit = spark.read.parquet(lake.side_table("filter_audit")).first()
        assert (audit.rows_before, audit.rows_removed) == ((6, 6) if name == "none" else (1, 0))


def test_audit_counts_no_row_twice_when_tasks_fail(tmp_path):
    """Tasks of the scan and of the write fail once; both are repeated, and so would be counters."""
    script = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from pyspark import TaskContext
        from meterline.operators.cleaning import filter_audit, typed_trips
        from meterline.plans import pipeline
        from meterline.session import build_session
        from meterline.sources.lake import Lake

        spark = build_session("faults", master="local[4,3]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false")
        spark.sparkContext.setLogLevel("OFF")

        def failing(batches):
            for batch in batches:
                yield batch
            context = TaskContext.get()
            if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
                raise RuntimeError("lost")

        start = "timestamp_micros(1672531200000000 + id * 60000000)"
        trips = spark.range(0, 4000, 1, 8).selectExpr(
            f"{{start}} AS tpep_pickup_datetime", f"{{start}} + INTERVAL 9 MINUTE AS tpep_dropoff_datetime",
            "1.0D AS passenger_count", "IF(id % 7 = 0, 0D, 2D) AS trip_distance", "IF(id % 5 = 0, -1D, 9D) AS fare_amount",
            "12D AS total_amount", "1D AS tip_amount", "1 AS PULocationID", "2 AS DOLocationID")
        zones = spark.sql("SELECT 1 AS LocationID, 'a' AS Borough, 'x' AS Zone UNION ALL SELECT 2, 'b', 'y'")
        lake = Lake({str(tmp_path)!r})
        job = pipeline.Pipeline(spark, lake, trips, zones)
        job.bronze()
        usual, enriched = pipeline.typed_trips, pipeline.Pipeline._enriched
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        pipeline.typed_trips = lambda bronze: usual(bronze.mapInArrow(failing, bronze.schema))
        job.silver()
        audit = spark.read.parquet(lake.side_table("filter_audit")).collect()
        assert audit == filter_audit(usual(lake.read(spark, "bronze.trips"))).collect(), audit
        assert audit[0].rows_before == 4000 and lake.read(spark, "silver.trips_cleaned").count() == audit[0].rows_after
        print("counted right")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=200)
    assert "counted right" in done.stdout, done.stderr[-3000:]


def test_a_failed_run_goes_on_where_it_stopped(spark, trips, zones, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))

    def job(version="v1", **options):
        return Pipeline(spark, lake, trips({}, {"PULocationID": 2}), zones, source_version=version, **options)

    def broken(sums):
        raise RuntimeError("no gold")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline.cube, "cube_sums", broken)
        with pytest.raises(RuntimeError, match="no gold"):
            job().run(resume=True)
    written = {p: p.stat().st_mtime_ns for p in Path(lake.root, "silver").rglob("*.parquet")}
    found = statuses(job().run(resume=True))
    assert found == {s: "SKIPPED" if s in ("bronze", "silver", "quality") else "SUCCESS" for s in STAGES}
    assert written == {p: p.stat().st_mtime_ns for p in Path(lake.root, "silver").rglob("*.parquet")}
    assert set(statuses(job().run(resume=True)).values()) == {"SKIPPED"}

    # other parameters rerun the stage that has them, other sources all
    found = statuses(job(export_root=f"{tmp_path}/exports").run(resume=True))
    assert [s for s in STAGES if found[s] == "SUCCESS"] == ["analytics", "maintenance"]
    assert set(statuses(job("v2").run(resume=True)).values()) == {"SUCCESS"}


def test_changed_code_lost_tables_and_refreshes_are_not_skipped(spark, trips, zones, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    job = Pipeline(spark, lake, trips(), zones, source_version="v1")
    for name in ("quality", "maintenance"):
        stage = lambda: []
        stage.__name__ = name
        monkeypatch.setattr(job, name, stage)
    job.run()
    location = Path(lake.location("gold.trips_daily_metrics"))
    for part in location.glob("*"):
        part.unlink()
    found = statuses(job.run(resume=True))
    assert (found["silver"], found["gold"], found["analytics"]) == ("SKIPPED", "SUCCESS", "SUCCESS")
    job.refresh("2023-03")
    assert statuses(job.run(resume=True))["silver"] == "SUCCESS"
    monkeypatch.setattr(pipeline, "_code_version", lambda: "other")
    assert set(statuses(job.run(resume=True)).values()) == {"SUCCESS"}
