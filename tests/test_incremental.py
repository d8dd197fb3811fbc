"""Runs that recompute only what has changed must leave what a full run would."""

import datetime as dt
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.layout import CLOCK_COLUMNS, TABLES
from meterline.plans.pipeline import Pipeline, update_from_files
from meterline.sources import arrivals
from meterline.sources.lake import Lake, replace_folders, write_table

RUN_DATE = dt.date(2024, 1, 1)


def trip(month, day, fare, zone=1, hour=9):
    start = dt.datetime(2023, month, day, hour)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + dt.timedelta(minutes=20),
        "fare_amount": fare,
        "PULocationID": zone,
    }


JANUARY = [trip(1, day, 10.0 + day, 1 + day % 3, day % 24) for day in range(1, 20)]
FEBRUARY = [trip(2, day, 20.25 + day, 1 + day % 3) for day in range(1, 15)]
CORRECTED = [trip(2, day, 40.5 + day, 2) for day in range(3, 18)] + [trip(3, 1, 12.0, 3)]


def contents(spark, lake, root=None):
    """Every row of every stored table, without clocks and paths."""
    result = {}
    for key in TABLES:
        df = lake.read(spark, key).drop(*CLOCK_COLUMNS, "_source_file")
        result[key] = sorted(map(str, df.select(sorted(df.columns)).collect()))
    if root:
        for path in sorted(Path(root).rglob("*.csv")):
            result[path.parent.name] = re.sub(r"\d{4}-\d\d-\d\dT[\d:.]+Z", "", path.read_text())
    return result


def fill(job):
    for stage in (job.bronze, job.silver, job.gold, job.analytics):
        stage()


def test_refresh_equals_a_full_run(spark, trips, zones, tmp_path):
    lake, full = Lake(f"{tmp_path}/lake"), Lake(f"{tmp_path}/full")
    fill(Pipeline(spark, lake, trips(*JANUARY, *FEBRUARY), zones, f"{tmp_path}/exports"))
    job = Pipeline(spark, lake, trips(*JANUARY, *CORRECTED), zones, f"{tmp_path}/exports")
    job.bronze()
    job.refresh("2023-02", "2023-03")
    fill(Pipeline(spark, full, trips(*JANUARY, *CORRECTED), zones, f"{tmp_path}/full_exports"))
    assert contents(spark, lake, f"{tmp_path}/exports") == contents(spark, full, f"{tmp_path}/full_exports")
    assert not list(Path(lake.root).rglob("*__new_*")) and not list(Path(lake.root).rglob("*__old_*"))


def test_refresh_of_a_month_without_trips_removes_it(spark, trips, zones, tmp_path):
    lake = Lake(str(tmp_path))
    fill(Pipeline(spark, lake, trips(*JANUARY, *FEBRUARY), zones))
    job = Pipeline(spark, lake, trips(*JANUARY), zones)
    job.bronze()
    job.refresh("2023-02")
    job.refresh()
    for key in ("silver.trips_cleaned", "gold.trips_daily_metrics", "gold.trips_hourly_metrics", "gold.trips_borough_metrics"):
        assert lake.read(spark, key).agg(F.max(F.month("pickup_date"))).first()[0] == 1, key
    assert lake.read(spark, "gold.trips_popular_routes").agg(F.sum("total_trips")).first()[0] == len(JANUARY)


def test_a_refresh_reads_one_month(spark, trips, zones, tmp_path, monkeypatch):
    """Bronze is read with a range on the stored time, silver by the day folders of the month."""
    lake = Lake(str(tmp_path))
    job = Pipeline(spark, lake, trips(*JANUARY, *FEBRUARY), zones)
    fill(job)
    bronze = job._bronze_of(["2023-02"])._jdf.queryExecution().executedPlan().toString()
    assert ">= 2023-02-01 00:00:00" in bronze and "PushedFilters: [IsNotNull(tpep_pickup_datetime), Gr" in bronze
    read = []
    for name in ("trip_sums", "route_sums"):
        build = monkeypatch_build(monkeypatch, name, read)
        assert build
    job.refresh("2023-02")
    assert len(read) == 2
    for silver in read:
        files = {Path(f).parent.name for f in silver.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
        assert files and all(name.startswith("pickup_date=2023-02-") for name in files)
        assert "PartitionFilters: [isnotnull(pickup_date" in silver._jdf.queryExecution().executedPlan().toString()


def monkeypatch_build(monkeypatch, name, read):
    from meterline.plans import pipeline

    build = pipeline.MONTHLY_SUMS[name]

    def watched(silver):
        read.append(silver)
        return build(silver)

    monkeypatch.setitem(pipeline.MONTHLY_SUMS, name, watched)
    return build


def test_folders_of_transactional_formats_are_not_moved(spark, tmp_path):
    with pytest.raises(ValueError, match="delta"):
        replace_folders(spark.range(1), str(tmp_path), "id", ["*"], fmt="delta")


def test_a_failed_refresh_leaves_the_folders(spark, tmp_path):
    location = f"{tmp_path}/t"
    write_table(spark.range(6).selectExpr("id", "id % 3 AS k"), location, ("k",))
    broken = spark.range(4).selectExpr("IF(id = 3, raise_error('it fails'), id) AS id", "1 AS k")
    with pytest.raises(Exception, match="it fails"):
        replace_folders(broken, location, "k", ["1"])
    assert spark.read.parquet(location).count() == 6 and [p.name for p in tmp_path.iterdir()] == ["t"]


# ingestion of what is new ---------------------------------------------------------


@pytest.fixture
def raw(spark, trips, tmp_path):
    """A folder of monthly files and a function that writes one; months may differ in schema."""
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "taxi_zone_lookup.csv").write_text("LocationID,Borough,Zone\n1,north,Alpha\n2,North,Beta\n3,South,Gamma\n")

    def month(name, rows, change=lambda df: df):
        path = folder / f"yellow_tripdata_2023-{name}.parquet"
        if path.exists():
            shutil.rmtree(path)
        change(trips(*rows)).coalesce(1).write.parquet(str(path))

    month.folder = str(folder)
    return month


def update(spark, raw, root, **options):
    return update_from_files(spark, raw.folder, str(root), RUN_DATE, f"{root}/exports", **options)


def full(spark, raw, root):
    update(spark, raw, root)
    return contents(spark, Lake(str(root)), f"{root}/exports")


def watch(monkeypatch):
    """The paths that later ingestions read."""
    read, usual = [], arrivals.read_months

    def watched(spark, paths):
        read.extend(path.rpartition("-")[2][:2] for path in paths)
        return usual(spark, paths)

    monkeypatch.setattr(arrivals, "read_months", watched)
    return read


def test_only_new_and_changed_months_are_read(spark, raw, tmp_path, monkeypatch):
    lake = Lake(f"{tmp_path}/lake")
    raw("01", JANUARY)
    assert update(spark, raw, lake.root) == ["2023-01"]
    read = watch(monkeypatch)
    raw("02", FEBRUARY)
    assert update(spark, raw, lake.root) == ["2023-02"] and read == ["02"]
    assert update(spark, raw, lake.root) == [] and read == ["02"]
    raw("02", CORRECTED)  # also has a trip of March
    assert update(spark, raw, lake.root) == ["2023-02", "2023-03"] and read == ["02", "02"]
    assert contents(spark, lake, f"{lake.root}/exports") == full(spark, raw, tmp_path / "full")
    known = arrivals.manifest(spark, lake)
    assert sorted(r.source for r in known.collect()) == [f"yellow_tripdata_2023-0{i}.parquet" for i in (1, 2)]


def test_a_wider_schema_rewrites_the_table_once(spark, raw, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    raw("01", JANUARY, lambda df: df.withColumn("passenger_count", F.col("passenger_count").cast("int")))
    update(spark, raw, lake.root)
    raw("02", FEBRUARY, lambda df: df.withColumns({"airport_fee": F.lit(1.25), "extra": F.lit("x")}))
    update(spark, raw, lake.root)
    bronze = lake.read(spark, "bronze.trips")
    assert dict(bronze.dtypes)["passenger_count"] == "double"
    assert bronze.groupBy("extra").count().collect() and bronze.count() == len(JANUARY) + len(FEBRUARY)
    raw("03", [trip(3, 5, 9.0)])  # a narrower one is filled up
    raw("01", JANUARY[:5], lambda df: df.withColumn("passenger_count", F.col("passenger_count").cast("int")))
    assert update(spark, raw, lake.root) == ["2023-01", "2023-03"]
    assert contents(spark, lake, f"{lake.root}/exports") == full(spark, raw, tmp_path / "full")


@pytest.mark.parametrize("step", ["_move_in", "refresh"])
def test_a_run_cut_off_anywhere_is_finished_by_the_next(spark, raw, tmp_path, monkeypatch, step):
    lake = Lake(f"{tmp_path}/lake")
    raw("01", JANUARY)
    update(spark, raw, lake.root)
    raw("01", JANUARY[:9])
    raw("02", FEBRUARY)
    owner = Pipeline if step == "refresh" else arrivals
    usual = getattr(owner, step)

    def broken(*args):
        if step == "_move_in":  # some files have moved
            usual(*args)
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, broken)
        with pytest.raises(RuntimeError, match="cut off"):
            update(spark, raw, lake.root)
    assert update(spark, raw, lake.root) == ["2023-01", "2023-02"]
    assert lake.read(spark, "bronze.trips").count() == 9 + len(FEBRUARY)
    for key in ("gold.trips_daily_metrics", "gold.trips_popular_routes"):
        assert lake.read(spark, key).agg(F.sum("total_trips")).first()[0] == 9 + len(FEBRUARY)


def test_a_changed_zone_lookup_recomputes_all(spark, raw, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    raw("01", JANUARY)
    update(spark, raw, lake.root)
    Path(raw.folder, "taxi_zone_lookup.csv").write_text("LocationID,Borough,Zone\n1,east,Alpha\n2,North,Beta\n3,South,Gamma\n")
    update(spark, raw, lake.root)
    assert {r.PU_Borough for r in lake.read(spark, "gold.trips_borough_metrics").collect()} == {"EAST", "NORTH", "SOUTH"}


def test_transactional_formats_are_left_to_their_own_commands(spark, raw, tmp_path):
    raw("01", JANUARY)
    with pytest.raises(ValueError, match="delta"):
        arrivals.ingest_arrivals(spark, Lake(str(tmp_path), "delta"), raw.folder, RUN_DATE)
