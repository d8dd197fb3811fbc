import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality, verification
from meterline.plans import maintenance
from meterline.plans.pipeline import (
    EXPORT_ORDER,
    Pipeline,
    QualityError,
    run_from_files,
    stored_tables,
    verify,
    verify_bronze,
)
from meterline.session import shared_folder
from meterline.sources.exports import export_check, export_csv
from meterline.sources.files import Storage
from meterline.sources.inventory import expired_files, file_layout, layout_summary, table_inventory
from meterline.sources.lake import (
    Lake,
    ReadBackError,
    SchemaChangeError,
    WriteResult,
    preview,
    refresh_partitions,
    try_read_table,
    write_table,
)
from meterline.sources.trips import find_monthly_files, ingest_trips, ingest_zones, read_months, union_months

RUN_DATE = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def raw_folder(spark, trips, tmp_path_factory):
    """Two months whose schemas differ in type, letter case and columns, and a zone file."""
    folder = tmp_path_factory.mktemp("raw")
    january = trips(*[{"tpep_pickup_datetime": dt.datetime(2023, 1, d, 9)} for d in range(1, 9)])
    january = january.withColumn("tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + INTERVAL 20 MINUTE"))
    february = january.withColumns(
        {
            "tpep_pickup_datetime": F.expr("tpep_pickup_datetime + INTERVAL 31 DAY"),
            "tpep_dropoff_datetime": F.expr("tpep_dropoff_datetime + INTERVAL 31 DAY"),
            "passenger_count": F.col("passenger_count").cast("long"),
            "airport_fee": F.lit(1.25),
            "extra": F.lit("x"),
        }
    )
    for name, df in (("01", january.withColumn("Airport_fee", F.lit(0.5))), ("02", february)):
        df.write.parquet(f"{folder}/yellow_tripdata_2023-{name}.parquet")
    (folder / "taxi_zone_lookup.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1, north ,"Alpha, West",Yellow\n2,North,Beta,Boro\n'
    )
    return str(folder)


def test_months_are_united_by_name(spark, raw_folder):
    paths = find_monthly_files(spark, raw_folder)
    assert [Path(p).name[-10:] for p in paths] == ["01.parquet", "02.parquet"]
    df = ingest_trips(spark, paths, RUN_DATE)
    kinds = dict(df.dtypes)
    assert kinds["passenger_count"] == "double" and "airport_fee" not in kinds
    rows = df.groupBy("Airport_fee", "extra", "_layer", "_ingestion_date").count().collect()
    assert {(r.Airport_fee, r.extra, r["count"]) for r in rows} == {(0.5, None, 8), (1.25, "x", 8)}
    assert {(r._layer, r._ingestion_date) for r in rows} == {("bronze", RUN_DATE)}
    assert df.select("_source_file").distinct().count() >= 2


def test_months_of_one_schema_share_a_scan(spark, raw_folder):
    paths = find_monthly_files(spark, raw_folder)
    plan = read_months(spark, [paths[1], *paths])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_missing_months_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        find_monthly_files(spark, str(tmp_path))


def test_zone_file(spark, raw_folder):
    df = ingest_zones(spark, f"{raw_folder}/taxi_zone_lookup.csv", RUN_DATE)
    assert dict(df.dtypes)["LocationID"] == "int" and "_source_file" not in df.columns
    assert {(r.LocationID, r.Zone, r.service_zone) for r in df.collect()} == {
        (1, "Alpha, West", "Yellow"), (2, "Beta", "Boro"),
    }


def test_union_widens_and_fills(spark):
    left, right = spark.sql("SELECT 1 AS a, 2 AS B"), spark.sql("SELECT 1.5D AS A, 'x' AS c")
    assert [tuple(r) for r in union_months([left, right]).collect()] == [(1.0, 2, None), (1.5, None, "x")]


def test_whole_run_from_files(spark, raw_folder, tmp_path):
    exports = f"{tmp_path}/exports"
    ledger = run_from_files(spark, raw_folder, f"{tmp_path}/lake", RUN_DATE, exports)
    assert [(r.job_name, r.status) for r in ledger.collect()] == [
        (name, "SUCCESS") for name in ("bronze", "silver", "quality", "gold", "analytics", "maintenance")
    ]
    lake = Lake(f"{tmp_path}/lake")
    silver = lake.read(spark, "silver.trips_cleaned")
    assert silver.count() == 16 and dict(silver.dtypes)["pickup_date"] == "date"
    assert len(list(Path(lake.location("silver.trips_cleaned")).glob("pickup_date=*"))) == 16
    assert lake.read(spark, "gold.trips_daily_metrics").agg({"total_trips": "sum"}).first()[0] == 16
    checks = spark.read.parquet(lake.side_table("quality_checks"))
    assert checks.filter("status = 'PASSED'").count() == 8
    assert spark.read.parquet(lake.side_table("check_summary")).first().checks_passed == 8
    assert spark.read.parquet(lake.side_table("trip_statistics")).first().avg_fare == 20.0
    assert spark.read.parquet(lake.side_table("expired_files")).count() == 0
    verdicts = {r.layer: r for r in verify(spark, lake).collect()}
    assert verdicts["silver"].verdict == "ISSUES FOUND" and sum(v.tables for v in verdicts.values()) == 12
    bronze = verify_bronze(spark, lake)
    assert bronze["columns"].filter("status <> 'PASSED'").count() == 0
    assert bronze["layers"].filter("status <> 'PASSED'").count() == 0
    assert bronze["boroughs"].first().status == "WARNING"
    inventory = {r.table_name: r for r in spark.read.parquet(lake.side_table("lake_tables")).collect()}
    assert inventory["trips_cleaned"].record_count == 16 and len(inventory) == 12
    for name in EXPORT_ORDER:
        assert len(list(Path(exports, name).glob("part-*.csv"))) == 1, name
    trends = next(Path(exports, "daily_trends").glob("part-*.csv")).read_text().splitlines()
    assert trends[0].startswith("pickup_date,total_trips") and trends[1:] == sorted(trends[1:])

    # a second run replaces the tables and adds to the ledger
    run_from_files(spark, raw_folder, f"{tmp_path}/lake", RUN_DATE)
    assert lake.read(spark, "silver.trips_cleaned").count() == 16
    assert spark.read.parquet(lake.side_table("pipeline_jobs")).count() == 12


def test_failing_stages(spark, trips, zones, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    job = Pipeline(spark, lake, trips(), zones)

    def broken(name, error):
        def stage():
            raise error

        stage.__name__ = name
        monkeypatch.setattr(job, name, stage)

    broken("quality", RuntimeError())
    broken("gold", RuntimeError("broken stage\nand more"))
    with pytest.raises(RuntimeError, match="broken stage"):
        job.run()
    rows = spark.read.parquet(lake.side_table("pipeline_jobs")).collect()
    assert [(r.job_name, r.status, r.error_message) for r in rows] == [
        ("bronze", "SUCCESS", None), ("silver", "SUCCESS", None),
        ("quality", "FAILED", "RuntimeError"), ("gold", "FAILED", "broken stage"),
    ]


def test_schema_change_needs_permission(spark, tmp_path):
    location = f"{tmp_path}/t"
    df = spark.range(3)
    assert write_table(df, location, allow_schema_change=False).rows == 3
    write_table(df, location, allow_schema_change=False)
    with pytest.raises(SchemaChangeError):
        write_table(df.withColumn("more", F.lit(1)), location, allow_schema_change=False)
    assert write_table(df.withColumn("more", F.lit(1)), location).rows == 3
    assert spark.read.parquet(location).columns == ["id", "more"]


def test_writes_are_read_back(spark, tmp_path, monkeypatch):
    lake, df = Lake(str(tmp_path)), spark.range(4)
    assert lake.write(df, "gold.trips_popular_routes").rows == 4
    monkeypatch.setattr("meterline.sources.lake.write_table", lambda *args: WriteResult(5, 1.0))
    with pytest.raises(ReadBackError):
        lake.write(df, "gold.trips_popular_routes")


def test_preview(spark):
    rows = preview(spark.range(9).selectExpr("id", "-id AS n"), ("id",), 3, "n").collect()
    assert [r.id for r in rows] == [8, 7, 6]
    assert preview(spark.range(9), ("id",)).count() == 5


def test_refresh_keeps_other_partitions(spark, tmp_path):
    location = f"{tmp_path}/t"
    df = spark.range(20).selectExpr("id", "id % 4 AS k")
    write_table(df, location, ("k",))
    refresh_partitions(df.filter("k = 1").withColumn("id", -F.col("id")), location, ("k",))
    rows = spark.read.parquet(location).collect()
    assert len(rows) == 20 and all((r.id < 0) == (r.k == 1) for r in rows)


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(0, 2_000_000, 1, 8).selectExpr("id", "uuid() AS payload", "IF(id % 3 = 0, 1, 0) AS k")
    write_table(hot, f"{tmp_path}/t", ("k",), task_bytes=4 << 20)
    assert len(list(Path(f"{tmp_path}/t/k=0").glob("*.parquet"))) > 2
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2_000_000


def test_export_round_trip(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "id / 2 AS half", "DATE '2023-01-01' AS day")
    export_csv(df, f"{tmp_path}/e", [F.desc("id")])
    row = export_check(spark, "e", f"{tmp_path}/e", df).first()
    assert (row.columns_exported, row.rows_expected, row.rows_exported, row.status) == (3, 5, 5, "PASSED")
    assert export_check(spark, "e", f"{tmp_path}/e", df.limit(2)).first().status == "FAILED"
    with pytest.raises(Exception, match="header|HEADER|Header"):
        export_check(spark, "e", f"{tmp_path}/e", df.withColumnRenamed("half", "other")).first()


def small_files(spark, location, files=12):
    spark.range(1000).repartition(files).write.parquet(location)
    return spark.read.parquet(location)


def test_compaction_swaps_and_keeps_the_old_files(spark, tmp_path):
    location = f"{tmp_path}/t"
    small_files(spark, location)
    report = maintenance.compact_table(spark, "t", location)
    assert (report.status, report.record_count, report.files_before, report.files_after, report.reduction) == (
        "SUCCESS", 1000, 12, 1, 11,
    )
    live = spark.read.parquet(location)
    assert live.selectExpr("sum(id)").first()[0] == 499500
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=5)
    expired = expired_files(spark, str(tmp_path), [location], later)
    assert expired.count() == 12 and expired.filter("file_path NOT LIKE '%__old_%'").count() == 0
    assert expired_files(spark, str(tmp_path), [location], later - dt.timedelta(days=1)).count() == 0
    again = maintenance.compact_table(spark, "t", location)
    assert (again.status, again.message, again.files_after) == ("SUCCESS", "already compact", 1)


def test_compaction_of_partitioned_and_missing_tables(spark, tmp_path):
    location = f"{tmp_path}/t"
    for _ in range(3):
        spark.range(90).selectExpr("id", "id % 3 AS k").write.mode("append").partitionBy("k").parquet(location)
    report = maintenance.compact_table(spark, "t", location, ("k",))
    assert report.status == "SUCCESS" and report.files_after == 3 and report.record_count == 270
    missing = maintenance.compact_table(spark, "none", f"{tmp_path}/none")
    assert missing.status == "SKIPPED"
    assert maintenance.reports_frame(spark, [report, missing]).count() == 2


def test_failed_swap_leaves_the_table(spark, tmp_path, monkeypatch):
    location = f"{tmp_path}/t"
    small_files(spark, location)
    rename = maintenance.Storage.rename

    def refuse(self, source, target):
        if "__new_" in source:
            raise OSError("refused")
        rename(self, source, target)

    monkeypatch.setattr(maintenance.Storage, "rename", refuse)
    report = maintenance.compact_table(spark, "t", location)
    assert (report.status, report.message) == ("FAILED", "refused")
    assert spark.read.parquet(location).count() == 1000


def test_layout(spark, tmp_path):
    small_files(spark, f"{tmp_path}/t", 5)
    files = file_layout(spark, f"{tmp_path}/t").collect()
    assert len(files) == 5 and sum(f.record_count for f in files) == 1000
    row = layout_summary(spark, f"{tmp_path}/t", 1 << 20).first()
    assert (row.file_count, row.files_needed, row.record_count) == (5, 1, 1000)
    assert row.size_bytes == sum(f.size_bytes for f in files)


def test_clustered_copy_splits_identical_rows(spark, tmp_path):
    rows = spark.range(4000).selectExpr("DATE '2023-01-01' AS pickup_date", "1 AS PULocationID")
    maintenance.write_clustered(rows, f"{tmp_path}/t", files=4)
    counts = [f.record_count for f in file_layout(spark, f"{tmp_path}/t").collect()]
    assert sum(counts) == 4000 and len(counts) == 4 and max(counts) < 2000


def test_unreadable_table_is_none(spark, tmp_path):
    assert try_read_table(spark, f"{tmp_path}/nothing") is None


def test_shared_folder_comes_from_the_session(tmp_path):
    def session(master, **conf):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf={k.replace("_", "."): v for k, v in conf.items()}, sparkContext=context)

    named = session("spark://host:7077", spark_checkpoint_dir=f"{tmp_path}/shared/")
    assert shared_folder(named) == f"{tmp_path}/shared"
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(session("spark://host:7077"))


# ingestion ------------------------------------------------------------------------


@pytest.mark.parametrize("first", ["a", "z"])
def test_columns_of_single_parts_are_kept(spark, trips, tmp_path, first):
    month = f"{tmp_path}/yellow_tripdata_2023-01.parquet"
    plain, fee = trips(), trips().withColumn("airport_fee", F.lit(1.5))
    for name, df in zip((first, "m"), (fee, plain)):
        df.coalesce(1).write.parquet(f"{tmp_path}/one-{name}")
        part = next(Path(f"{tmp_path}/one-{name}").glob("part-*.parquet"))
        Path(month).mkdir(exist_ok=True)
        part.rename(f"{month}/{name}-part.parquet")
    rows = read_months(spark, [month])
    assert sorted(str(r.airport_fee) for r in rows.collect()) == ["1.5", "None"]


def test_parts_with_conflicting_types_are_united(spark, tmp_path):
    month = f"{tmp_path}/yellow_tripdata_2023-01.parquet"
    spark.sql("SELECT 1L AS passenger_count, 'x' AS extra").coalesce(1).write.parquet(month)
    spark.sql("SELECT 1.5D AS passenger_count, 2 AS Tip").coalesce(1).write.mode("append").parquet(month)
    rows = read_months(spark, [month]).collect()
    assert sorted((r.passenger_count, r.extra, r.Tip) for r in rows) == [(1.0, "x", None), (1.5, None, 2)]
    assert all("yellow_tripdata_2023-01" in r._source_file for r in rows)


def test_pattern_and_registry_of_sources(spark, raw_folder, trips, tmp_path):
    folder = tmp_path / "raw"
    trips().write.parquet(f"{folder}/yellow_tripdata_2024-05.parquet")
    trips().write.parquet(f"{folder}/yellow_tripdata_2023-05.parquet")
    (folder / "taxi_zone_lookup.csv").write_text("LocationID,Borough,Zone\n1,North,Alpha\n")
    lake = Lake(f"{tmp_path}/lake")
    run_from_files(spark, str(folder), lake.root, RUN_DATE, pattern="yellow_tripdata_2024-*.parquet")
    sources = {r.source_name: r.is_active for r in spark.read.parquet(lake.side_table("data_sources")).collect()}
    assert sources == {
        "yellow_tripdata_2024-05.parquet": True, "yellow_tripdata_2023-05.parquet": False, "taxi_zone_lookup.csv": True,
    }
    assert lake.read(spark, "bronze.trips").count() == 1


# layout and maintenance -------------------------------------------------------------


@pytest.mark.parametrize("root", ["my lake", "a%20b", "plain"])
def test_expiry_never_names_live_files(spark, tmp_path, root):
    lake = Lake(f"{tmp_path}/{root}")
    location = lake.location("gold.trips_popular_routes")
    lake.write(spark.range(10).repartition(3), "gold.trips_popular_routes")
    lake.write(spark.range(0), "bronze.trips")
    left = f"{lake.root}/gold/left_over"
    spark.range(5).coalesce(1).write.parquet(left)
    live = [location, lake.location("bronze.trips"), f"{lake.root}/gold/not there"]
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=5)
    found = expired_files(spark, [lake.root, f"{tmp_path}/none"], live, later)
    assert [Path(r.file_path).parent.name for r in found.collect()] == ["left_over"]
    assert file_layout(spark, lake.location("bronze.trips")).count() >= 1
    inventory = {r.table_name: r.record_count for r in table_inventory(spark, lake).collect()}
    assert inventory == {"trips": 0, "trips_popular_routes": 10}


def test_reports_on_an_empty_lake(spark, tmp_path):
    lake = Lake(f"{tmp_path}/none")
    assert table_inventory(spark, lake).count() == 0
    assert expired_files(spark, lake.root, [], dt.datetime.now(dt.timezone.utc)).count() == 0
    tables = stored_tables(spark, lake)
    assert {r.record_count for r in verification.row_counts(tables).collect()} == {None}
    assert {r.status for r in verification.minimum_records(tables).collect()} == {"FAILED"}
    assert {r.status for r in verification.reconcile(tables).collect()} == {"FAILED"}
    assert all(r.failed == r.tables > 0 for r in verify(spark, lake).collect())


def test_only_fragmented_folders_are_rewritten(spark, tmp_path):
    location = f"{tmp_path}/my t"
    rows = spark.range(1000).selectExpr("id", "concat('k ', id % 10) AS k")
    rows.repartition(1).write.partitionBy("k").parquet(location)
    for _ in range(3):
        rows.filter("k = 'k 3'").coalesce(1).write.mode("append").partitionBy("k").parquet(location)
    before = {p: p.stat().st_mtime_ns for p in Path(location).rglob("*.parquet") if "k 3" not in str(p.parent)}
    report = maintenance.compact_table(spark, "t", location, ("k",))
    assert (report.status, report.files_before, report.files_after) == ("SUCCESS", 13, 10), report
    after = {p: p.stat().st_mtime_ns for p in Path(location).rglob("*.parquet") if "k 3" not in str(p.parent)}
    assert before == after and spark.read.parquet(location).count() == 1300
    assert maintenance.compact_table(spark, "t", location, ("k",)).message == "already compact"


def test_compaction_settles_near_the_target(spark, tmp_path):
    # columns of few values: their shuffle form is many times larger than their files
    location = f"{tmp_path}/t"
    rows = spark.range(400_000).selectExpr("id % 3 AS a", "repeat('x', CAST(id % 2 AS INT) * 40) AS b", "id % 2 AS k", "rand(1) AS r")
    rows.repartition(40).write.partitionBy("k").parquet(location)
    target = sum(p.stat().st_size for p in Path(location).rglob("*.parquet")) // 8
    report = maintenance.compact_table(spark, "t", location, ("k",), target)
    assert report.status == "SUCCESS" and 6 <= report.files_after <= 16, report
    sizes = [p.stat().st_size for p in Path(location).rglob("*.parquet")]
    assert target / 2 <= sum(sizes) / len(sizes) <= 2 * target
    assert maintenance.compact_table(spark, "t", location, ("k",), target).message == "already compact"


def test_whole_run_in_another_format(spark, raw_folder, tmp_path):
    ledger = run_from_files(spark, raw_folder, f"{tmp_path}/lake", RUN_DATE, fmt="orc").collect()
    assert [r.status for r in ledger] == ["SUCCESS"] * 6
    lake = Lake(f"{tmp_path}/lake", "orc")
    assert spark.read.parquet(lake.side_table("lake_tables")).count() == 12
    assert maintenance.compact_table(spark, "t", lake.root, fmt="delta").status == "SKIPPED"


# run bookkeeping --------------------------------------------------------------------


def test_a_pipeline_can_run_twice(spark, trips, zones, tmp_path):
    lake = Lake(str(tmp_path))
    job = Pipeline(spark, lake, trips(), zones)
    assert job.run().count() == 6 and job.run().count() == 6
    assert spark.read.parquet(lake.side_table("pipeline_jobs")).count() == 12
    history = spark.read.parquet(lake.side_table("quality_history"))
    assert history.count() == 16 and history.select("checked_at").distinct().count() == 2


def test_failed_checks_stop_a_strict_run(spark, trips, zones, tmp_path, monkeypatch):
    job = Pipeline(spark, Lake(str(tmp_path)), trips({"fare_amount": 20.0}), zones, fail_on_error=True)
    job.bronze()
    job.silver()
    silver = job.lake.read(spark, "silver.trips_cleaned").withColumn("fare_amount", F.lit(-1.0))
    monkeypatch.setattr(job, "silver", lambda: [job.lake.write(silver, "silver.trips_cleaned")])
    job.silver.__name__ = "silver"
    with pytest.raises(QualityError, match="fare_positive"):
        job.run()
    assert spark.read.parquet(job.lake.side_table("quality_checks")).filter("status = 'FAILED'").count() == 1


def test_every_borough_is_stored(spark):
    silver = spark.range(24).selectExpr("concat('b', id % 12) AS PU_Borough")
    assert quality.borough_distribution(silver).count() == 12


def test_refresh_recomputes_one_month(spark, trips, zones, tmp_path):
    def trip(month, day, fare):
        start = dt.datetime(2023, month, day, 9)
        return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=20), "fare_amount": fare}

    lake = Lake(str(tmp_path))
    Pipeline(spark, lake, trips(trip(1, 5, 10.0), trip(2, 5, 10.0), trip(2, 6, 10.0)), zones).run()
    job = Pipeline(spark, lake, trips(trip(1, 5, 99.0), trip(2, 5, 30.0), trip(2, 7, 30.0)), zones)
    job.bronze()
    job.refresh("2023-02")
    silver = {(r.pickup_date.month, r.pickup_date.day): r.fare_amount for r in lake.read(spark, "silver.trips_cleaned").collect()}
    assert silver == {(1, 5): 10.0, (2, 5): 30.0, (2, 7): 30.0}
    for key in ("gold.trips_daily_metrics", "gold.trips_hourly_metrics", "gold.trips_borough_metrics"):
        days = {(r.pickup_date.month, r.pickup_date.day) for r in lake.read(spark, key).collect()}
        assert days == {(1, 5), (2, 5), (2, 7)}, key


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    location = f"{tmp_path}/t"
    write_table(spark.range(5), location)
    with pytest.raises(Exception, match="fails"):
        write_table(spark.range(9).selectExpr("IF(id = 7, raise_error('it fails'), id) AS id"), location)
    assert spark.read.parquet(location).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_unreadable_tables_are_errors_and_not_absent(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/part-0.parquet").write_text("not a table")
    with pytest.raises(Exception, match="parquet|PARQUET|FAILED_READ"):
        try_read_table(spark, f"{tmp_path}/t")


def test_a_bad_table_fails_alone(spark, raw_folder, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    run_from_files(spark, raw_folder, lake.root, RUN_DATE)
    daily = lake.read(spark, "gold.trips_daily_metrics").drop("_layer", "total_trips")
    write_table(daily, lake.location("gold.trips_daily_metrics"))
    silver = lake.read(spark, "silver.trips_cleaned").drop("trip_distance")
    write_table(silver, lake.location("silver.trips_cleaned"), ("pickup_date",))
    for file in Path(lake.location("gold.trips_popular_routes")).glob("*.parquet"):
        file.write_text("broken")
    Storage(spark).delete(lake.location("gold.trips_hourly_metrics"))
    layers = {r.layer: r for r in verify(spark, lake).collect()}
    assert layers["gold"].tables == 4 and layers["gold"].failed == 2 and layers["bronze"].failed == 0
    checks = {(r.table_name, r.check_name): r.status for r in spark.read.parquet(lake.side_table("verification")).collect()}
    assert checks["gold.trips_daily_metrics", "layer_tag"] == "WARNING"
    assert checks["silver.trips_cleaned", "no_nulls"] == "WARNING"
    bronze = lake.read(spark, "bronze.trips").drop("fare_amount")
    write_table(bronze, lake.location("bronze.trips"))
    found = {r.column_name: r.status for r in verify_bronze(spark, lake)["nulls"].collect()}
    assert found["fare_amount"] == "FAILED" and found["trip_distance"] == "PASSED"
    assert verify_bronze(spark, lake)["columns"].filter("status = 'FAILED'").first().column_name == "fare_amount"


def test_exports_with_other_values_fail(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "IF(id = 1, NULL, concat('v', id)) AS v")
    export_csv(df, f"{tmp_path}/e", ["id"])
    assert export_check(spark, "e", f"{tmp_path}/e", df).first().status == "PASSED"
    other = df.withColumn("v", F.when(F.col("id") == 3, F.lit("w")).otherwise(F.col("v")))
    assert export_check(spark, "e", f"{tmp_path}/e", other).first().status == "FAILED"
