"""Layouts: files packed without a shuffle, files narrow in several columns, tables looked up cheaply."""

import datetime as dt
import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.operators.clustering import interleaved_key, range_cuts
from meterline.plans import maintenance, queries
from meterline.plans.pipeline import Pipeline
from meterline.sources.files import Storage
from meterline.sources.inventory import file_layout
from meterline.sources.lake import Lake, try_read_table


def sizes(location):
    return [p.stat().st_size for p in Path(location).rglob("*.parquet")]


def many_files(spark, location, files=60, rows=300_000):
    draw = spark.range(rows).selectExpr("id", "id % 2 AS k", "rand(1) AS r", "repeat('ab', CAST(id % 9 AS INT)) AS t")
    draw.repartition(files).write.partitionBy("k").parquet(location)


def test_files_are_packed_without_a_shuffle(spark, tmp_path, monkeypatch):
    location, plans = f"{tmp_path}/t", []
    many_files(spark, location)
    target = sum(sizes(location)) // 8
    usual = maintenance._rewrite
    listener = spark.sparkContext.statusTracker()
    assert listener is not None

    def watched(*args):
        reduce = maintenance.reduce

        def planned(*parts):
            rows = reduce(*parts)
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return rows

        with monkeypatch.context() as patch:
            patch.setattr(maintenance, "reduce", planned)
            usual(*args)

    monkeypatch.setattr(maintenance, "_rewrite", watched)
    report = maintenance.compact_table(spark, "t", location, ("k",), target)
    assert (report.status, report.record_count, report.files_before) == ("SUCCESS", 300_000, 120), report
    assert plans and not any("Exchange" in plan for plan in plans)
    found = sorted(sizes(location))
    assert all(0.75 * target <= size <= 1.5 * target for size in found[2:]), (target, found)  # the last of each folder is smaller
    live = spark.read.parquet(location)
    assert live.agg(F.sum("id"), F.count_distinct("id")).first()[:] == (299_999 * 150_000, 300_000)
    assert maintenance.compact_table(spark, "t", location, ("k",), target).message == "already compact"


def test_files_that_do_not_fit_together_are_left(spark, tmp_path):
    location = f"{tmp_path}/t"
    spark.range(40_000).selectExpr("id", "rand(2) AS r").repartition(6).write.parquet(location)
    target = int(max(sizes(location)) / 0.6)  # each file is above half the target
    assert maintenance.compact_table(spark, "t", location, target_bytes=target).message == "already compact"


def test_settings_of_packing_are_put_back(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum", "spark.sql.maxConcurrentOutputFileWriters"]
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(RuntimeError), maintenance.packed_to(spark, 5):
        assert spark.conf.get(names[0]) == "5"
        raise RuntimeError
    assert [spark.conf.get(name, None) for name in names] == before


# space-filling layout -------------------------------------------------------------


def taxi(spark, days=64, zones=64, each=4):
    rows = spark.range(days * zones * each).selectExpr(
        f"date_add(DATE '2023-01-01', CAST(id % {days} AS INT)) AS pickup_date",
        f"CAST((id div {days}) % {zones} AS INT) AS PULocationID",
        "id",
    )
    return rows.repartition(7)


def files_admitting(spark, location, column, value):
    """Files whose least and greatest value of a column leave room for a value."""
    files = spark.read.parquet(location).groupBy(F.col("_metadata.file_path")).agg(
        F.min(column).alias("least"), F.max(column).alias("most")
    )
    return files.filter(F.lit(value).between(F.col("least"), F.col("most"))).count()


def test_a_filter_on_either_column_skips_most_files(spark, tmp_path):
    maintenance.write_interleaved(taxi(spark), f"{tmp_path}/both", 64)
    maintenance.write_clustered(taxi(spark), f"{tmp_path}/line", 64)
    for day, zone in itertools.product((3, 40), (7, 50)):
        when = dt.date(2023, 1, 1) + dt.timedelta(days=day)
        assert files_admitting(spark, f"{tmp_path}/both", "PULocationID", zone) <= 20
        assert files_admitting(spark, f"{tmp_path}/both", "pickup_date", when) <= 20
        assert files_admitting(spark, f"{tmp_path}/line", "PULocationID", zone) >= 60
    live = spark.read.parquet(f"{tmp_path}/both")
    assert live.agg(F.sum("id"), F.count_distinct("id")).first()[:] == (16_383 * 8_192, 16_384)


def test_sorted_files_stay_small_enough_for_a_task(spark, tmp_path, monkeypatch):
    taxi(spark).coalesce(1).write.parquet(f"{tmp_path}/t")
    size = sum(sizes(f"{tmp_path}/t"))
    monkeypatch.setattr(maintenance, "SORTED_BYTES", -(-size // 5), raising=False)
    report = maintenance.cluster_table(spark, "t", f"{tmp_path}/t", ("PULocationID",))
    assert (report.status, report.files_after) == ("SUCCESS", 5)


def test_copies_are_fragmented_without_a_shuffle(spark, tmp_path, monkeypatch):
    many_files(spark, f"{tmp_path}/silver", files=48)
    silver = spark.read.parquet(f"{tmp_path}/silver")
    monkeypatch.setattr(queries, "_scratch", lambda layers, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "_silver_bytes", lambda layers: sum(sizes(f"{tmp_path}/silver")))
    monkeypatch.setattr(queries, "_stored_table", lambda layers, key: silver)
    monkeypatch.setattr(type(silver), "repartition", lambda *args: pytest.fail("rows are shuffled"))
    location, target = queries._small_files(queries.Layers(spark, ""), "copy")
    files = sizes(location)
    assert len(files) >= queries.FRAGMENTS * queries.COPY_FILES and max(files) < target / 2
    assert spark.read.parquet(location).exceptAll(silver).isEmpty() and spark.read.parquet(location).count() == 300_000


def test_key_interleaves_range_numbers(spark):
    rows = spark.range(256).selectExpr("CAST(id % 16 AS INT) AS a", "CAST(id div 16 AS DOUBLE) AS b", "id")
    keys = {(r.a, int(r.b)): r.z for r in rows.withColumn("z", interleaved_key(rows, ("a", "b"), 4)).collect()}

    def expected(a, b):
        return sum(((a >> i & 1) << (2 * i + 1)) + ((b >> i & 1) << (2 * i)) for i in range(4))

    # sixteen values, sixteen ranges: the number of a range is the number of cuts that do not exceed it
    cuts = range_cuts(rows, ("a", "b"), 4)
    number = [[sum(c <= v for c in found) for v in range(16)] for found in cuts]
    assert number[0] == number[1] == sorted(number[0])
    assert keys == {(a, b): expected(number[0][a], number[1][b]) for a in range(16) for b in range(16)}


def test_keys_of_nulls_skewed_and_unknown_columns(spark):
    rows = spark.sql("SELECT CAST(NULL AS DATE) AS d, 1 AS n UNION ALL SELECT DATE '2023-01-01', 1 UNION ALL SELECT NULL, NULL")
    assert [r.z for r in rows.withColumn("z", interleaved_key(rows, ("d", "n"))).collect()][0] is not None
    empty = rows.limit(0)
    assert empty.withColumn("z", interleaved_key(empty, ("d", "n"))).count() == 0
    with pytest.raises(TypeError, match="string"):
        interleaved_key(spark.sql("SELECT 'x' AS s"), ("s",))
    with pytest.raises(ValueError):
        interleaved_key(rows, ("n",) * 8)


def test_maintenance_can_cluster_tables(spark, trips, zones, tmp_path):
    start = dt.datetime(2023, 1, 1, 8)
    rows = [
        {"tpep_pickup_datetime": start + dt.timedelta(hours=h), "tpep_dropoff_datetime": start + dt.timedelta(hours=h, minutes=9), "PULocationID": 1 + h % 3}
        for h in range(60)
    ]
    lake = Lake(str(tmp_path))
    cluster = {"bronze.trips": ("tpep_pickup_datetime", "PULocationID"), "silver.trips_cleaned": ("PULocationID",)}
    Pipeline(spark, lake, trips(*rows), zones, cluster=cluster).run()
    reports = {r.table_name: r for r in spark.read.parquet(lake.side_table("maintenance")).collect()}
    for key in cluster:
        assert (reports[key].status, reports[key].message, reports[key].record_count) == ("SUCCESS", "clustered", 60)
        assert lake.read(spark, key).count() == 60
    silver = lake.location("silver.trips_cleaned")
    assert {p.name for p in Path(silver).glob("pickup_date=*")} == {f"pickup_date=2023-01-0{d}" for d in (1, 2, 3)}
    assert file_layout(spark, silver).agg(F.sum("record_count")).first()[0] == 60
    skipped = maintenance.cluster_table(spark, "t", f"{tmp_path}/none", ("id",))
    assert (skipped.status, maintenance.cluster_table(spark, "t", "x", ("id",), fmt="delta").status) == ("SKIPPED", "SKIPPED")
    spark.range(3).selectExpr("CAST(id AS STRING) AS id").write.parquet(f"{tmp_path}/text")
    failed = maintenance.cluster_table(spark, "t", f"{tmp_path}/text", ("id",))
    assert failed.status == "FAILED" and spark.read.parquet(f"{tmp_path}/text").count() == 3


# looking a table up ---------------------------------------------------------------


def test_finding_a_table_does_not_list_it(spark, tmp_path, monkeypatch):
    location, seen = f"{tmp_path}/t", []
    spark.range(1).write.parquet(location)
    part = next(Path(location).glob("*.parquet")).read_bytes()
    for i in range(2_000):
        folder = Path(location, f"k={i}")
        folder.mkdir()
        (folder / "part-0.parquet").write_bytes(part)
    usual = Storage._visible_files

    def counted(self, location):
        for file in usual(self, location):
            seen.append(file)
            yield file

    monkeypatch.setattr(Storage, "_visible_files", counted)
    assert Storage(spark).has_data(location) and len(seen) == 1
    Path(location, "_SUCCESS").unlink(missing_ok=True)
    assert try_read_table(spark, location) is not None and len(seen) == 2
    (tmp_path / "hidden").mkdir()
    (tmp_path / "hidden/_log").write_text("")
    assert try_read_table(spark, f"{tmp_path}/hidden") is None
