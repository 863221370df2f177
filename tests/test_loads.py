"""Month loads over real files: idempotence, stray trips, failures, layout, streaming."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import trip
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.model import BRONZE, GOLD, RUN_LOG, SILVER, TRIP_SCHEMA, Thresholds
from farelane.plans import gold
from farelane.sources import trips as source
from farelane.store import layout, loads, runlog, tables, views
from farelane.streaming import months as streaming

WALL_CLOCK_SCHEMA = T.StructType(
    [T.StructField(f.name, T.TimestampNTZType()) if f.name.endswith("datetime") else f for f in TRIP_SCHEMA]
)
CONFIG = loads.LoadConfig(thresholds=Thresholds(min_records_per_file=10))


def month_rows(year: int, month: int, n: int, vendor: int = 1) -> list[tuple]:
    start = datetime(year, month, 1, 6)
    return [
        trip(
            VendorID=vendor,
            tpep_pickup_datetime=start + timedelta(hours=5 * i),
            minutes=10 + i % 20,
            PULocationID=1 + i % 5,
            total_amount=10.0 + i,
        )
        for i in range(n)
    ]


def write_month(spark, root, year, month, rows, **columns) -> None:
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    for name, column in columns.items():
        df = df.withColumn(name, column)
    # A month is one file; it stores wall-clock times without zone.
    times = {c: F.col(c).cast("timestamp_ntz") for c in df.columns if c.endswith("datetime")}
    os.makedirs(root, exist_ok=True)
    pq.write_table(df.withColumns(times).toArrow(), source.month_path(root, year, month))


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("months"))
    write_month(spark, folder, 2023, 1, month_rows(2023, 1, 60))
    # The February file also holds two trips picked up in January, and a new column.
    stray = month_rows(2023, 1, 2, vendor=2)
    write_month(spark, folder, 2023, 2, month_rows(2023, 2, 40) + stray, cbd_congestion_fee=F.lit(0.75))
    return folder


@pytest.fixture(scope="module")
def loaded(spark, root):
    return loads.backfill(spark, root, (2023, 1), (2023, 3), CONFIG).collect()


def snapshot(spark, name: str) -> list:
    df = spark.table(name)
    stamps = [c for c in df.columns if "processing" in c or c == "ingestion_timestamp"]
    return sorted(str(r) for r in df.drop(*stamps).collect())


def test_backfill_goes_on_after_a_missing_month(spark, loaded):
    assert [(r.month, r.status, r.stage) for r in loaded] == [
        (1, "SUCCESS", "COMPLETED"),
        (2, "SUCCESS", "COMPLETED"),
        (3, "FAILED", "DATA_CHECK"),
    ]
    runs = {r.stage: r for r in spark.table(RUN_LOG.name).collect()}
    assert runs["DATA_CHECK"].error_message.startswith("no trips for 2023-03")
    assert runs["COMPLETED"].quality_score == 1.0


def test_layers_hold_all_rows(spark, loaded):
    bronze = spark.table(BRONZE.name)
    assert bronze.count() == 102
    counts = {r.ingestion_month: (r.n, r.fee) for r in bronze.groupBy("ingestion_month").agg(
        F.count("*").alias("n"), F.count("cbd_congestion_fee").alias("fee")).collect()}
    assert counts == {"2023-01": (60, 0), "2023-02": (42, 42)}
    assert spark.table(SILVER.name).count() == 102
    assert spark.table(GOLD["daily"].name).agg(F.sum("total_trips")).first()[0] == 102


def test_month_loads_equal_the_batch_build(spark, loaded):
    """Stray trips of a later file reach the gold rows of their own month."""
    silver = spark.table(SILVER.name)
    batch = sorted(str(r) for r in gold.daily(silver).collect())
    stored = spark.table(GOLD["daily"].name)
    assert sorted(str(r) for r in stored.select(*gold.daily(silver).columns).collect()) == batch
    hourly = gold.hourly(silver)
    assert sorted(map(str, hourly.collect())) == sorted(
        map(str, spark.table(GOLD["hourly"].name).select(*hourly.columns).collect())
    )


def test_loading_a_month_again_changes_nothing(spark, root, loaded):
    names = [BRONZE.name, SILVER.name, GOLD["daily"].name, GOLD["hourly"].name]
    before = {name: snapshot(spark, name) for name in names}
    for month in (1, 2):
        assert loads.run_month(spark, root, 2023, month, CONFIG)["status"] == "SUCCESS"
    assert {name: snapshot(spark, name) for name in names} == before


def test_reload_with_fewer_rows_leaves_nothing_behind(spark, root, loaded):
    """The new February file has no January trips any more; their rows must go."""
    write_month(spark, root, 2023, 2, month_rows(2023, 2, 30))
    assert loads.run_month(spark, root, 2023, 2, CONFIG)["status"] == "SUCCESS"
    assert spark.table(SILVER.name).count() == 90
    daily = spark.table(GOLD["daily"].name)
    assert daily.agg(F.sum("total_trips")).first()[0] == 90
    assert daily.where("pickup_month = 1").agg(F.max("active_vendors")).first()[0] == 1


def test_month_without_valid_trips_empties_its_slice(spark, root, loaded):
    write_month(spark, root, 2023, 2, month_rows(2023, 2, 12, vendor=3))
    outcome = loads.run_month(spark, root, 2023, 2, CONFIG)
    assert (outcome["status"], outcome["records_silver"], outcome["quality_score"]) == ("SUCCESS", 0, 0)
    assert spark.table(SILVER.name).where("ingestion_month = '2023-02'").isEmpty()
    assert spark.table(GOLD["daily"].name).where("pickup_month = 2").isEmpty()
    assert spark.table("control.pipeline_event_log").where("level = 'WARNING'").count() >= 1


def test_failed_stage_is_logged(spark, root, loaded, monkeypatch):
    def broken(*_):
        raise RuntimeError("disk on fire")

    monkeypatch.setattr(loads, "silver", broken)
    outcome = loads.run_month(spark, root, 2023, 1, CONFIG)
    assert (outcome["status"], outcome["stage"], outcome["error_message"]) == ("FAILED", "SILVER", "disk on fire")
    assert spark.table(SILVER.name).where("ingestion_month = '2023-01'").count() == 60


def test_batch_gold_views_and_layout(spark, root, loaded):
    for month in (1, 2):
        assert loads.run_month(spark, root, 2023, month, CONFIG)["status"] == "SUCCESS"
    by_month = snapshot(spark, SILVER.name)
    loads.build_silver(spark, CONFIG)
    assert snapshot(spark, SILVER.name) == by_month
    loads.build_gold(spark)
    for spec in GOLD.values():
        assert not spark.table(spec.name).isEmpty()
    assert spark.table("gold.kpi_dashboard").columns[:2] == ["trip_date", "pickup_dayname"]
    assert spark.table("gold.hourly_trends").count() > 0
    assert spark.table("gold.vendor_dashboard").count() > 0
    assert len(views.create_views(spark)) == 5 and len(spark.table("gold.kpi_dashboard").columns) == 11
    assert spark.table("control.pipeline_monitoring").count() == spark.table(RUN_LOG.name).count()
    assert spark.table("control.quality_metrics").count() >= 1
    for spec in (SILVER, GOLD["route"], GOLD["payment"]):
        before = snapshot(spark, spec.name)
        layout.cluster_table(spark, spec, files=3)
        assert snapshot(spark, spec.name) == before
    facts = {r.col_name: r.data_type for r in tables.describe(spark, GOLD["route"].name).collect()}
    assert "rows" in facts["Statistics"]


def test_month_slice_prunes_partitions(spark, loaded):
    rows = source.silver_month_slice(spark.table(SILVER.name), 2023, 1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "pickup_year" in filters and "pickup_month" in filters


def test_clustered_files_hold_narrow_ranges(spark):
    days = spark.range(365 * 20).select(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 365).cast("int")).cast("string").alias("trip_date"))
    files = layout.clustered(days, tables.TableSpec("x", (), ("trip_date",)), files=8).groupBy(F.spark_partition_id().alias("p"))
    ends = sorted(tuple(r)[1:] for r in files.agg(F.min("trip_date"), F.max("trip_date")).collect())
    assert len(ends) == 8 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert [layout.range_count(n, 100) for n in (0, 100, 101, 10_000)] == [1, 1, 2, 100]


def test_clustering_splits_a_hot_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("location_id"))
    spread = layout.clustered(df, GOLD["location"].__class__("x", (), ("location_id",)), files=6)
    sizes = [r.n for r in spread.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3000


def test_paths_and_months():
    assert source.month_path("/data/", 2023, 4) == "/data/yellow_tripdata_2023-04.parquet"
    assert source.months_between((2022, 11), (2023, 2)) == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]


def test_multi_month_read_fills_missing_columns(spark, root):
    rows = source.read_months(spark, root, [(2023, 1), (2023, 2)])
    assert rows.select("ingestion_month").distinct().count() == 2
    assert "source_file" in rows.columns


def test_save_table_with_stamps(spark, loaded):
    spec = tables.TableSpec("scratch.demo", ("id",))
    tables.save_table(spark.range(3).withColumn("x", F.lit(1)), spec, processing_id="p1")
    assert set(spark.table(spec.name).columns) == {"id", "x", "processing_timestamp", "processing_id"}


def test_run_log_has_its_columns(spark, loaded):
    assert len(runlog.read_run_log(spark).columns) == 15


def test_streamed_days_equal_the_batch_in_any_order(spark, tmp_path):
    root, out, days, state = (str(tmp_path / name) for name in ("in", "out", "days", "state"))
    stray = month_rows(2023, 1, 2, vendor=2)
    for month, rows in ((2, month_rows(2023, 2, 15) + stray), (1, month_rows(2023, 1, 20)), (3, month_rows(2023, 3, 5))):
        write_month(spark, root, 2023, month, rows)
        stream = streaming.month_files(spark, root, WALL_CLOCK_SCHEMA)
        streaming.load_new_files(stream, out, state, daily_path=days).awaitTermination()
    batch = gold.daily_basic(spark.read.parquet(out))
    stored = spark.read.parquet(days).select(*batch.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect())) and batch.agg(F.sum("total_trips")).first()[0] == 42


def test_replacing_a_slice_computes_it_once(spark):
    spec = tables.TableSpec("scratch.once", ("part",))
    seen = spark.sparkContext.accumulator(0)

    def rows(n):
        counted = spark.sparkContext.range(n).map(lambda i: (seen.add(1), (i, i % 2))[1])
        return spark.createDataFrame(counted, "id long, part long")

    for n in (10, 6):
        before = seen.value
        tables.replace_slice(rows(n), spec, F.lit(True))
        assert seen.value - before == n and spark.table(spec.name).count() == n
    tables.replace_slice(rows(1), spec, F.lit(True))
    assert [tuple(r) for r in spark.table(spec.name).select("id", "part").collect()] == [(0, 0)]


def test_a_stop_before_the_emptying_is_repaired_by_the_next_load(spark, monkeypatch):
    spec = tables.TableSpec("scratch.stopped", ("part",))
    tables.replace_slice(spark.range(4).withColumn("part", F.col("id")), spec, F.lit(True))
    fewer = spark.range(2).withColumn("part", F.col("id"))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_empty_partition", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            tables.replace_slice(fewer, spec, F.lit(True))
    assert spark.table(spec.name).count() == 4
    tables.replace_slice(fewer, spec, F.lit(True))
    assert spark.table(spec.name).count() == 2


def test_a_failed_overwrite_keeps_the_table(spark):
    spec = tables.TableSpec("scratch.kept")
    tables.save_table(spark.range(3), spec)
    with pytest.raises(Exception):
        tables.save_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), spec)
    assert spark.table(spec.name).count() == 3
    tables.save_table(spark.table(spec.name).where("id > 0").select("id"), spec)
    assert spark.table(spec.name).count() == 2


def test_two_spellings_and_unreadable_texts(spark):
    rows = spark.createDataFrame([("2023-01-01 10:00:00", None, 7.0), ("not a time", 5.0, 8.0)], "tpep_pickup_datetime string, Airport_fee double, airport_fee double")
    got = source.conform(rows).select("tpep_pickup_datetime", "airport_fee").collect()
    assert [(r[0] is None, r[1]) for r in got] == [(False, 7.0), (True, 5.0)]
    assert source.unreadable(rows).first().tpep_pickup_datetime == 1


def test_stream_takes_every_file_once(spark, tmp_path):
    root, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for month, n in ((1, 20), (2, 15)):
        write_month(spark, root, 2023, month, month_rows(2023, month, n))
        stream = streaming.month_files(spark, root, WALL_CLOCK_SCHEMA)
        streaming.load_new_files(stream, out, state).awaitTermination()
    loaded = spark.read.parquet(out)
    counts = {r.ingestion_month: r.n for r in loaded.groupBy("ingestion_month").agg(F.count("*").alias("n")).collect()}
    assert len(loaded.columns) == 19 + 3 + 10 + 1
    assert counts == {"2023-01": 20, "2023-02": 15}
