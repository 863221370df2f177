"""Loads of several months at once, what they keep beside the trips, and the care of written tables."""

from __future__ import annotations

import os
import random
from datetime import datetime
from pathlib import Path

import pytest
from conftest import trip
from pyspark.sql import functions as F
from test_loads import month_rows, write_month

from farelane.model import BOUNDS, BRONZE, EVENT_LOG, GOLD, RUN_LOG, SILVER, TRIP_SCHEMA, UNREADABLE, TableSpec, Thresholds
from farelane.operators import outliers
from farelane.plans import monitoring
from farelane.plans import silver as layer
from farelane.sources import trips as source
from farelane.store import layout, loads, tables

LIMITS = Thresholds(min_records_per_file=10)


def config(namespace: str, **changes) -> loads.LoadConfig:
    return loads.LoadConfig(thresholds=LIMITS, namespace=namespace, **changes)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sets"))
    for month in range(1, 7):
        rng = random.Random(month)
        rows = [trip(tpep_pickup_datetime=datetime(2023, month, 1 + i % 27, 6), minutes=5 + i % 40, tip_amount=rng.choice([1.0, 2.0, 2.5, 40.0 * month])) for i in range(30)]
        write_month(spark, folder, 2023, month, rows)
    return folder


def table(spark, cfg, spec):
    return spark.table(cfg.table(spec).name)


def rows_of(df) -> list[str]:
    stamps = [c for c in df.columns if "processing" in c or c == "ingestion_timestamp"]
    return sorted(map(str, df.drop(*stamps).collect()))


def test_a_backfill_renews_gold_once(spark, root, monkeypatch):
    written = []
    replace = tables.replace_slice

    def counted(df, spec, part, even_files=True):
        written.append(spec.name)
        replace(df, spec, part, even_files)

    monkeypatch.setattr(tables, "replace_slice", counted)
    together, alone = config("together_"), config("alone_")
    assert {r.status for r in loads.backfill(spark, root, (2023, 1), (2023, 4), together).collect()} == {"SUCCESS"}
    assert [written.count(together.table(s).name) for s in (BRONZE, SILVER, BOUNDS, GOLD["daily"], GOLD["hourly"])] == [1] * 5
    for month in range(1, 5):
        loads.run_month(spark, root, 2023, month, alone)
    for spec in (BRONZE, SILVER, BOUNDS, GOLD["daily"], GOLD["hourly"]):
        assert rows_of(table(spark, together, spec)) == rows_of(table(spark, alone, spec))
    counts = ("records_bronze", "records_silver", "records_gold", "quality_score", "status")
    logs = [sorted(tuple(r[c] for c in counts) for r in table(spark, cfg, RUN_LOG).collect()) for cfg in (together, alone)]
    assert logs[0] == logs[1] and len(logs[0]) == 4


def test_an_absent_or_broken_month_fails_alone(spark, root, tmp_path):
    folder = str(tmp_path)
    for month in (1, 2, 4, 5):
        os.symlink(source.month_path(root, 2023, month), source.month_path(folder, 2023, month))
    good = Path(source.month_path(root, 2023, 3)).read_bytes()
    Path(source.month_path(folder, 2023, 2)).unlink()
    Path(source.month_path(folder, 2023, 2)).write_bytes(b"PAR1 no parquet at all PAR1")
    # A sound footer over broken pages: only a full read finds out.
    Path(source.month_path(folder, 2023, 5)).unlink()
    Path(source.month_path(folder, 2023, 5)).write_bytes(good[:4] + bytes(len(good) // 2) + good[4 + len(good) // 2 :])
    cfg = config("broken_")
    got = {r.month: (r.status, r.stage) for r in loads.backfill(spark, folder, (2023, 1), (2023, 5), cfg).collect()}
    assert got[1] == got[4] == ("SUCCESS", "COMPLETED") and got[3] == ("FAILED", "DATA_CHECK")
    assert got[2][0] == got[5][0] == "FAILED"
    assert {r[0] for r in table(spark, cfg, SILVER).select("ingestion_month").distinct().collect()} == {"2023-01", "2023-04"}
    assert table(spark, cfg, GOLD["daily"]).agg(F.sum("total_trips")).first()[0] == table(spark, cfg, SILVER).count()


def test_quartiles_of_many_months_take_no_more_jobs(spark, root):
    jobs = {}
    for label, last in (("one_", 1), ("six_", 6)):
        cfg = config(label)
        loads.backfill(spark, root, (2023, 1), (2023, last), cfg)
        spark.sparkContext.setJobGroup(label, label)
        loads.build_silver(spark, cfg)
        jobs[label] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(label))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs["six_"] <= jobs["one_"] + 2  # one broadcast more or less; by month it would be six times as many
    cfg = config("six_")
    bounds = {(r.ingestion_month, r.column_name): (r.q1, r.q3, r.lower_bound, r.upper_bound) for r in table(spark, cfg, BOUNDS).collect()}
    assert len(bounds) == 30
    valid = layer.valid_trips(table(spark, cfg, BRONZE))
    for r in valid.groupBy("ingestion_month").agg(F.percentile("tip_amount", [0.25, 0.75]).alias("q")).collect():
        low, high = r.q
        reach = 1.5 * (high - low)
        assert bounds[r.ingestion_month, "tip_amount"] == pytest.approx((low, high, low - reach, high + reach))
    flags = outliers.flag_outliers(table(spark, cfg, SILVER), by=layer.SCOPE)
    assert rows_of(flags.select(sorted(flags.columns))) == rows_of(table(spark, cfg, SILVER).select(sorted(flags.columns)))


def test_quantiles_per_group_match_spark(spark):
    rng = random.Random(8)
    values = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1e-300, -1e300, 7.25]
    rows = [(rng.choice(["a", "a", "a", "b", None, "empty"]), rng.choice([rng.uniform(-50, 50), rng.randrange(9) * 1.0, rng.choice(values)])) for _ in range(600)]
    rows = [(g, None if g == "empty" else v) for g, v in rows]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("y", F.lit(3.0))
    for buckets in (2, 4096):
        found = outliers.group_quantiles(df, ["x", "y"], ["g"], (0.0, 0.25, 0.5, 0.9, 1.0), buckets).collect()
        got = {(r.g, r.column_name): (r.n_values, list(r.quantiles)) for r in found}
        assert ("empty", "x") not in got and got["empty", "y"][1] == [3.0] * 5
        for group in ("a", "b", None):
            own = sorted(v for g, v in rows if g == group and v is not None and v == v)
            n, quantiles = got[group, "x"]
            assert n == len(own)
            for p, q in zip((0.0, 0.25, 0.5, 0.9, 1.0), quantiles):
                low, high = own[int(p * (n - 1))], own[-int(-p * (n - 1) // 1)]
                weight = p * (n - 1) - int(p * (n - 1))
                assert q == low or q == pytest.approx(low + (high - low) * weight)


def test_a_hot_group_of_distinct_values(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("other").alias("g"), (F.col("id") * 0.37).alias("x"))
    got = {r.g: list(r.quantiles) for r in outliers.group_quantiles(df, ["x"], ["g"], buckets=64).collect()}
    expected = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", [0.25, 0.75]).alias("q")).collect()}
    assert {g: pytest.approx(q) for g, q in expected.items()} == got


def test_unreadable_texts_are_kept_and_counted(spark, tmp_path):
    folder, cfg = str(tmp_path), config("texts_")
    write_month(spark, folder, 2023, 1, month_rows(2023, 1, 20))
    bad = F.when(F.col("PULocationID") == 2, "none").otherwise(F.col("fare_amount").cast("string"))
    write_month(spark, folder, 2023, 2, month_rows(2023, 2, 20), fare_amount=bad)
    loads.backfill(spark, folder, (2023, 1), (2023, 2), cfg)
    kept = table(spark, cfg, UNREADABLE).collect()
    assert {(r.ingestion_month, r.source_file, r.column_name, r.raw_value, r.reason) for r in kept} == {
        ("2023-02", "yellow_tripdata_2023-02.parquet", "fare_amount", "none", "no double")
    }
    assert len(kept) == 4 == table(spark, cfg, BRONZE).where("fare_amount IS NULL").count()
    found = monitoring.event_report(table(spark, cfg, EVENT_LOG)).where("message = 'unreadable values'")
    assert {(r.detail, r.value, r.n_events, r.total) for r in found.collect()} == {("column", "fare_amount", 1, None), ("count", None, 1, 4.0)}
    # A repaired file takes its rejects along.
    write_month(spark, folder, 2023, 2, month_rows(2023, 2, 20))
    loads.run_month(spark, folder, 2023, 2, cfg)
    assert table(spark, cfg, UNREADABLE).isEmpty() and table(spark, cfg, BRONZE).where("fare_amount IS NULL").isEmpty()


def test_a_wider_column_widens_the_table(spark):
    spec = TableSpec("scratch.widened", ("part",))

    def add(part, **columns):
        df = spark.range(2).withColumn("part", F.lit(part).cast("string")).withColumns(columns)
        tables.replace_slice(df, spec, F.col("part").eqNullSafe(part))

    add("a", n=F.lit(1), x=F.lit(1.5).cast("float"), d=F.lit("2023-01-02").cast("date"), t=F.lit(7))
    add(None, n=F.lit(2), x=F.lit(2.5).cast("float"), d=F.lit("2023-01-03").cast("date"), t=F.lit(8))
    add("b", n=F.lit(3_000_000_000), x=F.lit(0.1), d=F.lit("2023-01-04 05:00:00").cast("timestamp"), t=F.lit("text"))
    add("c", n=F.lit(4).cast("smallint"), x=F.lit(5), d=F.lit("2023-01-05").cast("date"), t=F.lit(9))
    found = spark.table(spec.name)
    assert {f.name: f.dataType.simpleString() for f in found.schema if f.name in "nxdt"} == {"n": "bigint", "x": "double", "d": "timestamp", "t": "string"}
    got = {r.part: (r.n, r.x, str(r.d), r.t) for r in found.collect()}
    assert got == {
        "a": (1, 1.5, "2023-01-02 00:00:00", "7"),
        None: (2, 2.5, "2023-01-03 00:00:00", "8"),
        "b": (3_000_000_000, 0.1, "2023-01-04 05:00:00", "text"),
        "c": (4, 5.0, "2023-01-05 00:00:00", "9"),
    }
    assert found.count() == 8
    with pytest.raises(ValueError, match="no common type"):
        add("d", n=F.lit(True))
    assert spark.table(spec.name).count() == 8


@pytest.mark.parametrize("old, new, both", [("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"), ("int", "float", "double"), ("string", "int", "string")])
def test_common_types(old, new, both):
    assert tables.wider_type(old, new) == both


def test_compaction_leaves_good_partitions_alone(spark):
    spec = TableSpec("scratch.parts", ("day", "kind"), ("id",))
    rows = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("d "), F.col("id") % 4)).alias("day"), (F.col("id") % 2).alias("kind"))
    good = F.col("day").isin("d 1", "d 2")
    tables.replace_slice(rows.where(good), spec, F.lit(True))
    tables.append_rows(rows.where(~good | F.col("day").isNull()).repartition(3), spec)
    before = {r.path: r for r in layout.file_census(spark, spec).collect()}
    assert layout.compact_table(spark, spec) == 2
    after = {r.path: r for r in layout.file_census(spark, spec).collect()}
    stay = {p for p, r in before.items() if r.day in ("d 1", "d 2")}
    assert len(stay) == 2 and all(after[p].modificationTime == before[p].modificationTime for p in stay)
    assert len(after) == 4 and not (before.keys() - stay) & after.keys()
    spark.catalog.refreshTable(spec.name)
    assert sorted(tuple(r) for r in spark.table(spec.name).select("id", "day", "kind").collect()) == sorted(tuple(r) for r in rows.collect())
    assert layout.compact_table(spark, spec) == 0 and {r.path for r in layout.file_census(spark, spec).collect()} == after.keys()


def test_large_partitions_may_have_several_files(spark):
    spec = TableSpec("scratch.sized", ("part",))
    tables.append_rows(spark.range(20000).withColumn("part", F.col("id") % 2).repartition(4), spec)
    size = layout.file_census(spark, spec).groupBy("part").agg(F.sum("length").alias("n")).first().n
    assert layout.scattered(spark, spec, size // 4).isEmpty()
    assert layout.scattered(spark, spec, size * 2).count() == 2


def test_statistics_are_checked_against_the_table(spark):
    spec = TableSpec("scratch.known", ("part",))
    tables.save_table(spark.range(5).select("id", F.when(F.col("id") > 1, "x").alias("t"), F.lit(1).alias("part")), spec)
    assert all(r.is_stale for r in tables.check_statistics(spark, spec.name).collect() if r.column_name == "id")
    tables.analyze(spark, spec.name)
    got = {r.column_name: tuple(r)[1:] for r in tables.check_statistics(spark, spec.name).collect()}
    assert got["id"] == (0, 0, True, False) and got["t"] == (2, 2, True, False)


def test_months_of_two_schemas_are_two_scans(spark, root, tmp_path):
    folder = str(tmp_path)
    for month in (1, 2):
        os.symlink(source.month_path(root, 2023, month), source.month_path(folder, 2023, month))
    write_month(spark, folder, 2023, 3, month_rows(2023, 3, 5), meter=F.lit(1))
    raw = source.raw_months(spark, folder, [(2023, m) for m in (1, 2, 3)])
    assert len(raw) == 2
    got = source.read_months(spark, folder, [(2023, m) for m in (1, 2, 3)]).groupBy("ingestion_month", "source_file").count().collect()
    assert {tuple(r) for r in got} == {(f"2023-{m:02d}", source.file_name(2023, m), n) for m, n in ((1, 30), (2, 30), (3, 5))}
    assert set(TRIP_SCHEMA.names) <= set(source.conformed(raw[0]).columns)
