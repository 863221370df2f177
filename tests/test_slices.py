"""Slices are written once, without shuffles their rows do not need."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from farelane.model import TableSpec
from farelane.session import shared_root
from farelane.sources import trips as source
from farelane.store import tables

PARTS = TableSpec("scratch.written_once", ("part",))
WIDER = TableSpec("scratch.widened_in_place", ("part",))


def parted(spark, ids, part):
    return spark.createDataFrame([(i, part(i)) for i in ids], "id int, part int")


def rows(spark, spec):
    return sorted((r.id, r.part) for r in spark.table(spec.name).collect())


def test_a_slice_is_written_once(spark):
    tables.replace_slice(parted(spark, range(8), lambda i: i % 4), PARTS, F.lit(True))
    tables.replace_slice(parted(spark, [], lambda i: i), PARTS, F.col("part") == 3)
    before = set(os.listdir(shared_root(spark)))
    new = parted(spark, [10, 11, 12], lambda i: 0 if i < 12 else None)
    tables.replace_slice(new, PARTS, F.col("part").isNull() | F.col("part").isin(0, 1))
    assert set(os.listdir(shared_root(spark))) == before
    assert sorted(rows(spark, PARTS), key=str) == sorted([(10, 0), (11, 0), (12, None), (2, 2), (6, 2)], key=str)
    # A slice made from the table itself.
    tables.replace_slice(spark.table(PARTS.name).where("id = 6"), PARTS, F.col("part") == 2)
    assert [r.id for r in spark.table(PARTS.name).where("part = 2").collect()] == [6]


def test_more_partitions_than_open_files(spark, monkeypatch):
    monkeypatch.setattr(tables, "OPEN_FILES", 2)
    spec = TableSpec("scratch.many_parts", ("part",))
    df = parted(spark, range(60), lambda i: i * 7 % 11).repartition(2)
    for _ in range(2):
        tables.replace_slice(df, spec, F.lit(True), even_files=False)
        assert rows(spark, spec) == sorted((i, i * 7 % 11) for i in range(60))


def test_widening_a_column_shuffles_nothing(spark, monkeypatch):
    tables.replace_slice(parted(spark, range(6), lambda i: i % 2), WIDER, F.lit(True))
    monkeypatch.setattr(tables, "balanced", lambda *_: (_ for _ in ()).throw(AssertionError("shuffled")))
    wide = spark.createDataFrame([(1 << 40, 0)], "id bigint, part int")
    tables.replace_slice(wide, WIDER, F.col("part") == 0, even_files=False)
    assert rows(spark, WIDER) == [(1, 1), (3, 1), (5, 1), (1 << 40, 0)]


def test_settings_of_the_session_hold_for_its_writes(spark):
    assert tables._write_session(spark).conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_order_trips_are_shuffled_by_month_while_narrow(spark, tmp_path):
    items = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    lines = [(k, 3 * n, 5, n, 2.0, 50.0, 0.1, 0.02, "R", "O") for k in (1, 1, 2, 3, None) for n in (1, 2)]
    spark.createDataFrame(lines, items).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, datetime(1995, 3, 31)), (2, datetime(1995, 4, 1)), (2, datetime(1996, 4, 1)), (3, None), (None, datetime(1995, 1, 1))]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    plain, by_month = (source.order_trips(spark, str(tmp_path), flag) for flag in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_month.collect())) and plain.count() == 10
    above, below = by_month._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert "mta_tax" in above and "mta_tax" not in below and "store_and_fwd_flag" not in below
