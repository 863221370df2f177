"""Compaction and clustering of written tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.model import TableSpec
from farelane.store.tables import analyze, balanced, describe, overwrite_partitions, swap_in, written

#: Size a file should have after compaction or clustering.
FILE_BYTES = 256 << 20


def clustered(df: DataFrame, spec: TableSpec, files: int) -> DataFrame:
    """Rows dealt to ``files`` ranges of the table partitions and clustering columns, sorted in each.

    Files then hold narrow ranges of the first clustering column, so a filter on it skips
    most of them. A frequent value is no problem: a random last sort column lets the range
    split fall inside it.
    """
    by = (*spec.partitions, *spec.cluster_by)
    spread = df.withColumn("_spread", F.rand(seed=7)).repartitionByRange(files, *by, "_spread")
    return spread.drop("_spread").sortWithinPartitions(*by)


def range_count(size_in_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """Ranges for a table of this size, so that each file has about ``file_bytes``."""
    return max(1, -(-size_in_bytes // file_bytes))


def file_census(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """(*partition columns as text, path, length, modificationTime) per file of a table; names are listed, contents not read."""
    folder = next(r.data_type for r in describe(spark, spec.name).collect() if r.col_name == "Location")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    values = [F.url_decode(F.regexp_extract("path", f"/{re.escape(c)}=([^/]*)/", 1)).alias(c) for c in spec.partitions]
    return files.select(*values, "path", "length", "modificationTime")


def scattered(spark: SparkSession, spec: TableSpec, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(*partition columns as text, n_files, n_bytes) of the partitions with more files than their size asks for."""
    sizes = file_census(spark, spec).groupBy(*spec.partitions).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    return sizes.where(F.col("n_files") > F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / file_bytes)))


def compact_table(spark: SparkSession, spec: TableSpec, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the partitions with too many files and leave the files of all others; how many were rewritten.

    The list of partitions is joined to the table, which prunes the scan to them; each becomes files of about
    ``file_bytes``, sorted by the clustering columns. A table without partitions is rewritten if it needs it.
    """
    needy = written(scattered(spark, spec, file_bytes), "scattered")
    count = needy.count()
    if not count:
        return 0
    if not spec.partitions:
        swap_in(balanced(spark.table(spec.name), ()), spec)
        return count
    path = needy.inputFiles()[0].rsplit("/", 1)[0]

    def rows(session: SparkSession) -> DataFrame:
        chosen = session.read.schema(needy.schema).parquet(path)
        table = session.table(spec.name)
        kind = {f.name: f.dataType for f in table.schema}
        default = F.lit("__HIVE_DEFAULT_PARTITION__")
        named = chosen.select(*[F.when(F.col(c) != default, F.col(c)).cast(kind[c]).alias(f"_{c}") for c in spec.partitions])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in spec.partitions]
        return balanced(table.join(named, same, "left_semi"), spec.partitions).sortWithinPartitions(*spec.partitions, *spec.cluster_by)

    overwrite_partitions(spark, spec.name, rows, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)})
    return count


def cluster_table(spark: SparkSession, spec: TableSpec, files: int | None = None) -> None:
    """Rewrite a table in clustered order and refresh its statistics.

    A partitioned table is rewritten in place: dynamic overwrite stages all
    files and swaps the partitions in when the job commits. Any other table is
    rewritten under a second name that then takes the place of the first.
    """
    files = files or range_count(file_census(spark, spec).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])

    def rows(session: SparkSession) -> DataFrame:
        table = session.table(spec.name)
        return clustered(table, spec, files) if spec.cluster_by else balanced(table, spec.partitions)

    if spec.partitions:
        overwrite_partitions(spark, spec.name, rows)
    else:
        swap_in(rows(spark), spec)
    analyze(spark, spec.name)
