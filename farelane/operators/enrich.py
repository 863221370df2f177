"""Descriptions of coded columns by left joins to the code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.model import PAYMENT_TYPES, RATE_CODES, VENDOR_NAMES


def code_list(spark: SparkSession, codes: dict[int, str], key: str, label: str, key_type: T.DataType) -> DataFrame:
    """A code list as a frame Spark knows the size of.

    An inline table is a local relation, so the planner sees its few hundred
    bytes and broadcasts it by its own size check; no hint is needed.
    """
    values = ", ".join(f"({int(code)}, :label_{i})" for i, code in enumerate(codes))
    labels = {f"label_{i}": label for i, label in enumerate(codes.values())}
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(code, label)", args=labels)
    return rows.select(F.col("code").cast(key_type).alias(key), F.col("label").alias(label))


def add_vendor_name(df: DataFrame, names: dict[int, str] = VENDOR_NAMES) -> DataFrame:
    return _describe(df, names, "VendorID", "vendor_name")


def add_rate_code(df: DataFrame, names: dict[int, str] = RATE_CODES) -> DataFrame:
    return _describe(df, names, "RatecodeID", "rate_code_desc")


def add_payment_type(df: DataFrame, names: dict[int, str] = PAYMENT_TYPES) -> DataFrame:
    return _describe(df, names, "payment_type", "payment_type_desc")


def add_business_mappings(df: DataFrame) -> DataFrame:
    """All three descriptions; a code without description keeps its row and gets null."""
    return add_payment_type(add_rate_code(add_vendor_name(df)))


def _describe(df: DataFrame, names: dict[int, str], key: str, label: str) -> DataFrame:
    codes = code_list(df.sparkSession, names, key, label, df.schema[key].dataType)
    return df.join(codes, key, "left").select(*df.columns, label)
