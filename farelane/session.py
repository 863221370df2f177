"""Spark session and shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "trip-analytics", config: dict[str, str] | None = None) -> SparkSession:
    """A session that reads times without zone as UTC, unless ``config`` says otherwise."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str | None:
    """The folder all executors share, as the session or the application names it."""
    key = "spark.checkpoint.dir"
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def working_folder(spark: SparkSession, purpose: str) -> str:
    """The path of a new folder under the shared one."""
    root = shared_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
