"""Spark session with the settings that the library's plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "florilege", master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew-join splitting, Arrow transfer; cluster settings stay as they are given.

    ``settings`` are more of Spark's, with ``__`` for a dot.
    """
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in settings.items()},
    }.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
