"""A session with the settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", name: str = "tessera", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
