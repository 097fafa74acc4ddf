"""Session factory for local runs; on a cluster the session comes from the platform."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """UTC, adaptive execution, Arrow, and as many shuffle partitions as the machine can use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("brinewake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BRINEWAKE_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
