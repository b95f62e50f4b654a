"""The Spark session of tests, the bench and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "deedweb", master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session in UTC with adaptive execution; on a cluster, pass your own session to the operators instead."""
    return (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
