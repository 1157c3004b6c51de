"""A session for local work and tests; on a cluster the submitter's settings hold."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
