"""Session settings the library is tuned and tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks the number of reduce tasks, turns a shuffle join
# into a broadcast join once a side is known to be small, and splits skewed
# join partitions. Nothing in the library depends on local mode.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(name: str = "tillsight", cores: int | str = "*",
                  partitions: int = 8, memory: str = "8g",
                  **settings: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
