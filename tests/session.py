"""The local session that tests and the benchmark run in."""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowlab.settings import with_settings


def local_session(cores: str = "8", **settings: str) -> SparkSession:
    builder = (
        with_settings(SparkSession.builder.master(f"local[{cores}]"))
        .appName("flowlab")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
