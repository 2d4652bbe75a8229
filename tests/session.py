"""The session tests and local checks share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(cpus: str = "8", **extra) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pricewright")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
