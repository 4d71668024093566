"""The Spark session of tests and benchmarks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def spark_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpusloom-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
