"""One local Spark session for tests and checks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").appName("chromaloom")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
