"""The local session that tests and the comparison share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None, **options: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('TEST_CPUS', '8')}]")
        .appName("courier")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
