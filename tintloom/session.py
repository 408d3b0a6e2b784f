"""SparkSession with the settings that the engine's results depend on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "tintloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution and Arrow on; `master` is left to spark-submit if None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    defaults = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false",
    }
    return build_session(master=f"local[{cpus}]", **{**defaults, **conf})
