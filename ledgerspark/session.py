"""Session settings the package relies on."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_SHUFFLE_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, minimum: int = 200) -> int:
    """Shuffle partitions that keep one partition near 256 MB for this input.

    AQE merges the ones that turn out small, so erring high is cheap.
    """
    return max(minimum, math.ceil(input_bytes / TARGET_SHUFFLE_BYTES))


def build_session(app_name: str = "ledgerspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # the call-site capture costs more driver time than building the expressions
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
