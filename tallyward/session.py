"""Session settings the library is tuned for.

On a cluster the session is the caller's; these are the settings we
recommend. Nothing in the library changes the settings of a session it is given.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one person, site or event id may own a large share of the rows
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(cpus: int = 8, app: str = "tallyward") -> SparkSession:
    """A session on this machine, for tests and the bench, with a stage folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir",
                os.environ.get("TALLYWARD_STAGES") or tempfile.mkdtemp(prefix="tallyward-"))
    )
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
