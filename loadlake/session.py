"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings that results depend on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def session(app: str = "loadlake", cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own and call ``configure``."""
    n = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the tables of one run, below ``spark.checkpoint.dir``; on one machine a temporary one if that is
    unset. On a cluster it has to be set, as driver and executors share what is written there."""
    home = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not home:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        home = tempfile.mkdtemp(prefix="work-")
    return f"{home.rstrip('/')}/{name}-{uuid4().hex}"
