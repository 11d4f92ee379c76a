"""Session settings, shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tickloom", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Shuffle partition counts are left to adaptive execution; the time zone is
    pinned because ticks are naive UTC.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    A session without ``spark.checkpoint.dir`` gets a temporary folder if driver
    and executors are one process; on a cluster that is an error, because other
    machines would not see the files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/tickloom/{name}-{uuid.uuid4().hex}"


def input_bytes(df: DataFrame) -> int:
    """Size of what a frame reads, from the optimizer's statistics (no job is run).

    Sources of unknown size count as huge.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame that several branches of a plan read, such as a grouped trend.

    It is written to the shared scratch space once, so that its input is not read
    again by every branch, nor after the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
