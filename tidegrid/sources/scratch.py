"""The one place that knows where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder, if one machine runs all, and else an error."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {SETTING} to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidegrid-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, so that its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of plans whose tables are written.

    Spark drops the exchanges of a plan when its driver's garbage is collected, which a driver with room to spare may put
    off for long; the shuffle files stay on every executor until then, and the driver keeps the plans.  Jobs of many steps
    call this between them.  The scheduler holds on to the job that ran last, so a small one is run first.
    """
    gc.collect()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()
