"""The folder that driver and executors share, and tables written there to cut a lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started: its root goes on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, in local mode alone, a temporary one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set, and executors do not see a folder of the driver")
        root = "file://" + os.path.join(tempfile.gettempdir(), "lodestone")
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write a table into the shared folder and read it again."""
    path = fresh_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
