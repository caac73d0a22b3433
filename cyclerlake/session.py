"""Session settings the plans rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join may use a layout by a subset of its keys: join and step window share one shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # sort-merge joins become hash joins where measured partitions are small enough to be held
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # a union of equally laid out inputs keeps that layout
    "spark.sql.unionOutputPartitioning": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings. Results do not depend on them, the number of shuffles does."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not shared:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="cyclerlake-")
    return f"{shared.rstrip('/')}/cyclerlake/{purpose}-{uuid.uuid4().hex}"


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Several steps of a plan can then use it without computing it again, its size is known to
    the optimizer, and lost executors cost nothing. Runs a job.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
