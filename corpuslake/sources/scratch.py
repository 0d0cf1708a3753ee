"""Reliable scratch space: the checkpoint folder the cluster names."""

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``; only a local session that names none gets one of its own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="corpuslake-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, written once to reliable storage, with its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``checkpointed`` for wide frames: compressed columns, of which a reader takes what it needs."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *calls) -> list:
    """Runs calls that do not wait for one another at the same time, so that small jobs share the cores."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]
