"""Cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``. Only a local session without one gets its own."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="crawlspark-checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for tables of one run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as Parquet below the shared folder, and go on from the written rows.

    Against ``DataFrame.checkpoint`` this keeps column pruning for later readers, and gives the planner the true size,
    by which it decides whether a join may broadcast.
    """
    folder = scratch_folder(df.sparkSession, "rows")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
