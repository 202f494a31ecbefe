"""Folders for intermediate tables, streaming checkpoints and round trips."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    Only a ``local`` session may do without one: driver and executors are then
    one process and a temporary folder is as good. Anywhere else a missing
    setting is an error, never a silent machine-local folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larder-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/larder-{label}-{uuid.uuid4().hex}"


def checkpoint_ready(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work where the session set no folder up itself."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
