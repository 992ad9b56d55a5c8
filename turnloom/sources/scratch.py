"""Shared scratch folder for written intermediate tables and checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_base(spark: SparkSession) -> str:
    """The folder the session names; a new local one only for a local-mode session without it."""
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_base(spark).rstrip('/')}/turnloom/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write the frame to the checkpoint folder, so that a lost executor cannot change it."""
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)
