"""Cutting lineage by checkpoints in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the folder that ``spark.checkpoint.dir`` names. Where that is unset and all tasks run on
    this machine, as in tests, the folder is of our own making; elsewhere an unset folder is an error."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="sievework-"))
    return df.checkpoint()
