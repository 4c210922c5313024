"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of reliable checkpoints: the one the cluster names in spark.checkpoint.dir.

    Only a local master, as in tests, gets a temporary folder of its own; on a cluster without the setting this raises,
    for a folder on one machine is lost with that machine.
    """
    sc = spark.sparkContext
    known = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = tempfile.mkdtemp(prefix="quirework-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read from there; survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
