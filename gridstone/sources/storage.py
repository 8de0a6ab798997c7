"""Where long plans are cut, and where tables of a run are kept."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Only a local session may go without one: it gets a temporary folder."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="checkpoints-")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
