"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints.

    Only where none is set does a local run get a temporary one; a cluster must name its own,
    because executors cannot see a folder of the driver's machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidymart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/tidymart/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the rows as a table in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the planner the true size,
    so a lookup is broadcast exactly when it is below the broadcast threshold of the session.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table that `written` has made and that no later step reads."""
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = fs.Path(spark._jvm.java.net.URI(folder))
        if path.getParent().getName() != "tidymart":
            raise ValueError(f"{folder} is no intermediate table")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
