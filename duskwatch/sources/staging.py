"""Cutting a plan between stages with a table in the cluster's shared folder.

A staged frame is read back from files, so losing an executor costs a re-read and not a
recomputation, every consumer shares one computation, and the optimizer knows the exact
size, which is what decides whether a join may broadcast it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from duskwatch.sources.tables import overwrite, read_path

SETTING = "spark.checkpoint.dir"
_RUN = f"staged-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session, seen by the driver and every executor.

    Where none is named, a local master (tests) gets a scratch folder.  On a cluster that
    would be a different disk on every machine, and reading it back would silently give no
    rows, so there it is an error.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="duskwatch-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` under a fresh name and read it back.

    ``folder`` overrides the session's shared folder.  All tables of one driver process lie
    under one subfolder, which ``clear_staged`` removes.
    """
    top = (folder or shared_folder(df.sparkSession)).rstrip("/")
    path = f"{top}/{_RUN}/{name}-{uuid.uuid4().hex}"
    overwrite(df, path)
    return read_path(df.sparkSession, path, schema=df.schema)


def clear_staged(spark: SparkSession, folder: str | None = None) -> bool:
    """Remove what this process staged; frames read from it cannot be used afterwards."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{(folder or shared_folder(spark)).rstrip('/')}/{_RUN}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
