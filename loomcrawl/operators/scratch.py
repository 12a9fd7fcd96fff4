"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset the session's checkpoint folder, or a temporary one if all executors are in this process, as in tests."""
    if told := spark.conf.get("spark.checkpoint.dir", None):
        return told
    sc = spark.sparkContext
    if not (told := sc.getCheckpointDir()):
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomcrawl-"))
        told = sc.getCheckpointDir()
    return told


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/loomcrawl/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: lineage ends here, and a lost executor costs a re-read, not a re-run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
